import hashlib
import re
import zlib
from itertools import product

import pytest
from llm_cases import FOLDER, rows
from pyspark.sql import functions as F

from orderlens.llm import repair

LETTER = {"user": "u", "assistant": "a"}
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damaged(conversations):
    """Rows after damage by conversation, in order, and every conversation's id."""
    out = {}
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    def order(conv):
        def key(row):
            whole = f"{'-' if conv is None else conv}:{len(row[1])}:{row[1]}:{row[2]}"
            return row[0] is not None, row[0] or 0, row[1][:1], hashlib.sha256(whole.encode()).digest()
        return key
    return {conv: sorted(kept, key=order(conv)) for conv, kept in out.items()}


def faults(kept):
    out, seen = [], set()
    for _, role, text in kept:
        core = re.findall(r"[^\x20\x09-\x0D]", text)
        if not core:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(kept, fault):
    """Cost, audit and text of the best repair: forward over rows with the best (cost, audit) of every last initial."""
    best = {"": (0, "", ())}

    def offer(into, state, cost, audit, text):
        if state is not None and (state not in into or (cost, audit) < into[state][:2]):
            into[state] = (cost, audit, text)

    def insert(into):
        for _ in range(4):
            for state, (cost, audit, text) in list(into.items()):
                for name, letter in LETTER.items():
                    offer(into, STEP.get((state, letter)), cost + 5, audit + "I", (*text, f"{name}:"))

    for (_, role, text), wrong in zip(kept, fault, strict=True):
        insert(best)
        then = {}
        for state, (cost, audit, done) in best.items():
            offer(then, state, cost + 2, audit + "D", done)
            if wrong not in ("blank", "duplicate"):
                more = 5 if wrong else 0
                offer(then, STEP.get((state, role[:1])), cost + more, audit + "K", (*done, f"{role}:{text}"))
                for name, letter in LETTER.items():
                    offer(then, STEP.get((state, letter)), cost + more + 1, audit + "R", (*done, f"{name}:{text}"))
        best = then
    insert(best)
    return min(best[s] for s in ("", "a") if s in best)


def report(conversations):
    out = []
    for conv, kept in damaged(conversations).items():
        fault = faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, text = cheapest(kept, fault)
        digest = hashlib.sha256("\n".join(text).encode()).hexdigest()
        out.append((conv, gaps, *map(fault.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def found(df):
    names = "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_report_equals_brute_force(spark, folder):
    conversations = rows("conversations", "conv_id, turn, role, text", folder)
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    assert found(repair.repair_report(repair.damage(df))) == report(conversations)


ODD = [
    (1, None, None, None), (1, 2, "user", "a."), (1, 2, "user", "a."), (1, 2, "assistant", "b. \n"), (1, 5, "assistant", "b."),
    (None, 1, "user", "x!"), (None, None, "tool", "?"), (2, 1, "", "x."), (2, 2, "system", "y"), (2, 3, "s", "z?"),
    (3, -4, "user", "long " * 40_000), (3, 9, "assistant", "\x0b"), (3, 9, "User", "é."), *((4, t, "user", "again.") for t in range(300)),
    *((c, 0, "user", "q") for c in range(100, 160)), *((c, 1, "assistant", "r.") for c in range(100, 130)),
]


def test_odd_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(*r, "x", "x") for r in ODD], "conv_id long, turn long, role string, text string, same string, audit string")
    assert found(repair.repair_report(repair.damage(df))) == report(ODD)


def test_empty_table_and_conversations_without_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair_report(repair.damage(spark.createDataFrame([], schema))).count() == 0
    gone = next(t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    only = repair.repair_report(repair.damage(spark.createDataFrame([(7, gone, "user", "x.")], schema))).collect()
    assert [tuple(r) for r in only] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark):
    turns = [(1, 1, "user", "Hi."), (1, 2, "user", "You?"), (1, 3, "assistant", "cut"), (2, 1, "assistant", "Yes.")]
    df = repair.repair_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, df.collect())) == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "You?")]


def test_every_short_signature_equals_brute_force_and_nodes_are_shared():
    symbols = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    cases = []
    for n in range(5):
        for roles in product("suao", repeat=n):
            for marks in product("K.x" if n < 4 else "K.", repeat=n):
                kept = [(i, symbols[r], "" if m == "x" else f"{i}" if m == "." else f"{i}.") for i, (r, m) in enumerate(zip(roles, marks, strict=True))]
                signature = bytes(
                    repair.MUST_GO if m == "x" else repair.TURN_OF.get(r, 0) + (4 if m == "." else 0) for r, m in zip(roles, marks, strict=True)
                )
                cases.append((signature[::-1], kept))
    walk = repair.Walk()
    for ending, kept in sorted(cases, key=lambda c: c[0]):
        assert walk.audit(ending) == cheapest(kept, faults(kept))[:2]
    assert walk.made == len({ending[:i] for ending, _ in cases for i in range(len(ending) + 1)})


def test_long_conversation(spark):
    n = 30_000
    turns = spark.range(n).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id"), F.lit(".")).alias("text"),
    )
    row = repair.repair_report(turns).first()
    assert (row["cost"], row["audit"]) == (0, "K" * n)
