"""Conversation structure repair by a suffix-shared automaton (DAWG) over role/fault signatures.

A conversation's rows become one symbol each: its role's initial and whether it is truncated, or one symbol for rows
that must go (blank or duplicate). Signatures are kept last symbol first and sorted, so all conversations with the same
ending stand together. A node of the minimised automaton is a distinct ending; walking the sorted signatures with a stack
visits each node once, however many conversations share it, and only the endings on a border between two tasks twice.
A node holds, for every state of the grammar ``(s?(ua)+)?``, the cost to go and the first edit of the best audit; the
rest of that audit is the node's successor. The four edits have different initials, so among equal costs the least
initial is the least audit.

Edits: Keep (0), Rerole to user or assistant (1), Delete (2), Insert an empty user or assistant (5); a truncated row
that stays adds 5. Rows of one conversation meet one task in a sort that may spill and are streamed: the digest of
the repaired text is sequential by nature. That task holds one symbol a row, in the way the audit does.

Defined cases: a null role or text is one space; rows go by turn, nulls first, then the role's initial, then a digest of the
row, so equal rows stand together; rows without conv_id form one conversation under null; a role whose initial is not s, u or a
(the empty role too) cannot be kept; a text of any length is judged whole; a conversation without rows gives zeros, an
empty audit and the digest of the empty text; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

START, SYSTEM, USER, ASSISTANT = range(4)
TURN_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
KEEP = {(START, SYSTEM): SYSTEM, (START, USER): USER, (SYSTEM, USER): USER, (USER, ASSISTANT): ASSISTANT, (ASSISTANT, USER): USER}
NEXT = (USER, USER, ASSISTANT, USER)  # the role that a state can always go on with
NAME = {USER: "user", ASSISTANT: "assistant"}
FINAL = (START, ASSISTANT)
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
MUST_GO = 8  # symbols 0 to 3 are whole rows of no known role, s, u, a; 4 to 7 truncated ones

FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal")
SIGNED = "conv_id bigint, ending binary, " + ", ".join(f"{c} bigint" for c in FIGURES)
AUDITED = SIGNED + ", cost bigint, audit string"
REPORT = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in FIGURES) + ", cost bigint, audit string, repaired_sha256 string"
REPAIRED = "conv_id bigint, place bigint, edit string, role string, text string"


class Automaton:
    """The grammar's costs to go, folded into profiles: costs relative to the cheapest state.

    A node's profile follows from its successor's profile and its symbol alone, so each pair is worked out once.
    """

    def __init__(self):
        self.profiles: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int, str]] = {}
        self.end = self._close([(0, "") if state in FINAL else (1 << 30, "") for state in range(4)])

    def _close(self, best: list[tuple[int, str]]) -> tuple[int, int, str]:
        """Profile, added cost and the states' first edits (blank: none) after all useful insertions."""
        for _ in range(3):
            best = [min(best[state], (COSTS["I"] + best[NEXT[state]][0], "I")) for state in range(4)]
        least = min(cost for cost, _ in best)
        profile = tuple(cost - least for cost, _ in best)
        if profile not in self.number:
            self.number[profile] = len(self.profiles)
            self.profiles.append(profile)
        return self.number[profile], least, "".join(edit or " " for _, edit in best)

    def step(self, profile: int, symbol: int) -> tuple[int, int, str]:
        """The node before one of ``profile`` when it reads ``symbol``."""
        found = self.steps.get((profile, symbol))
        if found is None:
            after, best = self.profiles[profile], []
            for state in range(4):
                choices = [(COSTS["D"] + after[state], "D")]
                if symbol != MUST_GO:
                    extra = TRUNCATED_COST if symbol >= 4 else 0
                    choices.append((COSTS["R"] + extra + after[NEXT[state]], "R"))
                    kept = KEEP.get((state, symbol % 4))
                    if kept is not None:
                        choices.append((COSTS["K"] + extra + after[kept], "K"))
                best.append(min(choices))
            found = self.steps[profile, symbol] = self._close(best)
        return found


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Walk:
    """Audits of signatures (last symbol first) in sorted order; the stack holds the nodes of the current ending."""

    def __init__(self):
        self.automaton = Automaton()
        profile, cost, edits = self.automaton.end
        self.ending, self.nodes, self.costs, self.edits, self.made = b"", [profile], [cost], [edits], 1
        self.answer: tuple[int, str] | None = None

    def audit(self, ending: bytes) -> tuple[int, str]:
        """Cost and best audit of a whole signature."""
        if self.answer and ending == self.ending:
            return self.answer
        keep = shared(self.ending, ending)
        del self.nodes[keep + 1 :], self.costs[keep + 1 :], self.edits[keep + 1 :]
        for symbol in ending[keep:]:
            profile, added, edits = self.automaton.step(self.nodes[-1], symbol)
            self.nodes.append(profile)
            self.costs.append(self.costs[-1] + added)
            self.edits.append(edits)
        self.made += len(ending) - keep
        self.ending = ending
        at, state, audit = len(ending), START, []
        while (edit := self.edits[at][state]) != " ":
            audit.append(edit)
            if edit == "K":
                state = KEEP[state, ending[at - 1] % 4]
            elif edit != "D":
                state = NEXT[state]
            at -= edit != "I"
        profile = self.automaton.profiles[self.nodes[-1]]
        self.answer = self.costs[-1] + profile[START], "".join(audit)
        return self.answer


def _runs(ids: pa.Array) -> list[tuple[int | None, int, int]]:
    """Value, begin and end of the runs of equal ids in a batch."""
    values, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((values[1:] != values[:-1]) | (null[1:] != null[:-1])) + 1
    bounds = [0, *cut.tolist(), len(values)]
    return [(None if null[a] else int(values[a]), a, b) for a, b in zip(bounds, bounds[1:], strict=False) if b > a]


class _Signature:
    """What is gathered of one conversation's rows."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols = conv_id, bytearray()
        self.low = self.high = self.turn = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, row: bytes, role: str, fault: str | None, again: bool) -> None:
        again = again or row == self.last
        if fault == "blank":
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif fault:
            self.truncated += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        role_number = TURN_OF.get(role, START)
        if self.last is not None:
            self.illegal += not (self.turn != START and KEEP.get((self.turn, role_number)) is not None)
        self.turn, self.last = role_number, row
        self.symbols.append(MUST_GO if again or fault == "blank" else role_number + (4 if fault else 0))

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, bytes(reversed(self.symbols)), gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SIGNED = pa.schema([("conv_id", pa.int64()), ("ending", pa.binary()), *((c, pa.int64()) for c in FIGURES)])
_AUDITED = pa.schema([*_SIGNED, ("cost", pa.int64()), ("audit", pa.string())])
_REPORT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in FIGURES), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One signature per conversation from rows in order."""
    current: _Signature | None = None
    for batch in batches:
        done = []
        for conv_id, a, b in _runs(batch.column(0)):
            if current is None or current.conv_id != conv_id:
                if current:
                    done.append(current.row())
                current = _Signature(conv_id)
            part = batch.slice(a, b - a)
            for present, *row in zip(*(part.column(i).to_pylist() for i in range(1, 7)), strict=True):
                if present:
                    current.add(*row)
        yield _table(done, _SIGNED)
    if current:
        yield _table([current.row()], _SIGNED)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of sorted signatures."""
    walk = Walk()
    for batch in batches:
        found = [walk.audit(ending) for ending in batch.column(1).to_pylist()]
        cost, audit = [c for c, _ in found], [a for _, a in found]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cost, pa.int64()), pa.array(audit, pa.string())], schema=_AUDITED)


class _Edits:
    """An audit applied to rows as they come; ``take`` gives the edited rows (edit, role, text)."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield "I", NAME[self.state], ""

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = TURN_OF[role[:1]]
            yield edit, role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield edit, NAME[self.state], text


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple | None, list[tuple[str, str, str]]]]:
    """For each conversation its head, then pieces of its edited rows, then the rows inserted at its end with no head."""
    edits: _Edits | None = None
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        for i, audit in enumerate(columns["audit"]):
            if audit is not None:
                if edits:
                    yield None, list(edits.inserted())
                edits = _Edits(audit)
                yield (columns["conv_id"][i], *(columns[c][i] for c in FIGURES), columns["cost"][i], audit), []
            elif columns["present"][i]:
                yield None, list(edits.take(columns["role"][i], columns["text"][i]))
    if edits:
        yield None, list(edits.inserted())


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head, digest, first, done = None, None, True, []
    for new, rows in _edited(batches):
        if new is not None:
            if head is not None:
                done.append((*head, digest.hexdigest()))
            head, digest, first = new, hashlib.sha256(), True
            if len(done) >= 1000:
                yield _table(done, _REPORT)
                done = []
        for _, role, text in rows:
            digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
    if head is not None:
        done.append((*head, digest.hexdigest()))
    yield _table(done, _REPORT)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_id, place, done = None, 0, []
    for new, rows in _edited(batches):
        if new is not None:
            conv_id, place = new[0], 0
        for edit, role, text in rows:
            done.append((conv_id, place, edit, role, text))
            place += 1
        if len(done) >= 1000:
            yield _table(done, _REPAIRED)
            done = []
    yield _table(done, _REPAIRED)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) after damage by the checksum of ``conv_id:turn``, modulo 20.

    0 drops the row (it stays with ``present`` false, so that its conversation is known), 1 empties its text, 2 removes
    the marks at which a sentence ends, 3 repeats it, 4 makes it a user's.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")), F.lit(20))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ENDS, "")).otherwise(text("text")).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _keyed(turns: DataFrame) -> DataFrame:
    """Rows with ``same``, a digest equal only for rows of one conversation with equal role and text."""
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"),
    )
    whole = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.length("role").cast("string"), "role", "text")
    return rows.withColumn("same", F.unhex(F.sha2(whole, 256)))


def audits(turns: DataFrame) -> DataFrame:
    """``AUDITED``: figures, cost and best audit of every conversation. The signatures are stored when this is called."""
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(core == "", "blank").when(~F.right(core, F.lit(1)).isin(*ENDS), "truncated")
    rows = _keyed(turns).select("conv_id", "turn", "same", F.left("role", F.lit(1)).alias("role"), fault.alias("fault"), "present")
    when = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    firsts = rows.filter("present").groupBy("same").agg(F.min(when).alias("first"))  # combined before it moves
    rows = rows.join(firsts, "same", "left").select(
        "conv_id", "present", "turn", "same", "role", "fault", (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("again")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "same")
    signed = stored(rows.mapInArrow(_sign, SIGNED), "signatures")
    return signed.repartitionByRange("ending", "conv_id").sortWithinPartitions("ending").mapInArrow(_audit, AUDITED)


def _with_audits(turns: DataFrame) -> DataFrame:
    """Every conversation's audit before its rows, sorted in one partition per conversation."""
    heads = audits(turns).drop("ending")
    both = heads.unionByName(_keyed(turns), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc_nulls_last("audit"), F.asc_nulls_first("turn"), F.left("role", F.lit(1)), "same"
    )


def repair_conversations(turns: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, place, edit, role, text) of ``turns`` (conv_id, turn, role, text)."""
    return _with_audits(turns).mapInArrow(_rows, REPAIRED)


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of the cheapest repair, and the repaired text's digest."""
    return _with_audits(turns).mapInArrow(_digest, REPORT)
