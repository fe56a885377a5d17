import zlib
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ROWS, documents, frame

from orderlens.llm import sharding


def brute_capacity(sizes, shards):
    best = sum(sizes)
    for k in range(min(shards, len(sizes))):
        for cuts in combinations(range(1, len(sizes)), k):
            edges = [0, *cuts, len(sizes)]
            best = min(best, max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)))
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
def test_cuts_reach_the_smallest_capacity(sizes, shards):
    out = sharding.contiguous_shards(sizes, shards)
    assert out == sorted(out) and max(out) < shards
    largest = max(sum(s for s, o in zip(sizes, out, strict=True) if o == k) for k in set(out))
    assert sharding.smallest_capacity(sizes, shards) == brute_capacity(sizes, shards) >= largest


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 50), min_size=1, max_size=4), min_size=1, max_size=5), st.integers(1, 5))
def test_splitting_ends_with_the_smallest_capacity_of_the_groups(ranges, shards):
    want = brute_capacity([s for r in ranges for s in r], shards)
    parts = [tuple(r) for r in ranges]
    while True:
        sizes, whole = [sum(p) for p in parts], [len(p) == 1 for p in parts]
        assert sharding.relaxed_capacity(sizes, whole, shards) <= want <= sharding.smallest_capacity(sizes, shards)
        wide = sharding.undecided(sizes, whole, shards)
        if not wide:
            break
        assert all(not whole[i] for i in wide)
        parts = [q for i, p in enumerate(parts) for q in ((p[: len(p) // 2], p[len(p) // 2 :]) if i in wide else (p,))]
    assert sharding.smallest_capacity(sizes, shards) == want


def test_capacity_is_exact_for_groups_whatever_the_ranges(spark, monkeypatch):
    docs = documents("/root/testdata/sf0.001") + [(None, "one group of some size " * 40)] * 30
    loads = {}
    for ranges in (4, 1 << 16):
        monkeypatch.setattr(sharding, "RANGES", ranges)
        result = sharding.shard_documents(frame(spark, docs), 6).collect()
        check(docs, result, 6)
        loads[ranges] = max(sum(r["size"] for r in result if r["shard"] == k) for k in range(6))
    hashed = frame(spark, docs).selectExpr("xxhash64(coalesce(text, '')) h", "octet_length(coalesce(text, '')) + 8 s").groupBy("h").sum("s")
    sizes = [r[1] for r in sorted(map(tuple, hashed.collect()))]
    best = sharding.smallest_capacity(sizes, 6)
    assert loads[4] <= best and loads[1 << 16] <= best


def check(docs, result, shards):
    assert len(result) == len(docs)
    expected = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in result) == expected
    slots, of_text = {}, {}
    for r in result:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert of_text.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_documents(spark):
    docs = documents("/root/testdata/sf0.01")
    result = sharding.shard_documents(frame(spark, docs)).collect()
    check(docs, result, 24)
    load = [sum(r["size"] for r in result if r["shard"] == k) for k in range(24)]
    assert max(load) < 1.2 * sum(load) / 24


def test_hot_group_and_odd_rows(spark):
    docs = [*ROWS, *((1000 + i, "the same text " * 20) for i in range(300))]
    check(docs, sharding.shard_documents(frame(spark, docs, ["range", "salt", "n", "hash", "copies"]), 5).collect(), 5)


def test_empty_table(spark):
    assert sharding.shard_documents(frame(spark, [])).collect() == []


def test_main_path_is_native(spark):
    plan = sharding.shard_documents(frame(spark, ROWS[3:6])).select("slot")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow"))
