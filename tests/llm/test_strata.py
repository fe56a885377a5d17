import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_cases import FOLDER, ROWS, fold, frame

from orderlens.llm import strata


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold(text))


def brute(docs, items, k=20):
    docs = [(doc, Counter(t), len(t)) for doc, t in ((doc, terms(text)) for doc, text in docs) if t]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, tf, _ in docs for t in tf)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    wanted = {}
    for item, text in dict.fromkeys(items):
        wanted.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, asked in wanted.items():
        scored = []
        for doc, tf, n in docs:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(q * weight[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t, q in asked.items() if t in tf)
            if score > 0:
                scored.append((doc, score))
        scored.sort(key=lambda s: (-s[1], s[0] is None, s[0] or 0))
        out += [(item, rank, doc, score) for rank, (doc, score) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [
    (1, "one two three one THREE"), (1, "one two three one THREE"), (2, "the"), (2, "École x a"), (3, None), (4, ""), (None, "null z z"),
    (5, "nothing here knows"), (6, "minus"), (7, "x" * 5000), (8, "y" * 9000 + " eleven"),
]


def as_items(spark, items):
    return spark.createDataFrame([(*r, "x", "x") for r in items], "item_id long, text string, term string, score string")


def test_odd_rows_ties_repeats_and_clashing_names(spark):
    docs = [*ROWS, *((100 + i, "tie of equal texts one two") for i in range(60)), (None, "tie of equal texts one two")]
    want = brute(docs, ITEMS)
    assert found(strata.rank_documents(frame(spark, docs, ("term", "tfs", "score")), as_items(spark, ITEMS))) == want
    index = strata.stored(strata.build_index(frame(spark, docs).repartition(5)), "index")
    assert found(strata.search(index, as_items(spark, ITEMS), slice_pairs=3, block=8)) == want


def test_empty_tables(spark):
    docs, items = frame(spark, []), as_items(spark, [])
    assert strata.rank_documents(docs, as_items(spark, ITEMS)).count() == 0
    assert strata.rank_documents(frame(spark, ROWS), items).count() == 0
    assert strata.rank_documents(docs, items).count() == 0


@pytest.mark.parametrize("block, slice_pairs", [(strata.BLOCK, strata.SLICE), (2000, 300)])
def test_given_table_equals_sql(spark, block, slice_pairs):
    folder, duck = "/root/testdata/sf0.01" if block > 2000 else FOLDER, duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    want = sorted(duck.execute(strata.ORACLE).fetchall(), key=str)
    docs, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    index = strata.stored(strata.build_index(docs), "index")
    assert found(strata.search(index, items, block=block, slice_pairs=slice_pairs)) == want


def test_bounds_skip_strata_and_results_stay(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(strata, "VISIT", 8)
    n, t = 2000, 12
    m = np.sort(rng.integers(75, 600, n))
    tf = rng.integers(0, 4, (n, t))
    owner, place = np.nonzero(tf)
    weight = rng.integers(1, 5000, t)
    ids = rng.permutation(n).astype(np.int64)
    block = strata.Strata(ids, m, owner, place, tf[owner, place], weight)
    asked, repeats = np.array([0, 3, 7]), np.array([1, 2, 1])
    scored = []
    add_at = np.add.at
    counted = type("counted", (), {"at": staticmethod(lambda a, i, v: (scored.append(len(i)), add_at(a, i, v)))})
    monkeypatch.setattr(strata.np, "add", counted)
    scores, found_ids = block.search(asked, repeats, (np.zeros(0, np.int64), np.zeros(0, np.int64)), 5)
    monkeypatch.undo()
    impact = (10**9 * tf) // (1000 * tf + 12 * m[:, None])
    total = (impact[:, asked] * weight[asked] * repeats).sum(1)
    order = np.lexsort((ids, -total))[:5]
    assert (scores == total[order]).all() and (found_ids == ids[order]).all()
    assert sum(scored[1:]) < (tf[:, asked] > 0).sum() / 2  # the first call adds up bounds
