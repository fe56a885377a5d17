import math

import duckdb
import numpy as np
import pytest
from llm_cases import FOLDER
from pyspark.sql import functions as F

from orderlens.llm import queries, topk


@pytest.mark.parametrize("sizes", [(topk.BLOCK, topk.QUERY_BLOCK, topk.STEP), (64, 8, 16)])
def test_equals_sql(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK", "QUERY_BLOCK", "STEP"), sizes, strict=True):
        monkeypatch.setattr(topk, name, size)
    df = queries.op2_exact_topk(spark, FOLDER)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    expected = duck.execute(f"SELECT {', '.join(df.columns)} FROM ({topk.ORACLE})").fetchall()
    assert expected and sorted(map(tuple, df.collect())) == sorted(expected)


def brute(rows, k):
    fine = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    best = {}
    for q, v in fine:
        if q % 20 == 0:
            own = best.setdefault(q, {})
            for i, w in fine:
                if i != q:
                    score = sum(a * b for a, b in zip(v, w, strict=False))
                    own[i] = max(score, own.get(i, score))
    for q, own in best.items():
        scores = sorted((-s, i) for i, s in own.items())
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -2.0, 0.5]), (20, [0.0, 0.0, 0.0]), (40, [3.0]), (-20, []), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf]),
        (80, [1.0, 1.0]), (80, [-2.0, 1.0]), (81, [2.0]), (81, [-1.0]), (None, [1.0, 1.0]), (5, [1.0, -2.0, 0.5]), (6, [1.0, -2.0, 0.5]), (6, [1.0, -2.0, 0.5]), (7, [-1.0, 2.0]), (60, None),
        *((100 + i, [0.3 * i, -0.1 * i, 0.01]) for i in range(1, 30)), *((200 + i, [1.0, -2.0, 0.5]) for i in range(1, 19)),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, block string")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for k in (3, 20, 100):
        got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect()))
        assert got == brute(single, k)


def test_scores_above_2_to_the_53_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [int(x) / 64 for x in rng.integers(1 << 28, 1 << 29, 3)]) for i in range(60)]
    rows = [(i, [*v, float(i % 3) / 64]) for i, v in rows] + [(100 + i, rows[1][1] + [0.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, 5).collect()))
    assert got == brute(rows, 5) and min(r[3] for r in got) > 1 << 53


def test_cells_that_lengths_rule_out_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    kept, plain = [], topk.stored
    monkeypatch.setattr(topk, "stored", lambda df, name: (kept.append(plain(df, name)), kept[-1])[1])
    rng = np.random.default_rng(5)

    def cells(n, falling):
        kept.clear()
        v = rng.normal(size=(n, 8))
        v /= np.linalg.norm(v, axis=1)[:, None] * (1 + np.arange(n) if falling else np.ones(n))[:, None] / 100
        rows = [(i, x.tolist()) for i, x in enumerate(v)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, 5)
        cells = sum(c.count() for c in kept)
        assert sorted(map(tuple, got.collect())) == brute(rows, 5)
        return cells

    assert cells(600, True) < cells(600, False) / 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).collect() == []
    df = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).collect() == []
