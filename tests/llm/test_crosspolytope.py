import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import crosspolytope

SCHEMA = "vec_id long, embedding array<float>, score string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], SCHEMA)


def brute(rows, k, step=20):
    """Every query's best other ids with their products."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    out = {}
    for q, x in good:
        if q % step == 0:
            scores = out.setdefault(q, {})
            for i, v in good:
                if i != q:
                    scores[i] = max(scores.get(i, -np.inf), float((x * v).sum()))
    return {q: sorted(s.items(), key=lambda c: (-c[1], c[0]))[:k] for q, s in out.items() if s}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in best}) / len(best) for q, best in want.items()])


def table(folder):
    return duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_and_exact_scores_on_the_given_table(spark, folder):
    rows = table(folder)
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    got, want = found(crosspolytope.nearest(df, F.col("vec_id") % 20 == 0)), brute(rows, 20)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, best in got.items():
        assert len(best) == 20 and best == sorted(best, key=lambda c: (-c[1], c[0])) and q not in dict(best)
        assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for i, s in best)


def test_several_polytopes_small_blocks_and_unlike_lengths(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 12))
    rows = [(i, (centres[i % 30] + 0.2 * rng.normal(size=12)) * rng.uniform(0.5, 2)) for i in range(3000)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in rows]
    got = found(crosspolytope.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 10, bucket=8, block=200, query_block=16))
    assert recall(got, brute(rows, 10)) >= 0.9


def test_all_buckets_are_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(300)]
    same = [(i, [1.0, 2.0, 0.0, 0.0, -1.0]) for i in range(1000, 1300)]
    odd = [(400, None), (420, [0.0] * 5), (440, [1.0, None, 1.0, 1.0, 1.0]), (460, [float("nan")] * 5), (480, [float("inf")] + [1.0] * 4),
           (None, [1.0] * 5), (500, [2.0, 3.0]), (500, [2.0, 3.0]), (520, []), (540, [3.0] * 5), (540, [-3.0] * 5), (541, [3.0] * 5), (541, [-2.0] * 5)]
    rows += same + odd
    got = found(crosspolytope.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 7, block=64, query_block=4, probes=1 << 20))
    assert got == brute(rows, 7)


def test_few_candidates_and_short_queries_get_all(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=9).astype(np.float32).tolist()) for i in range(15)]
    assert found(crosspolytope.nearest(frame(spark, rows), F.col("vec_id") % 5 == 0)) == brute(rows, 20, 5)
    rows = [(i, rng.normal(size=9).astype(np.float32).tolist()) for i in range(60)]
    got = found(crosspolytope.nearest(frame(spark, rows), F.col("vec_id") % 5 == 0, probes=1))
    assert all(len(best) == 20 for best in got.values()) and got.keys() == brute(rows, 20, 5).keys()


def test_empty_and_single(spark):
    assert crosspolytope.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert crosspolytope.nearest(frame(spark, [(20, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_hadamard_keeps_products_and_probes_come_in_order():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 16))
    turned = crosspolytope.hadamard(x)
    assert np.allclose(turned @ turned.T, x @ x.T)
    hasher = crosspolytope.Hasher(10, 4.0, [16, 4])
    vectors, query = rng.normal(size=(50, 10)) / 4, rng.normal(size=(1, 10))
    depth = np.full(50, hasher.buckets)
    for t in range(hasher.tables):
        first, second = hasher.coordinates(query, t, True)
        total = (first[0][:, None] + second[0]).ravel()
        probed = hasher.probes(query, t, 20)[0]
        assert np.allclose(np.sort(total[probed]), np.sort(total)[-20:]) and len(set(probed)) == 20
        depth = np.minimum(depth, [(total >= total[c] - 1e-12).sum() - 1 for c in hasher.codes(vectors, t)])
    assert (hasher.depth(query[0], vectors) == depth).all()
