import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_cases import ROWS, crc, documents, frame, spaced

from orderlens.llm import lm
from orderlens.llm.eliasfano import EliasFano

END, BEGIN = "end of text ", "begin of text "


def brute(docs, order):
    """Contract columns and the unquantised score of every row."""
    texts = [(d, [*spaced(t), END], crc(d) % 7 == 2) for d, t in docs]
    grams = [None, *(Counter() for _ in range(order))]
    for _, w, held in texts:
        if not held:
            padded = [BEGIN] * (order - 1) + w
            for i in range(order - 1, len(padded)):
                for k in range(1, order + 1):
                    grams[k][tuple(padded[i - k + 1 : i + 1])] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    after = [None, None, *(Counter() for _ in range(order - 1))]
    for k in range(2, order + 1):
        for gram, c in grams[k].items():
            after[k][gram[:-1]] += c
    out = []
    for d, w, held in texts:
        base = sum(math.log10((grams[1][x,] + 1) / (n + v + 1)) for x in w)
        score, padded = 0.0, [BEGIN] * (order - 1) + w
        for i in range(order - 1, len(padded)):
            p = (grams[1][padded[i],] + 1) / (n + v + 1)
            for k in range(2, order + 1):
                gram = tuple(padded[i - k + 1 : i + 1])
                p = (grams[k][gram] + lm.PRIOR[k] * p) / (after[k][gram[:-1]] + lm.PRIOR[k])
            score += math.log10(p)
        out.append((str(d), held, len(w), sum(grams[1][x,] > 0 for x in w), n, base, score))
    return sorted(out)


@pytest.mark.parametrize("block", [lm.BLOCK_BYTES, 30_000])
@pytest.mark.parametrize("order", [2, 3])
def test_equals_brute_force(spark, block, order):
    docs = [*documents(), *ROWS]
    got = lm.score_documents(frame(spark, docs, ["block", "held_out"]).repartition(3), block, order).collect()
    got = sorted((str(r[0]), *r[1:]) for r in map(tuple, got))
    expected = brute(docs, order)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected])
    # codes are 0.04 apart in log10 and rounded down
    assert all(b[6] - 0.04 * (order - 1) * a[2] - 1e-6 <= a[6] <= b[6] + 1e-6 for a, b in zip(got, expected, strict=True))


def test_scores_do_not_depend_on_blocks(spark):
    docs = frame(spark, documents())
    def run(df, block):
        return sorted((tuple(r) for r in lm.score_documents(df, block).collect()), key=str)
    whole, cut = run(docs.coalesce(1), lm.BLOCK_BYTES), run(docs.repartition(4), 20_000)
    assert [r[:5] for r in whole] == [r[:5] for r in cut]
    assert [r[6] for r in whole] == pytest.approx([r[6] for r in cut], rel=1e-9)


def test_copies_gain_and_held_out_texts_do_not_lose(spark):
    docs = documents("/root/testdata/sf0.01")
    rows = [r for r in lm.score_documents(frame(spark, docs)).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_counts_above_32_bits_in_one_word_shard_only():
    """A shard with a hot word beside one without: counts and ids of both stay whole."""
    hot, many, rare = np.array([5, 9], np.uint64), (1 << 32) - 1, np.array([1 << 63, (1 << 63) + 7], np.uint64)

    def answer(shard, words, blocks):
        return lm._word_totals(lm._rows([
            (-1 - shard, block, shard, lm.WORDS, [lm.pack(words), lm.pack(np.array(c))]) for block, c in enumerate(blocks)
        ]))

    both = pa.concat_tables([answer(0, hot, [[many, 1], [many, 0]]), answer(1, rare, [[3, 0], [1, 0]])])
    sizes = both.filter(pc.equal(both["kind"], lm.SIZES))
    assert (pc.sum(sizes["tokens"]).as_py(), sizes["types"].to_pylist()) == (2 * many + 5, [2, 1])
    mine = both.filter(pc.and_(pc.equal(both["block"], 0), pc.equal(both["kind"], lm.TOTALS)))
    corpus = {"tokens": 2 * many + 5, "types": 3, "most": 2}
    mine = mine.append_column("corpus", pa.array([corpus] * 2))
    counts, ids = lm.Corpus(mine).known(mine)
    assert (counts.tolist(), ids.tolist()) == ([2 * many, 1, 4, 0], [0, 1, 2, -1])


def test_context_counts_above_32_bits_reach_the_shards():
    count, base = 5 << 32, 5
    data = [lm.pack(np.array([base])), lm.pack(np.array([1, 1])), lm.pack(np.array([count])), lm.pack(np.array([1 << 31, 1 << 31]))]
    codes = lm._answerer(2)(lm._rows([(-1, 0, 0, lm.GRAMS, data)]))["data"][0].as_py()
    assert np.allclose(lm.dequantised(np.frombuffer(codes[0], np.uint8)), (1 << 31) / count, rtol=0.1)


@pytest.mark.parametrize("top", [0, 1, 255, 256, 1 << 40, (1 << 64) - 1])
def test_packing(top):
    values = np.array([0, top // 3, top, 1 if top else 0], np.uint64)
    assert (lm.unpack(lm.pack(values)) == values).all() and len(lm.unpack(lm.pack(values[:0]))) == 0


def test_nothing_to_learn_from(spark):
    docs = [(d, t) for d, t in documents() if crc(d) % 7 == 2][:4]
    rows = lm.score_documents(frame(spark, docs), 1000).collect()
    assert len(rows) == 4 and all((r["train_tokens"], r["n_known"], r["base_score"], r["score"]) == (0, 0, 0, 0) for r in rows)
    assert lm.score_documents(frame(spark, [])).collect() == []


@pytest.mark.parametrize(("n", "universe"), [(0, 9), (1, 1), (5, 6), (1000, 50), (1000, 1 << 40), (4000, 1 << 62), (777, 10**6)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    coded = EliasFano.from_buffer(EliasFano.of(values, universe).to_bytes())
    assert (coded.values() == values).all()
    asked = np.concatenate([values, values + np.uint64(1), rng.integers(0, universe, 300, dtype=np.uint64)])
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
    assert (coded.access(np.arange(n)) == values).all()
    assert len(EliasFano.of(values, universe).to_bytes()) <= (3.5 + max(0, math.log2(universe / max(n, 1)))) * n / 8 + 80


@pytest.mark.parametrize("size", [0, 1, 600])
def test_trie_finds_n_grams_relative_to_their_context(size):
    rng = np.random.default_rng(2)
    base = 50
    pairs = np.unique(rng.integers(0, base * base, size, dtype=np.uint64))
    triples = np.unique(rng.integers(0, max(len(pairs), 1) * base, 2 * size if size else 0, dtype=np.uint64))
    share, deep, weight = (rng.uniform(1e-6, 1, n) for n in (len(pairs), len(triples), len(pairs)))
    trie = lm.Trie([pairs, triples], [lm.quantised(x) for x in (share, deep, weight)], base)
    at = trie.pairs(np.arange(base * base, dtype=np.uint64), base)
    assert (np.flatnonzero(at >= 0) == pairs).all() and (at[at >= 0] == np.arange(len(pairs))).all()
    pair = np.repeat(np.arange(-1, len(pairs)), base)
    third = np.tile(np.arange(base, dtype=np.uint64), len(pairs) + 1)
    found = trie.triples(pair, third)
    assert (np.flatnonzero(found[base:] >= 0) == triples).all() and (found[:base] == -1).all()
    assert (found[found >= 0] == np.arange(len(triples))).all()
    for kind, values in enumerate((share, deep, weight)):
        back = np.log10(lm.dequantised(trie.code(kind, np.arange(len(values)))))
        assert (back <= np.log10(values) + 1e-6).all() and (back >= np.log10(values) - 0.04).all()
