import random

import pytest
from llm_cases import ROWS, documents, frame, shingle_components, spaced

from orderlens.llm import components, jaccard


def near_copies():
    """Groups of near copies around the threshold, chains, and a passage that many texts share."""
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(120)]
        for copy in range(14):
            own = list(base)
            for _ in range(copy % 7):
                own[draw.randrange(120)] = f"n{draw.randrange(9)}"
            docs.append((10_000 + 100 * group + copy, " ".join(own)))
    docs += [(11_000 + i, f"{passage} " + " ".join(f"d{i}x{j}" for j in range(10 + i))) for i in range(25)]
    return docs + [(12_000 + i, " ".join(f"c{j}" for j in range(i * 4, i * 4 + 90))) for i in range(12)]


@pytest.mark.parametrize("tile", [jaccard.TILE, 3])
def test_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    docs = [*documents(), *near_copies(), *ROWS]
    got = jaccard.jaccard_classes(frame(spark, docs, ["n", "node"])).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == shingle_components(docs)


def brute_links(docs):
    """(doc_id, number of other rows that link) of every row."""
    sets = []
    for _, text in docs:
        w = spaced(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [sum(100 * len(s & t) >= 80 * len(s | t) for j, t in enumerate(sets) if i != j) if s else 0 for i, s in enumerate(sets)]
    return sorted(((d, n) for (d, _), n in zip(docs, links, strict=True)), key=str)


@pytest.mark.parametrize(("tile", "dense"), [(jaccard.TILE, jaccard.DENSE), (3, jaccard.DENSE), (5, 1)])
def test_counts_every_link(spark, monkeypatch, tile, dense):
    """Also the links inside a component: three near copies of each other have two each."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "DENSE", dense)
    copies = near_copies()
    long = [(20_000 + i, " ".join(f"l{j}" if j % 300 or i % 4 else f"m{i}x{j}" for j in range(20 * i, 950 + 60 * i))) for i in range(12)]
    docs = [*documents()[:200], *copies, *copies[20:24], *long, (None, copies[3][1]), *ROWS]
    got = sorted((tuple(r) for r in jaccard.jaccard_classes(frame(spark, docs)).select("doc_id", "n_links").collect()), key=str)
    assert got == brute_links(docs)
    assert max(n for _, n in got) > 4


def test_one_of_each_keeps_rows_and_columns(spark):
    docs = [*near_copies(), *ROWS]
    df = frame(spark, docs, ["row_key", "component"])
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    worded = {c for d, n, c in shingle_components([(i, t) for i, (_, t) in enumerate(docs)]) if n}
    wordless = sum(not (t or "").split() for _, t in docs)
    result = kept.collect()
    assert len(result) == len(worded) + wordless
    ids = [r["doc_id"] for r in result]
    assert all(ids.count(c) == 1 for d, n, c in shingle_components(near_copies()))


def test_bounds():
    for nx in range(1, 40):
        for ny in range(nx, 60):
            least = min((k for k in range(nx + 1) if 100 * k >= 80 * (nx + ny - k)), default=None)
            if least is None:
                assert jaccard.needed(nx, ny) > nx
            else:
                assert jaccard.needed(nx, ny) == least and jaccard.prefix_size(nx) >= nx - least + 1


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(60, 90)] + [(draw.randrange(40), draw.randrange(40)) for _ in range(25)] + [(5, 5)]
    parent = list(range(100))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, root(i)) for i in range(100) if root(i) != i}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_tables(spark):
    assert jaccard.jaccard_classes(frame(spark, [])).collect() == []
    rows = jaccard.jaccard_classes(frame(spark, [(1, None), (2, ""), (None, " ")])).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows) == [("1", 0, "1"), ("2", 0, "2"), ("None", 0, "None")]
