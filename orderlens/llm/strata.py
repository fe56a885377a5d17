"""Ranked lexical search over a length-stratified index.

The index holds every document's distinct terms with their frequencies (tf) and its length n, stored once. With N documents
and L terms in all, a document's normaliser is m = 75 + (25 * n * N) div L. A task takes index rows in blocks, groups the
documents of equal m into strata and orders a term's postings by stratum, then tf. An impact depends on (m, tf) alone and
is computed once for each such pair. A stratum's bound for an item adds up, over the item's terms, the impact of the
highest tf there; strata are visited by falling bound until the bound falls below the k-th best score so far, which a
task carries from block to block. Documents never move: a task returns k rows per item.

Items are broadcast in slices of at most ``SLICE`` distinct (item, term) pairs, or one item if it alone has more; each slice is
searched and stored before the next is read, so driver and executors hold one slice at a time.

Score of a document: over the item's terms, repeats included, the sum of w * ((10^9 * tf) div (1000 * tf + 12 * m)) with
w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))).

Defined cases: a null text and a text without terms count nowhere; repeated documents are documents of their own;
documents without an id are ranked after others of equal score; equal item rows count once, unlike texts of one item_id
are one item, rows without item_id too; items without any scoring document give no rows; terms are told apart by 64-bit
hashes; a text of any length is indexed whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import ALNUM, Words, text_slices

SLICE = 1 << 20  # (item, term) pairs that are broadcast at once
BLOCK = 1 << 20  # postings of item terms that a task holds at once
VISIT = 256  # documents that are scored between two looks at the bound

INDEX = "doc_id bigint, n bigint, terms array<bigint>, tfs array<int>"
FOUND = "item int, doc_id bigint, score bigint"
RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"

_NO_ID = np.iinfo(np.int64).max


def _counted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each row's number of terms and of distinct terms, then the distinct terms and their frequencies, row after row."""
    words = Words(data, offsets, ALNUM)
    n = np.diff(words.first)
    row, term = words.rows(), words.hashes().view(np.int64)
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(term), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    return n, np.bincount(row[first], minlength=len(n)), term[first], np.diff(np.append(first, len(term)))


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), values)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_slices(batches, "text"):
        n, sizes, terms, tfs = _counted(data, offsets)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n), _lists(pa.array(terms), sizes), _lists(pa.array(tfs.astype(np.int32)), sizes)],
            names=["doc_id", "n", "terms", "tfs"],
        ).filter(pa.array(n > 0))


def build_index(docs: DataFrame) -> DataFrame:
    """``INDEX`` rows of ``docs`` (doc_id, text) that have terms."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_index, INDEX)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, repeats) of ``items`` (item_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, "text"):
            _, sizes, terms, tfs = _counted(data, offsets)
            owner = rows.column(0).take(pa.array(np.repeat(np.arange(rows.num_rows), sizes)))
            yield pa.RecordBatch.from_arrays([owner, pa.array(terms), pa.array(tfs)], names=["item_id", "term", "repeats"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    found = rows.mapInArrow(run, "item_id bigint, term bigint, repeats bigint")
    return found.groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


@dataclass
class Slice:
    """Items as rows of (term place, repeats), the distinct terms in order, and what the corpus says of them."""

    ids: list[int | None]
    first: np.ndarray
    place: np.ndarray
    repeats: np.ndarray
    terms: np.ndarray
    weight: np.ndarray
    documents: int = 0
    tokens: int = 1

    @classmethod
    def of(cls, rows: list[tuple]) -> Slice:
        """``rows``: (item_id, term, repeats)."""
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        ids = list(dict.fromkeys(r[0] for r in rows))
        number = {item: i for i, item in enumerate(ids)}
        terms, place = np.unique(np.array([r[1] for r in rows], np.int64), return_inverse=True)
        first = np.searchsorted(np.array([number[r[0]] for r in rows], np.int64), np.arange(len(ids) + 1))
        return cls(ids, first, place, np.array([r[2] for r in rows], np.int64), terms, np.zeros(len(terms), np.int64))


def _places(terms: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The place of each found term among the sorted ``terms``, -1 if it is none of them."""
    at = np.minimum(np.searchsorted(terms, found), max(len(terms) - 1, 0))
    return np.where(terms[at] == found, at, -1) if len(terms) else np.full(len(found), -1)


class Strata:
    """A block of documents grouped by equal m; postings by term, stratum and tf.

    A run is the postings of one term in one stratum; ``highest`` is the impact of its highest tf, times the term's weight.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, owner: np.ndarray, place: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        self.ids = ids
        m, self.stratum = np.unique(m, return_inverse=True)
        self.size = np.bincount(self.stratum, minlength=len(m))
        order = np.lexsort((tf, self.stratum[owner], place))
        owner, place, tf = owner[order], place[order], tf[order].astype(np.int64)
        stratum = self.stratum[owner]
        both, which = np.unique(stratum * (int(tf.max(initial=0)) + 1) + tf, return_inverse=True)
        levels, frequency = np.divmod(both, int(tf.max(initial=0)) + 1)
        impact = (1_000_000_000 * frequency) // (1000 * frequency + 12 * m[levels])  # once per (m, tf)
        self.owner, self.gain = owner, impact[which] * weight[place]
        new = np.ones(len(owner), bool)
        new[1:] = (place[1:] != place[:-1]) | (stratum[1:] != stratum[:-1])
        begin = np.flatnonzero(new)
        self.begin, self.end = begin, np.append(begin[1:], len(owner)).astype(np.int64)
        self.run_stratum, self.highest = stratum[begin], self.gain[self.end - 1]
        self.run_of_term = np.searchsorted(place[begin], np.arange(len(weight) + 1))

    def search(self, place: np.ndarray, repeats: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best k (scores, ids) of an item among its ``best`` so far and this block."""
        sizes = self.run_of_term[place + 1] - self.run_of_term[place]
        runs = np.repeat(self.run_of_term[place] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        times = np.repeat(repeats, sizes)
        bound = np.zeros(len(self.size), np.int64)
        np.add.at(bound, self.run_stratum[runs], times * self.highest[runs])
        visits = np.argsort(-bound, kind="stable")
        visits = visits[: int((bound > 0).sum())]
        batch = np.cumsum(self.size[visits]) // VISIT  # strata that are scored together
        turn = np.full(len(self.size), -1)
        turn[visits] = batch
        by_turn = np.argsort(turn[self.run_stratum[runs]], kind="stable")
        runs, times = runs[by_turn], times[by_turn]
        run_turn = turn[self.run_stratum[runs]]
        score = np.zeros(len(self.ids), np.int64)
        scores, ids = best
        for step in np.unique(batch):
            at = np.searchsorted(batch, step)
            if len(scores) == k and bound[visits[at]] < scores[-1]:
                break
            here = slice(*np.searchsorted(run_turn, [step, step + 1]))
            length = self.end[runs[here]] - self.begin[runs[here]]
            posting = np.repeat(self.begin[runs[here]] - np.cumsum(length) + length, length) + np.arange(length.sum())
            np.add.at(score, self.owner[posting], np.repeat(times[here], length) * self.gain[posting])
            docs = np.unique(self.owner[posting])
            docs = docs[score[docs] >= (scores[-1] if len(scores) == k else 1)]
            scores, ids = np.concatenate([scores, score[docs]]), np.concatenate([ids, self.ids[docs]])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
        return scores, ids


def _frequencies(index: DataFrame, part: Slice) -> np.ndarray:
    """In how many documents each term of the slice occurs."""
    shared = index.sparkSession.sparkContext.broadcast(part.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            place = _places(shared.value, batch.column(0).flatten().to_numpy())
            total += np.bincount(place[place >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "df"])

    out = np.zeros(len(part.terms), np.int64)
    counts = index.select("terms").mapInArrow(count, "place bigint, df bigint").groupBy("place").agg(F.sum("df").alias("df"))
    for place, df in counts.collect():  # the slice's terms at most
        out[place] = df
    shared.destroy()
    return out


def _search_slice(index: DataFrame, part: Slice, k: int, block: int) -> DataFrame:
    """``FOUND``: every task's best k of each item of the slice."""
    shared = index.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in part.ids]
        held: list[tuple] = []

        def flush() -> None:
            ids, n, size, place, tf = (np.concatenate(c) for c in zip(*held, strict=True))
            m = 75 + (25 * n * part.documents) // part.tokens
            strata = Strata(ids, m, np.repeat(np.arange(len(ids)), size), place, tf, part.weight)
            for i in range(len(best)):
                own = slice(part.first[i], part.first[i + 1])
                best[i] = strata.search(part.place[own], part.repeats[own], best[i], k)
            held.clear()

        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            place = _places(part.terms, batch.column(2).flatten().to_numpy())
            owner = np.repeat(np.arange(len(ids)), batch.column(2).value_lengths().to_numpy())
            known = place >= 0
            size = np.bincount(owner[known], minlength=len(ids))
            tf = batch.column(3).flatten().to_numpy()[known]
            some = size > 0
            if not some.any():
                continue
            held.append((ids[some], batch.column(1).to_numpy()[some], size[some], place[known], tf))
            if sum(len(h[3]) for h in held) >= block:
                flush()
        if held:
            flush()
        item = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
        score, ids = (np.concatenate([b[j] for b in best]) if best else np.zeros(0, np.int64) for j in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(ids, mask=ids == _NO_ID), pa.array(score)], names=["item", "doc_id", "score"]
        )

    names = index.sparkSession.createDataFrame(list(enumerate(part.ids)), "item int, item_id bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = index.select("doc_id", "n", "terms", "tfs").mapInArrow(run, FOUND)
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _sliced(terms: DataFrame, bound: int) -> tuple[DataFrame, int]:
    """``terms`` with a column slice; no slice has more than ``bound`` rows unless it holds one item only."""
    sizes = terms.groupBy("item_id").agg(F.count("*").alias("pairs"))
    items, pairs = sizes.agg(F.count("*"), F.coalesce(F.sum("pairs"), F.lit(0))).first()
    slices = max(1, -(-pairs // bound))
    while True:
        number = F.pmod(F.xxhash64("item_id"), F.lit(slices)).alias("slice")
        crowded = sizes.groupBy(number).agg(F.sum("pairs").alias("pairs"), F.count("*").alias("items"))
        if slices >= 64 * max(items, 1) or crowded.filter((F.col("pairs") > bound) & (F.col("items") > 1)).isEmpty():
            return terms.withColumn("slice", number), slices
        slices *= 2


def search(index: DataFrame, items: DataFrame, k: int = 20, slice_pairs: int = SLICE, block: int = BLOCK) -> DataFrame:
    """``RESULT``: the k best documents of ``index`` for each of ``items`` (item_id, text).

    ``index`` is a stored table made by ``build_index``. Runs jobs when called; the rows of all slices but the last are stored.
    """
    spark = index.sparkSession
    documents, tokens = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    terms = stored(item_terms(items), "items")
    terms, slices = _sliced(terms, slice_pairs)
    used = [r[0] for r in terms.select("slice").distinct().orderBy("slice").collect()] if slices > 1 else [0]
    found: DataFrame | None = None
    for number in used:
        part = Slice.of([tuple(r) for r in terms.filter(F.col("slice") == number).select("item_id", "term", "repeats").collect()])
        if not part.ids or not documents:
            continue
        part.documents, part.tokens = documents, tokens
        frequency = _frequencies(index, part)
        part.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
        rows = _search_slice(index, part, k, block)
        if number != used[-1]:
            rows = stored(rows, "ranked")
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], RESULT) if found is None else found


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``RESULT`` for ``docs`` (doc_id, text) and ``items`` (item_id, text). The index is stored when this is called."""
    return search(stored(build_index(docs), "index"), items, k)


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS t
  FROM documents WHERE text IS NOT NULL
), sized AS (SELECT r, doc_id, t, len(t) AS n FROM docs WHERE len(t) > 0
), stat AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sized
), tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM sized) GROUP BY r, term
), df AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, stat GROUP BY term
), items AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY item_id, term
), normed AS (SELECT r, doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM sized, stat
), scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN df USING (term) JOIN normed USING (r) GROUP BY item_id, r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
