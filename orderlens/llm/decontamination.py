"""Benchmark decontamination by winnowing.

Words are digits, letters and non-ASCII characters after lower-casing A-Z. A benchmark window is ``WINDOW``
consecutive words of an item; an item of fewer words is one window. Of the hashes of all ``GRAM``-word grams in a
window the smallest is its fingerprint. Both sides choose by the same rule, so a shared span of ``WINDOW`` words or
more always shares a fingerprint. Documents look theirs up among the benchmark's, and each hit is extended: the
whole window must occur (128 bits of hash). A document word inside any occurrence is hit.

A benchmark of at most ``BROADCAST_WINDOWS`` pairs of window and item is broadcast, and documents never move. A larger
one stays where it is: the documents' distinct fingerprints are joined with the benchmark's, a document gets the windows
of the fingerprints that it shares, and extends its hits with them. No part of either passes through the driver then.

Defined cases: null and wordless texts have no words, no windows and no hits; items that share an id are one item;
repeated rows of documents are judged each; a text of any length is read whole; an item without an id counts under null
and is left out of joined ids; extra columns are ignored; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import ALNUM, Words, grams, mix, text_slices

WINDOW = 10
GRAM = 5
BROADCAST_WINDOWS = 1_000_000
FILTER_BITS = 22  # slots of the table that is asked before the exact lookup

_SECOND = np.uint64(0xD6E8FEB86659FD93)

SPANS = "array<struct<start:bigint,stop:bigint>>"
SCHEMA = f"doc_id bigint, text_key bigint, n_words bigint, spans {SPANS}, item_ids array<bigint>"


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of the window at every start: the smallest gram hash inside it."""
    gram = grams(hashes, GRAM)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    width, have = WINDOW - GRAM + 1, 1
    least = gram
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least[:n]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (item_id, length, first, second, fingerprint) of all windows of (item_id, text)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, "text"):
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            count = np.diff(words.first)
            found = []
            for r in np.flatnonzero(count):
                own = hashes[words.first[r] : words.first[r + 1]]
                length = min(WINDOW, len(own))
                first = grams(own, length)
                print_ = fingerprints(own) if length == WINDOW else first
                found.append((np.full(len(first), r), np.full(len(first), length), first, grams(mix(own ^ _SECOND), length), print_))
            if found:
                r, length, first, second, print_ = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(r)), pa.array(length.astype(np.int32)),
                     *(pa.array(x.view(np.int64)) for x in (first, second, print_))],
                    names=["item_id", "length", "first", "second", "print"],
                )

    return (
        benchmark.select("item_id", "text")
        .mapInArrow(windows, "item_id bigint, length int, first bigint, second bigint, print bigint")
        .distinct()
    )


class Windows:
    """Windows of the benchmark, by length: filter table, sorted windows and their items."""

    def __init__(self, rows: pa.Table):
        self.by_length = {}
        lengths = rows["length"].to_numpy()
        for length in np.unique(lengths):
            own = rows.filter(pa.array(lengths == length))
            first, second, prints = (own[c].to_numpy().view(np.uint64) for c in ("first", "second", "print"))
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            new = np.ones(len(order), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            start = np.flatnonzero(new)
            known = np.unique(prints)
            self.by_length[int(length)] = (
                known, first[start], second[start], np.append(start, len(order)), own["item_id"].take(pa.array(order)).combine_chunks()
            )


def _slot_table(known: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    table = np.zeros(1 << bits, bool)
    table[known >> np.uint64(64 - bits)] = True
    return table


def _among(values: np.ndarray, known: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``known``."""
    out = slots[values >> np.uint64(65 - len(slots).bit_length())]
    asked = values[out]
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    out[out] = known[at] == asked
    return out


def _occurrences(hashes: np.ndarray, length: int, known: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Starts of the windows whose fingerprint the benchmark has."""
    prints = fingerprints(hashes) if length == WINDOW else grams(hashes, length)
    if not len(prints):
        return np.zeros(0, np.int64)
    new = np.ones(len(prints), bool)
    new[1:] = prints[1:] != prints[:-1]
    run = np.flatnonzero(new)  # neighbouring windows with the same fingerprint are asked once
    hit = _among(prints[run], known, slots)
    size = np.diff(np.append(run, len(prints)))[hit]
    return np.repeat(run[hit] - np.cumsum(size) + size, size) + np.arange(size.sum())


def _judge(words: Words, tables: dict) -> tuple[list, list]:
    """Spans and items of the rows of a slice."""
    hashes = words.hashes()
    second = None
    covered = np.zeros(len(hashes) + 1, np.int32)
    pairs_row, pairs_item = [], []
    for length, (known, first, other, place, items, slots) in tables.items():
        start = _occurrences(hashes, length, known, slots)
        row = np.searchsorted(words.first, start, "right") - 1
        inside = start + length <= words.first[row + 1]
        start, row = start[inside], row[inside]
        if not len(start):
            continue
        second = mix(hashes ^ _SECOND) if second is None else second
        mine, mine2 = grams(hashes, length, start), grams(second, length, start)
        low, high = np.searchsorted(first, mine, "left"), np.searchsorted(first, mine, "right")
        at = low.copy()
        for step in range(1, int((high - low).max(initial=0))):  # equal first hashes, hardly ever
            at = np.where((low + step < high) & (other[np.minimum(low + step, len(other) - 1)] == mine2), low + step, at)
        good = (low < high) & (other[np.minimum(at, len(other) - 1)] == mine2)
        start, row, at = start[good], row[good], at[good]
        np.add.at(covered, start, 1)
        np.add.at(covered, start + length, -1)
        pair = np.unique(np.stack([row, at]), axis=1)
        size = place[pair[1] + 1] - place[pair[1]]
        pairs_row.append(np.repeat(pair[0], size))
        pairs_item.append(items.take(pa.array(np.repeat(place[pair[1]] - np.cumsum(size) + size, size) + np.arange(size.sum()))))
    n_rows = len(words.first) - 1
    hit = np.cumsum(covered)[:-1] > 0
    spans: list = [[] for _ in range(n_rows)]
    found: list = [[] for _ in range(n_rows)]
    if hit.any():
        rows = words.rows()
        edge = np.ones(len(hit), bool)
        edge[1:] = (hit[1:] != hit[:-1]) | (rows[1:] != rows[:-1])
        begin = np.flatnonzero(edge)
        stop = np.append(begin[1:], len(hit))
        for a, b in zip(begin[hit[begin]], stop[hit[begin]], strict=True):
            r = rows[a]
            spans[r].append({"start": int(a - words.first[r]), "stop": int(b - words.first[r])})
        for r, item in zip(np.concatenate(pairs_row), (i for c in pairs_item for i in c.to_pylist()), strict=True):
            found[r].append(item)
        found = [list(dict.fromkeys(x)) for x in found]
    return spans, found


def _judged(rows: pa.RecordBatch, words: Words, tables: dict) -> pa.RecordBatch:
    spans, items = _judge(words, tables)
    return pa.RecordBatch.from_arrays(
        [
            rows.column(0), rows.column(1), pa.array(np.diff(words.first)),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(items, pa.list_(pa.int64())),
        ],
        names=["doc_id", "text_key", "n_words", "spans", "item_ids"],
    )


def _scanned(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``SCHEMA`` of ``docs`` (doc_id, text_key, text) by broadcast windows."""
    shared = docs.sparkSession.sparkContext.broadcast(Windows(windows.toArrow()))  # BROADCAST_WINDOWS rows at most

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {n: (*x, _slot_table(x[0])) for n, x in shared.value.by_length.items()}
        for rows, data, offsets in text_slices(batches, "text"):
            yield _judged(rows, Words(data, offsets, ALNUM), tables)

    return docs.mapInArrow(scan, SCHEMA)


def _joined(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``SCHEMA`` of ``docs`` (doc_id, text_key, text) by a join of fingerprints."""
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]  # WINDOW rows at most

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, "text"):
            words = Words(data, offsets, ALNUM)
            hashes = words.hashes()
            for length in lengths:
                found = fingerprints(hashes) if length == WINDOW else grams(hashes, length)
                start = np.arange(len(found))
                row = np.searchsorted(words.first, start, "right") - 1
                inside = start + length <= words.first[row + 1]
                pair = np.unique(np.stack([row[inside].astype(np.uint64), found[inside]]), axis=1)
                owner = pa.array(pair[0].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(owner), rows.column(1).take(owner), pa.array(np.full(len(owner), length, np.int32)), pa.array(pair[1].view(np.int64))],
                    names=["doc_id", "text_key", "length", "print"],
                )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, "text"):
            own = pa.Table.from_arrays(rows.column(3).flatten().flatten().flatten(), names=WINDOW_FIELDS)
            own = own.group_by(WINDOW_FIELDS).aggregate([])  # several documents may bring one
            tables = {n: (*x, _slot_table(x[0], 16)) for n, x in Windows(own).by_length.items()} if own.num_rows else {}
            yield _judged(rows, Words(data, offsets, ALNUM), tables)

    kind = "doc_id bigint, text_key bigint, length int, print bigint"
    known = windows.groupBy("length", "print").agg(F.collect_list(F.struct(*WINDOW_FIELDS)).alias("windows"))
    hits = docs.mapInArrow(prints, kind).distinct().join(known, ["length", "print"])
    hits = hits.groupBy("doc_id", "text_key").agg(F.collect_list("windows").alias("windows"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("doc_id", "text_key")]
    nothing = F.expr("cast(array() as array<array<struct<length:int,print:bigint,first:bigint,second:bigint,item_id:bigint>>>)")
    rows = docs.alias("d").join(hits.alias("h"), same, "left").select("d.doc_id", "d.text_key", "d.text", F.coalesce("h.windows", nothing).alias("windows"))
    return rows.mapInArrow(extend, SCHEMA)


WINDOW_FIELDS = ["length", "print", "first", "second", "item_id"]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, text_key (hash of the text), n_words, hit spans (word positions, merged) and item_ids of every row of ``docs``.

    Stores the benchmark's windows when called.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))
    windows = stored(benchmark_windows(benchmark), "windows")
    few = windows.count() <= broadcast_windows
    return _scanned(rows, windows) if few else _joined(rows, windows)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of ``contaminated_spans``: counts of words, hit words and items, digest of the item ids, and the verdict."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return contaminated_spans(docs, benchmark).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that share no window with the benchmark."""
    hit = contaminated_spans(docs, benchmark).filter(F.size("spans") > 0).select("doc_id", "text_key").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (
        F.xxhash64(F.coalesce(F.col("d.text"), F.lit(""))) == F.col("h.text_key")
    )
    return docs.alias("d").join(hit.alias("h"), same, "left_anti")
