"""N-gram Jaccard join: all documents whose sets of word shingles are alike, exactly, as linked classes.

A document's set holds the hashes of its distinct ``SHINGLE``-word shingles (64 bits). Sets link when
100 * intersection >= ``PERCENT`` * union. The steps:

1. A sketch counts shingles in a fixed number of slots; frequent ones get a higher level. All sets are ordered by
   (level, hash), rare first, and linked sets must share a shingle of their prefixes in this order.
2. Sets that share a prefix shingle form a list. A list is sorted by size and compared in tiles of ``TILE`` sets at
   most; pairs outside the size band are never formed. Of the others, a bitmap signature of each set bounds the
   overlap from above: a set bit that the other lacks is a shingle that the other lacks. So does the position in the
   prefix.
3. What a tile allows is kept as a spanning forest, and the forests of all tiles are joined to groups. No link leaves
   its group, and every text enters one group, so each pair is met once however many lists share it.
4. Every pair of a group is verified by its exact intersection, in tiles again: shingles that few rows of a tile hold
   are counted pair by pair, the others by a matrix product. A tile returns one row per node, the links found and a
   spanning forest of them, never the pairs.

Equal sets are one node throughout (64-bit hash of the set). Lists longer than ``TILE`` are split into tiles that meet
pairwise.

Defined cases: with fewer than ``SHINGLE`` words the whole sequence is the only shingle; a null or wordless text has
an empty set, no links, and is its own component; ``n_links`` counts the other rows that a row links with, repeated
rows and rows of an equal set each; rows with the same text are one node, repeated rows are all
returned; a component's id is the smallest doc_id in it (null only if no row of it has one); extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import SPACED, Words, grams, mix, row_key, text_slices
from .components import connected_components

SHINGLE = 5
TILE = 2048
TILE_BYTES = 8 << 20  # text of a chunk of a group
DENSE = 32  # rows of a tile from which a shingle is a column of a matrix
COLUMNS = 1024  # columns multiplied at once
SLOT_BITS = 18  # slots of the frequency sketch
SIGNATURE_BITS = 2048  # least
KEY_BITS = 23  # slots of the bitmap of wanted rows
LIST = ["x", "y", "length"]  # what names a list


def needed(nx, ny):
    """Smallest intersection with which sets of these sizes link at 80 %: 9 * shared >= 4 * (nx + ny)."""
    return (4 * (nx + ny) + 8) // 9


def prefix_size(n: int) -> int:
    """Shingles of a set of n, in the common order, of which every linked set shares one."""
    return n - (4 * n + 4) // 5 + 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row of a slice."""
    words = Words(data, offsets, SPACED)
    hashes = words.hashes()
    whole = grams(hashes, SHINGLE)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(whole[a : b - SHINGLE + 1]))
        else:
            out.append(grams(hashes[a:b], b - a) if b > a else whole[:0])
    return out


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """The level of every slot: 0 for a usual number of shingles, one more for every doubling above."""
    piece, pieces = 1 << 12, 1 << (SLOT_BITS - 12)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for _, data, offsets in text_slices(batches, "text"):
            sets = shingle_sets(data, offsets)
            total += np.bincount(_slot(np.concatenate(sets)), minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(pieces), pa.int32()), pa.array([p.astype("<i8").tobytes() for p in total.reshape(pieces, piece)])],
            names=["piece", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), "<i8") for c in table["counts"])
        return pa.table({"piece": table["piece"][:1], "counts": pa.array([total.tobytes()])})

    rows = (
        docs.select("text").mapInArrow(count, "piece int, counts binary")
        .groupBy("piece").applyInArrow(add, "piece int, counts binary").collect()  # one row per piece
    )
    total = np.zeros((pieces, piece))
    for row in rows:
        total[row["piece"]] = np.frombuffer(row["counts"], "<i8")
    mean = total.mean()
    return np.log2(1 + np.maximum(total.ravel() - mean, 0) / (4 * np.sqrt(mean) + 4)).astype(np.uint8)


def set_hash(shingles: np.ndarray) -> np.int64:
    """A hash of the whole set."""
    whole = np.bitwise_xor.reduce(mix(shingles), keepdims=True) + np.add.reduce(shingles, keepdims=True)
    return mix(whole * np.uint64(2 * len(shingles) + 1)).view(np.int64)[0]


def signature(shingles: np.ndarray) -> bytes:
    """A bitmap of the set, two bits a shingle at least, so that it tells long sets apart too."""
    bits = np.zeros(max(SIGNATURE_BITS, 1 << (2 * len(shingles) - 1).bit_length()), bool)
    bits[(mix(shingles) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _by_width(signs: list[bytes]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The width of every signature, and for each width the rows' places in a matrix of those as wide or twice, folded."""
    width, out = np.array([len(s) for s in signs]), {}
    for w in np.unique(width).tolist():
        rows = np.flatnonzero((width == w) | (width == 2 * w))
        folded = np.empty((len(rows), w), np.uint8)
        for k, r in enumerate(rows.tolist()):
            own = np.frombuffer(signs[r], np.uint8)
            folded[k] = own if len(own) == w else own[:w] | own[w:]
        place = np.full(len(signs), -1)
        place[rows] = np.arange(len(rows))
        out[w] = place, folded.view(np.uint64)
    return width, out


def document_sets(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """doc_id, row_key, bytes, n, node (hash of the set, null if empty), and where a task meets a set first also its
    signature and prefix shingles, rarest first."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2 ** SLOT_BITS bytes

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        for rows, data, offsets in text_slices(batches, "text"):
            size, nodes, signs, prefixes = [], [], [], []
            for s in shingle_sets(data, offsets):
                size.append(len(s))
                node = sign = prefix = None
                if len(s):
                    node = int(set_hash(s))
                    if node not in seen:
                        seen.add(node)
                        sign = signature(s)
                        prefix = s[np.lexsort((s, level[_slot(s)]))[: prefix_size(len(s))]].view(np.int64)
                nodes.append(node)
                signs.append(sign)
                prefixes.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), rows.column(1), pa.array(np.diff(offsets)), pa.array(size, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array(signs, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "bytes", "n", "node", "signature", "prefix"],
            )

    return docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), "text").mapInArrow(
        sets, "doc_id bigint, row_key bigint, bytes bigint, n bigint, node bigint, signature binary, prefix array<bigint>"
    )


def shared_lists(sets: DataFrame) -> DataFrame:
    """(x, y, length, node, place): the nodes that share a prefix shingle, each such group once.

    A list is named by two sums of its nodes' hashes, since near copies share many shingles and would form the same
    list for each; ``place`` is a node's first place in the prefix among the shingles of the list.
    """
    rows = sets.filter("prefix is not null").select("node", F.posexplode("prefix").alias("place", "token"))
    same = Window.partitionBy("token")
    return (
        rows.withColumn("low", F.min("node").over(same))
        .withColumn("high", F.max("node").over(same))
        .filter("low <> high")
        .groupBy("token", "node")
        .agg(F.min("place").alias("place"))
        .withColumn("length", F.count("*").over(same))
        .withColumn("x", F.bit_xor("node").over(same))
        .withColumn("y", F.bit_xor(F.xxhash64("node")).over(same))
        .groupBy(*LIST, "node")
        .agg(F.min("place").alias("place"))
    )


def _whole_lists(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted batches regrouped so that no list (equal first ``keys`` columns) is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        new = np.zeros(batch.num_rows - 1, bool)
        for k in range(keys):
            c = batch.column(k).to_numpy()
            new |= c[1:] != c[:-1]
        cut = np.flatnonzero(new)
        if len(cut):
            at = int(cut[-1]) + 1
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, at)])
            held = [batch.slice(at)]
    if held:
        yield pa.Table.from_batches(held)


def _allowed(rows: pa.Table, keys: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i, j), i before j, of the same tile that the bounds allow. Rows are sorted by tile and size."""
    columns = [rows.column(k).to_numpy() for k in range(keys)]
    change = np.zeros(rows.num_rows, bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    tile = np.cumsum(change)
    n, place = rows["n"].to_numpy(), rows["place"].to_numpy()
    width, signs = _by_width(rows["signature"].to_pylist())
    alive, distance = np.arange(rows.num_rows), 0
    while len(alive):
        distance += 1
        alive = alive[alive + distance < rows.num_rows]
        other = alive + distance
        near = (tile[alive] == tile[other]) & (5 * n[alive] >= 4 * n[other])
        alive, other = alive[near], other[near]
        for w, (at_sign, sign) in signs.items():
            of_width = np.flatnonzero(width[alive] == w)
            step = max((1 << 24) // w, 1)
            for at in range(0, len(of_width), step):
                some = of_width[at : at + step]
                i, j = alive[some], other[some]
                least = needed(n[i], n[j])
                fits = np.minimum(n[i] - place[i], n[j] - place[j]) >= least
                i, j, least = i[fits], j[fits], least[fits]
                of_i, of_j = sign[at_sign[i]], sign[at_sign[j]]
                lacks_j = np.bitwise_count(of_i & ~of_j).sum(1, dtype=np.int64)
                lacks_i = np.bitwise_count(of_j & ~of_i).sum(1, dtype=np.int64)
                fits = np.minimum(n[i] - lacks_j, n[j] - lacks_i) >= least
                if fits.any():
                    yield i[fits], j[fits]


def _hang(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the rows i and j of every pair in ``root``, which has the smallest row joined with each."""
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        apart = low < high
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _tiles(rows: DataFrame, chunks: Column) -> DataFrame:
    """Rows copied to the tiles of their chunk with every chunk: columns chunk, low_tile and high_tile."""
    return (
        rows.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)))
        .withColumns({"low_tile": F.least("chunk", "other"), "high_tile": F.greatest("chunk", "other")}).drop("other")
    )


def candidate_edges(lists: DataFrame, signatures: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the pairs that share a list and that the bounds allow."""
    keys = [*LIST, "low_tile", "high_tile"]

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_lists(batches, len(keys)):
            node, chunk, low, high = (rows[c].to_numpy() for c in ("node", "chunk", "low_tile", "high_tile"))
            root = np.arange(rows.num_rows)
            for i, j in _allowed(rows, len(keys)):
                new = (low[i] == high[i]) | (chunk[i] != chunk[j])
                _hang(root, i[new], j[new])
            own = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[root[own]])], names=["a", "b"])

    rows = _tiles(lists.join(signatures, "node"), F.ceil(F.col("length") / TILE))
    rows = rows.select(*keys, "n", "node", "place", "signature", "chunk")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "n", "node").mapInArrow(edges, "a bigint, b bigint").distinct()


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (row_key, ...), one for each key, with the text of the row of ``docs`` that has the key.

    A bitmap of the wanted keys, of fixed size, keeps most other texts from being moved.
    """
    bits = 1 << KEY_BITS
    slot = F.pmod("row_key", F.lit(bits)) + 1
    parts = (
        wanted.select(F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit"))
        .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # bits / 32768 rows
    )
    marked = np.zeros((max(bits >> 15, 1), 4096), np.uint8)
    for row in parts:
        marked[row["part"] - 1] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(marked.ravel())

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for rows in batches:
            place = rows.column(0).to_numpy() & (bits - 1)
            yield rows.filter(pa.array((marks[place >> 3] >> (place & 7) & 1).astype(bool)))

    rows = docs.select(row_key("doc_id", "text").alias("row_key"), "text").mapInArrow(likely, "row_key bigint, text string")
    return rows.join(wanted, "row_key").dropDuplicates(["row_key"]).drop("row_key")


def overlaps(sets: list[np.ndarray], left: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets in ``left`` (a mask) with the others, or of all if it has all."""
    whole = bool(left.all())
    place = np.where(left, np.cumsum(left), np.cumsum(~left)) - 1
    shared = np.zeros((int(left.sum()), len(sets) if whole else int((~left).sum())), np.float32)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shingle = np.concatenate(sets)
    order = np.argsort(shingle, kind="stable")
    shingle, row = shingle[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    count = np.diff(np.append(first, len(row)))
    of = np.repeat(np.arange(len(first)), count)

    few = (count > 1) & (count <= DENSE)
    some, column = row[few[of]], of[few[of]]
    for d in range(1, int(count[few].max(initial=1))):
        same = column[d:] == column[:-d]
        i, j = some[:-d][same], some[d:][same]
        if not whole:
            across = left[i] != left[j]
            i, j = i[across], j[across]
            i, j = np.where(left[i], i, j), np.where(left[i], j, i)
        np.add.at(shared, (place[i], place[j]), 1)
        if whole:
            np.add.at(shared, (place[j], place[i]), 1)

    many = np.flatnonzero(count > DENSE)
    number = np.full(len(first), -1)
    number[many] = np.arange(len(many))
    some, column = row[number[of] >= 0], number[of][number[of] >= 0]
    for at in range(0, len(many), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[some[a:b], column[a:b] - at] = 1
        shared += matrix[left] @ (matrix if whole else matrix[~left]).T
    return shared  # whole numbers below 2 ** 24


def found_links(texts: DataFrame) -> DataFrame:
    """node, links and root of the nodes of every tile: the weight of the linked nodes, and the first of those joined.

    ``texts``: component (the group), node, n, weight, text, and size and bytes of the group. Texts move, not arrays:
    they are several times smaller.
    """
    keys = ["component", "low_tile", "high_tile"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_lists(batches, len(keys)):
            change = np.zeros(rows.num_rows, bool)
            for k in keys:
                c = rows[k].to_numpy()
                change[1:] |= c[1:] != c[:-1]
            cut = [0, *np.flatnonzero(change).tolist(), rows.num_rows]
            for a, b in zip(cut, cut[1:], strict=False):
                yield _tile_links(rows.slice(a, b - a))

    chunks = F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("bytes") / TILE_BYTES))
    rows = _tiles(texts, chunks).select(*keys, "n", "node", "weight", "chunk", "text")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "n", "node")
    return rows.mapInArrow(verify, "node bigint, links bigint, root bigint")


def _tile_links(rows: pa.Table) -> pa.RecordBatch:
    sets = []
    for _, data, offsets in text_slices(iter(rows.select(["text"]).to_batches()), "text"):
        sets += shingle_sets(data, offsets)
    node, n, weight, chunk = (rows[c].to_numpy() for c in ("node", "n", "weight", "chunk"))
    low, high = rows["low_tile"][0].as_py(), rows["high_tile"][0].as_py()
    left = chunk == low
    right = left if low == high else ~left
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    if left.any() and right.any():
        link = overlaps(sets, left) >= needed(n[left][:, None], n[right][None])
        if low == high:
            np.fill_diagonal(link, False)
        links[left] += link @ weight[right]
        if low != high:
            links[right] += weight[left] @ link
        i, j = np.nonzero(link)
        _hang(root, np.flatnonzero(left)[i], np.flatnonzero(right)[j])
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(node[root])], names=["node", "links", "root"])


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, n_links, component_id and component (null: empty set) of every row of ``docs``
    (doc_id, text).

    Runs jobs when called; sets, lists, groups, links and components are tables in the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    folder = shared_path(spark, "jaccard")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    sets = stored(document_sets(docs, frequency_levels(docs)), "sets")
    nodes = sets.filter("prefix is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("signature").alias("signature"))
    lists = stored(shared_lists(sets), "lists")
    groups = connected_components(candidate_edges(lists, nodes))
    groups = groups.unionByName(groups.select(F.col("component").alias("node"), "component").distinct())
    picked = sets.join(groups, "node").groupBy("node", "component").agg(
        F.min(F.struct("row_key", "bytes")).alias("row"), F.first("n").alias("n"), F.count("*").alias("weight")
    )
    picked = stored(picked.select("node", "component", "row.*", "n", "weight"), "picked")
    sizes = picked.groupBy("component").agg(F.count("*").alias("size"), F.sum("bytes").alias("bytes"))
    texts = wanted_texts(docs, picked.drop("bytes").join(sizes, "component"))
    found = stored(found_links(texts), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))

    smallest = sets.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("weight")
    )
    named = smallest.join(labels, "node", "left").join(links, "node", "left").withColumns({
        "component": F.coalesce("component", "node"), "n_links": F.col("weight") - 1 + F.coalesce("links", F.lit(0))
    })
    classes = (
        labels.select("component").distinct().join(named, "component")
        .groupBy("component").agg(F.min("least").alias("component_id"))
    )
    named = named.join(classes, "component", "left").select(
        "node", "n_links", "component", F.coalesce("component_id", "least").alias("component_id")
    )
    columns = ["doc_id", "row_key", F.col("n").alias("n_shingles"), "n_links", "component_id", "component"]
    some = sets.filter("node is not null").join(named, "node").select(*columns)
    empty = sets.filter("node is null").withColumns(
        {"n_links": F.lit(0).cast("bigint"), "component_id": F.col("doc_id"), "component": F.lit(None).cast("bigint")}
    )
    return some.unionByName(empty.select(*columns))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each class: its smallest doc_id, nulls last.

    Texts without words are no copies of each other and all stay.
    """
    classes = jaccard_classes(docs).filter("component is not null")
    first = classes.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    key = "row key of one_of_each"
    kept = docs.withColumn(key, row_key("doc_id", "text")).join(first.select(F.col("first.row_key").alias(key)), key, "left_semi")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    worded = kept.filter(~wordless).dropDuplicates([key]).drop(key)
    return worded.unionByName(docs.filter(wordless))
