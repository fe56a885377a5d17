"""Sharding by minimax contiguous partition: the smallest shard capacity that ordered atomic groups allow.

Rows with equal texts are a group, which stays together; groups are ordered by the 64-bit hash of their text. The
capacity is found without bringing all group sizes to the driver: hashes with the same leading bits form ranges, at most
``RANGES`` of them, whose bytes are added up by Spark. A binary search with a greedy check finds the smallest
capacity twice, with ranges that cannot be cut (enough) and with ranges that can be cut anywhere (no less will do). While
the two differ, the ranges in which a greedy cut may lie for any capacity between them are split by further bits. What
ends the search is the smallest capacity for the groups themselves. Cuts are then made below it, each as near to the fair
share of what is left as the rest allows.

Rows are numbered within a shard by offsets of small cells, so no shard is ever one task; equal rows are one row with
a count until the end.

Defined cases: a null text is an empty one of size 8; equal rows get slots of their own; a shard without rows is
possible when there are fewer groups than shards or one group is larger than a fair share; slots follow
(range, salt, doc_id, hash), equal rows in any order; a text of any length is one row; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

RANGES = 65_536  # ranges of hashes whose sizes come to the driver at once; a power of two
SALTS = 64  # parts that the rows of a range are numbered in, so that a group of copies is not one task
CHUNK = 65_536  # equal rows that are laid out together
ROW_BYTES = 8


def shards_needed(sizes: Sequence[int], capacity: int) -> int:
    """Shards that a greedy pass fills, none above ``capacity``."""
    shards, filled = 1, 0
    for size in sizes:
        if filled + size > capacity:
            shards, filled = shards + 1, 0
        filled += size
    return shards


def smallest_capacity(sizes: Sequence[int], shards: int) -> int:
    """The smallest feasible capacity of ``shards`` contiguous shards."""
    low = max(max(sizes, default=0), -(-sum(sizes) // shards))
    high = max(low, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        if shards_needed(sizes, middle) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def contiguous_shards(sizes: Sequence[int], shards: int) -> list[int]:
    """The shard of each size: contiguous, none above the smallest feasible capacity, near equal below it.

    A shard closes at the cut nearest to its fair share of what is left, provided that the remaining groups still
    fit into the remaining shards.
    """
    capacity = smallest_capacity(sizes, shards)
    need, filled, wanted = [0] * (len(sizes) + 1), 0, 0
    for i in range(len(sizes) - 1, -1, -1):
        if wanted == 0 or filled + sizes[i] > capacity:
            wanted, filled = wanted + 1, 0
        filled += sizes[i]
        need[i] = wanted
    out, shard, filled, left = [], 0, 0, sum(sizes)
    for i, size in enumerate(sizes):
        after = shards - shard - 1
        fair = (left + filled) / (after + 1)
        if filled and after and need[i] <= after and (filled + size > capacity or filled + size / 2 > fair):
            shard, filled = shard + 1, 0
        filled += size
        left -= size
        out.append(shard)
    return out


def relaxed_needed(sizes: Sequence[int], whole: Sequence[bool], capacity: int) -> int:
    """Shards that a greedy pass fills if only ``whole`` sizes must stay whole."""
    shards, filled = 1, 0
    for size, stays in zip(sizes, whole, strict=True):
        if filled + size <= capacity:
            filled += size
        elif stays:
            shards, filled = shards + 1, size
        else:
            over = filled + size - capacity
            more = -(-over // capacity)
            shards, filled = shards + more, over - (more - 1) * capacity
    return shards


def relaxed_capacity(sizes: Sequence[int], whole: Sequence[bool], shards: int) -> int:
    """A capacity below which no cutting of the groups can go."""
    low = max(max((s for s, stays in zip(sizes, whole, strict=True) if stays), default=1), -(-sum(sizes) // shards), 1)
    high = max(low, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        if relaxed_needed(sizes, whole, middle) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def undecided(sizes: Sequence[int], whole: Sequence[bool], shards: int) -> list[int]:
    """The places of sizes to be split before the smallest capacity of the groups in them is known."""
    enough, least = smallest_capacity(sizes, shards), relaxed_capacity(sizes, whole, shards)
    if enough == least:
        return []
    start = [0, *accumulate(sizes)]
    found: set[int] = set()
    early = late = 0
    for _ in range(shards - 1):  # the earliest and latest place of each greedy cut for any capacity between the two
        if early + least >= start[-1]:
            break
        early = max(early, start[bisect_right(start, early + least) - 1])
        late = min(late + enough, start[-1])
        first, last = bisect_right(start, early) - 1, bisect_right(start, late) - 1
        found.update(i for i in range(first, min(last, len(sizes) - 1) + 1) if not whole[i] and start[i] < late)
    return sorted(found)


def _leading(bits: int) -> Column:
    """The leading bits of the hash as a signed number, so that ranges are in the order of the hash."""
    return F.shiftright("hash", 64 - bits) if bits < 64 else F.col("hash")


def group_ranges(rows: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """First hashes and bytes of ranges of ``rows`` (hash, size, copies), fine enough that their smallest capacity is that
    of the groups."""
    bytes_ = F.sum(F.col("size") * F.col("copies")).alias("bytes")

    def sizes(part: DataFrame, bits: int) -> list[tuple[int, int, bool, int]]:
        found = part.groupBy(_leading(bits).alias("prefix")).agg(bytes_, F.min("hash").alias("low"), F.max("hash").alias("high"))
        return [(r["low"], r["bytes"], r["low"] == r["high"], bits) for r in found.collect()]  # ``RANGES`` rows at most

    bits = RANGES.bit_length() - 1
    ranges = sorted(sizes(rows, bits))
    while wide := undecided([r[1] for r in ranges], [r[2] for r in ranges], shards):
        bits = min(ranges[i][3] for i in wide)
        wide = [i for i in wide if ranges[i][3] == bits][:RANGES // 2]
        finer = min(64, bits + max(1, (RANGES // len(wide)).bit_length() - 1))
        prefixes = [ranges[i][0] >> (64 - bits) for i in wide]
        split = sizes(rows.filter(_leading(bits).isin(prefixes)), finer)
        gone = set(wide)
        ranges = sorted([r for i, r in enumerate(ranges) if i not in gone] + split)
    return [r[0] for r in ranges], [r[1] for r in ranges]


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its size, checksum, shard and slot within the shard.

    Sizes and hashes of the rows are stored when this is called, and the cuts found.
    """
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    rows = stored(rows.groupBy("doc_id", "size", "text_crc32", "hash").agg(F.count("*").alias("copies")), "sizes")
    first, sizes = group_ranges(rows, shards)
    placed = contiguous_shards(sizes, shards)
    starts = [(low, shard) for low, shard, before in zip(first, placed, [0, *placed], strict=False) if shard != before]
    shard = F.lit(0)
    for low, number in starts:  # one for each shard but the first
        shard = F.when(F.col("hash") >= low, number).otherwise(shard)
    rows = rows.select(
        "*", shard.cast("int").alias("shard"), _leading(RANGES.bit_length() - 1).alias("range"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)).cast("int").alias("salt"),
    )
    cells = rows.groupBy("shard", "range", "salt").agg(F.sum("copies").alias("n"))
    known = sorted(tuple(r) for r in cells.groupBy("shard", "range").agg(F.sum("n")).collect())  # RANGES + shards rows at most
    offsets, slot, last = [], 0, None
    for number, prefix, n in known:
        slot = 0 if number != last else slot
        offsets.append((number, prefix, slot))
        slot, last = slot + n, number
    table = spark.createDataFrame(offsets, "shard int, range bigint, first bigint")
    earlier = Window.partitionBy("shard", "range").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(F.broadcast(table), ["shard", "range"])  # RANGES + shards rows at most
        .select("shard", "range", "salt", (F.col("first") + F.col("before")).alias("first"))
    )
    within = Window.partitionBy("shard", "range", "salt").orderBy("doc_id", "hash", "text_crc32", "size")
    before = F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, -1))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(CHUNK).cast("bigint"))).alias("chunk")
    inside = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(CHUNK).cast("bigint"), F.col("copies") - F.col("chunk")) - 1)).alias("i")
    return (
        rows.join(cells, ["shard", "range", "salt"])
        .withColumn("start", F.col("first") + F.coalesce(before, F.lit(0)))
        .select("*", chunk).select("*", inside)
        .select(
            "doc_id", "size", "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("chunk") + F.col("i")).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
