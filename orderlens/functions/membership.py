"""A filter of fixed size for rows that may be members of a set, so that the others need not be shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Words of 64 bits, chosen by a hash's leading bits, the bit by the six that follow.
WORD_BITS = 20
WORD = f"shiftrightunsigned(_hash, {64 - WORD_BITS})"
BIT = f"shiftleft(1L, cast(shiftrightunsigned(_hash, {58 - WORD_BITS}) & 63 AS int))"


def mark_possible(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false only if no row of ``members`` has their ``_hash``. Both have such a column.

    Runs when called: the words are stored, at most 2 ** WORD_BITS rows. A set that fills them marks every row, so what
    follows must hold for any marked row.
    """
    words = members.groupBy(F.expr(WORD).alias("_word")).agg(F.bit_or(F.expr(BIT)).alias("_bits"))
    marked = rows.withColumn("_word", F.expr(WORD)).join(F.broadcast(stored(words, "members")), "_word", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(F.expr(BIT)) != 0, F.lit(False))
    return marked.withColumn("_maybe", maybe).drop("_word", "_bits", "_hash")
