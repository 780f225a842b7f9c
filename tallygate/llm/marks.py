"""Sets of integer ids as 64-id bitmap words, to mark rows of a large table.

One word stands for 64 neighbouring ids, so the set is small beside the ids themselves.  The mark
is a plain join with the written words: their size is known when it is planned, so Spark broadcasts
them while that allows, without shuffling the large side first, and shuffles both beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import written


def id_words(ids: DataFrame, column: str, name: str) -> DataFrame:
    """(_word, name): the bitmap words of the non-null ids of ``column``.  Runs a job."""
    c = F.col(column).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(c, F.lit(64)).cast("int"))
    words = ids.where(c.isNotNull()).select(
        F.shiftright(c, 6).alias("_word"), bit.alias("_bit")
    ).groupBy("_word").agg(F.bit_or("_bit").alias(name))
    return written(words, name)


def marked(rows: DataFrame, column: str, words: list[tuple[DataFrame, str]]) -> DataFrame:
    """``rows`` with one boolean per set: whether the id is in it (a null id is in none)."""
    c = F.col(column).cast("long")
    out = rows.withColumn("_word", F.shiftright(c, 6))
    for df, name in words:
        out = out.join(df, "_word", "left")
        mask = F.coalesce(F.col(name), F.lit(0).cast("long"))
        bit = F.call_function("shiftright", mask, F.pmod(c, F.lit(64)).cast("int"))
        out = out.withColumn(name, F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False)))
    return out.drop("_word")
