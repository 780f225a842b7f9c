"""Deterministic key hashing: text form of a key, and md5 as a number modulo m."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def double_text(x: Column) -> Column:
    """DOUBLE as text with plain digits from 1e-4 up to 1e16, two-digit exponents outside.

    Spark switches to exponents at 1e-3 and 1e7; keys must not depend on that.
    """
    plain = F.rtrim(x.cast("decimal(38,18)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    spark_text = x.cast("string")
    mantissa = F.regexp_replace(F.substring_index(spark_text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(spark_text, "E", -1).try_cast("int")
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    scientific = F.concat(mantissa, sign, F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    size = F.abs(x)
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0) | F.isnan(x), spark_text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def key_text(df: DataFrame, key: Sequence[str], sep: str = "|") -> Column:
    """The key's columns as one string; NULL parts are skipped, as concat_ws does."""
    parts = [
        double_text(F.col(c)) if isinstance(df.schema[c].dataType, T.DoubleType)
        else F.col(c).cast("string")
        for c in key
    ]
    return F.concat_ws(sep, *parts)


def digest_modulo(digest: str | Column, modulus: int) -> Column:
    """An md5 hex digest as a little-endian unsigned 128-bit integer, modulo ``modulus``.

    No Spark type holds 128 bits, but (sum of byte * 256^i) mod m only needs 256^i mod m, so the
    digest becomes a weighted sum of its bytes: plain generated arithmetic, no lambda per byte.
    """
    if modulus == 1:
        return F.lit(0).cast("bigint")
    weights = [pow(256, i, modulus) for i in range(16)]
    terms = [
        F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("bigint") * F.lit(w).cast("bigint")
        for i, w in enumerate(weights)
        if w
    ]
    return reduce(lambda a, b: a + b, terms) % F.lit(modulus).cast("bigint")


def modulus_for(fraction: float | None) -> int:
    """Sampling modulus of a fraction; no fraction means every row."""
    return 1 if fraction is None else max(1, round(1 / fraction))


def in_sample(df: DataFrame, key: Sequence[str], modulus: int | None) -> DataFrame:
    """``df`` plus the boolean ``in_sample``: whether the key hash is 0 modulo ``modulus``."""
    if modulus in (None, 1):
        return df.withColumn("in_sample", F.lit(True))
    # explode keeps the digest a column: a filter would otherwise repeat the md5 once per byte
    digested = df.select("*", F.explode(F.array(F.md5(key_text(df, key)))).alias("_digest"))
    picked = digest_modulo(F.col("_digest"), modulus) == 0
    return digested.withColumn("in_sample", picked).drop("_digest")


def hash_sample(df: DataFrame, key: Sequence[str], modulus: int | None) -> DataFrame:
    """Rows whose key hash is 0 modulo ``modulus``; rows sharing a key stay together."""
    return in_sample(df, key, modulus).where("in_sample").drop("in_sample")


def row_hash(df: DataFrame, columns: Sequence[str], order: Sequence[str] | None = None) -> Column:
    """64-bit hash of a row's content, whatever the order of its columns.

    ``order`` gives the names that decide their order, where the columns were renamed.
    """
    named = sorted(zip(order or columns, columns, strict=True))
    cols = [F.col(f"`{c}`") for _, c in named]
    # xxhash64 skips NULLs, so their positions are hashed too
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, content_sum): equal for equal row multisets, whatever their order."""
    total = F.sum(row_hash(df, df.columns).cast("decimal(38,0)"))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(total, F.lit(0)).cast("string").alias("content_sum"),
    )
