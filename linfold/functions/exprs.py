"""Column expressions shared by the operators. All built-in, JVM-side, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator, denominator) -> Column:
    """``numerator / denominator`` as double; NULL (not an error, not inf) when the divisor is 0."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def row_key(*cols) -> Column:
    """A text key made of several columns, for hashing and ordering."""
    return F.concat_ws("-", *[col(c).cast("string") for c in cols])


def key_hash(key, hash_fn: str = "xxhash64") -> Column:
    """A row key's hash as a share of the whole, from 0 up to (not including) 1; never NULL.

    ``xxhash64`` (default): Spark's own hash of the key, a few nanoseconds a row.
    ``md5``: the first 32 bits of md5 of the key's text, dearer but portable - other
    engines (DuckDB: ``('0x' || substr(md5(k), 1, 8))::BIGINT / 4294967296``) get the same
    share. A NULL key hashes like an empty text. Either way a row's side depends on its
    key alone, not on partitioning or executor count.
    """
    if hash_fn == "xxhash64":
        # 53 bits, so that the share is exact in a double
        return F.shiftrightunsigned(F.xxhash64(F.coalesce(col(key).cast("string"), F.lit(""))), 11) / F.lit(2.0 ** 53)
    if hash_fn != "md5":
        raise ValueError(f"unknown hash {hash_fn!r}")
    digest32 = F.conv(F.substring(F.md5(F.coalesce(col(key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")
    return digest32 / F.lit(2.0 ** 32)


def q(name: str) -> str:
    """Backtick-quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def present(value: str) -> str:
    """SQL text of a double value with NaN as NULL: the one rule for missing numbers."""
    return f"nanvl({value}, CAST(NULL AS DOUBLE))"


def lit_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
