"""A join for keys so frequent that one task cannot hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys reported at most (fewer can have a share of 1 in 500), and keys a sketch keeps track of.
MOST_HOT, TRACKED = 500, 8192
SALT = "_salt"


def hot_keys(df: DataFrame, on: Sequence[str | Column], share: float) -> list[int]:
    """Hashes of the keys that hold ``share`` or more of the rows; at most 500 of them, so ``share``
    is 0.002 or more.

    Found by a frequent-items sketch: each task keeps counters of bounded number, which merge. A
    count may be too high by a fraction of the rows far below ``share``, so a key a little less
    frequent may be among them, and none that has the share is missed.
    """
    if not share >= 1 / MOST_HOT:
        raise ValueError(f"share must be {1 / MOST_HOT} or more")
    name = "_key"
    found = df.select(F.xxhash64(*on).alias(name)).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k({name}, {MOST_HOT}, {TRACKED})").alias("top")
    ).first()
    return sorted(item["item"] for item in found["top"] or [] if item["count"] >= share * found["n"])


def is_hot(on: Sequence[str | Column], hot: Sequence[int]) -> Column:
    return F.xxhash64(*on).isin(list(hot))


def with_salts(df: DataFrame, on: Sequence[str | Column], hot: Sequence[int], n: int) -> DataFrame:
    """The small side of a salted join: rows of hot keys once for each salt, others for salt 0."""
    every = F.when(is_hot(on, hot), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    return df.withColumn(SALT, F.explode(every))


def with_salt(df: DataFrame, on: Sequence[str | Column], hot: Sequence[int], n: int, by: Sequence[str | Column]) -> DataFrame:
    """The big side: a hash of ``by`` as the salt of rows with hot keys, 0 for others. A hash, not
    a random number, so a recomputed task sends each row where it went before."""
    salt = F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    return df.withColumn(SALT, F.when(is_hot(on, hot), salt).otherwise(F.lit(0)))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    n: int,
    how: str = "inner",
    salt_by: Sequence[str] | None = None,
    share: float = 0.01,
) -> DataFrame:
    """Equi-join that spreads the keys with ``share`` or more of ``big``'s rows over n salts.

    For plans in which Spark does not split skewed joins itself. Only the hot keys' rows of
    ``small`` are repeated, n times; without hot keys it is a plain join. ``salt_by`` are columns
    that differ between the rows of a key. Without them, rows of a hot key, which may all be alike,
    are counted first: equal rows are joined once, with their number, and repeated afterwards, so
    no key has more rows than it has different ones.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep or drop rows of the big side can be salted")
    hot = hot_keys(big, on, share)
    if not hot:
        return big.join(small, list(on), how)
    if salt_by:
        left = with_salt(big, on, hot, n, salt_by)
        return left.join(with_salts(small, on, hot, n), [*on, SALT], how).drop(SALT)
    chosen = is_hot(on, hot)
    counted = big.where(chosen).groupBy(*big.columns).agg(F.count("*").alias("_times"))
    left = with_salt(counted, on, hot, n, big.columns)
    joined = left.join(with_salts(small.where(chosen), on, hot, n), [*on, SALT], how).drop(SALT)
    copies = F.explode(F.sequence(F.lit(1), F.col("_times")))
    warm = joined.withColumn("_copy", copies).drop("_times", "_copy")
    return big.where(~chosen).join(small, list(on), how).unionByName(warm)
