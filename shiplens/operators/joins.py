"""A join that survives a hot key on the many side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame, right: DataFrame, key: str, salt_by: Column, how: str = "inner", salts: int = 32
) -> DataFrame:
    """``left`` joined with ``right``, which has one row per key, on a salted key.

    Adaptive execution splits a hot partition only between two plain shuffles; where the
    right side is an aggregate it does not. Left rows are spread over ``salts`` by
    ``salt_by`` and the right side is repeated for each, so one key is shared by as many
    tasks. Spark does not see the copies in its estimate, so it would broadcast a table
    ``salts`` times its threshold; the hint rules that out.
    """
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join in which a null key matches a null key, as data frames outside SQL do."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])
