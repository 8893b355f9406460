"""An equi-join of many rows with a table of keys, in which no hot key's rows meet in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all weight is hot; so there are fewer than 1 / HOT hot keys.
HOT = 1 / 1000


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str, spread: Column) -> DataFrame:
    """Inner join of `rows` with `table`, one row a `key` (long), whose `weight` tells how many rows have it.

    Hot keys are broadcast, fewer than 1 / HOT by their definition; the others are joined by shuffle, and rows
    that found a hot key go there by `spread`, a number that differs from row to row.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) > F.lit(float(total) * HOT)
    values = [c for c in table.columns if c not in (key, weight)]
    packed = F.struct(*values) if values else F.struct(F.lit(True).alias("found"))
    few = table.where(hot).select(key, packed.alias("_hot"))
    many = table.where(~hot).select(F.col(key).alias("_key"), packed.alias("_cold"))
    met = rows.join(F.broadcast(few), key, "left").withColumn("_at", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread))
    out = met.join(many, met["_at"] == many["_key"], "left").withColumn("_value", F.coalesce("_hot", "_cold")).where(F.col("_value").isNotNull())
    return out.select(*rows.columns, *[F.col("_value")[c].alias(c) for c in values])
