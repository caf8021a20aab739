"""First-wins, last-wins and numbering per key, safe for keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``. Spark limits each task to one row per key before the
    shuffle (window group limit), so hot keys do not pile up."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def last_filled_per_key(df: DataFrame, keys: list[str], order: list[str], properties: list[str]) -> DataFrame:
    """Per property the last value that is not empty; a property never set stays null. One
    aggregation, combined map-side."""
    at = F.struct(*order)
    picked = [
        F.max_by(F.col(p), F.when(F.col(p).isNotNull() & (F.col(p).cast("string") != ""), at)).alias(p)
        for p in properties
    ]
    return df.groupBy(*keys).agg(*picked)


def number_per_key(df: DataFrame, key: str, order: list[str], bucket: Column, name: str) -> DataFrame:
    """``row_number`` per key without one task per key: rows are numbered inside ``(key, bucket)``
    and shifted by the sizes of the earlier buckets. ``bucket`` must grow with ``order``."""
    df = df.withColumn("_bucket", bucket)
    sizes = df.groupBy(key, "_bucket").count()
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(key, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order))
    return (
        df.withColumn("_n", inside).join(shift, [key, "_bucket"])
        .withColumn(name, (F.col("_n") + F.col("_shift")).cast("int")).drop("_n", "_shift", "_bucket")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break uniqueness, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def out_of_range(df: DataFrame, value: str = "confidence", low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.filter(~F.col(value).between(low, high))


def pending(df: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the state table."""
    return df.join(state.select(*keys), keys, "left_anti")


def uniqueness_report(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """``(label, key, value, n)``: every value that breaks the uniqueness of its key, over all given ``(label, key)``
    tables at once. One aggregation, combined map-side, so a value of many rows does not pile up. Null keys break
    nothing. No tables give an error, tables without rows an empty report."""
    parts = [df.select(F.lit(label).alias("label"), F.lit(key).alias("key"), F.col(key).cast("string").alias("value")) for (label, key), df in tables.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.where("value IS NOT NULL").groupBy("label", "key", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
