"""Ranks over ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import stored


def ranked(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``df`` with ``rank``, from 1, of each row among those of equal ``keys`` (among all, for none) by ``order``.

    Rows are dealt by ranges of keys and order, so that a key that most rows have spreads over many tasks. Their ranks there are then shifted
    by how many rows of the key lie in ranges before: a few numbers for each range. The ranges are written once, as a second deal could cut
    them elsewhere. Rows of equal keys and order are ranked in any order."""
    by = [*keys, order]
    dealt = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).withColumn("__range", F.spark_partition_id())
    dealt = stored(dealt)
    sizes = dealt.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys, "__range").orderBy(order)
    rows = dealt.withColumn("__place", F.row_number().over(within))
    same = [rows[k].eqNullSafe(shifts[k]) for k in [*keys, "__range"]]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return rows.join(shifts, condition).select(*[rows[c] for c in df.columns], (F.col("__place") + F.col("__before")).cast("long").alias("rank"))
