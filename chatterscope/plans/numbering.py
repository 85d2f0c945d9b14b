"""Dense numbers in the order of a column, without a task that holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatterscope.plans.lineage import cut_lineage


def numbered(values: DataFrame, column: str, name: str, first: int = 0) -> DataFrame:
    """(column, name): the distinct values of ``column``, numbered from ``first`` in their order.

    Values are dealt out by range, numbered inside their part, and shifted by the sizes of the
    parts before; the driver sees one size for a part.
    """
    parted = cut_lineage(
        values.select(column)
        .distinct()
        .repartitionByRange(column)
        .withColumn("_part", F.spark_partition_id())
    )
    sizes = {r["_part"]: r["count"] for r in parted.groupBy("_part").count().collect()}
    pairs, before = [], first
    for part in sorted(sizes):
        pairs += [F.lit(part), F.lit(before)]
        before += sizes[part]
    offset = F.element_at(F.create_map(*pairs), F.col("_part")) if pairs else F.lit(0)
    place = F.row_number().over(W.partitionBy("_part").orderBy(column)) - 1
    return parted.select(column, (place + offset).cast("int").alias(name))
