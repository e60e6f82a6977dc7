"""Fixed-size batches of a sorted id list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.tables import scratch_table


def nested_ids(df: DataFrame, items: str, field: str = "id", name: str = "id") -> DataFrame:
    """Distinct values of one field of a nested list, in no order; a listing sorts them itself."""
    return df.select(F.explode(f"{items}.{field}").alias(name)).distinct()


def batches(ids: DataFrame, column: str, size: int = 100, partitions: int | None = None) -> DataFrame:
    """Number the sorted ids and cut them into batches 0, 1, 2 .. of ``size``; NULLs come last.

    One global order in two passes and without one global task at any size: the ids are range-partitioned and
    numbered within their partition, and written down so that they stay where they are; then the partitions are
    counted, and each one's numbers go on where the ones before it end.
    """
    order = F.col(column).asc_nulls_last()
    dealt = ids.repartitionByRange(order) if partitions is None else ids.repartitionByRange(partitions, order)
    # the number of the partition stands in the upper bits, that of the row in the lower 33
    placed = scratch_table(dealt.sortWithinPartitions(order).withColumn("__at", F.monotonically_increasing_id()), "batches")
    partition = F.call_function("shiftright", F.col("__at"), F.lit(33)).cast("int")
    counted = placed.groupBy(partition.alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
    counts = {row["partition"]: row["rows"] for row in counted.collect()}  # one row for each partition
    before = [sum(n for other, n in counts.items() if other < number) for number in range(max(counts, default=0) + 1)]
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    place = F.get(offsets, partition) + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("batch", F.floor(place / size).cast("bigint")).drop("__at")
