"""Contiguous shards of nearly equal bytes, cut on a global prefix sum of sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segwatch.functions.storage import cut

DELIMITER_BYTES = 1
LEAST_PARTS = 256
ROWS_PER_PART = 1 << 20


def byte_shards(
    df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16,
    partitions: int | None = None, rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``key, size, text_crc32, shard, slot``: every row placed in one of ``shards`` shards.

    The rows are taken in key order. A row's size is its text in UTF-8 plus one delimiter, and its
    shard is the target interval of total / shards bytes that the middle of the row falls into, so
    shards are contiguous in key order and differ from the target by at most a row's size.
    ``slot`` numbers the rows of a shard from 0.

    Only key, size and checksum are shuffled. They are dealt by ranges of the key into
    ``partitions`` parts, by default of about ``rows_per_part`` rows and 256 at least; the parts' totals (one row each)
    give every part its offset, and running sums inside the parts do the rest, so no sum runs over the table in one task. Equal keys are
    told apart by checksum, size and position in the input, so a key with most of the rows is dealt over many
    parts. NULL texts have size 1, NULL keys come first, repeated rows take neighbouring slots, an
    empty table gives an empty result, and other columns are not read.
    """
    if min(shards, 1 if partitions is None else partitions, rows_per_part) < 1:
        raise ValueError("shards, partitions and rows_per_part must be at least 1")
    body = F.coalesce(F.col(text), F.lit(""))
    order = ["key", "text_crc32", "size", "place"]
    rows = df.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + DELIMITER_BYTES).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Written once: positions and part numbers must not change when a part is computed again.
    rows = cut(rows, "shard-sizes")
    if partitions is None:  # the count comes from the files' footers
        partitions = max(LEAST_PARTS, -(-rows.count() // rows_per_part))
    parts = cut(rows.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()), "shard-parts")
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # One row of 40 bytes for each part, a millionth of the rows: 10^12 rows give 40 MB to the window and the broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_parts = Window.partitionBy()
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(all_parts).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        parts.withColumns({"bytes_here": F.sum("size").over(inside), "rows_here": F.count(F.lit(1)).over(inside)})
        .join(F.broadcast(offsets), "part")
        .withColumn("twice_middle", 2 * (F.col("bytes_before") + F.col("bytes_here")) - F.col("size"))
        .withColumn("position", F.col("rows_before") + F.col("rows_here") - 1)
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"twice_middle * {shards} div (2 * total)")).cast("int"))
        .select("key", "size", "text_crc32", "shard", "position")
    )
    placed = cut(placed, "shard-rows")
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))  # at most `shards` rows
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot")
    )
