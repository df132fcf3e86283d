"""Two-pass external shuffle into shards of equally many rows.

First pass: records are scattered by a seeded hash into buckets that fit in memory. Second pass: each bucket is
shuffled on its own (Spark's `shuffle`, a Fisher-Yates shuffle of the bucket's array) and the buckets, laid end to end,
are written as shards. DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Bytes that a record counts beside its text.
OVERHEAD = 16


def record_size(text: str = "text"):
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + OVERHEAD).cast("bigint")


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """counts (bucket, n) with `before`, the rows of all smaller buckets: sums in runs of about sqrt(buckets) buckets,
    then over the runs, so that no task sees more than that many rows."""
    buckets = counts.agg(F.max("bucket")).first()[0]
    run = (F.col("bucket") / F.lit(math.isqrt((buckets or 0) + 1) + 1)).cast("bigint")
    up = Window.partitionBy("_run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("_run", run).withColumn("_own", F.coalesce(F.sum("n").over(up), F.lit(0)))
    runs = counts.withColumn("_run", run).groupBy("_run").agg(F.sum("n").alias("_n"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return own.join(runs, "_run").select("bucket", (F.col("_own") + F.col("_before")).alias("before"))


def shuffled_shards(records: DataFrame, shards: int, seed: int = 11, bucket_bytes: int = 4_000_000, size: str = "size") -> DataFrame:
    """records, with shard and slot: a uniform random order of all rows, cut into `shards` runs whose lengths differ by
    one row at most (law `rows`); slot counts from 0 in each. `size` names the column with a record's bytes.

    The records are written once with a row number. A row's bucket is a seeded hash of that number, so neither a hot
    key nor copies can fill one; there are as many buckets as make bucket_bytes each on average, and a task holds one
    bucket at a time. A rerun over the same files and settings gives the same order.

    Null values in any column, repeated rows and records larger than a bucket are records like any other. An empty
    table gives an empty result; with fewer rows than shards, some shards stay empty. Columns named shard or slot are
    replaced; any other name may occur."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    names = [c for c in records.columns if c not in ("shard", "slot")]
    given = [f"c{i}" for i in range(len(names))]
    bytes_of = F.col(given[names.index(size)])
    rows = cut(records.select(*(F.col(f"`{c}`").alias(g) for c, g in zip(names, given)), F.monotonically_increasing_id().alias("row")))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(bytes_of), F.lit(0))).first()
    buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(buckets)))
    offsets = bucket_offsets(cut(scattered.groupBy("bucket").agg(F.count("*").alias("n"))))
    # a fixed number of partitions, each in a fixed order: the shuffle's random numbers then come out alike in a retry
    parts = min(buckets, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = scattered.repartition(parts, "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("row", *given))).alias("held"))
    mixed = held.sortWithinPartitions("bucket").withColumn("held", F.shuffle("held", seed=seed))
    placed = mixed.join(offsets, "bucket").select("before", F.posexplode("held").alias("at", "held"))
    place = (F.col("before") + F.col("at")).cast("bigint")
    first = F.expr(f"(cast(_shard as bigint) * {n} + {shards - 1}) div {shards}")  # the shard's first place
    spread = placed.select(place.alias("_place"), "held").withColumn("_shard", F.expr(f"_place * {shards} div {max(n, 1)}"))
    return spread.select(*(F.col("held")[g].alias(g) for g in given), F.col("_shard").cast("int"), F.col("_place") - first).toDF(*names, "shard", "slot")


def write_shards(records: DataFrame, path: str, shards: int, **options) -> None:
    """The shuffled records as Parquet files in folders shard=0, 1, ... of path, rows of a file in the order of slots.
    A bucket never spreads over more than a few shards, so each task writes a few files."""
    shuffled_shards(records, shards, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 40, **options) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes of its text, none if null, plus 16), text_crc32, law, shard,
    slot, grown_shard (null: under law `rows` a new shard count moves rows everywhere). Texts stay where they are
    read; an id and two numbers a document are shuffled."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    placed = shuffled_shards(docs.select("doc_id", record_size().alias("size"), crc.alias("text_crc32")), shards, **options)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
