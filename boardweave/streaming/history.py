"""Type-2 history kept by a stream, right for batches in any order.

Two logs, one folder for each micro-batch, which a replayed batch overwrites.
``versions`` has the dated versions that came, also those that opened no
interval, as a later row may yet come between. ``intervals`` has the whole
history of the keys that a batch touched, made from all their versions so far;
of a key the newest batch counts. Nothing is kept in memory between batches.

Versions lie in ``BUCKETS`` folders by key, so a batch reads the buckets that it
touches and not the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardweave.operators.latest import KEYS, SEQUENCE, version_history, version_order
from boardweave.streaming.silver import _drain_batches

BUCKETS = 64


def _bucket(keys: tuple[str, ...]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")


def history_log(stream: DataFrame, log_dir: str, checkpoint: str, keys: tuple[str, ...] = KEYS,
                sequence: tuple[str, ...] = SEQUENCE, ignore: tuple[str, ...] = ("updated_at",)):
    """Drain the stream into the logs at ``log_dir``; ``read_history`` reads them.

    A late version changes the interval it falls into: it splits it, moves its
    start or joins it with the one before, as ``version_history`` over everything would have it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.groupBy(*keys, sequence[0]).agg(
            F.max_by(F.struct(*batch.columns), version_order(batch, sequence)).alias("_row")).select("_row.*")
        came = f"{log_dir}/versions/batch={batch_id}"
        # a bucket's rows meet before they are written: else every task leaves a file in every folder
        dated.withColumn("bucket", _bucket(keys)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(came)
        own = spark.read.schema(f"{_ddl(batch)}, bucket int").parquet(came)
        buckets = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # BUCKETS at most
        log = spark.read.schema(f"{_ddl(batch)}, batch int, bucket int").parquet(f"{log_dir}/versions")
        log = log.filter(F.col("bucket").isin(buckets) & (F.col("batch") <= batch_id))
        versions = log.join(own.select(*keys).distinct(), list(keys), "left_semi").select(*batch.columns)
        version_history(versions, keys, sequence, ignore).write.mode("overwrite").parquet(f"{log_dir}/intervals/batch={batch_id}")
    return _drain_batches(stream, write, checkpoint, "append")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def read_history(spark: SparkSession, log_dir: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """All intervals of all keys, as ``version_history`` gives them."""
    log = spark.read.parquet(f"{log_dir}/intervals")
    newest = log.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return log.join(newest, [*keys, "batch"], "left_semi").drop("batch")
