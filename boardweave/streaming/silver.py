"""Silver on streams: row-local typing, and latest-wins by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardweave.operators.latest import KEYS, SEQUENCE, latest_wins, version_order
from boardweave.operators.quality import TYPED_RULES, Rule, enforce
from boardweave.operators.typed import typed_postings
from boardweave.plans.session import STATE_STORE
from boardweave.sources import files
from boardweave.streaming.bronze import drain


def table_stream(spark: SparkSession, path: str, limits: dict[str, str] | None = None) -> DataFrame:
    """An append-only parquet table as a stream, with the columns of all its files.

    ``limits`` bounds a micro-batch, e.g. maxFilesPerTrigger.
    """
    schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    return spark.readStream.schema(schema).options(**(limits or {})).parquet(path)


def observed_stream(df: DataFrame, applied: list[Rule], name: str) -> DataFrame:
    """Count each rule per micro-batch, then enforce drops and fails."""
    counts = [F.count_if(rule.passes()).alias(rule.name) for rule in applied]
    return enforce(df.observe(name, F.count("*").alias("rows"), *counts), applied)


def observed_totals(progresses: list, name: str) -> dict[str, int]:
    """Counts of an observed stream, summed over its micro-batches."""
    totals: dict[str, int] = {}
    for progress in progresses:
        metrics = progress["observedMetrics"].get(name)
        for key, value in (metrics.asDict() if metrics else {}).items():
            totals[key] = totals.get(key, 0) + value
    return totals


def stream_typed(bronze: DataFrame, typed_dir: str, checkpoint: str,
                 applied: list[Rule] = TYPED_RULES, state_policy: str = "passthrough",
                 min_evidence: bool = False) -> dict[str, int]:
    """Type new bronze rows and append them. A violated fail rule stops the
    micro-batch before the sink commits any of its rows."""
    typed = observed_stream(typed_postings(bronze, state_policy, min_evidence), applied, "typed_postings")
    return observed_totals(drain(typed, typed_dir, checkpoint), "typed_postings")


def _drain_batches(stream: DataFrame, write, checkpoint: str, mode: str):
    query = (stream.writeStream.foreachBatch(write).outputMode(mode)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def upsert_log(stream: DataFrame, log_dir: str, checkpoint: str, keys: tuple[str, ...] = KEYS,
               sequence: tuple[str, ...] = SEQUENCE):
    """Append each micro-batch, reduced to its newest row per key.

    The batch id is the folder name, so a replayed batch overwrites itself.
    No state is kept between batches; ``read_current`` settles them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        latest_wins(batch, keys, sequence).write.mode("overwrite").parquet(f"{log_dir}/batch={batch_id}")
    return _drain_batches(stream, write, checkpoint, "append")


def _compacted(log_dir: str) -> str:
    return f"{log_dir}_compacted"


def compacted_through(spark: SparkSession, log_dir: str) -> int | None:
    """Newest batch that a finished compaction holds."""
    versions = f"{_compacted(log_dir)}/versions"
    if not files.exists(spark, versions):
        return None
    return spark.read.parquet(versions).agg(F.max("through")).first()[0]


def read_current(spark: SparkSession, log_dir: str, keys: tuple[str, ...] = KEYS,
                 sequence: tuple[str, ...] = SEQUENCE) -> DataFrame:
    """One row per key over the newest compaction and all batches after it, late older versions ignored.

    A batch has a key once, as ``upsert_log`` writes it, so a log of one batch is read as it is.
    """
    log, through = spark.read.parquet(log_dir), compacted_through(spark, log_dir)
    if through is None:
        first, last = log.agg(F.min("batch"), F.max("batch")).first()
        return log.drop("batch") if first == last else latest_wins(log.drop("batch"), keys, sequence)
    base = spark.read.parquet(f"{_compacted(log_dir)}/through={through}")
    return latest_wins(log.filter(F.col("batch") > through).drop("batch").unionByName(base), keys, sequence)


def compact_log(spark: SparkSession, log_dir: str, keys: tuple[str, ...] = KEYS, sequence: tuple[str, ...] = SEQUENCE,
                every: int = 1) -> bool:
    """Write the current rows as a new version, once ``every`` batches have come since the last.

    Call it between drains, when the last batch is complete. The version counts
    only from its entry in ``versions`` on, which is written after it; batches
    and older versions stay until someone removes those that no reader needs.
    """
    newest = spark.read.parquet(log_dir).agg(F.max("batch")).first()[0]
    through = compacted_through(spark, log_dir)
    if newest is None or newest - (-1 if through is None else through) < every:
        return False
    read_current(spark, log_dir, keys, sequence).write.mode("overwrite").parquet(f"{_compacted(log_dir)}/through={newest}")
    spark.createDataFrame([(newest,)], "through int").coalesce(1).write.mode("append").parquet(f"{_compacted(log_dir)}/versions")
    return True


def stateful_latest(stream: DataFrame, log_dir: str, checkpoint: str, keys: tuple[str, ...] = KEYS,
                    sequence: tuple[str, ...] = SEQUENCE):
    """Latest-wins with the newest version of every key held in stream state.

    Every batch writes the keys it touched with their newest version so far,
    which is right even for a row that arrives late. State holds a whole row
    of every key, so a session whose state store keeps it in memory is
    refused; ``session.tune`` sets the one on disk. ``upsert_log`` needs no state.
    """
    provider = stream.sparkSession.conf.get(STATE_STORE[0])
    if provider != STATE_STORE[1]:
        raise ValueError(f"{STATE_STORE[0]} must be {STATE_STORE[1]}, not {provider}")
    newest = (
        stream.groupBy(*keys)
        .agg(F.max_by(F.struct(*stream.columns), version_order(stream, sequence)).alias("_row"))
        .select("_row.*")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_dir}/batch={batch_id}")
    return _drain_batches(newest, write, checkpoint, "update")


def read_touched(spark: SparkSession, log_dir: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Current rows from a stateful log: per key, the row of its last batch."""
    log = spark.read.parquet(log_dir)
    row = F.max_by(F.struct(*[c for c in log.columns if c != "batch"]), "batch")
    return log.groupBy(*keys).agg(row.alias("_row")).select("_row.*")
