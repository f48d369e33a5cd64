"""Incremental ingest: every landed file exactly once, then stop."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardweave.sources import files
from boardweave.sources import landing as land


OLDEST = "36500d"


class UnseenFields(RuntimeError):
    """New fields stopped the run; they are recorded, so the next run goes on."""

    def __init__(self, fields: list[str]):
        super().__init__(f"new fields recorded, run again: {fields}")
        self.fields = fields


def finished(query: StreamingQuery) -> list[dict]:
    """Wait for the end and return the progress of every micro-batch.

    Spark keeps the newest progresses only, so they are gathered while the
    query runs; ``drain`` has it keep more than pass between two looks.
    """
    seen: dict[int, dict] = {}
    running = True
    while running:
        running = not query.awaitTermination(1)
        seen.update((p["batchId"], p) for p in query.recentProgress)
    return [seen[k] for k in sorted(seen)]


def rows_ingested(progress: list[dict]) -> int:
    return sum(p["numInputRows"] for p in progress)


def drain(stream: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Append everything new to a parquet table, then stop. The checkpoint and
    the sink's own log make a repeated or crashed run harmless."""
    stream.sparkSession.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000")
    return finished(
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def bronze_stream(spark: SparkSession, landing: str, fields: dict[str, str], glob: str = "*.ndjson",
                  stop_on_unseen: bool = True, limits: dict[str, str] | None = None) -> DataFrame:
    """``limits`` bounds a micro-batch, e.g. maxFilesPerTrigger or maxBytesPerTrigger.

    Spark passes over files that are a week older than the newest it has seen; here a
    file may be ``OLDEST`` older. The driver remembers the names of files of that time, so
    a landing zone that is never cleared may set a shorter maxFileAge in ``limits``.
    """
    options = {**land.text_options(glob), "maxFileAge": OLDEST, **(limits or {})}
    lines = spark.readStream.options(**options).text(landing)
    return land.parse_lines(land.with_provenance(lines), fields, stop_on_unseen)


def ingested_batches(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """(_ingested_at, rows) of each committed micro-batch.

    A batch has one time, which Spark keeps with the batch's offsets, so a replay has it too. The
    counts are those of the table: no crash of the driver can lose or double them.
    """
    return spark.read.parquet(bronze_dir).groupBy("_ingested_at").agg(F.count("*").alias("rows"))


def _newest(spark: SparkSession, bronze_dir: str):
    if not files.exists(spark, f"{bronze_dir}/_spark_metadata"):
        return None
    return spark.read.parquet(bronze_dir).agg(F.max("_ingested_at")).first()[0]


def ingest(spark: SparkSession, landing: str, bronze_dir: str, checkpoint: str, schema_dir: str,
           glob: str = "*.ndjson", evolve: bool = True, limits: dict[str, str] | None = None) -> int:
    """Drain new files into bronze and return the number of rows the table has gained.

    With ``evolve`` a field outside the recorded schema stops the run once:
    nothing of the batch is committed, the widened schema is recorded, and the
    same files load on the next run. Without it such fields are rescued.
    """
    fields = land.recorded_fields(spark, schema_dir)
    if fields is None:
        fields = dict(land.BRONZE_FIELDS)
        land.record_fields(spark, schema_dir, fields)
    before = _newest(spark, bronze_dir)
    try:
        drain(bronze_stream(spark, landing, fields, glob, evolve, limits), bronze_dir, checkpoint)
    except StreamingQueryException as stopped:
        if land.UNSEEN not in str(stopped):
            raise
        new = land.unseen_fields(spark, land.pending_files(spark, landing, glob, bronze_dir), fields)
        land.record_fields(spark, schema_dir, {**fields, **dict.fromkeys(new, "string")})
        raise UnseenFields(new) from stopped
    if _newest(spark, bronze_dir) is None:
        return 0
    gained = ingested_batches(spark, bronze_dir)
    gained = gained if before is None else gained.filter(F.col("_ingested_at") > F.lit(before))
    return gained.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

