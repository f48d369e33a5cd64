"""Declared output tables: column order, types, comments, and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardweave.sources import files

MONEY = "decimal(18,2)"

POSTINGS = [
    ("posting_key", "string", "board and source id; unique"),
    ("board", "string", "feed the posting came from"),
    ("source_id", "bigint", "id within the feed"),
    ("schema_gen", "string", "dialect of the feed: gen_a, gen_b or gen_c"),
    ("title", "string", "title as published"),
    ("company_name", "string", "company as published"),
    ("employment_type", "string", "canonical employment type, 11 values"),
    ("employment_type_raw", "string", "source value behind employment_type"),
    ("seniority", "string", "canonical seniority, 9 values"),
    ("seniority_source", "string", "published, title_parsed or none"),
    ("status", "string", "canonical status, 7 values"),
    ("is_remote", "boolean", "remote by flag, location text or remote type"),
    ("is_hybrid", "boolean", "hybrid by flag"),
    ("city", "string", "source city, else parsed from the location"),
    ("region", "string", "source state, else parsed from the location"),
    ("country", "string", "ISO code of source or parsed country; NULL if unknown"),
    ("location_raw", "string", "location as published"),
    ("location_quality", "string", "parse verdict of the location text"),
    ("salary_min_src", MONEY, "lower bound in source currency; NULL unless positive"),
    ("salary_max_src", MONEY, "upper bound in source currency; NULL unless positive"),
    ("salary_currency", "string", "effective currency, only next to an amount"),
    ("salary_currency_confidence", "string", "how the currency was decided"),
    ("salary_period", "string", "effective pay period"),
    ("salary_period_confidence", "string", "published or inferred_magnitude"),
    ("source_url", "string", "public link of the posting"),
    ("source_hash", "string", "hash assigned by the feed"),
    ("dup_key", "string", "duplicate group: normalised link, else content fingerprint"),
    ("dup_group_size", "bigint", "postings in the duplicate group"),
    ("is_canonical", "boolean", "representative of its duplicate group"),
    ("is_cross_board_duplicate", "boolean", "group spans several boards"),
    ("posted_at", "timestamp", "posting time, else creation time"),
    ("updated_at", "timestamp", "last source update"),
    ("last_seen_at", "timestamp", "last confirmation by the source"),
    ("expires_at", "timestamp", "expiry by the source"),
    ("exported_at", "timestamp", "export the row came from"),
]
POSTING_SKILLS = [
    ("posting_key", "string", "posting the skill belongs to"),
    ("board", "string", "feed of the posting"),
    ("skill", "string", "normalised skill"),
    ("skill_raw", "string", "skill as published"),
    ("skill_source", "string", "required_skills_json or tags"),
]
SALARY_FACTS = [
    ("posting_key", "string", "posting the salary belongs to"),
    ("board", "string", "feed of the posting"),
    ("country", "string", "country of the posting"),
    ("seniority", "string", "seniority of the posting"),
    ("employment_type", "string", "employment type of the posting"),
    ("is_canonical", "boolean", "filter on it to count each posting once"),
    ("salary_currency", "string", "effective currency"),
    ("salary_currency_confidence", "string", "how the currency was decided"),
    ("salary_period", "string", "effective pay period"),
    ("salary_period_confidence", "string", "how the period was decided"),
    ("salary_min_src", MONEY, "lower bound in source currency"),
    ("salary_max_src", MONEY, "upper bound in source currency"),
    ("usd_rate", "double", "rate applied"),
    ("salary_min_annual_usd", "double", "lower bound, US dollars a year"),
    ("salary_max_annual_usd", "double", "upper bound, US dollars a year"),
    ("salary_mid_annual_usd", "double", "midpoint, US dollars a year"),
    ("posted_at", "timestamp", "posting time"),
]
SALARY_QUARANTINE = SALARY_FACTS + [("reject_reason", "string", "why the salary is not usable")]
REF_FX_RATES = [
    ("currency", "string", "ISO 4217 code"),
    ("usd_rate", "double", "US dollars per unit"),
    ("as_of", "string", "when the rates were pinned"),
]
_FLAGS = {"dup_group_size", "is_canonical", "is_cross_board_duplicate"}
_AS_PUBLISHED = {  # further columns of typed rows, before the one they stand next to
    "salary_currency": [("salary_currency_src", "string", "currency as published")],
    "salary_period": [("salary_period_src", "string", "pay period as published, if it is a known one")],
    "source_url": [("skills_json", "string", "skills as published, a JSON array"), ("tags", "array<string>", "tags as published")],
}
TYPED = [column for c in POSTINGS if c[0] not in _FLAGS for column in [*_AS_PUBLISHED.get(c[0], []), c]]
WEEKLY_POSTINGS = [
    ("week", "timestamp", "Monday the ISO week begins with"),
    ("board", "string", "feed"),
    ("new_postings", "bigint", "canonical postings of the week"),
    ("distinct_companies", "bigint", "different company names among them"),
    ("remote_share", "double", "share of them that is remote, 0 to 1"),
    ("salary_coverage_pct", "double", "percent of them with a usable salary"),
]
SALARY_BANDS = [
    ("board", "string", "feed"),
    ("country", "string", "country of the postings"),
    ("seniority", "string", "seniority of the postings"),
    ("employment_type", "string", "employment type of the postings"),
    ("p25", "double", "lower quartile of the annual midpoint in US dollars"),
    ("p50", "double", "median of the annual midpoint in US dollars"),
    ("p75", "double", "upper quartile of the annual midpoint in US dollars"),
    ("n_postings", "bigint", "canonical postings with a usable salary"),
    ("small_sample", "boolean", "too few postings to rely on"),
]
SKILL_TRENDS = [
    ("skill", "string", "normalised skill"),
    ("board", "string", "feed"),
    ("week", "timestamp", "Monday the ISO week begins with; NULL if unknown"),
    ("postings", "bigint", "postings that ask for the skill"),
    ("share", "double", "share of all postings of board and week, 0 to 1"),
]
DUPLICATION_RATE = [
    ("board_a", "string", "one feed of the pair"),
    ("board_b", "string", "the other feed of the pair"),
    ("week", "timestamp", "week of the canonical posting"),
    ("matched_by", "string", "source_url or fingerprint"),
    ("dup_groups", "bigint", "groups that span both feeds"),
    ("redundant_postings", "bigint", "their postings that are not canonical"),
    ("total_postings", "bigint", "all postings of both feeds in the week"),
    ("rate", "double", "redundant by total postings"),
]
SALARY_COVERAGE = [
    ("board", "string", "feed"),
    ("postings", "bigint", "canonical postings"),
    ("usable", "bigint", "those with a usable salary"),
    ("salary_coverage_pct", "double", "their percentage"),
]
MART_RECONCILIATION = [
    ("check", "string", "name of the check"),
    ("checked", "bigint", "rows it looked at"),
    ("violations", "bigint", "rows that break it; the run fails unless 0"),
]


def struct_of(columns: list[tuple[str, str, str]], quality: str = "silver") -> T.StructType:
    """Schema with the comment and quality tag of each column as metadata."""
    return T.StructType([
        T.StructField(name, T.DataType.fromDDL(kind), True, {"comment": comment, "quality": quality})
        for name, kind, comment in columns])


def declared(df: DataFrame, columns: list[tuple[str, str, str]], quality: str = "silver") -> DataFrame:
    """Exactly the declared columns, in order, cast, with their comments."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in struct_of(columns, quality).fields])


def write_table(df: DataFrame, run_dir: str, name: str) -> DataFrame:
    """Write one table of a run into its own new folder and read it back."""
    path = f"{run_dir}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def every_run(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """Rows of one table over all runs below ``out_dir`` that came to write it."""
    return spark.read.parquet(f"{out_dir}/run=*/{name}")


def publish(spark: SparkSession, out_dir: str, run_id: str) -> None:
    """Point readers at a finished run; until then they see the one before.

    Each publication is a new small file, so a failed one leaves the old
    pointer in place.
    """
    pointer = spark.sql("SELECT current_timestamp() AS published_at").withColumn("run_id", F.lit(run_id))
    pointer.coalesce(1).write.mode("append").parquet(f"{out_dir}/published")


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    if not files.exists(spark, f"{out_dir}/published"):
        return None
    pointers = spark.read.parquet(f"{out_dir}/published")
    return pointers.agg(F.max_by("run_id", "published_at")).first()[0]


def read_published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/run={published_run(spark, out_dir)}/{name}")
