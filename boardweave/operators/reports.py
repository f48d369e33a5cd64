"""Profiles and summaries over the bronze and silver tables.

Every report aggregates with map-side combining to a result bounded by a small
vocabulary; rankings take their top rows without a full sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardweave.functions.text import path_tail


def raggedness_profile(bronze: DataFrame) -> DataFrame:
    """Which generation-specific columns each feed really fills."""
    probes = {"has_int_enum": "EmploymentType", "has_str_enum": "JobType", "has_parsed_geo": "City",
              "has_salary": "SalaryMin", "rescued": "_rescued_data"}
    counts = [(F.count(c) if c in bronze.columns else F.lit(0).cast("bigint")).alias(n)
              for n, c in probes.items()]
    return (bronze.groupBy("board", "schema_gen").agg(F.count("*").alias("rows"), *counts)
            .orderBy(F.desc("rows"), "board", "schema_gen"))


def raw_spellings(bronze: DataFrame, top: int = 25) -> DataFrame:
    """Most frequent raw employment values per generation."""
    return (bronze.groupBy("schema_gen", F.coalesce("JobType", "EmploymentType").alias("employment_raw"))
            .agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "schema_gen", "employment_raw").limit(top))


def rows_per_file(bronze: DataFrame, parts: int = 2) -> DataFrame:
    """Rows and first ingest per file, named by the last ``parts`` of its path."""
    return (bronze.groupBy(path_tail(F.col("_source_file"), parts).alias("file"))
            .agg(F.count("*").alias("rows"), F.min("_ingested_at").alias("ingested_at")).orderBy("file"))


def funnel(bronze: DataFrame, postings: DataFrame) -> DataFrame:
    """Row counts from raw to current to canonical; postings are read once."""
    stages = F.expr("stack(2, 'silver postings', n, 'canonical postings', canonical) AS (stage, n)")
    silver = postings.agg(F.count("*").alias("n"), F.count_if("is_canonical").alias("canonical")).select(stages)
    return bronze.agg(F.count("*").alias("n")).select(F.lit("bronze rows").alias("stage"), "n").union(silver)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percent of total per value of a small-vocabulary column."""
    counts = df.groupBy(column).agg(F.count("*").alias("postings"))
    total = F.sum("postings").over(Window.partitionBy(F.lit(0)))
    return (counts.withColumn("pct", F.round(100 * F.col("postings") / total, 1))
            .orderBy(F.desc("postings"), column))


def histogram(df: DataFrame, *columns: str, count_as: str = "n", top: int | None = None) -> DataFrame:
    """Rows per combination of values, most frequent first."""
    ranked = df.groupBy(*columns).agg(F.count("*").alias(count_as)).orderBy(F.desc(count_as), *columns)
    return ranked if top is None else ranked.limit(top)


def seniority_sources(postings: DataFrame, top: int = 15) -> DataFrame:
    return histogram(postings, "seniority", "seniority_source", count_as="postings", top=top)


def salary_trust_matrix(facts: DataFrame, top: int = 25) -> DataFrame:
    return histogram(facts, "salary_currency", "salary_currency_confidence", "salary_period",
                     "salary_period_confidence", count_as="rows", top=top)


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    return (quarantine.groupBy("reject_reason", "board")
            .agg(F.count("*").alias("rows"),
                 F.min("salary_mid_annual_usd").alias("min_annual_usd"),
                 F.max("salary_mid_annual_usd").alias("max_annual_usd"))
            .orderBy(F.desc("rows"), "reject_reason", "board"))


def top_skills(skills: DataFrame, top: int = 20) -> DataFrame:
    """Skills by number of postings, with the boards they appear on. A skill
    row is unique per posting, so counting rows counts postings."""
    per_board = skills.groupBy("skill", "board").agg(F.count("*").alias("n"))
    return (per_board.groupBy("skill")
            .agg(F.sum("n").alias("postings"), F.array_sort(F.collect_set("board")).alias("boards"))
            .orderBy(F.desc("postings"), "skill").limit(top))


def profile(df: DataFrame, *columns: str) -> DataFrame:
    """(dimension, value, n) for several small-vocabulary columns at once."""
    values = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"))
                       for c in columns])
    return (df.select(F.explode(values).alias("v")).groupBy("v.dimension", "v.value")
            .agg(F.count("*").alias("n")))


def clean_range(facts: DataFrame) -> DataFrame:
    return facts.agg(F.min("salary_mid_annual_usd").alias("lowest"),
                     F.max("salary_mid_annual_usd").alias("highest"))


def conformance_tail(postings: DataFrame) -> DataFrame:
    """Share of postings whose employment type or seniority stayed open."""
    def share(condition):
        return F.count_if(condition) / F.count("*")
    return postings.agg(
        F.count("*").alias("postings"),
        share(F.col("employment_type").isin("other", "unknown")).alias("employment_tail"),
        share(F.col("seniority") == "unknown").alias("seniority_tail"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Ragged union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
