"""A training corpus from raw documents, in five stages that each take all their predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from boardweave.llm import bpe, decontaminate, language, similar, substrings
from boardweave.llm.batches import order_id, table, unused, written
from boardweave.llm.queries import BYTE_BPE, language_model
from boardweave.llm.ship import ship
from boardweave.plans.session import fresh_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or in too mixed a text go."""
    return language.in_known_language(docs, language_model(ship(spark), sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least row of each group that five-word similarities of 0.8 or more connect.

    Rows are ordered by id, those without one last, and a hash of all columns; of rows that are equal throughout one stays.
    """
    row, least, many = (unused(docs.columns, c) for c in ("row_hash", "least_row", "times"))
    others = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c not in ("doc_id", "text")]  # as JSON, as maps have no hash
    docs = (ship(spark) and docs).withColumn(row, F.xxhash64("doc_id", "text", *([F.to_json(F.struct(*others))] if others else [])))
    found = similar.groups(docs.select(order_id().alias("order"), F.col(row).alias("row"), "text"))
    each = written(found.groupBy("group", "order", "row").agg(F.count("*").alias("n")), "rows")
    first = each.groupBy("group").agg(F.min(F.struct("order", "row")).alias("least"))
    each = written(each.join(first, "group").select("row", "n", (F.struct("order", "row") == F.col("least")).alias("stays")), "kept")
    gone = similar.few(each.where("not stays").select(F.col("row").alias(least)))
    kept = docs.join(gone, F.col(row) == F.col(least), "left_anti")
    twice = each.where("stays and n > 1").select(F.col("row").alias(many))
    if not twice.isEmpty():
        again = F.col(row) == F.col(many)
        twice = similar.few(twice)
        kept = kept.join(twice, again, "left_anti").unionByName(kept.join(twice, again, "left_semi").dropDuplicates([row]))
    return kept.drop(row)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that an earlier document has; documents of which nothing is left go."""
    return substrings.without_repeats(ship(spark) and docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.without_matches(docs, table(ship(spark), sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with their number and digests."""
    return bpe.token_digests(ship(spark) and docs, *BYTE_BPE)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("substrings", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("bpe", token_ids),
]

ORACLE_SQL = None  # fingerprints, learned languages and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
