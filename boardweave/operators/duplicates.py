"""Duplicate groups across feeds: size, canonical row, cross-board flag.

One duplicate key can hold a large share of all rows (every row without link,
company and title has the same fingerprint), so no step may send a whole group
to one task. Group facts are one aggregation of narrow columns, combined on the
map side, that keeps groups of two or more. The rows join them back. Neither side of that join comes
from an aggregation's exchange, so adaptive execution can split the partition of a hot key, and no
other row pays for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardweave.functions.text import norm_text
from boardweave.sources.tables import POSTINGS

POSTING_COLUMNS = [name for name, *_ in POSTINGS]

_BY_URL = "url:"


def matched_by() -> Column:
    return (F.when(F.col("dup_key").startswith(_BY_URL), "source_url")
            .otherwise("fingerprint").alias("matched_by"))


def _precedence() -> Column:
    """Earliest posted first, undated last, then board and source id."""
    return F.struct(F.col("posted_at").isNull().alias("undated"), "posted_at", "board", "source_id")


def group_facts(current: DataFrame) -> DataFrame:
    """Size, first row by precedence and whether boards differ, of each group of two or more."""
    return (
        current.select("dup_key", "board", _precedence().alias("_rank"))
        .groupBy("dup_key")
        .agg(F.count("*").alias("dup_group_size"), F.min("_rank").alias("_first"),
             (F.min("board") != F.max("board")).alias("is_cross_board_duplicate"))
        .filter("dup_group_size > 1")
    )


def flag_duplicates(current: DataFrame) -> DataFrame:
    """``current`` plus group size, canonical flag and cross-board flag.

    Needs dup_key, board, source_id and posted_at; other columns ride along.
    Rows without a match in ``group_facts`` are alone in their group.
    """
    # The key as an expression is dealt anew: only then may the join split the rows of a hot key.
    facts = group_facts(current).select(
        F.concat("dup_key", F.lit("")).alias("_key"), "dup_group_size", "_first", "is_cross_board_duplicate")
    joined = current.withColumn("_rank", _precedence()).join(facts, F.col("dup_key") == F.col("_key"), "left")
    return joined.select(
        *current.columns,
        F.coalesce("dup_group_size", F.lit(1).cast("bigint")).alias("dup_group_size"),
        F.coalesce(F.col("_rank") == F.col("_first"), F.lit(True)).alias("is_canonical"),
        F.coalesce("is_cross_board_duplicate", F.lit(False)).alias("is_cross_board_duplicate"))


def enrich_postings(current: DataFrame) -> DataFrame:
    """Current postings -> 35 consumer columns with duplicate-group flags."""
    return flag_duplicates(current).select(*POSTING_COLUMNS)


def cross_board_summary(postings: DataFrame) -> DataFrame:
    """Per set of boards and kind of match: groups and redundant postings.

    Boards are first counted per (group, board), so the set collected for one
    group holds each board once however many postings the group has.
    """
    per_board = (
        postings.filter("is_cross_board_duplicate")
        .groupBy("dup_key", "board")
        .agg(F.count_if(~F.col("is_canonical")).alias("n"))
    )
    groups = per_board.groupBy("dup_key").agg(
        F.array_sort(F.collect_set("board")).alias("boards_in_group"), F.sum("n").alias("n"))
    return (
        groups.groupBy("boards_in_group", matched_by())
        .agg(F.count("*").alias("dup_groups"), F.sum("n").alias("redundant_postings"))
        .orderBy(F.desc("dup_groups"), "boards_in_group", "matched_by")
    )


def group_samples(postings: DataFrame) -> DataFrame:
    """Per cross-board group: its boards and the title of its canonical row."""
    return (
        postings.filter("is_cross_board_duplicate")
        .groupBy("dup_key", "board")
        .agg(F.max(F.when(F.col("is_canonical"), F.col("title"))).alias("title"))
        .groupBy("dup_key")
        .agg(F.array_sort(F.collect_set("board")).alias("boards"), F.max("title").alias("title"))
    )


def canonical_violations(postings: DataFrame) -> DataFrame:
    """Groups that do not have exactly one canonical row (expected: none)."""
    return (
        postings.groupBy("dup_key")
        .agg(F.count_if(F.col("is_canonical")).alias("canonical_rows"))
        .filter("canonical_rows <> 1")
    )


def exact_copies(df: DataFrame, *columns: str, row_id: str) -> DataFrame:
    """Groups of rows equal in normalised ``columns``: size and first row."""
    parts = [F.coalesce(norm_text(F.col(c)), F.lit("")) for c in columns]
    return (
        df.select(row_id, F.sha2(F.concat_ws("||", *parts), 256).alias("fingerprint"))
        .groupBy("fingerprint")
        .agg(F.count("*").alias("copies"), F.min(row_id).alias("first_id"))
    )
