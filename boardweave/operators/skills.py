"""Skills in three encodings -> one row per (posting, skill)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardweave.functions.text import norm_text

JSON_SOURCE = "required_skills_json"
TAG_SOURCE = "tags"
SKILL_COLUMNS = ("posting_key", "board", "skill", "skill_raw", "skill_source")


def _entries(values: Column, source: str, preference: int) -> Column:
    entry = F.transform(values, lambda raw: F.struct(
        norm_text(raw).alias("skill"), F.lit(preference).alias("preference"),
        raw.alias("skill_raw"), F.lit(source).alias("skill_source")))
    return F.coalesce(entry, F.array().cast(
        "array<struct<skill:string,preference:int,skill_raw:string,skill_source:string>>"))


def _found_skills() -> Column:
    """All entries of one posting in order of skill, JSON spelling before tag
    spelling, then raw text."""
    return F.sort_array(F.concat(
        _entries(F.from_json("skills_json", "array<string>"), JSON_SOURCE, 0),
        _entries(F.col("tags"), TAG_SOURCE, 1)))


def _first_per_skill(found: str) -> Column:
    marked = F.transform(found, lambda entry, at: F.struct(
        entry.alias("entry"),
        ((at == 0) | ~entry["skill"].eqNullSafe(F.get(found, at - 1)["skill"])).alias("keep")))
    return F.transform(F.filter(marked, lambda m: m["keep"]), lambda m: m["entry"])


def skills_from(current: DataFrame, carry: tuple[str, ...] = (), unique_keys: bool = False) -> DataFrame:
    """(posting_key, board, skill, skill_raw, skill_source), one per skill.

    Duplicates inside a posting disappear before rows are multiplied, without
    a shuffle. With ``unique_keys`` (one row per posting, as latest-wins
    guarantees) that is all; otherwise rows of the same posting are merged by
    one more aggregation. ``carry`` passes further posting columns through.
    """
    rows = (
        current.select("posting_key", "board", *carry, _found_skills().alias("_found"))
        .select("posting_key", "board", *carry, _first_per_skill("_found").alias("_skills"))
        .select("posting_key", "board", *carry, F.explode("_skills").alias("_s"))
    )
    if unique_keys:
        return rows.select("posting_key", "board", "_s.skill", "_s.skill_raw", "_s.skill_source", *carry)
    best = F.min_by(F.struct("board", "_s", *carry), F.struct("_s.preference", "_s.skill_raw", "board"))
    return (
        rows.groupBy("posting_key", F.col("_s.skill").alias("skill"))
        .agg(best.alias("_b"))
        .select("posting_key", "_b.board", "skill", "_b._s.skill_raw", "_b._s.skill_source",
                *[f"_b.{c}" for c in carry])
    )
