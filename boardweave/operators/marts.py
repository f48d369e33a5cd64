"""Analytics marts over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardweave.operators.duplicates import matched_by
from boardweave.operators.quantiles import exact_quantiles
from boardweave.operators.quality import DROP, FAIL, WARN, rules
from boardweave.operators.salary import has_amount, with_annual_usd

SMALL_SAMPLE = 5
MIN_SKILL_POSTINGS = 10

TABLE_COMMENTS = {
    "weekly_postings": "New canonical postings per board and ISO week.",
    "salary_bands": f"Quartiles of annual salaries of canonical postings; under {SMALL_SAMPLE} postings are flagged, not hidden.",
    "skill_trends": f"Postings per skill, board and week; skills with at least {MIN_SKILL_POSTINGS} postings overall.",
    "duplication_rate": "Duplicate groups over several boards per pair of boards, week and kind of match.",
    "salary_coverage": "Canonical postings with a usable salary per board.",
    "mart_reconciliation": "Checks of the marts against each other and the postings; a violation fails the run.",
}
SKILL_TREND_RULES = rules(FAIL, {"share_in_unit_range": "share BETWEEN 0 AND 1"})
BAND_RULES = rules(DROP, {"has_postings": "n_postings > 0"}) + rules(WARN, {
    "bands_ordered": "p25 <= p50 AND p50 <= p75"})


def weekly_rules(as_of: str | None = None):
    now = f"timestamp'{as_of}'" if as_of else "current_timestamp()"
    return rules(DROP, {"week_known_not_future": f"week IS NOT NULL AND week <= {now}"}) + rules(WARN, {
        "counts_not_negative": "new_postings >= 0 AND distinct_companies >= 0"})


RECONCILIATION_RULES = rules(FAIL, {"reconciled": "violations = 0"})


def week_of(when: str = "posted_at") -> Column:
    return F.date_trunc("week", when).alias("week")


def weekly_postings(postings: DataFrame, fx: DataFrame) -> DataFrame:
    """New canonical postings per board and ISO week: volume, companies,
    remote share and the share with a usable salary.

    Whether a salary is usable depends on the row and the rate table alone, so
    it is worked out here again instead of joining the facts table back on a
    key as wide as the postings themselves. Companies are counted after
    reducing to one row per (week, board, company), in two combined steps.
    """
    rows = with_annual_usd(
        postings.filter("is_canonical").select(
            "board", "posted_at", "company_name", "is_remote", "salary_currency", "salary_period",
            "salary_min_src", "salary_max_src"), fx)
    usable = has_amount() & F.col("reject_reason").isNull()
    per_company = rows.groupBy(week_of(), "board", "company_name").agg(
        F.count("*").alias("n"),
        F.count_if("is_remote").alias("remote"),
        F.count_if(usable).alias("paid"))
    return per_company.groupBy("week", "board").agg(
        F.sum("n").alias("new_postings"),
        F.count("company_name").alias("distinct_companies"),
        (F.sum("remote") / F.sum("n")).alias("remote_share"),
        (100 * F.sum("paid") / F.sum("n")).alias("salary_coverage_pct"))


def salary_bands(facts: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """p25 / p50 / p75 of the annual midpoint per board, country, seniority and
    employment type. The percentile sketch merges partial results, so no group
    is ever held whole. A value's rank is off by at most n / ``accuracy`` of its
    group's n rows; up to ``accuracy`` rows it is exact."""
    keys = ("board", "country", "seniority", "employment_type")
    mid = F.col("salary_mid_annual_usd")
    return (
        facts.filter("is_canonical").groupBy(*keys)
        .agg(F.percentile_approx(mid, [0.25, 0.5, 0.75], accuracy).alias("_p"),
             F.count("*").alias("n_postings"))
        .select(*keys, F.get("_p", F.lit(0)).alias("p25"), F.get("_p", F.lit(1)).alias("p50"),
                F.get("_p", F.lit(2)).alias("p75"), "n_postings",
                (F.col("n_postings") < SMALL_SAMPLE).alias("small_sample"))
    )


def exact_salary_bands(facts: DataFrame) -> DataFrame:
    """``salary_bands`` with exact quartiles of groups of any size, at the price of a few passes over the facts."""
    keys = ("board", "country", "seniority", "employment_type")
    found = exact_quantiles(facts.filter("is_canonical"), keys, "salary_mid_annual_usd", [0.25, 0.5, 0.75])
    return found.select(*keys, *[F.get("values", F.lit(i)).alias(name) for i, name in enumerate(("p25", "p50", "p75"))],
                        F.col("n").alias("n_postings"), (F.col("n") < SMALL_SAMPLE).alias("small_sample"))


def skill_trends(dated_skills: DataFrame, postings: DataFrame,
                 min_postings: int = MIN_SKILL_POSTINGS) -> DataFrame:
    """Postings per skill, board and week, and their share of that board-week.

    ``dated_skills`` are skill rows that carry ``posted_at``, unique per
    (posting, skill). The overall threshold is checked on the aggregated rows.
    """
    counts = dated_skills.groupBy("skill", "board", week_of()).agg(F.count("*").alias("postings"))
    overall = F.sum("postings").over(Window.partitionBy("skill"))
    frequent = counts.withColumn("_overall", overall).filter(F.col("_overall") >= min_postings).drop("_overall")
    totals = (postings.groupBy(F.col("board").alias("_board"), week_of().alias("_week"))
              .agg(F.count("*").alias("_total")))
    same = (F.col("board") == F.col("_board")) & F.col("week").eqNullSafe(F.col("_week"))
    return frequent.join(totals, same).select(
        "skill", "board", "week", "postings", (F.col("postings") / F.col("_total")).alias("share"))


def duplication_rate(postings: DataFrame) -> DataFrame:
    """Cross-board duplication per board pair, week and kind of match.

    A group counts for each pair of boards it spans, in the week of its
    canonical row; its redundant postings are its non-canonical ones on either
    board. The rate divides by all postings of both boards in that week.
    Pairs are formed of the boards of a group, never of its rows.
    """
    per_board = (
        postings.filter("is_cross_board_duplicate")
        .groupBy("dup_key", "board")
        .agg(F.count_if(~F.col("is_canonical")).alias("redundant"),
             F.min(F.when(F.col("is_canonical"), F.col("posted_at"))).alias("first_posted"))
    )
    member = F.struct("board", "redundant")
    groups = per_board.groupBy("dup_key").agg(
        F.sort_array(F.collect_list(member)).alias("_m"), week_of_min("first_posted"))
    lefts = groups.select("dup_key", "week", "_m", F.posexplode("_m").alias("_i", "_a"))
    pairs = lefts.select("dup_key", "week", "_a",
                         F.explode(F.slice("_m", F.col("_i") + 2, F.size("_m"))).alias("_b"))
    rated = pairs.groupBy(F.col("_a.board").alias("board_a"), F.col("_b.board").alias("board_b"),
                          "week", matched_by()).agg(
        F.count("*").alias("dup_groups"),
        F.sum(F.col("_a.redundant") + F.col("_b.redundant")).alias("redundant_postings"))
    totals = postings.groupBy("board", week_of()).agg(F.count("*").alias("n"))

    def total_of(board: str) -> DataFrame:
        return totals.select(F.col("board").alias(f"{board}_key"), F.col("week").alias(f"{board}_week"),
                             F.col("n").alias(f"{board}_n"))

    def matches(board: str) -> Column:
        return (F.col(board) == F.col(f"{board}_key")) & F.col("week").eqNullSafe(F.col(f"{board}_week"))

    total = F.coalesce("board_a_n", F.lit(0)) + F.coalesce("board_b_n", F.lit(0))
    return (
        rated.join(total_of("board_a"), matches("board_a"), "left")
        .join(total_of("board_b"), matches("board_b"), "left")
        .select("board_a", "board_b", "week", "matched_by", "dup_groups", "redundant_postings",
                total.alias("total_postings"),
                (F.col("redundant_postings") / F.nullif(total, F.lit(0))).alias("rate"))
    )


def week_of_min(column: str) -> Column:
    return F.date_trunc("week", F.min(column)).alias("week")


def salary_coverage(postings: DataFrame, fx: DataFrame) -> DataFrame:
    """Share of canonical postings with a usable salary, per board."""
    rows = with_annual_usd(postings.filter("is_canonical"), fx)
    usable = F.count_if(has_amount() & F.col("reject_reason").isNull())
    return rows.groupBy("board").agg(
        F.count("*").alias("postings"), usable.alias("usable"),
        (100 * usable / F.count("*")).alias("salary_coverage_pct"))


def reconciliation(postings: DataFrame, weekly: DataFrame, bands: DataFrame, trends: DataFrame,
                   as_of: str | None = None) -> DataFrame:
    """(check, checked, violations): band order, share range, and weekly sums per
    board against the canonical postings whose week is known and not in the future."""
    def checked(name: str, rows: DataFrame, holds: str) -> DataFrame:
        return rows.agg(F.count("*").alias("checked"), F.count_if(~F.coalesce(F.expr(holds), F.lit(False))).alias("violations")
                        ).select(F.lit(name).alias("check"), "checked", "violations")

    now = f"timestamp'{as_of}'" if as_of else "current_timestamp()"
    expected = (postings.filter("is_canonical").filter(week_of() <= F.expr(now))
                .groupBy("board").agg(F.count("*").alias("expected")))
    summed = weekly.groupBy("board").agg(F.sum("new_postings").alias("summed"))
    return (
        checked("bands_ordered", bands, "p25 <= p50 AND p50 <= p75")
        .union(checked("share_in_unit_range", trends, "share BETWEEN 0 AND 1"))
        .union(checked("weekly_sums_match", expected.join(summed, "board", "full_outer"), "expected = summed"))
    )
