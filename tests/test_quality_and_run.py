from datetime import datetime

import pytest
from pyspark.sql import functions as F
from records import posting

from boardweave.operators import quality as Q
from boardweave.operators.duplicates import flag_duplicates
from boardweave.operators.latest import latest_wins
from boardweave.operators.salary import fx_rates, salary_base_from, salary_facts_from
from boardweave.operators import marts as M
from boardweave.operators.typed import typed_postings
from boardweave.plans.facade import bronze
from boardweave.plans.silver_run import silver_run, silver_run_incremental
from boardweave.sources import tables as S

# a salary nobody earns, and a record that does not say who it is
ABSURD = posting(Id="99999901", CompanyName="Demo Co", JobType="Full-time", Location="Berlin, DE", SalaryMin="2",
                 SalaryMax="3", SalaryCurrency="EUR", SalaryPeriod="yearly")
NAMELESS = posting(Id=None, CompanyName="Demo Co", JobType="Full-time", Location="Berlin, DE")


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1,), (-1,), (None,)], "x int")


def test_policies(numbers):
    assert Q.enforce(numbers, Q.rules(Q.WARN, {"p": "x > 0"})).count() == 3
    assert Q.enforce(numbers, Q.rules(Q.DROP, {"p": "x > 0"})).count() == 1
    assert Q.enforce(numbers, Q.rules(Q.DROP, {"p": "x IS NULL OR x > 0"})).count() == 2
    with pytest.raises(Exception, match="expectation failed: p"):
        Q.enforce(numbers, Q.rules(Q.FAIL, {"p": "x > 0"})).count()
    assert Q.enforce(numbers, Q.rules(Q.FAIL, {"p": "x IS NULL OR x < 9"})).count() == 3


def test_fail_rule_survives_column_pruning(numbers):
    wide = numbers.withColumn("y", F.lit(1))
    with pytest.raises(Exception, match="expectation failed"):
        Q.enforce(wide, Q.rules(Q.FAIL, {"p": "x > 0"})).select("y").collect()


def test_counts_in_one_pass_and_while_writing(numbers):
    applied = Q.rules(Q.DROP, {"p": "x > 0"}) + Q.rules(Q.WARN, {"q": "x IS NOT NULL"})
    measured = {r["name"]: (r["passed_records"], r["failed_records"]) for r in Q.measure(numbers, applied, "t").collect()}
    assert measured == {"p": (1, 2), "q": (2, 1)}
    kept, seen = Q.observed(numbers, applied, "seen-once")
    assert kept.count() == 1 and seen.get == {"rows": 3, "passed:p": 1, "passed:q": 2}


def test_rollup_reads_the_latest_run_only(spark):
    def metrics(run_id, at, name, passed, failed):
        return spark.createDataFrame([(run_id, datetime.fromisoformat(at), "t", name, Q.WARN, passed, failed)], Q.METRIC_SCHEMA)

    old, new = metrics("a", "2026-01-01", "p", 1, 2), metrics("b", "2026-01-02", "q", 0, 0)
    rows = [tuple(r) for r in Q.expectation_rollup(old.union(new)).collect()]
    assert rows == [("t", "q", 0, 0, None)]


@pytest.fixture(scope="module")
def run(spark, bronze_of, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    rows = bronze(spark, "/root/testdata/sf0.001").unionByName(bronze_of(ABSURD), allowMissingColumns=True)
    return out, silver_run(rows, out, as_of="2026-09-01")


def test_absurd_salary_is_dropped_and_quarantined(spark, run):
    out, _ = run
    mine = "posting_key = 'board_1:99999901'"
    assert S.read_published(spark, out, "postings").filter(mine).count() == 1
    assert S.read_published(spark, out, "salary_facts").filter(mine).count() == 0
    assert S.read_published(spark, out, "salary_quarantine").filter(mine).first()["reject_reason"] == "annual_out_of_bounds"


def test_declared_tables(spark, run):
    out, _ = run
    for name, declared in [("postings", S.POSTINGS), ("posting_skills", S.POSTING_SKILLS),
                           ("salary_facts", S.SALARY_FACTS), ("salary_quarantine", S.SALARY_QUARANTINE),
                           ("postings_typed", S.TYPED), ("postings_current", S.TYPED), ("weekly_postings", S.WEEKLY_POSTINGS),
                           ("salary_bands", S.SALARY_BANDS), ("skill_trends", S.SKILL_TRENDS),
                           ("duplication_rate", S.DUPLICATION_RATE), ("salary_coverage", S.SALARY_COVERAGE),
                           ("mart_reconciliation", S.MART_RECONCILIATION)]:
        fields = S.read_published(spark, out, name).schema.fields
        assert [(f.name, f.dataType.simpleString()) for f in fields] == [(n, k) for n, k, _ in declared]
        assert all(f.metadata["comment"] for f in fields)
    comments = dict(S.read_published(spark, out, "table_comments").collect())
    assert "at least 10 postings" in comments["skill_trends"]


def test_metrics_match_the_tables(spark, run):
    out, run_id = run
    metrics = {(r["dataset"], r["name"]): r for r in S.read_published(spark, out, "quality_metrics").collect()}
    assert len(metrics) == 17 + 6  # silver rules, mart rules
    bounds = metrics["salary_facts", "annual_in_bounds"]
    assert bounds["passed_records"] == S.read_published(spark, out, "salary_facts").count()
    assert bounds["failed_records"] == S.read_published(spark, out, "salary_quarantine").count()
    assert bounds["run_id"] == run_id


def test_missing_identity_fails_and_publishes_nothing(spark, bronze_of, run):
    out, run_id = run
    with pytest.raises(Q.ExpectationFailed, match="source_identity_present"):
        silver_run(bronze_of(ABSURD, NAMELESS), out, run_id="broken")
    assert S.published_run(spark, out) == run_id


# --- marts against plain Python --------------------------------------------------

@pytest.fixture(scope="module")
def silver(spark):
    postings = flag_duplicates(latest_wins(typed_postings(bronze(spark, "/root/testdata/sf0.001")))).cache()
    fx = fx_rates(spark)
    return postings, fx, salary_facts_from(salary_base_from(postings, fx)).cache()


def test_weekly_coverage_equals_a_join_to_the_facts(silver):
    postings, fx, facts = silver
    weekly = M.weekly_postings(postings, fx)
    keys = facts.select(F.col("posting_key").alias("k"), F.lit(1).alias("usable"))
    joined = (postings.filter("is_canonical").join(keys, F.col("posting_key") == F.col("k"), "left")
              .groupBy(M.week_of(), "board").agg(F.count("*").alias("n"), F.count("usable").alias("u"),
                                                 F.countDistinct("company_name").alias("c")))
    got = {(r["week"], r["board"]): (r["new_postings"], round(r["salary_coverage_pct"] * r["new_postings"] / 100),
                                     r["distinct_companies"]) for r in weekly.collect()}
    assert got == {(r["week"], r["board"]): (r["n"], r["u"], r["c"]) for r in joined.collect()}


def test_bands_flag_small_samples_and_are_ordered(silver):
    bands = M.salary_bands(silver[2]).collect()
    assert all(b["p25"] <= b["p50"] <= b["p75"] and b["small_sample"] == (b["n_postings"] < 5) for b in bands)
    assert sum(b["n_postings"] for b in bands) == silver[2].filter("is_canonical").count()


def test_duplication_pairs_come_from_boards(spark, silver):
    """Three boards in one group, one of them twice: three pairs, each counting
    the redundant rows on its own two boards."""
    rows = [("k", b, i, i == 1, True, "2026-01-05") for i, b in enumerate(["x", "x", "y", "z"], 1)]
    postings = spark.createDataFrame(rows, "dup_key string, board string, source_id long, is_canonical boolean, "
                                           "is_cross_board_duplicate boolean, d string")
    postings = postings.withColumn("posted_at", F.col("d").cast("timestamp"))
    got = {(r["board_a"], r["board_b"]): (r["dup_groups"], r["redundant_postings"], r["total_postings"])
           for r in M.duplication_rate(postings).collect()}
    assert got == {("x", "y"): (1, 2, 3), ("x", "z"): (1, 2, 3), ("y", "z"): (1, 2, 2)}


def test_incremental_run_types_new_rows_only(spark, tmp_path):
    rows = bronze(spark, "/root/testdata/sf0.001")
    places = [str(tmp_path / n) for n in ("bronze", "state", "out")]

    def typed_in_last_run():
        metrics = S.read_published(spark, places[2], "quality_metrics").filter("dataset = 'postings_typed'")
        return {r["passed_records"] + r["failed_records"] for r in metrics.collect()}

    halves = [rows.filter("board < 'board_3'"), rows.filter("board >= 'board_3'")]
    for half in halves:
        half.write.mode("append").parquet(places[0])
        silver_run_incremental(spark, *places, as_of="2026-09-01", with_marts=False, compact_every=1)
        assert typed_in_last_run() == {half.count()}
    silver_run_incremental(spark, *places, as_of="2026-09-01", with_marts=False, compact_every=1)
    assert typed_in_last_run() == {0}
    silver_run(rows, str(tmp_path / "once"), as_of="2026-09-01", with_marts=False)
    found, whole = S.read_published(spark, places[2], "postings"), S.read_published(spark, str(tmp_path / "once"), "postings")
    assert found.exceptAll(whole).count() == 0 and whole.exceptAll(found).count() == 0


def test_quartiles_of_a_large_group(spark):
    """Beyond the sketch's accuracy a rank may be off by one in ten thousand, and no more."""
    n = 60_000
    facts = spark.range(n).select(
        F.lit("b").alias("board"), F.lit("US").alias("country"), F.lit("mid").alias("seniority"),
        F.lit("full_time").alias("employment_type"), F.lit(True).alias("is_canonical"),
        (F.col("id") * 7919 % n).cast("double").alias("salary_mid_annual_usd")).repartition(8)
    (row,) = M.salary_bands(facts).collect()
    assert row["n_postings"] == n and not row["small_sample"]
    for p, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert abs(row[p] - share * n) <= n / 10_000 + 1


@pytest.mark.parametrize(("predicate", "what"), [
    ("salary > (SELECT avg(x) FROM t)", "subquery"), ("exists (\nselect 1)", "subquery"), ("sum(x) > 1", "sum"), ("x > Max (y)", "Max"), ("row_number() OVER (ORDER BY x) = 1", "window"),
    ("count(*) OVER w > 1", "window"), ("lag(x) > 1", "lag"), ("any_value(x) IS NULL", "any_value")])
def test_rules_about_several_rows_are_refused(spark, predicate, what):
    with pytest.raises(ValueError, match=f"(?s)rule odd_one .*{what}"):
        Q.Rule("odd_one", predicate)


def test_rules_about_one_row_may_name_what_they_like(spark):
    for predicate in ("note != 'select sum(x) over (w)'", "`over (` = 1 -- select\n", "length(skill) <= 80 AND greatest(a, b) > 1", "exists(tags, t -> t = 'x')", "selected > 1"):
        assert Q.Rule("fine", predicate).passes() is not None
