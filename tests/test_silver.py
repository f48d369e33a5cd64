from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from records import posting

from boardweave.operators import duplicates as D
from boardweave.operators import salary as P
from boardweave.operators.latest import latest_wins, version_history
from boardweave.operators.skills import skills_from
from boardweave.operators.typed import INPUT_CONTRACT, ensure_columns, typed_postings
from boardweave.plans.facade import bronze


@pytest.fixture(scope="module")
def facade(spark):
    return bronze(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def current(facade):
    return latest_wins(typed_postings(facade)).cache()


def one(bronze_of, **fields):
    return typed_postings(bronze_of(posting(**fields))).first()


def test_shape_and_missing_columns(spark):
    bare = spark.createDataFrame([("board_1", "7")], "board string, Id string")
    typed = typed_postings(bare)
    assert len(typed.columns) == 36
    row = typed.first()
    assert row["posting_key"] == "board_1:7" and row["source_id"] == 7 and row["tags"] is None
    assert row["is_remote"] is False and row["employment_type"] == "unknown"
    assert ensure_columns(bare, {"board": "int"}).schema == bare.schema
    assert len(INPUT_CONTRACT) == 30


def test_amounts(bronze_of):
    assert one(bronze_of, SalaryMin="0", SalaryMax="-5")["salary_min_src"] is None
    assert one(bronze_of, SalaryMin="12.345")["salary_min_src"] == Decimal("12.35")
    assert one(bronze_of, SalaryMin="ten", SalaryCurrency="EUR")["salary_currency"] is None


@pytest.mark.parametrize("fields, currency, confidence", [
    (dict(SalaryMin="9", SalaryCurrency=" eur "), "EUR", "published"),
    (dict(SalaryMin="9", Country="FR"), "EUR", "inferred_geo"),
    (dict(SalaryMin="9", Country="OK"), None, None),
    (dict(SalaryCurrency="EUR"), None, None),
    (dict(SalaryMin="9", SalaryCurrency="USD", Country="UA"), "USD", "published"),
    (dict(SalaryMin="9", SalaryCurrency="USD", Country="UA", schema_gen="gen_a"), "UAH", "inferred_geo_over_default"),
    (dict(SalaryMin="9", SalaryCurrency="USD", Country="US", schema_gen="gen_a"), "USD", "published"),
    (dict(SalaryMin="9", SalaryCurrency="USD", Country="Atlantis", schema_gen="gen_a"), "USD", "published"),
])
def test_currency_trust(bronze_of, fields, currency, confidence):
    row = one(bronze_of, **fields)
    assert (row["salary_currency"], row["salary_currency_confidence"]) == (currency, confidence)


@pytest.mark.parametrize("fields, period, confidence", [
    (dict(SalaryPeriod=" Monthly ", SalaryMin="5", SalaryCurrency="USD"), "monthly", "published"),
    (dict(SalaryMin="149.99", SalaryCurrency="USD"), "hourly", "inferred_magnitude"),
    (dict(SalaryMin="150", SalaryCurrency="USD"), "monthly", "inferred_magnitude"),
    (dict(SalaryMin="10000", SalaryMax="20000", SalaryCurrency="USD"), "yearly", "inferred_magnitude"),
    (dict(SalaryMin="150", SalaryCurrency="XXX"), None, None),
    (dict(SalaryPeriod="per year"), None, None),
])
def test_period(bronze_of, fields, period, confidence):
    row = one(bronze_of, **fields)
    assert (row["salary_period"], row["salary_period_confidence"]) == (period, confidence)


def test_remote_never_null(bronze_of):
    assert one(bronze_of)["is_remote"] is False
    assert one(bronze_of, IsRemote="false", RemoteType="FullyRemote")["is_remote"] is True
    assert one(bronze_of, Location="Home Office")["is_remote"] is True
    assert one(bronze_of, IsHybrid="maybe")["is_hybrid"] is False


def test_duplicate_keys(bronze_of):
    assert one(bronze_of, SourceUrl=" HTTP://A/b/ ")["dup_key"] == "url:http://a/b"
    same = {one(bronze_of, CompanyName=c, Title=t)["dup_key"] for c, t in [("Acme", "Cook"), (" ACME", "cook ")]}
    assert len(same) == 1 and same.pop().startswith("fp:")
    empty = [posting(Id=str(i), CompanyName=None, Title=None) for i in (1, 2)]
    keys = typed_postings(bronze_of(*empty)).select("dup_key").distinct()
    assert keys.count() == 1
    assert typed_postings(bronze_of(*empty), min_evidence=True).select("dup_key").distinct().count() == 2


def test_times_and_ids(bronze_of):
    row = one(bronze_of, Id="abc", PostedAt="08/01/2026", UpdatedAt="2026-07-02")
    assert row["source_id"] is None and str(row["posted_at"]) == "2026-07-01 00:00:00"
    assert str(row["updated_at"]) == "2026-07-02 00:00:00"


def test_latest_is_independent_of_order(facade, current):
    shuffled = latest_wins(typed_postings(facade.orderBy(F.desc("Id"), "exported_at").repartition(5)))
    assert shuffled.exceptAll(current).count() == 0 and current.exceptAll(shuffled).count() == 0


def test_tied_versions_settle_alike(bronze_of):
    tied = [posting(Title=t, UpdatedAt=u) for t, u in [("a", None), ("b", "2026-07-02"), ("c", "2026-07-02")]]
    picks = {latest_wins(typed_postings(bronze_of(*rows))).first()["title"] for rows in (tied, tied[::-1])}
    assert len(picks) == 1 and picks < {"b", "c"}


def test_history_collapses_unchanged_versions(bronze_of):
    days = {1: "Active", 2: "Active", 3: "Closed", 4: "Active"}
    rows = [posting(Status=s, exported_at=f"2026-08-{n:02}T00:00:00") for n, s in days.items()]
    hourly = [posting(Id="2", Status=s, exported_at=f"2026-08-01T00:{n:02}:00") for n, s in days.items()]
    history = version_history(typed_postings(bronze_of(*rows, *hourly))).orderBy("source_id", "valid_from").collect()
    assert [r["status"] for r in history] == ["active", "closed", "active"] * 2
    assert [r["is_current"] for r in history] == [False, False, True] * 2
    assert history[0]["valid_to"] == history[1]["valid_from"] and history[3]["valid_to"] == history[4]["valid_from"]


def window_flags(current):
    group = Window.partitionBy("dup_key")
    order = group.orderBy(F.col("posted_at").asc_nulls_last(), "board", "source_id")
    return current.select(
        "board", "source_id", F.count("*").over(group).alias("dup_group_size"),
        (F.row_number().over(order) == 1).alias("is_canonical"),
        (F.size(F.collect_set("board").over(group)) > 1).alias("is_cross_board_duplicate"))


def test_duplicate_flags_match_plain_windows(current):
    got = D.flag_duplicates(current).select("board", "source_id", "dup_group_size", "is_canonical",
                                            "is_cross_board_duplicate")
    want = window_flags(current)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert D.canonical_violations(D.flag_duplicates(current)).count() == 0


def test_duplicate_flags_under_a_hot_key(current):
    hot = current.withColumn("dup_key", F.when(F.col("source_id") % 3 == 0, "fp:hot").otherwise(F.col("dup_key")))
    hot = hot.withColumn("posted_at", F.when(F.col("source_id") % 2 == 0, F.col("posted_at")))
    got = D.flag_duplicates(hot).select("board", "source_id", "dup_group_size", "is_canonical",
                                        "is_cross_board_duplicate")
    want = window_flags(hot)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rows_of_a_hot_key_are_split(spark, tmp_path):
    """With a third of all rows under one key the join is split by adaptive execution, and no window holds a group."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "fp:hot").otherwise(F.concat(F.lit("fp:"), "id")).alias("dup_key"), F.concat(F.lit("b"), F.col("id") % 4).alias("board"),
        F.col("id").cast("string").alias("source_id"), F.lit(None).cast("timestamp").alias("posted_at"), F.sha2(F.col("id").cast("string"), 512).alias("wide"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        flagged = D.flag_duplicates(rows)
        parts = flagged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("wide"), F.max("is_canonical"))
        sizes = [r["n"] for r in parts.collect()]
        plan = parts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "skew=true" in plan and max(sizes) < 60_000 and sum(sizes) == 300_000


def test_skills(bronze_of):
    typed = typed_postings(bronze_of(
        posting(Id="1", RequiredSkills='["Latte Art","latte  art",null]', Tags=["LATTE ART", "b"]),
        posting(Id="2", Tags=["Python", "python", "SQL", "  "]),
        posting(Id="3", RequiredSkills="not json", Tags=[]), posting(Id="4", RequiredSkills='"scalar"')))
    rows = {(r["posting_key"], r["skill"], r["skill_raw"], r["skill_source"]) for r in skills_from(typed).collect()}
    assert rows == {
        ("board_1:1", None, None, "required_skills_json"),
        ("board_1:1", "latte art", "Latte Art", "required_skills_json"), ("board_1:1", "b", "b", "tags"),
        ("board_1:2", "python", "Python", "tags"), ("board_1:2", "sql", "SQL", "tags"), ("board_1:2", "", "  ", "tags")}
    unique = skills_from(typed, unique_keys=True)
    assert unique.exceptAll(skills_from(typed)).count() == 0
    assert "Exchange" not in unique._jdf.queryExecution().executedPlan().toString()


def test_skills_merge_rows_of_one_posting(bronze_of):
    typed = typed_postings(bronze_of(posting(Tags=["b", "A"]), posting(RequiredSkills='["a"]')))
    rows = {(r["skill"], r["skill_source"]) for r in skills_from(typed).collect()}
    assert rows == {("a", "required_skills_json"), ("b", "tags")}


@pytest.mark.parametrize("fields, reason", [
    (dict(SalaryMin="50000", SalaryCurrency="XXX", SalaryPeriod="per year"), "unknown_currency"),
    (dict(SalaryMin="2", SalaryMax="3", SalaryCurrency="EUR", SalaryPeriod="yearly"), "annual_out_of_bounds"),
    (dict(SalaryMin="1000", SalaryCurrency="USD", SalaryPeriod="yearly"), None),
    (dict(SalaryMin="5000000.01", SalaryCurrency="USD", SalaryPeriod="yearly"), "annual_out_of_bounds"),
])
def test_reject_reasons(spark, bronze_of, fields, reason):
    rows = D.enrich_postings(latest_wins(typed_postings(bronze_of(posting(**fields)))))
    base = P.salary_base_from(rows, P.fx_rates(spark))
    assert base.first()["reject_reason"] == reason and len(base.columns) == 18


def test_unknown_period_needs_a_rate_table_of_its_own(spark, bronze_of):
    rows = D.enrich_postings(latest_wins(typed_postings(bronze_of(posting(SalaryMin="50000", SalaryCurrency="XXX")))))
    fx = spark.createDataFrame([("XXX", 2.0)], "currency string, usd_rate double")
    assert P.salary_base_from(rows, fx).first()["reject_reason"] == "unknown_period"


def test_facts_and_quarantine_are_complements(spark, current):
    base = P.salary_base_from(D.enrich_postings(current), P.fx_rates(spark)).cache()
    facts, rejects = P.salary_facts_from(base), P.salary_quarantine_from(base)
    assert facts.count() + rejects.count() == base.count() and facts.count() > 0 and rejects.count() > 0
    assert facts.filter("salary_mid_annual_usd NOT BETWEEN 1000 AND 5000000").count() == 0
    assert base.filter("salary_currency_confidence = 'inferred_geo_over_default'").count() > 0


def test_rate_table_is_broadcast_by_its_size(spark, current):
    plan = P.salary_base_from(D.enrich_postings(current), P.fx_rates(spark))
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
