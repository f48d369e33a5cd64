"""The whole run: bronze rows in, published silver tables and marts out."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from boardweave.operators import marts as M
from boardweave.operators import quality as Q
from boardweave.operators.duplicates import enrich_postings
from boardweave.operators.latest import latest_wins
from boardweave.operators.salary import fx_rates, salary_base_from, salary_quarantine_from
from boardweave.operators.skills import skills_from
from boardweave.operators.typed import typed_postings
from boardweave.plans.session import tune
from boardweave.sources import tables as S
from boardweave.streaming.silver import compact_log, read_current, stream_typed, table_stream, upsert_log


def silver_run(bronze: DataFrame, out_dir: str, run_id: str | None = None, as_of: str | None = None,
               state_policy: str = "passthrough", with_marts: bool = True, min_evidence: bool = False) -> str:
    """Build every table under ``out_dir/run=<run_id>``, then publish the run.

    Each step is a written table, so a lost executor costs its tasks only and
    no step recomputes an earlier one. A violated fail rule raises
    ``ExpectationFailed`` and leaves the published run as it was.
    """
    def current(table, _note) -> DataFrame:
        rows = typed_postings(bronze, state_policy, min_evidence)
        return latest_wins(table("postings_typed", S.declared(rows, S.TYPED), Q.TYPED_RULES))
    return _built(bronze.sparkSession, out_dir, current, run_id, as_of, with_marts)


def silver_run_incremental(spark: SparkSession, bronze_dir: str, state_dir: str, out_dir: str, run_id: str | None = None,
                           as_of: str | None = None, state_policy: str = "passthrough", with_marts: bool = True,
                           min_evidence: bool = False, limits: dict[str, str] | None = None, compact_every: int = 8) -> str:
    """As ``silver_run`` over the bronze table, but typing only rows that are new since the last call.

    ``state_dir`` keeps the typed rows, the log of newest versions and the
    checkpoints of both streams; a fresh folder is a full refresh. ``limits``
    bounds the micro-batches. After ``compact_every`` batches the log of newest
    versions is compacted, so a run never reads its whole history. The later tables are built anew from the current
    rows, for any of their groups may have changed.
    """
    typed_dir, log_dir = f"{state_dir}/typed", f"{state_dir}/log"

    def current(_table, note) -> DataFrame:
        try:
            counts = stream_typed(table_stream(spark, bronze_dir, limits), typed_dir, f"{state_dir}/typed_checkpoint",
                                  state_policy=state_policy, min_evidence=min_evidence)
        except StreamingQueryException as failed:
            if "expectation failed" in str(failed):
                raise Q.ExpectationFailed(f"postings_typed: {failed}") from failed
            raise
        passed = {f"passed:{r.name}": counts.get(r.name, 0) for r in Q.TYPED_RULES}
        note("postings_typed", Q.TYPED_RULES, {"rows": counts.get("rows", 0)} | passed)
        upsert_log(table_stream(spark, typed_dir, limits), log_dir, f"{state_dir}/log_checkpoint")
        compact_log(spark, log_dir, every=compact_every)
        return read_current(spark, log_dir)
    return _built(spark, out_dir, current, run_id, as_of, with_marts)


def _built(spark: SparkSession, out_dir: str, current_rows: Callable, run_id: str | None, as_of: str | None,
           with_marts: bool) -> str:
    tune(spark)
    run_id = run_id or uuid.uuid4().hex
    run_dir = f"{out_dir}/run={run_id}"
    metrics: list[tuple] = []

    def table(name: str, rows: DataFrame, applied: list[Q.Rule] = ()) -> DataFrame:
        if not applied:
            return S.write_table(rows, run_dir, name)
        kept, seen = Q.observed(rows, list(applied), f"{name}-{run_id}")
        try:
            written = S.write_table(kept, run_dir, name)
        except PySparkException as failed:
            if "expectation failed" in str(failed):
                raise Q.ExpectationFailed(f"{name}: {failed}") from failed
            raise
        note(name, applied, seen.get)
        return written

    def note(name: str, applied: list[Q.Rule], counts: dict[str, int]) -> None:
        metrics.extend(Q.metric_rows(run_id, name, list(applied), counts, datetime.now(timezone.utc)))

    fx = table("ref_fx_rates", S.declared(fx_rates(spark), S.REF_FX_RATES, "reference"), Q.FX_RULES)
    current = table("postings_current", S.declared(current_rows(table, note), S.TYPED), Q.CURRENT_RULES)
    postings = table("postings", S.declared(enrich_postings(current), S.POSTINGS), Q.posting_rules(as_of))
    table("posting_skills", S.declared(skills_from(current, unique_keys=True), S.POSTING_SKILLS), Q.SKILL_RULES)
    # facts and quarantine both scan the few salary columns of ``postings``:
    # cheaper than storing the shared base, and nothing to lose with a node
    base = salary_base_from(postings, fx)
    facts = table("salary_facts", S.declared(base, S.SALARY_FACTS), Q.SALARY_RULES)
    table("salary_quarantine", S.declared(salary_quarantine_from(base), S.SALARY_QUARANTINE), Q.QUARANTINE_RULES)

    if with_marts:
        def mart(name: str, rows: DataFrame, columns: list, applied: list[Q.Rule] = ()) -> DataFrame:
            return table(name, S.declared(rows, columns, "gold"), applied)

        weekly = mart("weekly_postings", M.weekly_postings(postings, fx), S.WEEKLY_POSTINGS, M.weekly_rules(as_of))
        bands = mart("salary_bands", M.salary_bands(facts), S.SALARY_BANDS, M.BAND_RULES)
        dated = Q.enforce(skills_from(current, carry=("posted_at",), unique_keys=True), Q.SKILL_RULES)
        trends = mart("skill_trends", M.skill_trends(dated, postings), S.SKILL_TRENDS, M.SKILL_TREND_RULES)
        mart("duplication_rate", M.duplication_rate(postings), S.DUPLICATION_RATE)
        mart("salary_coverage", M.salary_coverage(postings, fx), S.SALARY_COVERAGE)
        mart("mart_reconciliation", M.reconciliation(postings, weekly, bands, trends, as_of), S.MART_RECONCILIATION,
             M.RECONCILIATION_RULES)

    S.write_table(spark.createDataFrame(list(M.TABLE_COMMENTS.items()), "dataset string, comment string").coalesce(1),
                  run_dir, "table_comments")
    S.write_table(spark.createDataFrame(metrics, Q.METRIC_SCHEMA).coalesce(1), run_dir, "quality_metrics")
    S.publish(spark, out_dir, run_id)
    return run_id
