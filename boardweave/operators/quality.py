"""Named row rules with a policy: count, drop or fail.

A rule is a SQL predicate. A row passes when the predicate is true; NULL is a
violation, so rules that accept missing values say so. Counting rides along
with the job that writes the rows (an ``Observation``), so measuring a table
costs no second pass over it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boardweave.functions import lookups as L

WARN, DROP, FAIL = "warn", "drop", "fail"
METRIC_SCHEMA = ("run_id string, recorded_at timestamp, dataset string, name string, policy string, "
                 "passed_records bigint, failed_records bigint")


_QUOTED = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/""", re.DOTALL)
_CALLED = re.compile(r"([A-Za-z_]\w*)\s*\(")


def _beyond_the_row(predicate: str) -> str | None:
    """What in a predicate looks beyond its row. Aggregates are known to a session only."""
    bare = _QUOTED.sub(" '' ", predicate)
    for what, sign in (("a subquery", r"\bselect\b"), ("a window", r"\bover\b\s*(\(|\w)")):
        if re.search(sign, bare, re.IGNORECASE):
            return what
    spark = SparkSession.getActiveSession()
    for name in dict.fromkeys(_CALLED.findall(bare)) if spark else ():
        if spark.catalog.functionExists(name):
            made_by = spark.catalog.getFunction(name).className or ""
            if ".expressions.aggregate." in made_by or made_by.rpartition(".")[2] in _RANKS:
                return f"the aggregate or window function {name}"
    return None


#: Classes of the functions that number or compare the rows of a window.
_RANKS = ("RowNumber", "Rank", "DenseRank", "PercentRank", "CumeDist", "NTile", "Lag", "Lead", "NthValue")


@dataclass(frozen=True)
class Rule:
    """A predicate over one row. One that looks at other rows is refused: when it is
    declared, or, for aggregates of a rule declared before there is a session, when it is first used."""

    name: str
    predicate: str
    policy: str = WARN

    def __post_init__(self) -> None:
        found = _beyond_the_row(self.predicate)
        if found:
            raise ValueError(f"rule {self.name} is not about one row alone: it has {found}")

    def passes(self) -> Column:
        self.__post_init__()
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def rules(policy: str, predicates: dict[str, str]) -> list[Rule]:
    """A group of rules sharing one policy, from name -> predicate."""
    return [Rule(name, predicate, policy) for name, predicate in predicates.items()]


# --- the rules of each table (fixed names and predicates) ---------------------

FX_RULES = rules(FAIL, {
    "positive_rate": "usd_rate > 0",
    "iso_4217_shape": "length(currency) = 3",
})
TYPED_RULES = rules(FAIL, {
    "source_identity_present": "board IS NOT NULL AND source_id IS NOT NULL AND exported_at IS NOT NULL",
}) + rules(WARN, {
    "title_present": "title IS NOT NULL",
    "company_present": "company_name IS NOT NULL",
})
CURRENT_RULES = rules(WARN, {"posting_key_present": "posting_key IS NOT NULL"})
SKILL_RULES = rules(DROP, {
    "skill_nonempty": "skill IS NOT NULL AND skill != ''",
    "posting_key_present": "posting_key IS NOT NULL",
}) + rules(WARN, {"skill_length_sane": "length(skill) <= 80"})
SALARY_RULES = rules(DROP, {
    "fx_rate_known": "usd_rate IS NOT NULL",
    "period_known": "salary_period IS NOT NULL",
    "annual_in_bounds": f"salary_mid_annual_usd BETWEEN {L.ANNUAL_USD_MIN} AND {L.ANNUAL_USD_MAX}",
}) + rules(WARN, {
    "bounds_ordered": "salary_min_annual_usd IS NULL OR salary_max_annual_usd IS NULL "
                      "OR salary_min_annual_usd <= salary_max_annual_usd",
})
QUARANTINE_RULES = rules(WARN, {"reason_present": "reject_reason IS NOT NULL"})


def posting_rules(as_of: str | None = None) -> list[Rule]:
    """Rules of the consumer table; ``as_of`` fixes "now" for repeatable runs."""
    now = f"timestamp'{as_of}'" if as_of else "current_timestamp()"
    return rules(WARN, {
        "posted_at_reasonable": "posted_at IS NULL OR (posted_at >= '2015-01-01' "
                                f"AND posted_at <= {now} + INTERVAL 7 DAYS)",
        "country_resolved": "country IS NOT NULL",
        "employment_conformed": "employment_type NOT IN ('other', 'unknown')",
    })


# --- applying rules -------------------------------------------------------------

class ExpectationFailed(RuntimeError):
    """A fail rule met a violating row; nothing was published."""


def _counts(applied: list[Rule]) -> list[Column]:
    return [F.count_if(rule.passes()).alias(f"passed:{rule.name}") for rule in applied]


def enforce(df: DataFrame, applied: list[Rule]) -> DataFrame:
    """Rows the drop rules keep; a row violating a fail rule stops the job.

    The fail check is a filter: unlike an extra column, a filter cannot be
    pruned away when nobody reads its result.
    """
    for rule in applied:
        if rule.policy == FAIL:
            stop = F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")
            df = df.filter(F.when(rule.passes(), True).otherwise(stop))
        elif rule.policy == DROP:
            df = df.filter(rule.passes())
    return df


def observed(df: DataFrame, applied: list[Rule], name: str) -> tuple[DataFrame, Observation]:
    """``enforce`` plus pass counts taken over all incoming rows, available
    from the observation once a job has consumed the result."""
    seen = Observation(name)
    counted = df.observe(seen, F.count("*").alias("rows"), *_counts(applied))
    return enforce(counted, applied), seen


def metric_rows(run_id: str, dataset: str, applied: list[Rule], counts: dict, recorded_at) -> list[tuple]:
    """One ``METRIC_SCHEMA`` row per rule from observed counts."""
    return [(run_id, recorded_at, dataset, rule.name, rule.policy, counts[f"passed:{rule.name}"],
             counts["rows"] - counts[f"passed:{rule.name}"]) for rule in applied]


def measure(df: DataFrame, applied: list[Rule], dataset: str) -> DataFrame:
    """(dataset, name, policy, passed_records, failed_records), one per rule,
    from a single aggregation over ``df``."""
    totals = df.agg(F.count("*").alias("rows"), *_counts(applied))
    per_rule = F.array(*[
        F.struct(F.lit(rule.name).alias("name"), F.lit(rule.policy).alias("policy"),
                 F.col(f"`passed:{rule.name}`").alias("passed_records"),
                 (F.col("rows") - F.col(f"`passed:{rule.name}`")).alias("failed_records"))
        for rule in applied])
    return (totals.select(F.explode(per_rule).alias("m"))
            .select(F.lit(dataset).alias("dataset"), "m.*"))


# --- metrics of several runs ------------------------------------------------------

def of_latest_run(metrics: DataFrame) -> DataFrame:
    """Rows of the run recorded last. Its id is one row by construction and
    joins on equality, so that side is reduced to it before it meets the rest."""
    latest = metrics.agg(F.max_by("run_id", F.struct("recorded_at", "run_id")).alias("run_id"))
    return metrics.join(latest, "run_id", "left_semi")


def expectation_rollup(metrics: DataFrame) -> DataFrame:
    """Passed, failed and failed percent per rule of the latest run in ``METRIC_SCHEMA`` rows."""
    passed, failed = F.sum("passed_records"), F.sum("failed_records")
    return (
        of_latest_run(metrics).groupBy("dataset", F.col("name").alias("expectation"))
        .agg(passed.alias("passed"), failed.alias("failed"),
             F.round(100 * failed / F.nullif(passed + failed, F.lit(0)), 2).alias("failed_pct"))
        .orderBy("dataset", "expectation")
    )
