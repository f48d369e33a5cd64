"""Published amounts -> annual US dollars, with a reason for every reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardweave.functions import lookups as L
from boardweave.functions.conform import midpoint, period_annual_multiplier

REJECT_REASONS = ("unknown_currency", "unknown_period", "annual_out_of_bounds")
_CARRIED = (
    "posting_key board country seniority employment_type is_canonical salary_currency "
    "salary_currency_confidence salary_period salary_period_confidence salary_min_src salary_max_src"
).split()


def fx_rates(spark: SparkSession) -> DataFrame:
    """(currency, usd_rate, as_of), one row per pinned rate, by currency.

    Inline VALUES, so Spark knows the size of this side and broadcasts it on
    its own; a larger table passed in its place is joined as its size demands.
    """
    rows = ", ".join(f"('{c}', {rate!r}D, '{L.FX_AS_OF}')" for c, rate in sorted(L.FX_TO_USD.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS fx(currency, usd_rate, as_of)")


def has_amount() -> Column:
    return F.col("salary_min_src").isNotNull() | F.col("salary_max_src").isNotNull()


def with_annual_usd(postings: DataFrame, fx: DataFrame) -> DataFrame:
    """Every posting, its rate, its annual figures and its reject reason.

    The rate is looked up by left join, so a currency without one is visible
    as NULL. Rows without any amount get NULL figures and no reason.
    """
    rates = fx.select(F.col("currency").alias("_currency"), "usd_rate")
    joined = postings.join(rates, F.col("salary_currency") == F.col("_currency"), "left").drop("_currency")
    factor = period_annual_multiplier(F.col("salary_period"))

    def annual(amount: Column) -> Column:
        return (amount * factor * F.col("usd_rate")).cast("double")

    low, high = F.col("salary_min_src"), F.col("salary_max_src")
    priced = joined.withColumns({
        "salary_min_annual_usd": annual(low),
        "salary_max_annual_usd": annual(high),
        "salary_mid_annual_usd": annual(midpoint(low, high)),
    })
    mid = F.col("salary_mid_annual_usd")
    reason = (F.when(~has_amount(), None)
              .when(F.col("usd_rate").isNull(), "unknown_currency")
              .when(F.col("salary_period").isNull(), "unknown_period")
              .when((mid < L.ANNUAL_USD_MIN) | (mid > L.ANNUAL_USD_MAX), "annual_out_of_bounds"))
    return priced.withColumn("reject_reason", reason)


def salary_base_from(postings: DataFrame, fx: DataFrame) -> DataFrame:
    """Postings with an amount: 17 columns plus ``reject_reason``."""
    return with_annual_usd(postings.filter(has_amount()), fx).select(
        *_CARRIED, "usd_rate", "salary_min_annual_usd", "salary_max_annual_usd",
        "salary_mid_annual_usd", "posted_at", "reject_reason")


def salary_facts_from(base: DataFrame) -> DataFrame:
    return base.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def salary_quarantine_from(base: DataFrame) -> DataFrame:
    return base.filter(F.col("reject_reason").isNotNull())


def unknown_currencies(postings: DataFrame, fx: DataFrame) -> DataFrame:
    """Postings with an amount whose currency has no rate, by anti join."""
    return postings.filter(has_amount()).join(
        fx, F.col("salary_currency") == F.col("currency"), "left_anti")
