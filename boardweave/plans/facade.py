"""A postings-shaped bronze input over the order tables.

No table of postings comes with the test data, so each order becomes one: the
order key decides which dialect, spelling, place, salary and link a posting
shows, so that every branch of the conformance rules is met. All orders are
used; some are exported again later (or arrive late), as separate versions.
Links are shared by pairs and by groups of 3 to 50 over all boards; one order in
a hundred has neither link, company, title nor place, so that all of these have
one duplicate key. Some 40 skills are common, thousands rare.

The text is one SELECT both Spark SQL and other ANSI engines run; only four
tokens differ between engines, so a checker can start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK_TOKENS = {"text": "STRING", "generate": "explode", "array": "array", "orders": "{orders}",
                "customer": "{customer}"}

# {text} string type, {generate} array generator, {array} array constructor
FACADE_SQL = """
SELECT
  CONCAT('board_', b) AS board,
  CASE b WHEN 0 THEN 'gen_a' WHEN 1 THEN 'gen_b' ELSE 'gen_c' END AS schema_gen,
  exported_at,
  CAST(j AS {text}) AS Id,
  CASE WHEN bare THEN NULL WHEN p % 20 = 1 THEN 'Barista' ELSE CASE j % 10
    WHEN 0 THEN 'Senior Barista' WHEN 1 THEN 'Jr. Developer' WHEN 2 THEN 'Team Lead'
    WHEN 3 THEN 'Account Executive' WHEN 4 THEN 'International Sales'
    WHEN 5 THEN 'Onboarding Clerk' WHEN 6 THEN 'Head of Roasting'
    WHEN 7 THEN 'Graduate Engineer' WHEN 8 THEN '  Cafe   Manager ' ELSE 'Barista' END END AS Title,
  CASE WHEN bare THEN NULL WHEN p % 20 = 1 THEN CONCAT('Shared Co ', CAST(p AS {text})) ELSE c_name END AS CompanyName,
  CASE WHEN b = 0 THEN CAST(j % 8 AS {text}) END AS EmploymentType,
  CASE WHEN b > 0 THEN CASE j % 14
    WHEN 0 THEN 'Full-time' WHEN 1 THEN 'FullTime' WHEN 2 THEN 'CDI' WHEN 3 THEN 'CDD'
    WHEN 4 THEN 'Ausbildung' WHEN 5 THEN '正社員' WHEN 6 THEN 'Teilzeit'
    WHEN 7 THEN 'Full-time, Part-time' WHEN 8 THEN 'Freelance' WHEN 9 THEN 'Per Diem'
    WHEN 10 THEN 'Werkstudent' WHEN 11 THEN 'gig' WHEN 12 THEN '  ' END END AS JobType,
  CASE WHEN b > 0 THEN CASE j % 6
    WHEN 0 THEN 'Senior' WHEN 1 THEN 'mid-level' WHEN 2 THEN 'Director' END END AS ExperienceLevel,
  CASE WHEN bare THEN NULL WHEN p % 20 = 1 THEN 'Berlin, DE' ELSE CASE j % 9
    WHEN 0 THEN 'Edmond, OK' WHEN 1 THEN 'San Jose, CA'
    WHEN 2 THEN 'Geldermalsen, Gelderland, NL' WHEN 3 THEN 'Remote (EU)'
    WHEN 4 THEN 'Deutschland' WHEN 5 THEN '名古屋市' WHEN 6 THEN 'Kyiv, Ukraine'
    WHEN 7 THEN '  ' WHEN 8 THEN CASE WHEN j % 2 = 0 THEN 'Austin, tx' END END END AS Location,
  CASE WHEN p % 20 <> 1 AND b < 2 AND NOT bare THEN CASE j % 4
    WHEN 0 THEN 'Kyiv' WHEN 1 THEN 'Paris' WHEN 2 THEN '  ' END END AS City,
  CASE WHEN p % 20 <> 1 AND b < 2 AND NOT bare THEN CASE j % 4 WHEN 0 THEN '  ' WHEN 1 THEN 'IDF' END END AS State,
  CASE WHEN p % 20 <> 1 AND b < 2 AND NOT bare THEN CASE j % 4
    WHEN 0 THEN 'Ukraine' WHEN 1 THEN 'FR' WHEN 2 THEN 'Atlantis' END END AS Country,
  CASE j % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS IsRemote,
  CASE WHEN b = 0 THEN CASE j % 2 WHEN 0 THEN 'true' ELSE 'false' END END AS IsHybrid,
  CASE WHEN b = 1 AND j % 70 = 0 THEN 'FullyRemote' END AS RemoteType,
  CASE WHEN j % 8 < 3 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS {text})
    WHEN j % 8 = 3 THEN '2' WHEN j % 8 = 4 THEN '0' END AS SalaryMin,
  CASE j % 8
    WHEN 0 THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(18, 2)) * CAST(1.2 AS DECIMAL(2, 1)) AS DECIMAL(18, 2)) AS {text})
    WHEN 2 THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(18, 2)) * CAST(0.9 AS DECIMAL(2, 1)) AS DECIMAL(18, 2)) AS {text})
    WHEN 3 THEN '3' END AS SalaryMax,
  CASE WHEN b = 0 THEN 'USD' ELSE CASE j % 5
    WHEN 0 THEN 'EUR' WHEN 1 THEN ' usd ' WHEN 2 THEN 'XXX' WHEN 3 THEN '  ' END END AS SalaryCurrency,
  CASE WHEN b = 0 THEN 'yearly' ELSE CASE j % 6
    WHEN 0 THEN 'yearly' WHEN 1 THEN 'Monthly' WHEN 2 THEN 'hourly' WHEN 5 THEN 'per year' END END AS SalaryPeriod,
  CASE WHEN b = 0 THEN CASE j % 4
    WHEN 0 THEN '["Latte Art","  milk  steaming"]' WHEN 1 THEN '[]' WHEN 2 THEN 'not json' END END AS RequiredSkills,
  CASE WHEN b = 0 THEN CASE j % 3 WHEN 0 THEN '[1,2]' WHEN 1 THEN '[]' END END AS RequiredCertifications,
  CASE WHEN b > 0 THEN CASE j % 3
    WHEN 0 THEN {array}('Python', 'python', 'SQL', CONCAT('Skill ', CAST(j % 40 AS {text})),
      CONCAT('Rare ', CAST(j % 5000 AS {text}))) WHEN 1 THEN {array}('  ') END END AS Tags,
  CASE WHEN b = 0 THEN CAST(j % 10 AS {text}) END AS Category,
  CASE WHEN b = 0 THEN CAST(j % 23 AS {text}) END AS RoleType,
  CASE WHEN b = 0 THEN CAST(j % 17 AS {text}) END AS CompanyType,
  CASE WHEN bare THEN NULL WHEN q % 7 = 5 AND k % 50 < 3 + q % 48 THEN CONCAT('https://jobs.example/block/', CAST(q AS {text}))
    WHEN p % 20 = 0 AND k % 2 = 0 THEN CONCAT('https://Jobs.Example/', CAST(p AS {text}), '/')
    WHEN p % 20 = 0 THEN CONCAT(' https://jobs.example/', CAST(p AS {text}))
    WHEN p % 20 <> 1 THEN CONCAT('https://jobs.example/u/', CAST(k AS {text})) END AS SourceUrl,
  CASE WHEN b > 0 THEN CONCAT('h', CAST(k AS {text})) END AS SourceHash,
  CASE WHEN exported_at = '2026-08-15T00:00:00' THEN CASE WHEN b = 0 THEN '5' ELSE 'Closed' END
    WHEN b = 0 THEN CAST(j % 7 AS {text})
    ELSE CASE j % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'closed' WHEN 2 THEN ' PAUSED ' ELSE 'Archived' END END AS Status,
  CASE WHEN b > 0 THEN CASE WHEN j % 97 = 0 THEN '08/01/2026' ELSE ordered END END AS PostedAt,
  CASE WHEN j % 97 = 0 AND b = 0 THEN '08/01/2026' ELSE ordered END AS CreatedAt,
  CASE WHEN b < 2 THEN REPLACE(CAST(o_orderdate + INTERVAL '3' DAY AS {text}), ' ', 'T') END AS UpdatedAt,
  CASE WHEN b = 0 THEN REPLACE(CAST(o_orderdate + INTERVAL '9' DAY AS {text}), ' ', 'T') END AS LastSeenAt,
  REPLACE(CAST(o_orderdate + INTERVAL '60' DAY AS {text}), ' ', 'T') AS ExpiresAt
FROM (
  SELECT o_orderkey AS k, o_orderkey % 7 AS b, CAST(floor(o_orderkey / 7) AS BIGINT) AS j,
         CAST(floor(o_orderkey / 2) AS BIGINT) AS p, CAST(floor(o_orderkey / 50) AS BIGINT) AS q,
         o_orderkey % 100 = 99 AS bare, o_totalprice, o_orderdate, c_name,
         REPLACE(CAST(o_orderdate AS {text}), ' ', 'T') AS ordered,
         {generate}(CASE
           WHEN o_orderkey % 50 = 0 THEN {array}('2026-08-01T00:00:00', '2026-08-15T00:00:00', '2026-07-15T00:00:00')
           WHEN o_orderkey % 10 = 0 THEN {array}('2026-08-01T00:00:00', '2026-08-15T00:00:00')
           ELSE {array}('2026-08-01T00:00:00') END) AS exported_at
  FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey
) AS versions
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """As many partitions as the session's ``boardweave.spread`` says, if it is set.

    Typing is CPU-bound, so one small file would keep one core busy; the bench
    sets it, nothing else does.
    """
    parts = df.sparkSession.conf.get("boardweave.spread", None)
    return df.repartition(int(parts)) if parts and not df.isStreaming else df


def evenly(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores, by their size: a file of one row group is one task however
    large, and all that follows up to the next exchange would stay in that task."""
    if df.isStreaming or df.sparkSession.conf.get("boardweave.spread", None):
        return df
    return df.hint("rebalance")


def bronze_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The facade over given order and customer rows (``orders`` may stream)."""
    orders = evenly(spread(orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")))
    return orders.sparkSession.sql(FACADE_SQL.format(**SPARK_TOKENS), orders=orders, customer=customer)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_orders(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
