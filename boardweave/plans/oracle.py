"""Independent ANSI SQL for the checked queries.

Only the facade text and the fixed lookup values are shared with the Spark
side. The logic is written again, the way a SQL engine would put it: window
ranks instead of combined aggregates, self joins instead of folded groups,
whole regular expressions instead of substring tests.
"""

from __future__ import annotations

import re

from boardweave.functions import lookups as L
from boardweave.plans.facade import FACADE_SQL

TOKENS = {"text": "VARCHAR", "generate": "unnest", "array": "list_value", "orders": "orders",
          "customer": "customer"}
AS_OF = "2026-09-01 00:00:00"
STAMP = "%Y-%m-%d %H:%M:%S"


def _quoted(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _decode(key: str, table: dict) -> str:
    arms = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in table.items())
    return f"CASE {key} {arms} END"


def _pattern(java: str) -> str:
    r"""Unicode word boundaries, spelled out: RE2 knows only ASCII ones."""
    edge = r"[^\p{L}\p{N}_]"
    java = re.sub(r"(^|\|)\\b", lambda m: f"{m[1]}(^|{edge})", java)
    return java.replace(r"\b", f"({edge}|$)")


def _rules(text: str, rules, fallback: str = "NULL") -> str:
    arms = " ".join(f"WHEN regexp_matches({text}, {_quoted(_pattern(p))}) THEN '{label}'" for p, label in rules)
    return f"CASE {arms} ELSE {fallback} END"


def _norm(col: str) -> str:
    return rf"regexp_replace(lower(trim({col})), '\s+', ' ', 'g')"


def _iso(col: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({col}), '[A-Za-z]{{2}}') THEN upper(trim({col})) "
            f"ELSE {_decode(_norm(col), L.COUNTRY_NAMES)} END")


def _int(col: str) -> str:
    return rf"CASE WHEN regexp_full_match(trim({col}), '[+-]?\d+') THEN TRY_CAST({col} AS INTEGER) END"


_EMPLOYMENT = {n: L.EMPLOYMENT_NAMES[v] for n, v in L.EMPLOYMENT_ORDINALS.items()}
_STATUS = {n: v.lower() for n, v in L.STATUS_ORDINALS.items()}
_STATES = ", ".join(f"'{s}'" for s in L.US_STATES)
_COUNTRIES = ", ".join(f"'{c}'" for c in sorted({*L.COUNTRY_NAMES.values(), *L.COUNTRY_CURRENCY}))
_MID = "coalesce(CAST(s_min + s_max AS DOUBLE) / 2, CAST(s_min AS DOUBLE), CAST(s_max AS DOUBLE))"

CTES: dict[str, str] = {}
CTES["bronze"] = FACADE_SQL.format(**TOKENS)
CTES["fx"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', CAST({r!r} AS DOUBLE))" for c, r in sorted(L.FX_TO_USD.items())) + ") AS f(currency, usd_rate)"
CTES["pieces"] = rf"""
SELECT *, {_norm('Title')} AS n_title, {_norm('CompanyName')} AS n_company, {_norm('JobType')} AS n_job,
  {_norm('ExperienceLevel')} AS n_level, {_norm('Location')} AS n_where,
  string_split_regex(trim(Location), '\s*,\s*') AS parts,
  nullif(regexp_replace(lower(trim(SourceUrl)), '/+$', ''), '') AS n_url,
  CASE WHEN TRY_CAST(SalaryMin AS DECIMAL(18, 2)) > 0 THEN TRY_CAST(SalaryMin AS DECIMAL(18, 2)) END AS s_min,
  CASE WHEN TRY_CAST(SalaryMax AS DECIMAL(18, 2)) > 0 THEN TRY_CAST(SalaryMax AS DECIMAL(18, 2)) END AS s_max,
  nullif(upper(trim(SalaryCurrency)), '') AS s_cur,
  CASE WHEN lower(trim(SalaryPeriod)) IN ('yearly', 'monthly', 'weekly', 'daily', 'hourly')
    THEN lower(trim(SalaryPeriod)) END AS s_per
FROM bronze"""
CTES["places"] = rf"""
SELECT *, {_iso('Country')} AS c_country,
  CASE WHEN n_parts >= 2 THEN {_iso('tail')} WHEN n_parts = 1 THEN {_iso('head')} END AS l_country
FROM (SELECT *, len(parts) AS n_parts,
  regexp_replace(parts[1], '\s*\(.*?\)\s*', '', 'g') AS head,
  regexp_replace(parts[-1], '\s*\(.*?\)\s*', '', 'g') AS tail FROM pieces) AS x"""
CTES["located"] = f"""
SELECT * EXCLUDE (City, Country, State), coalesce(c_country, l_country) AS country, coalesce(nullif(trim(City), ''), l_city) AS city,
  coalesce(nullif(trim(State), ''), CASE WHEN upper(trim(tail)) IN ({_STATES}) THEN upper(trim(tail))
    WHEN n_parts >= 3 THEN trim(parts[2]) END) AS region,
  CASE WHEN Location IS NULL OR trim(Location) = '' THEN 'empty'
    WHEN l_country IS NOT NULL AND l_city IS NOT NULL THEN 'parsed_full'
    WHEN l_country IS NOT NULL OR l_city IS NOT NULL THEN 'parsed_partial' ELSE 'unparsed' END AS location_quality
FROM (SELECT *, CASE WHEN n_parts = 1 AND l_country IS NOT NULL THEN NULL ELSE nullif(trim(head), '') END AS l_city
  FROM places) AS x"""
CTES["trusted"] = f"""
SELECT *, CASE WHEN s_min IS NULL AND s_max IS NULL THEN NULL WHEN lie THEN geo_cur
    ELSE coalesce(s_cur, geo_cur) END AS currency,
  CASE WHEN s_min IS NULL AND s_max IS NULL THEN NULL WHEN lie THEN 'inferred_geo_over_default'
    WHEN s_cur IS NOT NULL THEN 'published' WHEN geo_cur IS NOT NULL THEN 'inferred_geo' END AS currency_confidence
FROM (SELECT *, coalesce(schema_gen = 'gen_a' AND s_cur = 'USD' AND geo_cur <> 'USD', false) AS lie
  FROM (SELECT *, {_decode('country', L.COUNTRY_CURRENCY)} AS geo_cur FROM located) AS y) AS x"""
CTES["valued"] = f"""
SELECT t.*, {_MID} * fx.usd_rate AS mid_usd FROM trusted AS t LEFT JOIN fx ON t.currency = fx.currency"""
CTES["typed"] = f"""
SELECT board || ':' || Id AS posting_key, board, TRY_CAST(Id AS BIGINT) AS source_id, schema_gen, Title AS title,
  CompanyName AS company_name,
  coalesce({_decode(f'({_int("EmploymentType")})', _EMPLOYMENT)}, {_rules('n_job', L.EMPLOYMENT_RULES,
    "CASE WHEN trim(JobType) <> '' THEN 'other' END")}, 'unknown') AS employment_type,
  coalesce(JobType, EmploymentType) AS employment_type_raw,
  coalesce(by_level, by_title, 'unknown') AS seniority,
  CASE WHEN by_level IS NOT NULL THEN 'published' WHEN by_title IS NOT NULL THEN 'title_parsed' ELSE 'none' END
    AS seniority_source,
  coalesce({_decode(f'({_int("Status")})', _STATUS)},
    CASE WHEN lower(trim(Status)) IN ('draft', 'active', 'paused', 'filled', 'expired', 'closed')
      THEN lower(trim(Status)) END, 'unknown') AS status,
  coalesce(TRY_CAST(IsRemote AS BOOLEAN), false) OR coalesce(regexp_matches(n_where, {_quoted(L.REMOTE_PATTERN)}), false)
    OR coalesce(RemoteType = 'FullyRemote', false) AS is_remote,
  coalesce(TRY_CAST(IsHybrid AS BOOLEAN), false) AS is_hybrid,
  city, region, country, Location AS location_raw, location_quality,
  s_min AS salary_min_src, s_max AS salary_max_src, s_cur AS salary_currency_src, currency AS salary_currency,
  currency_confidence AS salary_currency_confidence, s_per AS salary_period_src,
  coalesce(s_per, CASE WHEN mid_usd < {L.HOURLY_BELOW_USD} THEN 'hourly' WHEN mid_usd < {L.MONTHLY_BELOW_USD}
    THEN 'monthly' WHEN mid_usd IS NOT NULL THEN 'yearly' END) AS salary_period,
  CASE WHEN s_per IS NOT NULL THEN 'published' WHEN mid_usd IS NOT NULL THEN 'inferred_magnitude' END
    AS salary_period_confidence,
  RequiredSkills AS skills_json, Tags AS tags, SourceUrl AS source_url, SourceHash AS source_hash,
  coalesce('url:' || n_url, 'fp:' || sha256(coalesce(n_company, '') || '||' || coalesce(n_title, '') || '||'
    || coalesce(country, '') || '||' || coalesce({_norm('city')}, ''))) AS dup_key,
  coalesce(TRY_CAST(PostedAt AS TIMESTAMP), TRY_CAST(CreatedAt AS TIMESTAMP)) AS posted_at,
  TRY_CAST(UpdatedAt AS TIMESTAMP) AS updated_at, TRY_CAST(LastSeenAt AS TIMESTAMP) AS last_seen_at,
  TRY_CAST(ExpiresAt AS TIMESTAMP) AS expires_at, TRY_CAST(exported_at AS TIMESTAMP) AS exported_at
FROM (SELECT *, {_rules('n_level', L.SENIORITY_RULES)} AS by_level, {_rules('n_title', L.SENIORITY_RULES)} AS by_title
  FROM valued) AS x"""
CTES["current"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY board, source_id
  ORDER BY exported_at DESC) AS rn FROM typed) AS x WHERE rn = 1"""
CTES["postings"] = """
SELECT *, count(*) OVER (PARTITION BY dup_key) AS dup_group_size,
  row_number() OVER (PARTITION BY dup_key ORDER BY posted_at ASC NULLS LAST, board, source_id) = 1 AS is_canonical,
  min(board) OVER (PARTITION BY dup_key) <> max(board) OVER (PARTITION BY dup_key) AS is_cross_board_duplicate
FROM current"""
CTES["raw_skills"] = """
SELECT posting_key, board, posted_at, unnest(TRY_CAST(CASE WHEN json_valid(skills_json) THEN skills_json END AS JSON)::VARCHAR[])
    AS skill_raw, 'required_skills_json' AS skill_source, 0 AS preference FROM current
UNION ALL SELECT posting_key, board, posted_at, unnest(tags), 'tags', 1 FROM current"""
CTES["all_skills"] = f"""
SELECT posting_key, board, posted_at, skill, skill_raw, skill_source FROM (
  SELECT *, row_number() OVER (PARTITION BY posting_key, skill ORDER BY preference, skill_raw) AS rn
  FROM (SELECT *, {_norm('skill_raw')} AS skill FROM raw_skills) AS y) AS x WHERE rn = 1"""
CTES["skills"] = "SELECT * FROM all_skills WHERE skill <> ''"
_FACTOR = _decode("salary_period", L.PERIOD_TO_ANNUAL)
CTES["priced"] = f"""
SELECT *, CAST(salary_min_src AS DOUBLE) * factor * usd_rate AS salary_min_annual_usd,
  CAST(salary_max_src AS DOUBLE) * factor * usd_rate AS salary_max_annual_usd,
  coalesce(CAST(salary_min_src + salary_max_src AS DOUBLE) / 2, CAST(salary_min_src AS DOUBLE),
    CAST(salary_max_src AS DOUBLE)) * factor * usd_rate AS salary_mid_annual_usd
FROM (SELECT p.*, fx.usd_rate, CAST({_FACTOR} AS DOUBLE) AS factor FROM postings AS p
  LEFT JOIN fx ON p.salary_currency = fx.currency) AS x"""
CTES["base"] = f"""
SELECT *, CASE WHEN usd_rate IS NULL THEN 'unknown_currency' WHEN salary_period IS NULL THEN 'unknown_period'
  WHEN NOT salary_mid_annual_usd BETWEEN {L.ANNUAL_USD_MIN} AND {L.ANNUAL_USD_MAX} THEN 'annual_out_of_bounds' END
  AS reject_reason
FROM priced WHERE salary_min_src IS NOT NULL OR salary_max_src IS NOT NULL"""
CTES["facts"] = "SELECT * FROM base WHERE reject_reason IS NULL"
CTES["quarantine"] = "SELECT * FROM base WHERE reject_reason IS NOT NULL"


def over(name: str, select: str) -> str:
    """``select`` preceded by the CTE chain up to and including ``name``."""
    chain = []
    for key, body in CTES.items():
        chain.append(f"{key} AS ({body})")
        if key == name:
            break
    return "WITH " + ",\n".join(chain) + "\n" + select


def stamp(col: str) -> str:
    return f"strftime({col}, '{STAMP}') AS {col}"


TYPED_SELECT = f"""SELECT posting_key, board, source_id, schema_gen, title, company_name, employment_type,
  employment_type_raw, seniority, seniority_source, status, is_remote, is_hybrid, city, region, country,
  location_raw, location_quality, CAST(salary_min_src AS DOUBLE) AS salary_min_src,
  CAST(salary_max_src AS DOUBLE) AS salary_max_src, salary_currency_src, salary_currency,
  salary_currency_confidence, salary_period_src, salary_period, salary_period_confidence, skills_json,
  array_to_string(tags, '|') AS tags, source_url, source_hash, dup_key, {stamp('posted_at')}, {stamp('updated_at')},
  {stamp('last_seen_at')}, {stamp('expires_at')}, {stamp('exported_at')} FROM """
POSTINGS_SELECT = TYPED_SELECT.replace("salary_currency_src, ", "").replace("salary_period_src, ", "").replace(
    " skills_json,\n", "\n").replace("array_to_string(tags, '|') AS tags, ", "").replace(
    "dup_key, ", "dup_key, dup_group_size, is_canonical, is_cross_board_duplicate, ")
SALARY_SELECT = f"""SELECT posting_key, board, country, seniority, employment_type, is_canonical, salary_currency,
  salary_currency_confidence, salary_period, salary_period_confidence, CAST(salary_min_src AS DOUBLE) AS salary_min_src,
  CAST(salary_max_src AS DOUBLE) AS salary_max_src, usd_rate, salary_min_annual_usd, salary_max_annual_usd,
  salary_mid_annual_usd, {stamp('posted_at')}"""
