import pytest
from pyspark.sql import functions as F

from boardweave.functions import conform as C
from boardweave.functions import lookups as L
from boardweave.functions import text as X


def results(spark, pairs, build, kind="string"):
    """[(input, expected)] -> {input: actual} for one column function."""
    ddl = ", ".join(f"c{i} {kind}" for i in range(len(pairs[0]) - 1))
    rows = [(i, *p[:-1]) for i, p in enumerate(pairs)]
    df = spark.createDataFrame(rows, f"n int, {ddl}")
    got = df.select("n", build(*[F.col(f"c{i}") for i in range(len(pairs[0]) - 1)]).alias("r")).collect()
    return {pairs[r["n"]][:-1]: r["r"] for r in got}


def check(spark, pairs, build):
    assert results(spark, pairs, build) == {p[:-1]: p[-1] for p in pairs}


def test_employment(spark):
    check(spark, [
        ("Full-time", None, "full_time"), ("FullTime", None, "full_time"), ("CDI", None, "full_time"),
        ("正社員", None, "full_time"), ("Festanstellung", None, "full_time"),
        ("Full-time, Part-time", None, "full_time"), ("Teilzeit", None, "part_time"),
        ("アルバイト", None, "part_time"), ("Werkstudent", None, "part_time"),
        ("CDD", None, "contract"), ("契約社員", None, "contract"), ("intérim", None, "contract"),
        ("Ausbildung", None, "apprenticeship"), ("Lehrstelle", None, "apprenticeship"),
        ("Internship", None, "internship"), ("Stage", None, "internship"), ("backstage", None, "other"),
        ("bénévolat", None, "volunteer"), ("Saisonarbeit", None, "seasonal"),
        ("self-employed", None, "freelance"), ("ZZP", None, "freelance"), ("Per Diem", None, "temporary"),
        ("TEMP", None, "temporary"), ("template", None, "other"), ("gig", None, "other"),
        ("  ", None, "unknown"), (None, None, "unknown"), ("\t", None, "other"),
        (None, "0", "full_time"), (None, "4", "internship"), ("gig", "6", "temporary"),
        (None, "7", "unknown"), ("gig", "7", "other"), (None, "1.0", "unknown"), (None, " 1 ", "part_time"),
        (None, "x", "unknown"), ("étemp", None, "other"),
    ], C.employment_type_canonical)


def test_seniority_and_its_source(spark):
    check(spark, [
        ("Senior", "Cook", "senior"), ("Senior Manager", None, "manager"), (None, "Team Lead", "lead"),
        (None, "Onboarding Clerk", "executive"), (None, "International Sales", "internship"),
        (None, "Jr. Developer", "entry"), (None, "Head of Roasting", "manager"), ("mid-level", "Chief", "mid"),
        (None, "Leader", "unknown"), (None, None, "unknown"), ("  ", "Director", "director"),
        (None, "シニア エンジニア", "senior"), ("Associate", None, "entry"), ("Associates", None, "unknown"),
    ], C.seniority_canonical)
    check(spark, [("Senior", "Lead", "published"), ("cook", "Lead", "title_parsed"), (None, "cook", "none")],
          C.seniority_source)


def test_status(spark):
    check(spark, [("1", "active"), ("5", "closed"), ("6", "unknown"), (" PAUSED ", "paused"), ("Archived", "unknown"),
                  (None, "unknown"), ("", "unknown"), ("-1", "unknown")], C.status_canonical)


def test_country(spark):
    check(spark, [("de", "DE"), (" ok ", "OK"), ("Deutschland", "DE"), ("THE  Netherlands", "NL"), ("日本", "JP"),
                  ("Atlantis", None), ("USA", "US"), ("", None), (None, None), ("\u00a0US", None)], C.country_iso2)


@pytest.mark.parametrize("raw, city, region, country, remote, quality", [
    ("Edmond, OK", "Edmond", "OK", "OK", False, "parsed_full"),
    ("Geldermalsen, Gelderland, NL", "Geldermalsen", "Gelderland", "NL", False, "parsed_full"),
    ("Remote (EU)", "Remote", None, None, True, "parsed_partial"),
    ("Deutschland", None, None, "DE", False, "parsed_partial"),
    ("名古屋市", "名古屋市", None, None, False, "parsed_partial"),
    ("Kyiv , Ukraine", "Kyiv", None, "UA", False, "parsed_full"),
    ("Berlin,", "Berlin", None, None, False, "parsed_partial"),
    ("  ", None, None, None, False, "empty"), (None, None, None, None, False, "empty"),
    (",", None, None, None, False, "unparsed"), ("A, B, Nowhere", "A", "B", None, False, "parsed_partial"),
    ("Télétravail, Paris, France", "Télétravail", "Paris", "FR", True, "parsed_full"),
])
def test_location(spark, raw, city, region, country, remote, quality):
    df = spark.createDataFrame([(raw,)], "raw string")
    row = df.select(*[c.alias(n) for n, c in C.location_parts(F.col("raw")).items()]).first()
    assert (row["city"], row["region"], row["country"], row["is_remote_text"], row["quality"]) == (
        city, region, country, remote, quality)


def test_state_policy(spark):
    rows = [("Edmond, OK", "US"), ("Austin, TX", "US"), ("Berlin, DE", "DE"), ("San Jose, CA", "CA"), ("OK", "OK")]
    check(spark, rows, lambda c: C.location_parts(c, "unambiguous_us")["country"])
    with pytest.raises(ValueError):
        C.location_parts(F.col("x"), "guess")


def test_money_lookups(spark):
    check(spark, [("EUR", "1.1"), ("ZZZ", None), (None, None)], lambda c: C.fx_usd_rate(c).cast("string"))
    check(spark, [("hourly", "2080.0"), ("per year", None)], lambda c: C.period_annual_multiplier(c).cast("string"))
    check(spark, [("FI", "EUR"), ("GB", "GBP"), ("OK", None)], C.country_default_currency)
    assert len(L.FX_TO_USD) == 40 and len(L.US_STATES) == 51


def test_text(spark):
    check(spark, [("  A \t b\n", "a b "), (None, None), ("\u00a0x", "\u00a0x"), ("İ", "i̇")], X.norm_text)
    check(spark, [("a\u2028b\u2029c\r\nd", "a b c  d"), (None, None)], X.scrub_line_breaks)
    check(spark, [(" HTTPS://x.Y/a// ", "https://x.y/a"), ("///", None), ("  ", None), (None, None)], X.normalise_url)
    check(spark, [("/l/board=1/f.ndjson", "board=1/f.ndjson")], X.path_tail)


def test_redaction(spark):
    df = spark.createDataFrame(
        [("mail a@b.co or c@d.org", "https://x/a@b.co", ["z@z.io", "ok"], 1)],
        "Title string, SourceUrl string, Tags array<string>, n int")
    row = X.redact_emails(df).first()
    assert row["Title"] == "mail [email-redacted] or [email-redacted]"
    assert row["SourceUrl"] == "https://x/a@b.co" and row["Tags"] == ["z@z.io", "ok"] and row["emails_redacted"] == 1
    assert X.redact_emails(df, arrays=True).first()["Tags"] == ["[email-redacted]", "ok"]
    assert X.redact_emails(df, arrays=True).first()["emails_redacted"] == 2
