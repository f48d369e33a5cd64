"""URL filters: rules on host and path, and character language models for the URLs that no rule decides.

URLs that a rule accepts or rejects teach one model each, of the characters
after the scheme. The models are of variable order: the probability of a
character after ``ORDER`` others is a mixture of what was counted after them
and the probability after one character less, down to all characters alike.
Where a context is well known its own counts weigh more, where it was never
seen the shorter one decides alone.

A URL's score is the difference of its two log-likelihoods divided by its
length. It is calibrated: every URL with a rule is also scored by models without
the half of URLs it is in, and the threshold is the one that tells these accepted and rejected
URLs apart best.

All of it is DataFrame operations. A URL is counted once, however many pages have it.
Every window of ``ORDER + 1`` characters in the table gets its log-ratio by joins
of distinct windows with their distinct tails and contexts, where no key is
hot. Nothing but totals and the threshold reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from boardweave.llm.batches import written
from boardweave.llm.similar import few

#: Verdict, host and path of each rule; a rule fits its host and all subdomains, the longest one that fits wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
STRENGTH = 2.0  # how many characters the shorter context counts for
BINS = 100  # thresholds tried for each unit of the score
START, END = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Occurrences among accepted and rejected URLs, in each half of the URLs.
_COUNTS = ["allow0", "allow1", "block0", "block1"]
#: Models: of all URLs, and without the one or the other half.
_MODELS = {"all": (0, 1), "not0": (1,), "not1": (0,)}


def host_of(url: str = "url") -> Column:
    """What stands between the first ``://`` and a slash, question mark, hash or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: str = "host", path: str = "path", rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, name).otherwise(verdict)
    return rule, verdict


def text_of(url: str = "url") -> Column:
    """What the models read: the URL without its scheme, the host in lower case; without ``://`` the whole text."""
    rest = F.concat(host_of(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1))
    return F.coalesce(F.when(F.contains(F.col(url), F.lit("://")), rest).otherwise(F.col(url)), F.lit(""))


def windows_of(text: Column, order: int = ORDER) -> Column:
    """Every character, and one end, with the ``order`` characters before it; starts stand in for those that are missing."""
    letters = F.regexp_extract_all(F.concat(F.lit(START * order), text, F.lit(END)), F.lit("(?s)."), F.lit(0))
    return F.transform(F.sequence(F.lit(0), F.size(letters) - order - 1), lambda i: F.array_join(F.slice(letters, i + 1, order + 1), ""))


def _again(name: str) -> Column:
    """The column as an expression: a join then deals this side anew, and may split the other where a key is hot."""
    return F.bitwise_not(F.bitwise_not(name))


def ratios(windows: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, all, not0, not1): the log-ratio of each window's last character by each model.

    ``windows`` has each distinct window once, ``gram``, with its counts. Tails and
    contexts are distinct too, hence a key of these joins has as many rows as there
    are different characters, at most.
    """

    def tails(level: int) -> DataFrame:  # the last character with ``level`` others before it
        if level == order:
            return windows.withColumnRenamed("gram", "tail")
        return windows.groupBy(F.substr("gram", F.lit(order + 1 - level)).alias("tail")).agg(*[F.sum(c).alias(c) for c in _COUNTS])

    def totals() -> list[Column]:
        return [F.sum(c).alias(f"all_{c}") for c in _COUNTS]

    known = None
    for level in range(order + 1):
        own = tails(level).withColumn("context", F.substr("tail", F.lit(1), F.lit(level)))
        if known is None:  # before any context all characters are alike; the totals are one row
            whole = own.agg(*totals(), F.count("*").alias("letters")).first()
            rows = own.select("*", *[F.lit(n).alias(c) for c, n in whole.asDict().items()])
        else:
            sums = own.groupBy(F.col("context").alias("whole")).agg(*totals())
            rows = own.join(sums, F.col("context") == F.col("whole")).join(known, F.substr("tail", F.lit(2)) == F.col("shorter"))
        shares = []
        for model, halves in _MODELS.items():
            for kind in ("allow", "block"):
                count = sum((F.col(f"{kind}{h}") for h in halves), F.lit(0))
                after = sum((F.col(f"all_{kind}{h}") for h in halves), F.lit(0))
                before = F.col(f"{kind}_{model}") if known is not None else F.try_divide(F.lit(1), F.col("letters"))  # no letters, no rows
                shares.append(((count + STRENGTH * before) / (after + STRENGTH)).alias(f"{kind}_{model}"))
        known = rows.select(F.col("tail").alias("shorter"), *shares)
    return known.select(F.col("shorter").alias("gram"), *[F.log(F.col(f"allow_{m}") / F.col(f"block_{m}")).alias(m) for m in _MODELS])


def threshold(scores: DataFrame) -> float:
    """The score from which on URLs are accepted: best at telling accepted and rejected URLs of ``scores`` apart, the nearest to 0 of equals.

    The mean of both kinds' rates of right verdicts counts. Scores are counted in
    bins, of which there is a bounded number. 0 where one of the kinds is missing.
    """
    place = F.greatest(F.lit(-64 * BINS), F.least(F.lit(64 * BINS), F.floor(F.col("score") * BINS))).cast("int")
    bins = scores.where("kind is not null").groupBy(place.alias("bin")).agg(
        F.count_if(F.col("kind") == "allow").alias("allow"), F.count_if(F.col("kind") == "block").alias("block"))
    below, whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()

    def less(c: str) -> Column:
        return F.coalesce(F.sum(c).over(below), F.lit(0))

    def share(part: Column, c: str) -> Column:
        return F.try_divide(part, F.sum(c).over(whole))

    right = share(F.sum("allow").over(whole) - less("allow"), "allow") + share(less("block"), "block")
    best = bins.select("bin", right.alias("right")).where("right is not null").orderBy(
        F.round("right", 9).desc(), F.abs("bin"), "bin").first()
    return best["bin"] / BINS if best else 0.0


def scored(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """(u1, u2, kind, score) of every distinct URL; the score of one with a rule is by models without its half of the URLs."""
    each = pages.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
    each = each.select("url", host_of().alias("host"), path_of().alias("path"))
    each = each.select(
        *_identity(), rule_of(rules=rules)[1].alias("kind"), (F.ascii(F.md5("url")) % 2).alias("half"), text_of().alias("text"))
    each = written(each, "urls")
    # Dealt by URL: text this short lies in few partitions, and the sums of a URL then need no exchange of their own.
    spread = each.repartition("u1", "u2").select("u1", "u2", "kind", "half", F.explode(windows_of(F.col("text"), order)).alias("gram"))
    counts = [F.count_if((F.col("kind") == c[:-1]) & (F.col("half") == int(c[-1]))).alias(c) for c in _COUNTS]
    windows = written(spread.groupBy("gram").agg(*counts), "windows")
    known = written(ratios(windows, order).withColumnRenamed("gram", "known"), "ratios")
    value = F.when(F.col("kind").isNull(), F.col("all")).when(F.col("half") == 0, F.col("not0")).otherwise(F.col("not1"))
    found = spread.join(few(known), F.col("gram") == F.col("known")).groupBy("u1", "u2").agg(
        F.first("kind").alias("kind"), F.round(F.avg(value), 9).alias("score"))
    return written(found, "scores")


def _identity() -> list[Column]:
    return [F.xxhash64("url").alias("u1"), F.xxhash64(F.lit(1), "url").alias("u2")]


def judged(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, threshold) of every page.

    The verdict is the rule's, or ``allow`` where the score reaches the threshold. Without rules
    that fit, or with those of one kind alone, all scores compare nothing known
    and the threshold is 0. Null URLs count as empty. Only ``page_id`` and ``url`` are read.
    """
    scores = scored(pages, rules, order)
    least = threshold(scores)
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    rows = rows.select("page_id", host_of().alias("host"), path_of().alias("path"), *_identity())
    rule, verdict = rule_of(rules=rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), "u1", "u2")
    scores = scores.select(_again("u1").alias("w1"), _again("u2").alias("w2"), "score")
    rows = rows.join(scores, (F.col("u1") == F.col("w1")) & (F.col("u2") == F.col("w2")))
    own = F.when(F.col("score") >= least, "allow").otherwise("block")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score", F.lit(least).alias("threshold"))


def verdicts(pages: DataFrame) -> DataFrame:
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")


def oracle(order: int = ORDER) -> str:
    """The same in SQL: rules, counts, mixtures and calibration."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{i}}}"
        for i, (_, h, p) in sorted(enumerate(RULES), key=lambda r: -len(r[1][1] + r[1][2])))
    rule = fits.format(*[f"'{h}{p}'" for _, h, p in RULES])
    kind = fits.format(*[f"'{v}'" for v, _, _ in RULES])
    sums = ", ".join(f"sum({c}) AS {c}" for c in _COUNTS)
    levels = []
    for level in range(order + 1):
        shares = []
        for model, halves in _MODELS.items():
            for k in ("allow", "block"):
                count, after = " + ".join(f"t.{k}{h}" for h in halves), " + ".join(f"c.{k}{h}" for h in halves)
                before = f"b.{k}_{model}" if level else "1.0 / (SELECT count(*) FROM t0)"
                shares.append(f"({count} + {STRENGTH} * {before})::DOUBLE / ({after} + {STRENGTH}) AS {k}_{model}")
        levels.append(f"""
        t{level} AS (SELECT substr(gram, {order + 1 - level}) AS tail, {sums} FROM windows GROUP BY 1),
        c{level} AS (SELECT substr(tail, 1, {level}) AS context, {sums} FROM t{level} GROUP BY 1),
        p{level} AS (SELECT t.tail, {", ".join(shares)} FROM t{level} t JOIN c{level} c ON substr(t.tail, 1, {level}) = c.context
            {f"JOIN p{level - 1} b ON substr(t.tail, 2) = b.tail" if level else ""})""")
    text = "CASE WHEN contains(url, '://') THEN host || regexp_extract(url, '^.*?://[^/?#]*(.*)$', 1, 's') ELSE url END"
    return rf"""
        WITH d AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
        parts AS (SELECT page_id, url, translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
                         regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM d),
        ruled AS (SELECT *, CASE {rule} END AS rule, CASE {kind} END AS kind, {text} AS text, ascii(md5(url)) % 2 AS half FROM parts),
        each AS (SELECT DISTINCT url, kind, half, repeat(chr(2), {order}) || text || chr(3) AS text FROM ruled),
        spread AS (SELECT url, kind, half, substr(text, i, {order + 1}) AS gram
                   FROM (SELECT *, unnest(range(1, len(text) - {order} + 1)) AS i FROM each)),
        windows AS (SELECT gram, {", ".join(f"count(*) FILTER (kind = '{c[:-1]}' AND half = {c[-1]}) AS {c}" for c in _COUNTS)} FROM spread GROUP BY gram),
        {",".join(levels)},
        scores AS (SELECT url, kind, round(avg(CASE WHEN kind IS NULL THEN ln(allow_all / block_all) WHEN half = 0 THEN ln(allow_not0 / block_not0)
                   ELSE ln(allow_not1 / block_not1) END), 9) AS score FROM spread JOIN p{order} ON gram = tail GROUP BY url, kind),
        bins AS (SELECT floor(score * {BINS})::INT AS bin, count(*) FILTER (kind = 'allow') AS a, count(*) FILTER (kind = 'block') AS b
                 FROM scores WHERE kind IS NOT NULL GROUP BY 1),
        rated AS (SELECT bin, (sum(a) OVER () - coalesce(sum(a) OVER w, 0)) / sum(a) OVER () + coalesce(sum(b) OVER w, 0) / sum(b) OVER () AS r
                  FROM bins WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        best AS (SELECT bin FROM rated WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY round(r, 9) DESC, abs(bin), bin LIMIT 1)
        SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN score >= coalesce((SELECT bin FROM best), 0) / {BINS}.0 THEN 'allow' ELSE 'block' END) AS verdict
        FROM ruled JOIN scores USING (url, kind) WHERE kind IS NOT NULL
        UNION ALL
        SELECT page_id, host, path, rule, CASE WHEN score >= coalesce((SELECT bin FROM best), 0) / {BINS}.0 THEN 'allow' ELSE 'block' END
        FROM ruled JOIN (SELECT url, score FROM scores WHERE kind IS NULL) USING (url) WHERE kind IS NULL"""
