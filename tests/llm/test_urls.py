"""Rules and verdicts of URLs against plain versions and against SQL."""

import math
from collections import defaultdict
from hashlib import md5

import duckdb

from boardweave.llm import queries, urls

URLS = [
    "http://a.net/x", "https://NET/", "http://net", "http://x.net?q=1", "http://example.net/en/1", "http://m.EXAMPLE.net/en/", "http://example.net/en", "http://example.net/de/en/",
    "https://shop.example.com/de/1#top", "http://notexample.com/de/1", "http://example.com/fr/", "http://wiki.org/fr/2", "http://wiki.org/en/2", "http://org/fr/", "borg/fr/", "http://borg/fr/",
    "no scheme at all", "", None, "://", "http://?x/", "http://ÄÖ.org/fr/Ü", "a://b://c.net/", "http://u:p@h.net:80/p;x?y#z", "http://x.org/fr/\nline", "HTTP://X.ORG/FR/", "http://é日.com/" + "😀" * 9,
    "http://x.com/" + "z" * 20_000,
] + [f"http://good{i % 7}.org/fr/news/{i}" for i in range(30)] + [f"http://bad{i % 7}.net/win/{i}?ad" for i in range(30)] + [
    f"http://good{i}.com/fr/news" for i in range(4)] + [f"http://bad{i}.com/win?ad" for i in range(4)]


def parts(url):
    before, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min([k for c in "/?#" if (k := rest.find(c)) >= 0], default=len(rest))
    path = rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, path[: min([k for c in "?#" if (k := path.find(c)) >= 0], default=len(path))]


def rule_of(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def plain(rows):
    """(page_id, host, path, rule, verdict) by counting and mixing without Spark."""
    each, order = {}, urls.ORDER
    for _, url in rows:
        url = url or ""
        host, path = parts(url)
        text = host + url.partition("://")[2][len(host):] if "://" in url else url
        each[url] = (rule_of(host, path)[1], ord(md5(url.encode()).hexdigest()[0]) % 2, "\x02" * order + text + "\x03")
    counts, letters = defaultdict(int), set()
    for kind, half, text in each.values():
        for i in range(order, len(text)):
            letters.add(text[i])
            for level in range(order + 1):
                counts[kind, half, text[i - level : i + 1]] += 1
                counts[kind, half, text[i - level : i], level] += 1

    def chance(kind, halves, gram):
        p = 1 / len(letters)
        for level in range(order + 1):
            own = sum(counts[kind, h, gram[order - level :]] for h in halves)
            p = (own + urls.STRENGTH * p) / (sum(counts[kind, h, gram[order - level : -1], level] for h in halves) + urls.STRENGTH)
        return p

    scores = {}
    for url, (kind, half, text) in each.items():
        halves = (0, 1) if kind is None else (1 - half,)
        grams = [text[i - order : i + 1] for i in range(order, len(text))]
        scores[url] = round(sum(math.log(chance("allow", halves, g) / chance("block", halves, g)) for g in grams) / len(grams), 9)
    known = [(math.floor(s * urls.BINS), each[u][0]) for u, s in scores.items() if each[u][0]]
    yes, no = (sum(k == v for _, k in known) for v in ("allow", "block"))
    best = min(((-round(sum(k == "allow" and b >= t for b, k in known) / yes + sum(k == "block" and b < t for b, k in known) / no, 9), abs(t), t)
                for t in {b for b, _ in known}), default=(0, 0, 0))[2] if yes and no else 0
    out = []
    for page, url in rows:
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        out.append((page, host, path, rule, verdict or ("allow" if scores[url or ""] >= best / urls.BINS else "block")))
    return sorted(out, key=repr)


def test_verdicts_against_plain_counts(llm):
    rows = [*enumerate(URLS), (0, URLS[0]), (None, URLS[5]), (None, None)]
    pages = llm.createDataFrame([(*r, "h", "x", 1) for r in rows], "page_id long, url string, host string, gram string, u1 int").repartition(4)
    got = sorted(map(tuple, urls.verdicts(pages).collect()), key=repr)
    assert got == plain(rows)
    by_url = {(h, p): v for _, h, p, r, v in got if r is None}
    assert all(by_url[f"good{i}.com", "/fr/news"] == "allow" and by_url[f"bad{i}.com", "/win"] == "block" for i in range(4))


def test_sql_of_verdicts(llm):
    rows = [(k, u) for k, u in enumerate(URLS) if not any(c > "\uffff" for c in u or "")]
    with duckdb.connect() as db:
        db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
        db.executemany("INSERT INTO pages VALUES (?, ?)", rows)
        assert sorted(db.execute(queries.ORACLE["op11_url_verdicts"]).fetchall(), key=repr) == plain(rows)


def test_without_rules_that_fit_and_without_pages(llm):
    for given in ([], [(1, "http://x.com/")], [(1, None)], [(1, "http://x.net/"), (2, "http://y.com/")]):
        pages = llm.createDataFrame(given, "page_id long, url string")
        found = urls.judged(pages).collect()
        assert len(found) == len(given) and all(r.threshold == 0 for r in found)
