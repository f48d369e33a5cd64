"""WARC archives, page text, the pipeline and the SQL of the queries."""

import base64
import hashlib

import brute
import duckdb
import pytest
from odd_rows import ODD, prose
from test_similar import jaccard_groups

from boardweave.llm import extract, queries, warc

PAGES = [
    (1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (0, "http://c", "<p>y</p>"), (3, None, None), (4, "http://e\r\nX: y", ""),
    (5, "http://f", "WARC/1.1\r\n\r\n\r\nbody" * 20), (6, "http://g", "z\r\n\r\n" * 500), (7, "http://h", "é日😀" * 3000), (7, "http://h", "é日😀" * 3000),
    (None, "http://n", "<p>x</p>"), (None, None, "alone"), (8, "http://i", "\r\n\r\n"),
]


def expected(pages, least):
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        origin = first.get(html or "")
        again = origin is not None and page != origin and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if again else "response", origin if again else None, True))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "segment"), [(0, 32768), (8, 100), (10**9, 7)])
def test_archives_round_trip(llm, tmp_path, least, segment):
    pages = llm.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, sum string").repartition(4)
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder, least, segment)
    found = warc.read_pages(llm, folder)
    assert sorted(map(tuple, found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound").collect()), key=repr) == expected(PAGES, least)
    whole = {r.page_id: bytes(r.payload) for r in found.where("payload is not null").collect()}
    assert whole[7] == ("é日😀" * 3000).encode() and whole[5] == PAGES[5][2].encode()


def test_empty_archives(llm, tmp_path):
    warc.write_archives(llm.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.read_pages(llm, str(tmp_path / "w")).collect() == []


def test_segments_in_any_order_doubled_or_missing(llm):
    def record(number, origin, block, total=None, own=None):
        return (own, "response" if number == 1 else "continuation", "u", None, "d", number, origin, total, block)

    rows = [record(3, "A", b"ee", 6), record(1, None, b"aa", own="A"), record(2, "A", b"cc"), record(2, "A", b"cc"),
            record(1, None, b"xx", own="B"), record(3, "B", b"zz", 6), record(1, None, b"mm", own="C"), record(2, "C", b"nn", 5),
            record(2, "lost", b"qq", 4)]
    found = {r.record_id: r for r in warc.reassembled(llm.createDataFrame(rows, warc._RECORD).repartition(3)).collect()}
    assert bytes(found["A"].block) == b"aaccee" and found["A"].whole
    assert not found["B"].whole and not found["C"].whole and "lost" not in found


def test_chunked_framing():
    assert warc.unframed(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    assert warc.unframed(warc.framed(b"")) == b"" and warc.unframed(warc.framed(b"q" * 9000, 4096)) == b"q" * 9000
    for damaged in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabcX\r\n"):
        with pytest.raises(ValueError):
            warc.unframed(damaged)


LONG = [prose(k, 60).capitalize() + ", and so on." for k in range(4)]


def test_article_without_furniture():
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href=/>Home, sweet home.</a></ul></nav><div class="cookie-notice">We use cookies, really. Yes.</div>
      <article><h1>A  title &amp;\nmore</h1><p><b>{LONG[0]}<br>again<p>{LONG[1]}</p><p>Short.</p><div class="ad-slot">Buy now, today. Cheap.</div>
      <!-- <p>hidden</p> --><ul><li>One<li>Two</ul><form><p>Your mail, please.</p></form><aside><p>Elsewhere, later.</p></aside>
      <section id="comments"><p>First! {LONG[3]}</p></section></article><footer>&copy; all rights.</footer></body></html>"""
    assert extract.main_text(page) == "\n\n".join(["A title & more", LONG[0] + " again", LONG[1], "Short.", "One", "Two"])


def test_article_found_by_its_paths_alone():
    links = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(12))
    page = f"<body><div class=top><ul>{links}</ul></div><div class=main><h2>Head</h2>{''.join(f'<p>{x}</p>' for x in LONG)}<p>Tiny.</p></div><div class=low><p>x</p><ul>{links}</ul></div>"
    assert extract.main_text(page) == "\n\n".join(["Head", *LONG, "Tiny."])


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- open", "<script>x", "<nav><p>a</p></nav>", "</div></p>", "<a href='x>y", "<p>" * 3000, "\x00<b></b>"])
def test_broken_pages(page):
    assert isinstance(extract.main_text(page), str)


def test_plain_text_and_deep_nesting():
    assert extract.main_text("just   text,\n\tno tags") == "just text, no tags"
    assert extract.main_text("<div>" * 2000 + LONG[0] + "</div>" * 2000) == LONG[0]


def test_texts_of_pages(llm):
    found = extract.main_texts(llm.createDataFrame([(1, "u", "<p>Hi, there.</p>", "z"), (2, None, None, "z"), (None, "u", "", "z"), (1, "u", "<p>Hi, there.</p>", "z")],
                                                   "page_id long, url string, html string, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, "u", "Hi, there.", 10), (1, "u", "Hi, there.", 10), (2, None, "", 0), (None, "u", "", 0)], key=repr)


def test_sql_of_repeated_words(llm):
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents AS SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'")
        db.execute("INSERT INTO documents VALUES (100000, NULL), (100001, ''), (100002, ' ')")
        found = sorted(db.execute(queries.ORACLE["op8_repeated_words"]).fetchall())
        assert found == brute.repeated_words(db.execute("SELECT doc_id, text FROM documents").fetchall())


def test_pipeline_stages_against_plain_versions(llm, odd):
    import corpus_pipeline

    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    have = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, "/root/testdata/sf0.001")
        if name == "bpe":
            assert {r.doc_id for r in out.collect()} == set(have)
            continue
        assert out.columns == docs.columns
        kept = {r.doc_id: r.text for r in out.collect()}
        if name == "language":
            assert set(have) - set(kept) == {k for k, t in have.items() if not any(c.isalpha() for c in t or "")}
        elif name == "near_duplicates":
            least = {}
            for doc, group in zip(have, jaccard_groups(list(have.values())), strict=True):
                least[group] = min(doc, least.get(group, doc))
            assert set(kept) == set(least.values())
        elif name == "substrings":
            lost = {d: n for d, _, n, _ in brute.repeated_words(list(have.items()))}
            assert set(kept) == {d for d, t in have.items() if lost[d] < len(t.encode().split()) or not lost[d]}
            assert all(kept[d] == have[d] for d in kept if not lost[d])
        elif name == "decontamination":
            items = [" ".join(r.text.lower().split()) for r in llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
            assert not [d for d, t in kept.items() if any(i in " ".join(t.lower().split()) for i in items)]
            plain = {d: " ".join(have[d].lower().split()) for d in set(have) - set(kept)}
            assert all(any(p[k : k + 16] in t for p in items for k in range(0, len(p) - 15, 16)) for t in plain.values())
        docs = llm.createDataFrame(out.collect(), out.schema)
        have = kept


def test_pipeline_on_odd_and_empty_documents(llm, odd, none):
    import corpus_pipeline

    for given in (odd, none):
        docs = given
        for _, stage in corpus_pipeline.STAGES:
            docs = llm.createDataFrame((out := stage(llm, docs, "/root/testdata/sf0.001")).collect(), out.schema)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert len(ODD) > 20
