"""Proofs of rows against plain trees, and against their SQL."""

import brute
import duckdb
import pytest

from boardweave.llm import merkle, queries

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, tree string, at long, leaf long, `a.b` map<string,int>"


def rows(n):
    langs = ["en", "en", "en", "en", None, "", "n", "é", "z" * 300]
    plain = [(i, f"s{i % 3}" if i % 4 else None, langs[i * i % len(langs)], i if i % 5 else None, "x" * i if i % 6 else None) for i in range(n)]
    return plain + plain[1:2] * 3 + [(None, None, None, None, None)] * 2 + [(3, "s", "en", 1, "same id"), (None, "s", "en", 7, "é" * 50_000), (-7, "s", "en", 2, "")] if n else []


@pytest.mark.parametrize(("height", "n"), [(2, 0), (2, 5), (2, 150), (9, 2), (9, 150)])
def test_proofs_against_plain_trees(llm, monkeypatch, height, n):
    """Two levels a row and chunks of one row's leaves make the climb take several steps and rows at every level."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "WIDTH", 1 << height)
    monkeypatch.setattr(merkle, "CHUNK", 1 << 2 * height)
    monkeypatch.setattr(merkle, "FEW_ROWS", 0 if height == 2 else 100)  # the rows dealt out, and sent to all
    docs = llm.createDataFrame([(*r, "t", 1, 2, {"k": 1}) for r in rows(n)], COLUMNS).repartition(4)
    got = merkle.tampered_proofs(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute.merkle_proofs(rows(n))))


def test_one_row_and_rows_that_are_all_alike(llm):
    for given in ([(1, "s", "en", 3, "abc")], [(7, None, None, None, "")] * 40):
        docs = llm.createDataFrame(given, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
        assert sorted(map(tuple, merkle.tampered_proofs(docs).collect())) == sorted(brute.merkle_proofs(given))


def test_every_change_is_found_and_the_limit_of_rows_is_put_back(llm):
    from pyspark.sql import functions as F

    docs = llm.createDataFrame([r for r in rows(60) if r[0] is not None], "doc_id long, source string, lang string, n_chars long, text string")
    before = llm.conf.get(merkle._ROW_LIMIT)
    found = merkle.proofs(docs, {"text": F.when(F.col("doc_id") % 10 == 4, F.lit("other")).otherwise(F.col("text"))}).collect()
    assert {r.doc_id for r in found if not r.verified} == {4, 14, 24, 34, 44, 54} and all(r.folded_root == r.root for r in found if r.verified)
    assert llm.conf.get(merkle._ROW_LIMIT) == before


def test_manifest_on_disk_is_linked(llm, tmp_path):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    merkle.write_manifest(docs, str(tmp_path))
    nodes = llm.read.parquet(str(tmp_path / "nodes"))
    assert nodes.where("root").select("top").distinct().count() == 1
    assert nodes.where("subroot").select("tree").distinct().count() == docs.select("lang").distinct().count()
    up = nodes.alias("u").selectExpr("tree as t", "chunk as c", "step as s", "no as n")
    assert nodes.where("not root").join(up, (nodes.tree == up.t) & (nodes.chunk == up.c) & (nodes.step + 1 == up.s) & (nodes.up == up.n), "left_anti").count() == 0


def test_sql_of_proofs(llm):
    given = [r for r in rows(40) if r[0] is not None and r[0] != 3 and r[0] != 1]
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", given)
        assert sorted(map(repr, db.execute(queries.ORACLE["op13_merkle_proofs"]).fetchall())) == sorted(map(repr, brute.merkle_proofs(given)))
