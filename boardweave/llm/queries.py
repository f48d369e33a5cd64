"""One query for each operator, over its whole table, and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from boardweave.llm import (
    align, bpe, decontaminate, extract, frames, language, merkle, rules, simhash, sketch, substrings, urls, warc)
from boardweave.llm.batches import table
from boardweave.llm.ship import ship
from boardweave.plans.session import fresh_dir

BYTE_BPE = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE, END_ID = public_tokenizers.path("word_bpe_49k.json"), 1


def fold(parts: int, name: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % parts


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(ship(spark), "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_pages(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(ship(spark), sf_dir, "pages"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(ship(spark), sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(ship(spark), "tokens")
    frames.write_tokens(table(spark, sf_dir, "documents"), WORD_BPE, folder, END_ID)
    return frames.token_summaries(spark, folder)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.scored(table(ship(spark), sf_dir, "documents"), table(spark, sf_dir, "labels").where(fold(3) != 1)).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


def language_model(spark: SparkSession, sf_dir: str) -> language.Model:
    return language.learn(table(ship(spark), sf_dir, "documents").where(fold(4) != 2))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_model(spark, sf_dir)
    return language.predict(table(spark, sf_dir, "documents"), model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op7_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(ship(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_word_digests(table(ship(spark), sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(ship(spark), sf_dir, "documents"), *BYTE_BPE)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.neighbour_report(table(ship(spark), sf_dir, "documents"))


def op11_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(table(ship(spark), sf_dir, "documents"), BYTE_BPE[0], PIECE_BPE, BYTE_BPE[1:])


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_warc, op2_main_text, op3_near_duplicates, op4_token_files, op5_quality, op6_language, op7_benchmark_matches,
              op8_repeated_words, op9_bpe, op10_fingerprints, op11_url_verdicts, op12_alignment, op13_merkle_proofs)
}

#: The words of a text as the operator counts them.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE: dict[str, str] = {
    "op11_url_verdicts": urls.oracle(),
    "op13_merkle_proofs": merkle.oracle(),
    "op8_repeated_words": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        spot AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
        win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM spot),
        least AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING count(*) > 1),
        hit AS (SELECT win.doc_id, win.i FROM win JOIN least USING (s) WHERE win.doc_id > first),
        gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS g FROM hit GROUP BY doc_id),
        kept AS (SELECT d.doc_id, w, g, list_filter(range(1, len(w) + 1), lambda k: g IS NULL OR NOT list_contains(g, k)) AS k
                 FROM d LEFT JOIN gone USING (doc_id))
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(k))::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(list_select(w, k), ' '), '')) AS kept_sha256
        FROM kept""",
}
