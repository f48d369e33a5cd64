"""Languages of spans and documents: scripts narrow, words score, Viterbi labels.

Learned from texts with a known language, over all of them: how often each
letter trigram (word edges included) and each script occurs in a language.
Trigrams share ``BUCKETS`` buckets, so the model has one size for any corpus.
A word's score in a language is the sum of its trigrams' log probabilities,
relative to the best language and bounded; a language in which the word's
script is hardly ever seen is no candidate. Viterbi over the words of a text,
with a penalty for each change, labels spans. All texts of a piece step
together, longest first, so that a step is a few array operations.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from boardweave.llm.batches import mixed, run_hashes, slices, unused

BUCKETS = 1 << 15
CLIP, SWITCH = 8.0, 12.0
SCRIPT_SHARE = 0.01
SMOOTHING = 0.5
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray, int]:
    """Of each code point: the number of its script from 1 on if it is a letter, else 0; its lower case; the number of scripts.

    The script is the first word of the letter's Unicode name.
    """
    names = {"": 0}
    script, lower = np.zeros(0x110000, np.uint16), np.arange(0x110000, dtype=np.uint32)
    for point in [*range(0xD800), *range(0xE000, 0x323B0)]:
        c = chr(point)
        if c.isalpha():
            script[point] = names.setdefault(unicodedata.name(c, "OTHER").split(" ")[0].split("-")[0], len(names))
            if len(low := c.lower()) == 1:
                lower[point] = ord(low)
    return script, lower, len(names)


class Cut(NamedTuple):
    """Words of letters in a piece's texts."""

    start: np.ndarray  # in all code points of the piece
    end: np.ndarray
    first: np.ndarray  # word number at which each text begins, and one more
    word: np.ndarray  # hash
    script: np.ndarray
    trigram: np.ndarray  # bucket at each letter, in order
    offset: np.ndarray  # where each text begins in the code points


def _cut(texts: list[str]) -> Cut:
    script_of, lower_of, _ = _letters()
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    edge = np.zeros(1, np.uint32)
    text = np.concatenate([x for p in points for x in (edge, p)] + [edge])
    offset = np.cumsum([1, *(len(p) + 1 for p in points)])
    script = script_of[text]
    letter = script > 0
    low = np.where(letter, lower_of[text], 0).astype(np.uint64)
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    end = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    at = np.flatnonzero(letter)
    trigram = (mixed(low[at - 1] << np.uint64(42) | low[at] << np.uint64(21) | low[at + 1]) % np.uint64(BUCKETS)).astype(np.int64)
    return Cut(start, end, np.searchsorted(start, offset), run_hashes(low, start, end), script[start], trigram, offset)


class Model(NamedTuple):
    languages: list[str]
    trigrams: np.ndarray  # [language, bucket] log probabilities
    candidates: np.ndarray  # [script, language]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts: features below BUCKETS are trigrams, the others scripts."""
    width = BUCKETS + _letters()[2]
    counts: dict[str, np.ndarray] = {}
    for piece in slices(batches):
        texts, langs = (piece.column(c).to_pylist() for c in ("text", "lang"))
        for lang in set(langs):
            cut = _cut([t for t, own in zip(texts, langs, strict=True) if own == lang])
            length = cut.end - cut.start
            have = counts.setdefault(lang, np.zeros(width, np.int64))
            have[:BUCKETS] += np.bincount(cut.trigram, minlength=BUCKETS)
            have[BUCKETS:] += np.bincount(cut.script, length, width - BUCKETS).astype(np.int64)
    for lang, have in counts.items():
        feature = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(feature), pa.string()), pa.array(feature), pa.array(have[feature])], ["lang", "feature", "n"])


def learn(docs: DataFrame) -> Model:
    """From all rows with text and language. The counts brought back are one number for each language and bucket at most."""
    known = docs.select("text", "lang").where("text is not null and lang is not null")
    counts = known.mapInArrow(_counted, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(counts["lang"]))
    table = np.zeros((len(languages), BUCKETS + _letters()[2]))
    row = counts["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(np.int64)
    table[row, counts["feature"].to_numpy(np.int64)] = counts["n"].to_numpy(np.float64)
    trigrams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    trigrams = np.log((trigrams + SMOOTHING) / (trigrams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, trigrams.astype(np.float32), (share >= SCRIPT_SHARE).T)


def word_scores(model: Model, cut: Cut) -> np.ndarray:
    """[word, language] from -CLIP to 0; all 0 in a script that no language has."""
    codes, seen = pd.factorize(cut.word)
    place = np.empty(len(seen), np.int64)
    place[codes[::-1]] = np.arange(len(codes))[::-1]
    length = cut.end - cut.start
    begin = (np.cumsum(length) - length)[place]
    size = length[place]
    total = np.cumsum(size)
    within = np.arange(int(total[-1])) - np.repeat(total - size, size)
    buckets = cut.trigram[np.repeat(begin, size) + within]
    scores = np.empty((len(seen), len(model.languages)), np.float32)
    for i, log in enumerate(model.trigrams):
        scores[:, i] = np.add.reduceat(log[buckets], total - size)
    able = model.candidates[cut.script[place]]
    none = ~able.any(axis=1)
    scores[~able & ~none[:, None]] = -np.inf
    scores = np.maximum(scores - scores.max(axis=1, keepdims=True), -CLIP)
    scores[none] = 0
    return scores[codes]


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word; ``first`` has where each text's words begin."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    begin, n = first[:-1][order], n[order]
    path = np.zeros(len(scores), np.int64)
    if not len(scores):
        return path
    came = np.zeros(scores.shape, np.int16)  # the language before, on the best way to each
    active = np.searchsorted(-n, -np.arange(1, n[0] + 1), "right")  # texts with so many words
    value = scores[begin[: active[0]]].copy()
    languages = np.arange(scores.shape[1])
    last = np.zeros(len(n), np.int64)
    for step in range(1, int(n[0]) + 1):
        more = int(active[step]) if step < n[0] else 0
        if more < len(value):
            last[more : len(value)] = value[more:].argmax(axis=1)
            value = value[:more]
            if not more:
                break
        best = value.argmax(axis=1)
        top = value[np.arange(more), best] - switch
        stay = value >= top[:, None]
        came[begin[:more] + step] = np.where(stay, languages, best[:, None])
        value = np.where(stay, value, top[:, None]) + scores[begin[:more] + step]
    state = last
    for step in range(int(n[0]) - 1, -1, -1):
        at = begin[: active[step]] + step
        path[at] = state[: active[step]]
        if step:
            state[: active[step]] = came[at, state[: active[step]]]
    return path


def predicted(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, Cut, np.ndarray]:
    """Language and score of each text, and the labels of its words."""
    cut = _cut(texts)
    n = len(texts)
    if not len(cut.start) or not model.languages:
        return [UNKNOWN] * n, np.zeros(n), cut, np.zeros(len(cut.start), np.int64)
    scores = word_scores(model, cut)
    path = viterbi(scores, cut.first)
    many = len(model.languages)
    doc = np.repeat(np.arange(n), np.diff(cut.first))
    letters = np.bincount(doc * many + path, cut.end - cut.start, n * many).reshape(n, many)
    chosen = letters.argmax(axis=1)
    share = letters.max(axis=1) / np.maximum(1, letters.sum(axis=1))
    own = path == chosen[doc]
    sums = np.stack([np.bincount(doc[own], scores[own, i], n) for i in range(many)], axis=1)
    sums = np.exp(sums - sums.max(axis=1, keepdims=True))
    score = share * sums[np.arange(n), chosen] / sums.sum(axis=1)
    empty = np.diff(cut.first) == 0
    score[empty] = 0
    return [UNKNOWN if e else model.languages[c] for e, c in zip(empty, chosen, strict=True)], score, cut, path


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): ``und`` and 0 where the text is null or has no letter.

    The score is the share of the letters in spans of this language times its
    posterior over those spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            langs, score, _, _ = predicted(shared.value, piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(langs), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans): first and past-the-last code point and language of each span, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            _, _, cut, path = predicted(shared.value, piece.column("text").to_pylist())
            out = []
            for a, b, zero in zip(cut.first, cut.first[1:], cut.offset, strict=False):
                heads = a + np.flatnonzero(np.r_[a < b, path[a + 1 : b] != path[a : max(a, b - 1)]][: b - a])
                tails = np.r_[heads[1:] - 1, b - 1] if len(heads) else heads
                out.append([{"start": int(cut.start[h] - zero), "end": int(cut.end[t] - zero), "lang": shared.value.languages[path[h]]}
                            for h, t in zip(heads, tails, strict=True)] if shared.value.languages else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<start: long, end: long, lang: string>>")


def _identified(shared):
    """A column function: language and score of each text, as ``predict`` gives them."""

    @F.pandas_udf("lang string, score double")
    def identified(texts: pd.Series) -> pd.DataFrame:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], ["text"])
        found = [predicted(shared.value, p.column("text").to_pylist())[:2] for p in slices([batch])]
        return pd.DataFrame({"lang": [x for langs, _ in found for x in langs], "score": [x for _, s in found for x in s]})

    return identified


def in_known_language(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents, all columns kept, that have a language with this score at least."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = unused(docs.columns, "identified")
    kept = docs.withColumn(found, _identified(shared)("text"))
    return kept.where((F.col(f"{found}.lang") != UNKNOWN) & (F.col(f"{found}.score") >= least)).drop(found)
