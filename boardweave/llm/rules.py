"""Text quality by a sparse ensemble of rules.

Statistics of each text (lengths, shares of kinds of signs, repetition) are the
only inputs. Small boosted trees on labelled rows propose rules: each path from
the root to a node is a conjunction of thresholds. A logistic model over rules,
statistics clipped and scaled, is fitted with an L1 penalty, which leaves few
of them. Rules and weights become one Spark column expression.

Training uses at most ``SAMPLE`` labelled rows, those with the least hash of
their id: a bound on what the driver holds, and the one place where it applies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add, and_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from boardweave.llm.batches import bytes_of, run_hashes, slices, word_hashes, words_of, written

SAMPLE = 20_000
TREES, DEPTH, BINS, SHRINK = 40, 3, 32, 0.2
PENALTY, STEPS = 2e-3, 400
SIGNS = "#$%&*|<>{}[]=_~^/\\@+"  # signs that prose seldom has

STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "letters", "digits", "capitals", "blanks", "lines", "prose_signs", "odd_signs",
    "most_odd_sign", "other_bytes", "bare_words", "capital_words", "repeated_words", "repeated_lines", "short_lines", "line_words",
    "stops", "long_words", "top_word", "signed_words",
]


def statistics_of(texts: pa.LargeStringArray) -> np.ndarray:
    """[text, statistic]; zeros for a text without words."""
    data, offsets = bytes_of(texts)
    words = words_of(texts)
    size, n = np.diff(offsets).astype(float), np.diff(words.first).astype(float)

    def per_text(marks: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(marks, dtype=np.int64)]
        return np.diff(total[offsets]).astype(float)

    def per_word(marks: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(marks, dtype=np.int64)]
        return np.diff(total[words.first]).astype(float)

    kinds = np.zeros(256, np.uint8)
    for kind, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:!?'\"()-", SIGNS), 1):
        kinds[[ord(c) for c in members]] = kind
    kinds[128:] = 6
    kind = kinds[data]
    small, capital, digit, prose, odd, other = (per_text(kind == k) for k in range(1, 7))
    bytes_, safe_n = np.maximum(size, 1), np.maximum(n, 1)
    letter_before = np.r_[0, np.cumsum((kind == 1) | (kind == 2) | (kind == 6), dtype=np.int64)]
    odd_before = np.r_[0, np.cumsum(kind == 5, dtype=np.int64)]
    last = np.maximum(words.end - 1, 0)
    h = word_hashes(words)
    doc = np.repeat(np.arange(len(n)), n.astype(np.int64))
    order = np.lexsort((h, doc))
    run = np.flatnonzero(np.r_[True, (np.diff(doc[order]) != 0) | (h[order][1:] != h[order][:-1])]) if len(h) else np.zeros(0, np.int64)
    times = np.diff(np.r_[run, len(h)])
    top, distinct = np.zeros(len(n)), np.zeros(len(n))
    np.maximum.at(top, doc[order][run], times)
    np.add.at(distinct, doc[order][run], 1)
    newline = data == 10
    lines = per_text(newline) + 1
    repeated, short = _lines(data, offsets, newline)
    odd_counts = np.stack([per_text(data == ord(c)) for c in SIGNS])
    length = words.end - words.start
    columns = [
        np.log1p(size), np.log1p(n), (size / safe_n), (small + capital) / bytes_, digit / bytes_, capital / bytes_,
        per_text(np.isin(data, [32, 9, 10, 11, 12, 13])) / bytes_, np.log1p(lines), prose / bytes_, odd / bytes_,
        odd_counts.max(axis=0) / bytes_, other / bytes_, per_word(letter_before[words.end] == letter_before[words.start]) / safe_n,
        per_word(kind[words.start] == 2) / safe_n, 1 - distinct / safe_n, repeated / lines, short / lines, np.log1p(n / lines),
        per_word(np.isin(data[last], [ord(c) for c in ".!?"])) / safe_n, per_word(length > 20) / safe_n, top / safe_n,
        per_word(odd_before[words.end] > odd_before[words.start]) / safe_n,
    ]
    out = np.stack(columns, axis=1)
    out[n == 0] = 0
    return out


def _lines(data: np.ndarray, offsets: np.ndarray, newline: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: lines that stand in it before, and lines of under 20 bytes."""
    marks = np.flatnonzero(newline)
    begin = np.unique(np.r_[offsets[:-1], marks + 1])
    begin = begin[begin < len(data)]
    end = np.r_[begin[1:], len(data)]
    doc = np.searchsorted(offsets, begin, "right") - 1
    size = end - begin
    key = run_hashes(data, begin, end)
    order = np.lexsort((key, doc))
    same = np.zeros(len(begin), bool)
    if len(begin) > 1:
        same[order[1:]] = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
    n = len(offsets) - 1
    return np.bincount(doc[same & (size > 1)], minlength=n).astype(float), np.bincount(doc[size < 20], minlength=n).astype(float)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, STATISTICS...) of every row, null texts as empty ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = statistics_of(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, found.T)], ["doc_id", *STATISTICS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[int, bool, float], ...]  # statistic, whether it lies above, threshold


def _grow(codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """Paths of one tree of second-order gains, and its values on the rows."""
    paths, value = [], np.zeros(len(gradient))
    todo: list[tuple[Rule, np.ndarray]] = [((), np.arange(len(gradient)))]
    while todo:
        path, rows = todo.pop()
        g, w = gradient[rows], weight[rows]
        value[rows] = -g.sum() / (w.sum() + 1)
        if len(path) == DEPTH or len(rows) < 20:
            continue
        best = (1e-6, 0, 0)
        for s in range(codes.shape[1]):
            left_g = np.cumsum(np.bincount(codes[rows, s], g, BINS))[:-1]
            left_w = np.cumsum(np.bincount(codes[rows, s], w, BINS))[:-1]
            gain = left_g**2 / (left_w + 1) + (g.sum() - left_g) ** 2 / (w.sum() - left_w + 1) - g.sum() ** 2 / (w.sum() + 1)
            at = int(gain[: len(cuts[s])].argmax()) if len(cuts[s]) else 0
            if len(cuts[s]) and gain[at] > best[0]:
                best = (float(gain[at]), s, at)
        if best[0] <= 1e-6:
            continue
        _, s, at = best
        above = codes[rows, s] > at
        for side in (False, True):
            longer = (*path, (s, side, float(cuts[s][at])))
            paths.append(longer)
            todo.append((longer, rows[above == side]))
    return paths, value


def _applies(x: np.ndarray, rule: Rule) -> np.ndarray:
    return reduce(and_, ((x[:, s] > t) if above else (x[:, s] <= t) for s, above, t in rule))


class Ensemble(NamedTuple):
    intercept: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[int, float, float, float]]  # statistic, low, high, weight of its clipped value

    def column(self) -> Column:
        """Probability of label 1 as one expression over the statistics."""
        terms = [F.lit(self.intercept)]
        for rule, weight in self.rules:
            holds = reduce(and_, ((F.col(STATISTICS[s]) > t) if above else (F.col(STATISTICS[s]) <= t) for s, above, t in rule))
            terms.append(F.when(holds, weight).otherwise(0.0))
        terms += [F.lit(w) * F.least(F.greatest(F.col(STATISTICS[s]), F.lit(low)), F.lit(high)) for s, low, high, w in self.linear]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(add, terms)))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """The ensemble for these statistics and labels; a constant if one label alone occurs."""
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Ensemble(float(np.log(p / (1 - p))), [], [])
    cuts = [np.unique(np.quantile(x[:, s], np.arange(1, BINS) / BINS)) for s in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, s], "left") for s, c in enumerate(cuts)], axis=1)
    margin, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        paths, value = _grow(codes, cuts, p - y, p * (1 - p))
        rules |= dict.fromkeys(paths)
        margin += SHRINK * value
    held = [(r, _applies(x, r)) for r in rules]
    held = [(r, h.astype(float)) for r, h in held if 0.002 < h.mean() < 0.998]
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    matrix = np.column_stack([*(h for _, h in held), clipped])
    mean, spread = matrix.mean(axis=0), matrix.std(axis=0)
    spread[len(held):] /= 0.4  # a statistic counts as a typical rule
    live = spread > 1e-9
    scaled = np.where(live, (matrix - mean) / np.where(live, spread, 1), 0)
    weights, intercept = _lasso(scaled, y)
    weights = np.where(live, weights / np.where(live, spread, 1), 0)
    intercept -= float(weights @ mean)
    kept = [(r, float(w)) for (r, _), w in zip(held, weights, strict=False) if w]
    linear = [(s, float(low[s]), float(high[s]), float(w)) for s, w in enumerate(weights[len(held):]) if w]
    return Ensemble(intercept, kept, linear)


def _lasso(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic loss with an L1 penalty, by accelerated proximal steps."""
    n = len(y)
    probe = np.ones(x.shape[1])
    for _ in range(20):  # largest eigenvalue
        probe = x.T @ (x @ probe)
        probe /= np.linalg.norm(probe) or 1
    step = 1 / (0.25 * (np.linalg.norm(x @ probe) ** 2 / n + 1))
    w = ahead = np.zeros(x.shape[1])
    b = b_ahead = float(np.log(y.mean() / (1 - y.mean())))
    t = 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(x @ ahead + b_ahead))) - y
        new = ahead - step * (x.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        b_new = b_ahead - step * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, b_ahead = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    return w, float(b)


def learn(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """From (doc_id, quality) and the statistics; rows without either are left out, of equal ids each counts."""
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("int").alias("quality"))
    rows = stats.join(known, F.col("doc_id") == F.col("labelled")).select("doc_id", "quality", *STATISTICS)
    # Least hashes lie below this share of all; so tasks together send about the sample, however many they are.
    share = 1.2 * sample / max(1, known.count())
    if share < 1:
        rows = rows.where(F.xxhash64("doc_id") < int((2 * share - 1) * (1 << 63)))
    held = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATISTICS).limit(sample).toPandas()
    return fit(held[STATISTICS].to_numpy(float), held["quality"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, predicted) of every row, learned from the given labels; a score of 0.5 or more is label 1."""
    stats = written(statistics(docs), "statistics")
    score = learn(stats, labels, sample).column()
    return stats.select("doc_id", score.alias("score")).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
