"""Alignments of two tokenizers against whole texts, and the perfect hash."""

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from odd_rows import ODD

from boardweave.llm import align, queries

A, B, FAST = queries.BYTE_BPE[0], queries.PIECE_BPE, queries.BYTE_BPE[1:]
SIGNS = [" ", " ", "  ", "\n", "\t", "a", "b", "The", "é", "日本", "▁", "'s", "don't", "1", "23", "...", "\x00", "\xa0", "\u3000", "<|endoftext|>", "<0x41>", "</s>", "xxx",
         "\x1c", "\x85", "\r\n", "😀", "ab c", "_", "\u2028", " straße", " Ĳssel'll", " x²½", " ǅ", " ñandú,", " 12ª", " (¡no!)", " \xad", " ʼn"]


@pytest.fixture(scope="module")
def plain():
    return brute.Alignment(A, B)


@pytest.mark.parametrize(("segment", "fast"), [(1 << 20, None), (1 << 20, FAST), (5, FAST)])
def test_units_give_what_whole_texts_give(plain, monkeypatch, segment, fast):
    monkeypatch.setattr(align, "SEGMENT", segment)
    aligner, chance = align.Aligner(A, B, fast), random.Random(1)
    for _ in range(1500):
        text = "".join(chance.choices(SIGNS, k=chance.randint(1, 14)))
        want, got = plain.of(text), aligner.sums(text)
        assert (want is None) == (got is None), text
        if want:
            sums, sha = got
            assert [sums[c] for c in ("n_a", "n_b", "n_groups", "n_links")] == [want[0], want[1], len(want[2]), len(want[3])]
            assert sha == hashlib.sha256(";".join(want[2]).encode()).hexdigest()
            assert aligner.pairs(text).tolist() == sorted({a << align.B_BITS | b for a, b in want[3]})
        else:
            assert not len(aligner.pairs(text))


def test_units_encoded_together_are_those_of_the_given_table(llm, plain):
    aligner = align.Aligner(A, B, FAST)
    for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 4000").collect():
        want, (sums, sha) = plain.of(r.text), aligner.sums(r.text)
        assert [sums[c] for c in ("n_a", "n_b", "n_links")] == [want[0], want[1], len(want[3])] and sha == hashlib.sha256(";".join(want[2]).encode()).hexdigest()


def test_units_are_forgotten_when_there_are_too_many(monkeypatch, plain):
    monkeypatch.setattr(align, "CACHE", 40)
    aligner = align.Aligner(A, B, FAST)
    for k in range(30):
        text = f"some words number {k} and {k} again"
        assert aligner.sums(text)[0]["n_a"] == plain.of(text)[0]
    assert aligner.held < 200


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.array(random.Random(n).sample(range(1 << 40), n), np.int64)
    function = align.PerfectHash.build(keys)
    assert sorted(function.index(keys).tolist()) == list(range(n))
    assert len(function.words) * 64 < 4 * n + 500


def test_pairs_that_were_never_counted_have_zeros():
    keys = np.array([5 << align.B_BITS, 6 << align.B_BITS])
    function = align.PerfectHash.build(keys)
    held = np.empty_like(keys)
    held[function.index(keys)] = keys
    lookup = align.Lookup(1, {0: function}, {0: held}, {0: np.array([1, 1])}, np.ones(9, np.int64))
    best, count = lookup.of(np.array([*keys, 7, 5 << align.B_BITS | 1, keys[0]]))
    assert count.tolist() == [1, 1, 0, 0, 1] == best.tolist()


def test_words_of_texts_without_tokens_are_not_counted(llm, plain):
    """The second text has a sign that the second tokenizer does not give back; its words stand nowhere else."""
    docs = [(1, "some words here"), (2, "strangely unusual words \u2581 zebra"), (3, "words here"), (4, None)]
    given = llm.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert sorted(map(tuple, align.alignments(given, A, B, FAST).collect())) == sorted(plain.report(docs))


@pytest.mark.parametrize(("shard", "block", "held"), [(1 << 17, 1 << 22, 1 << 21), (64, 256, 50)])
def test_alignments_against_whole_texts(llm, odd, none, plain, monkeypatch, shard, block, held):
    """Odd rows, with one shard, and with many shards in several blocks."""
    for name, value in (("SHARD", shard), ("BLOCK", block)):
        monkeypatch.setattr(align, name, value)
    found = align.alignments(odd, A, B, FAST)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    small = [(d, t) for d, t in ODD if len(t or "") < 20_000]
    long = [(d, t) for d, t in ODD if len(t or "") >= 20_000]
    want = {repr(r) for r in plain.report(small)} if not long else None
    got = sorted(map(repr, map(tuple, found.collect())))
    if want is not None:
        assert got == sorted(map(repr, plain.report(small)))
    assert len(got) == len(ODD) and align.alignments(none, A, B, FAST).collect() == []


def test_sums_of_many_parts(llm, plain, monkeypatch):
    """More parts than a vector is made of: the tree has several levels."""
    docs = [(i, f"common words of all and {'the' * (i % 4)} {i % 5}") for i in range(60)]
    monkeypatch.setattr(align, "FAN", 2)
    given = llm.createDataFrame(docs, "doc_id long, text string").repartition(40)
    assert sorted(map(tuple, align.alignments(given, A, B, FAST).collect())) == sorted(plain.report(docs))


def test_each_text_is_aligned_once(llm, plain, tmp_path):
    """The texts are read by the first pass alone; the report comes from the stored links."""
    docs = [(1, "some words here and some words there"), (2, "some other words"), (2, "some other words"), (None, "words"), (4, None), (5, "a \u2581 b")]
    llm.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    found = align.alignments(llm.read.parquet(str(tmp_path / "docs")), A, B, FAST)
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain.report(docs)))


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_links_packed_and_unpacked(n):
    chance = random.Random(n)
    pairs = np.array(sorted(chance.sample(range(1 << 40), n)), np.int64)
    times = np.array([chance.randint(1, 1 << 31) for _ in range(n)], np.int64)
    assert [x.tolist() for x in align.unpacked(align.packed(pairs, times))] == [pairs.tolist(), times.tolist()]


@pytest.mark.parametrize("segment", [1 << 20, 5])
def test_links_of_a_text_have_their_number(plain, monkeypatch, segment):
    monkeypatch.setattr(align, "SEGMENT", segment)
    aligner, text = align.Aligner(A, B, FAST), "the cat and the dog and the \u00e9t\u00e9 " * 9
    found, (_, _, _, links) = aligner.aligned(text), plain.of(text)
    want = {}
    for a, b in links:
        want[a << align.B_BITS | b] = want.get(a << align.B_BITS | b, 0) + 1
    assert dict(zip(found.pairs.tolist(), found.times.tolist(), strict=True)) == want


def test_links_are_unpacked_a_few_rows_at_a_time(monkeypatch):
    monkeypatch.setattr(align, "READ", 4)
    rows = [np.arange(k, dtype=np.int64) for k in (3, 0, 5, 1, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array([align.packed(x, x + 1) for x in rows], pa.binary())], ["links"])
    pieces = list(align._linked([batch]))
    assert [len(p) for p, *_ in pieces] == [3, 2] and [s.tolist() for *_, s in pieces] == [[3, 0, 5], [1, 0]]
    assert [p.tolist() for _, p, _, _ in pieces] == [[0, 1, 2, 0, 1, 2, 3, 4], [0]]
