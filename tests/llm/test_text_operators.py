"""Operators on documents against plain versions, on odd rows and on the small tables."""

import hashlib
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from odd_rows import ODD, prose
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from boardweave.llm import bpe, decontaminate, frames, language, queries, rules, simhash, sketch, substrings
from boardweave.llm.wordpieces import WordPieces

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# SimHash


def test_near_duplicates_of_odd_rows(odd, none):
    assert set(rows(simhash.near_duplicates(odd))) == brute.near_duplicates(ODD)
    assert len(rows(simhash.near_duplicates(odd))) == len(ODD)
    assert rows(simhash.near_duplicates(none)) == []


def test_near_duplicates_of_the_small_table(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    assert set(rows(simhash.near_duplicates(docs))) == brute.near_duplicates([tuple(r) for r in docs.collect()])


def test_golay_words_one_bit_apart_share_an_index():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 1 << 23, 3000)
    other = word ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(simhash.nearby_indices(word), simhash.nearby_indices(other), strict=True):
        assert set(a[a >= 0]) & set(b[b >= 0])
    assert len(np.unique(simhash.codeword_index(np.arange(1 << 23)))) == 4096


def test_prints_within_three_bits_share_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(-(1 << 63), 1 << 63, 2000)
    b = a.copy()
    for _ in range(3):
        b ^= (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)).view(np.int64)
    ra, ka = simhash.fuzzy_keys(a)
    rb, kb = simhash.fuzzy_keys(b)
    assert {r for r, _ in set(zip(ra, ka, strict=True)) & set(zip(rb, kb, strict=True))} == set(range(2000))


@pytest.mark.parametrize("bucket", [1, 3, 1 << 14])
def test_larger_buckets_are_compared_block_by_block(llm, bucket):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 6)
    prints = np.unique(np.concatenate([base[:, None] ^ (1 << rng.integers(0, 62, (6, 60))) ^ (1 << rng.integers(0, 62, (6, 60)))]).ravel())
    found = simhash.links(llm.createDataFrame([(int(p),) for p in prints], "fingerprint long").repartition(3), bucket=bucket).collect()
    assert all((r.u ^ r.v).bit_count() <= 3 for r in found)
    root = {int(p): int(p) for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        root[find(r.u)] = find(r.v)
    for i, x in enumerate(map(int, prints)):
        for y in map(int, prints[:i]):
            assert (x ^ y).bit_count() > 3 or find(x) == find(y)


# Substrings


def test_repeated_words_of_odd_rows(odd, none):
    known = [(i, t) for i, t in ODD if i is not None]
    found = rows(substrings.repeated_word_digests(odd.where("doc_id is not null")))
    assert found == sorted(brute.repeated_words(known), key=repr)
    assert len(rows(substrings.repeated_word_digests(odd))) == len(ODD)
    assert rows(substrings.repeated_word_digests(none)) == []


@pytest.mark.parametrize("length", [1, 2, 5, 26])
def test_other_window_lengths(odd, length):
    known = [(i, t) for i, t in ODD if i is not None]
    found = rows(substrings.repeated_word_digests(odd.where("doc_id is not null"), length))
    assert found == sorted(brute.repeated_words(known, length), key=repr)


def test_many_shared_passages_over_small_pieces(llm, monkeypatch):
    passage = prose(9, 40)
    known = [(i, f"{prose(i * 3, 20 + i % 7)} {passage if i % 3 else ''} {prose(i, 15)}") for i in range(120)]
    docs = llm.createDataFrame(known, "doc_id long, text string").repartition(6)
    assert rows(substrings.repeated_word_digests(docs)) == sorted(brute.repeated_words(known), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_windows_that_one_text_repeats(llm, parts):
    """Texts of few words, which repeat their own windows many times; only other texts' windows count."""
    chance = np.random.default_rng(parts)
    line = " ".join(f"w{i}" for i in range(9))
    texts = [" ".join(chance.choice(list("ab"), 60)) for _ in range(6)] + ["x " * 90, "y z " * 50, "x " * 30, f"{line} " * 30, f"q {line} {line} r", "x " * 12, "x " * 13]
    texts += [f"{line} " * 3 + " ".join(chance.choice(list("cd"), 40)) for _ in range(3)] + ["z y " * 40 + "end"]
    docs = [(int(i), texts[i]) for i in chance.permutation(len(texts))]
    given = llm.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    assert rows(substrings.repeated_word_digests(given)) == sorted(brute.repeated_words(docs), key=repr)


def test_rows_of_one_id_that_repeat_windows(llm):
    """Places of two texts with one id are not taken for each other's."""
    window = " ".join(f"v{i}" for i in range(13))
    docs = [(1, window), (5, f"a b {window} c {window}"), (5, f"{window} {window} d"), (5, "x " * 30 + window), (6, f"{window} e")]
    for parts in (1, 4):
        found = rows(substrings.repeated_word_digests(llm.createDataFrame(docs, "doc_id long, text string").repartition(parts)))
        want = [(1, 13, 0, ""), (5, 29, 26, "a b c"), (5, 27, 26, "d"), (5, 43, 13, "x " * 29 + "x"), (6, 14, 13, "e")]
        assert [f[:3] for f in found] == sorted((d, n, m) for d, n, m, _ in want)
        assert {f[3] for f in found} == {hashlib.sha256((t or window).encode()).hexdigest() for *_, t in want}


def test_texts_without_repeats_keep_their_columns(odd):
    kept = substrings.without_repeats(odd)
    assert kept.columns == odd.columns and dict(kept.dtypes) == dict(odd.dtypes)
    by_id = {(r.doc_id, r.id): r for r in kept.collect()}
    assert by_id[(1, 0)].text == prose(1, 60) and (2, 1) not in by_id
    assert by_id[(3, 3)].text == prose(2, 40) and by_id[(3, 3)].n_chars == len(prose(2, 40))
    assert by_id[(6, 7)].text == "  \n\t "  # nothing to lose


def test_longest_repeats_double_until_none_survive(llm):
    shared = prose(11, 60)
    docs = llm.createDataFrame([(1, "a b " + shared), (2, shared + " c"), (3, " ".join(f"w{i}" for i in range(90))), (4, None)], "doc_id long, text string")
    found = {r.doc_id: r.length for r in substrings.longest_repeats(docs).collect()}
    assert found == {1: 52, 2: 52}


# Token files


def test_token_files_round_trip(odd, none, llm, tmp_path):
    library = Tokenizer.from_file(queries.WORD_BPE)
    folder = str(tmp_path / "tokens")
    frames.write_tokens(odd, queries.WORD_BPE, folder, 1, file_bytes=3000)
    assert len(list((tmp_path / "tokens").glob("part-*"))) > 3
    found = [tuple(r) for r in frames.token_summaries(llm, folder).orderBy("start").collect()]
    expect, start = [], 0
    ordered = sorted((r for r in ODD if r[0] is not None), key=lambda r: (r[0], r[1] or ""))
    for doc, text in ordered:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expect.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found[: len(expect)] == expect and [r[0] for r in found[len(expect) :]] == [None, None]
    some = {r.doc_id: r.ids for r in frames.read_documents(llm, folder, [9, 17]).collect()}
    assert some == {k: [*library.encode(dict(ODD)[k], add_special_tokens=False).ids, 1] for k in (9, 17)}
    frames.write_tokens(none, queries.WORD_BPE, str(tmp_path / "empty"), 1)
    assert rows(frames.token_summaries(llm, str(tmp_path / "empty"))) == []


def test_damage_in_a_frame_is_found():
    data = bytearray(frames.packed([b"first" * 100, b"", b"third"]))
    reader = frames.FrameReader(bytes(data))
    assert [reader.read(i) for i in range(3)] == [b"first" * 100, b"", b"third"]
    data[len(data) - 9 - 36 + 8] ^= 1  # the checksum of the first frame
    with pytest.raises(ValueError):
        frames.FrameReader(bytes(data)).read(0)
    assert frames.FrameReader(bytes(data)).read(2) == b"third"


WORDS = WordPieces(queries.WORD_BPE)
SIGNS = st.text(st.sampled_from("aAzßéİǅµ ' 's't've dll12½.,#-_\n\t\x85\xa0\x1c日Привет́"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(SIGNS, max_size=6))
def test_word_pieces_equal_the_library(texts):
    ids, counts = WORDS.encode(texts)
    expect = [WORDS.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(e) for e in expect] and ids.tolist() == [i for e in expect for i in e]


# Byte BPE


LIBRARY = Tokenizer.from_file(queries.BYTE_BPE[0])
TIGHT = bpe.ChunkedBpe(*queries.BYTE_BPE, cut_bits=2, store_bytes=3000)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab  \n\t'séßñ日.1   😀<|endoftext|>"), max_size=200))
def test_chunked_bpe_equals_the_library(text):
    ids = TIGHT.encode(text)
    expect = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expect and TIGHT.decode(ids) == LIBRARY.decode(expect, skip_special_tokens=False)


def test_ids_that_split_a_character_decode_alike():
    ids = LIBRARY.encode("日本😀é", add_special_tokens=False).ids
    for i in range(len(ids)):
        assert TIGHT.decode(np.array(ids[i:], np.int64)) == LIBRARY.decode(ids[i:], skip_special_tokens=False)


def test_shared_chunks_are_encoded_once():
    engine = bpe.ChunkedBpe(*queries.BYTE_BPE)
    text = prose(6, 4000)
    engine.encode(text)
    once = engine.encoded
    engine.encode("moved " + text)
    assert engine.encoded - once < len(text) / 10


def test_token_digests_of_odd_rows(odd, none):
    found = rows(bpe.token_digests(odd, *queries.BYTE_BPE))
    expect = []
    for doc, text in ODD:
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4")
        back = LIBRARY.decode(ids.tolist(), skip_special_tokens=False)
        expect.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert found == sorted(expect, key=repr)
    assert rows(bpe.token_digests(none, *queries.BYTE_BPE)) == []


# Fingerprints


def shingles(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_neighbour_report_of_odd_rows(odd, none):
    found = rows(sketch.neighbour_report(odd.where("doc_id is not null")))
    ordered = sorted(((i, t or "") for i, t in ODD if i is not None), key=lambda r: (r[0], r[1]))
    expect = []
    for k, (doc, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        changed = sketch.edited(text, after)
        prints = sketch.fingerprints_of(pa.array([text, changed, after], pa.large_string()))
        expect.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), sketch.text_of(prints[0]), sketch.text_of(prints[1]),
                       float(sketch.likeness(prints[0], prints[1])), float(sketch.likeness(prints[0], prints[2]))))
    assert found == sorted(expect, key=repr)
    assert len(rows(sketch.neighbour_report(odd))) == len(ODD)
    assert rows(sketch.neighbour_report(none)) == []
    assert len(rows(sketch.neighbour_report(odd.where("doc_id = 7")))) == 1


def test_likeness_is_near_the_true_similarity():
    error = []
    for k in range(40):
        a, b = prose(k, 700), prose(k, 300 + 10 * k) + " " + prose(k + 100, 200)
        prints = sketch.fingerprints_of(pa.array([a, b], pa.large_string()))
        x, y = shingles(a), shingles(b)
        error.append(float(sketch.likeness(prints[0], prints[1])) - len(x & y) / len(x | y))
    assert abs(np.mean(error)) < 0.02 and np.max(np.abs(error)) < 0.12


# Decontamination


def distance(item, text):
    """Least edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_matches_equal_all_distances(llm):
    items = [(k, prose(20 + k, 12)) for k in range(5)] + [(9, None), (10, "too short"), (None, prose(40, 10))]
    docs = [(0, None), (1, ""), (2, prose(21, 11)), (3, prose(60, 20) + "\n" + prose(20, 12).upper() + " " + prose(61, 9)),
            (4, prose(22, 12).replace("e", "", 2)), (5, prose(23, 12).replace("o", "00")), (6, prose(24, 5)), (None, prose(40, 10))]
    found = decontaminate.benchmark_matches(
        llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string"), block_chars=150).collect()
    expect = set()
    for doc, text in docs:
        for item, wanted in items:
            wanted = decontaminate.normal(wanted or "")
            budget = max(1, len(wanted) // decontaminate.PIECE) - 1
            if len(wanted) >= decontaminate.LEAST and (d := distance(wanted, decontaminate.normal(text or ""))) <= budget:
                expect.add((doc, item, d))
    assert {(r.doc_id, r.item_id, r.distance) for r in found} == expect and len(found) == len(expect)
    spans = {(r.doc_id, r.item_id): dict(docs)[r.doc_id][r.start : r.end] for r in found}
    assert spans[(3, 0)] == prose(20, 12).upper() and spans[(None, None)] == prose(40, 10)


def test_documents_without_matches(odd, none):
    benchmark = odd.sparkSession.createDataFrame([(1, prose(2, 30)), (1, prose(2, 30)), (2, None)], "item_id long, text string")
    kept = decontaminate.without_matches(odd, benchmark)
    assert kept.columns == odd.columns
    assert sorted(r.id for r in kept.collect()) == [k for k, (_, t) in enumerate(ODD) if prose(2, 30) not in (t or "")]
    assert rows(decontaminate.without_matches(none, benchmark)) == [] and kept.count() == len(ODD) - 1
    assert decontaminate.without_matches(odd, benchmark.limit(0)).count() == len(ODD)


# Language


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(4)
    first = np.array([0, 5, 5, 6, 12])
    scores = rng.normal(0, 9, (12, 3)).astype(np.float32)
    path = language.viterbi(scores, first)
    for a, b in zip(first, first[1:], strict=False):
        best = max(np.ndindex(*[3] * (b - a)), key=lambda p: sum(scores[a + i, s] for i, s in enumerate(p)) - language.SWITCH * sum(
            x != y for x, y in zip(p, p[1:], strict=False))) if b > a else ()
        assert tuple(path[a:b]) == tuple(best)


def test_languages_of_held_out_documents(llm):
    found = queries.op6_language(llm, "/root/testdata/sf0.01").alias("f").join(
        llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.97


def test_spans_of_mixed_text_and_odd_rows(llm, odd, none):
    train = llm.createDataFrame([("the house and the other thing with that " * 20, "en"), ("das Haus und die andere Sache mit der ich " * 20, "de"),
                                 ("Привет мир и всё остальное " * 20, "ru"), (None, "en"), ("no language", None)], "text string, lang string")
    model = language.learn(train)
    mixed = "the thing with the house and that other " * 3 + "und die Sache mit der ich das Haus " * 3
    docs = llm.createDataFrame([(1, mixed), (2, None), (3, "123 --"), (4, "мир")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in language.spans(docs, model).collect()}
    assert [s.lang for s in found[1]] == ["en", "de"] and abs(found[1][1].start - mixed.index("und die")) < 12
    assert found[2] == found[3] == [] and [s.lang for s in found[4]] == ["ru"] and (found[4][0].start, found[4][0].end) == (0, 3)
    got = {r.doc_id: r for r in language.predict(odd, model).collect()}
    assert got[10].lang_pred == "ru" and got[6].lang_pred == got[4].lang_pred == got[12].lang_pred == "und" and got[4].score == 0
    assert all(0 <= r.score <= 1 for r in got.values()) and language.predict(odd, model).count() == len(ODD)
    assert rows(language.predict(none, model)) == []
    assert {r.lang_pred for r in language.predict(odd, language.learn(train.limit(0))).collect()} == {"und"}
    assert language.in_known_language(odd, model).columns == odd.columns


# Quality


def test_quality_of_held_out_documents(llm):
    found = queries.op5_quality(llm, "/root/testdata/sf0.01").join(
        llm.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.95


def test_rules_compile_to_what_they_say(llm, odd, none):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, len(rules.STATISTICS)))
    y = ((x[:, 1] > 0.3) & (x[:, 2] <= 0.5)).astype(float)
    made = rules.fit(x, y)
    assert 0 < len(made.rules) < 60
    frame = llm.createDataFrame([tuple(map(float, r)) for r in x[:200]], ", ".join(f"{s} double" for s in rules.STATISTICS))
    z = np.full(200, made.intercept)
    for rule, weight in made.rules:
        z += weight * rules._applies(x[:200], rule)
    for s, low, high, weight in made.linear:
        z += weight * np.clip(x[:200, s], low, high)
    got = [r[0] for r in frame.select(made.column()).collect()]
    assert np.allclose(sorted(got), sorted(1 / (1 + np.exp(-z)))) and np.mean((1 / (1 + np.exp(-z)) >= 0.5) == (y[:200] == 1)) > 0.97
    labels = llm.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None), (99, 1), (5, 0)], "doc_id long, quality int")
    found = rules.scored(odd, labels).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert {round(r.score, 3) for r in rules.scored(odd, labels.limit(0)).collect()} == {0.5}
    assert rows(rules.scored(none, labels)) == []
