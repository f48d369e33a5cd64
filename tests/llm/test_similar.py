"""Groups by true similarity, and the pipeline's stage that keeps one document of each."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from odd_rows import ODD

from boardweave.llm import similar


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def jaccard_groups(texts):
    """A number for each text, by all pairs that have a shingle in common."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    first, having = {}, defaultdict(list)
    for i, s in enumerate(sets):
        root[find(i)] = find(first.setdefault(s, i))
        if first[s] == i:
            for g in s:
                having[g].append(i)
    common = defaultdict(int)
    for at in having.values():
        for k, i in enumerate(at):
            for j in at[:k]:
                common[i, j] += 1
    for (i, j), both in common.items():
        if both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def test_similar_sets_share_a_key():
    """Of pairs at a similarity of just 0.8, at most one in a hundred has no key in common; unlike sets have none."""
    chance, met, tried, unlike = random.Random(5), 0, 0, 0
    for n in [*range(8, 80, 3), 200, 1000]:
        for _ in range(30):
            base = [chance.getrandbits(63) for _ in range(n)]
            lost = n // 5
            other = base[lost:] if chance.random() < 0.5 else base[lost // 2 :] + [chance.getrandbits(63) for _ in range(max(0, (5 * (n - lost // 2)) // 4 - n))]
            both = len(set(base) & set(other)) / len(set(base) | set(other))
            if both < 0.8:
                continue
            sets = [sorted(base), sorted(other), sorted(chance.getrandbits(63) for _ in range(n))]
            hashes, first = np.array(sum(sets, []), np.uint64), np.cumsum([0, *map(len, sets)])
            prints = similar.prints_of(hashes, first)
            of, keys = similar.keys_of(prints, similar.anchors_of(hashes, first))
            met, tried = met + bool(set(keys[of == 0]) & set(keys[of == 1])), tried + 1
            unlike += bool(set(keys[of == 0]) & set(keys[of == 2]))
            assert np.bitwise_count(prints[0] ^ prints[1]).sum() <= similar.MOST_BITS
    assert tried > 300 and met >= 0.98 * tried and not unlike


def test_prints_in_blocks_and_of_empty_sets():
    hashes, first = similar.shingle_sets(pa.array([t or "" for _, t in ODD], pa.large_string()))
    assert (similar.prints_of(hashes, first) == similar.prints_of(hashes, first, 7)).all()
    plain = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in similar._stamped(hashes[i:j], 3)) > j - i) for i, j in zip(first, first[1:])]
    assert similar.prints_of(hashes, first)[:, 3].tolist() == plain


def test_sets_are_those_of_plain_shingles():
    texts = [t or "" for _, t in ODD] + ["A b c D e", "a B C d E", "a b c d", "a b c d e f"]
    hashes, first = similar.shingle_sets(pa.array(texts, pa.large_string()))
    assert [len(shingles(t)) for t in texts] == list(np.diff(first))
    nodes = similar.nodes_of(hashes, first)
    assert len(set(nodes.tolist())) == len({shingles(t) for t in texts}) and nodes[-4] == nodes[-3]


def test_chain_of_neighbours_and_bridges(llm):
    """Copies with edits of their own, chains whose ends are unlike, and a passage that all share."""
    chance = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    texts, common = [], chance.choices(words, k=15)
    for _ in range(12):
        own = chance.choices(words, k=chance.choice([4, 9, 30, 120])) + common
        for _ in range(8):
            texts.append(" ".join(own))
            own = list(own)
            own[chance.randrange(len(own))] = chance.choice(words)
    docs = llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    want, got = jaccard_groups(texts), {r.doc_id: r.group for r in similar.groups(docs).collect()}
    assert len(set(zip(want, [got[i] for i in range(len(texts))], strict=True))) == len(set(want)) == len(set(got.values()))


def test_bucket_whose_least_node_is_unlike_the_others(llm, monkeypatch):
    """One key for all: the star around the least node finds little, the blocks of the bucket find the rest."""
    chance = random.Random(3)
    texts = []
    for family in range(5):
        own = [f"f{family}w{i}" for i in range(60)]
        for _ in range(9):
            texts.append(" ".join(own))
            own = list(own)
            own[chance.randrange(60)] = f"x{chance.random()}"
    docs = llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "row long, text string")
    rows = docs.mapInArrow(similar._marked, "row long, node long, size long, " + ", ".join(f"{c} long" for c in similar._PRINT + similar._ANCHOR))
    rows = [r.asDict() for r in rows.collect()]
    nodes = llm.createDataFrame([{**r, "shown": r["row"]} for r in rows])
    members = llm.createDataFrame([(1, r["node"], r["node"]) for r in rows], "key long, node long, root long")
    sets = {r["node"]: shingles(texts[r["row"]]) for r in rows}


    def met():
        apart = similar._apart(members, None)
        return {(r.u, r.v) for r in similar._met(apart, len(rows), docs, nodes).collect()}

    alike = {(a, b) for a in sets for b in sets if a < b and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))}

    def parts(links):
        of = {n: n for n in sets}
        for u, v in links:
            of = {n: of[u] if r == of[v] else r for n, r in of.items()}
        return {frozenset(n for n in sets if of[n] == r) for r in of.values()}

    whole = met()
    assert whole <= alike and parts(whole) == parts(alike) and len(whole) == len(sets) - len(parts(alike))
    monkeypatch.setattr(similar, "BLOCK", 8)
    assert met() <= alike and parts(met()) == parts(alike)


def test_stage_takes_maps_and_names_with_dots(llm):
    import corpus_pipeline

    docs = llm.createDataFrame([(1, "a b", {"k": 1}, 2), (1, "a b", {"k": 1}, 2), (2, "A b", None, 3)], "doc_id long, text string, m map<string,int>, `x.y` long")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert [tuple(r) for r in stage(llm, docs, "").collect()] == [(1, "a b", {"k": 1}, 2)]


def test_stage_keeps_one_of_each_group_of_the_small_table(llm):
    import corpus_pipeline

    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    have = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    least = {}
    for (doc, _), group in zip(have, jaccard_groups([t for _, t in have]), strict=True):
        least[group] = min(doc, least.get(group, doc))
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r.doc_id for r in stage(llm, docs, "").select("doc_id").collect()) == sorted(least.values())


def test_stage_keeps_one_of_rows_without_id_and_of_repeated_rows(llm, odd):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(None, long, "a"), (None, long, "b"), (None, long, "b"), (7, "x y z", "a"), (7, "x y z", "a"), (7, "x y z", "a"), (8, "X  y z", "a"), (9, "p q", "a"), (9, "r s", "a"),
            (1, long + " end of it", "c")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    assert sorted(map(tuple, stage(llm, docs, "").collect())) == [(1, long + " end of it", "c"), (7, "x y z", "a"), (9, "p q", "a"), (9, "r s", "a")]
    nulls = llm.createDataFrame(rows[:3], docs.schema)
    assert stage(llm, nulls, "").count() == 1
    assert stage(llm, odd, "").count() == len(set(jaccard_groups([t for _, t in ODD])))


def test_rows_that_share_an_id_are_sources_for_each_other(llm):
    from boardweave.llm import substrings

    shared = " ".join(f"w{i}" for i in range(20))
    docs = llm.createDataFrame([(1, "a b " + shared), (1, shared + " c d"), (None, shared), (None, shared), (2, "e f g")], "doc_id long, text string").repartition(3)
    kept = sorted(r.text for r in substrings.without_repeats(docs).collect())
    assert kept in (sorted(["a b " + shared, "c d", "e f g"]), sorted(["a b", shared + " c d", "e f g"]))
