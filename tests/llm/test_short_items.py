"""Benchmark items of few characters, and benchmarks of several blocks."""

from odd_rows import ODD, prose

from boardweave.llm import decontaminate


def test_short_items_match_between_word_edges(llm):
    docs = [(1, "He said:  The\nCAT, sat."), (2, "the cats"), (3, "scathe cat"), (4, "x the cat"), (5, "see 42 and 420"), (6, "日本語の本"), (7, None), (8, "the cat the cat"), (9, "café x")]
    items = [(1, "the cat"), (2, "42"), (3, "本語"), (4, ""), (5, " \n"), (6, None), (7, "cafe")]
    found = decontaminate.benchmark_matches(
        llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.distance, r.start, r.end) for r in found) == [
        (1, 1, 0, 10, 17), (4, 1, 0, 2, 9), (5, 2, 0, 4, 6), (6, 3, 0, 1, 3), (8, 1, 0, 0, 7)]
    kept = decontaminate.without_matches(llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7, 9]


def test_blocks_are_fetched_one_at_a_time(llm, odd, monkeypatch):
    items = [(k, f"{prose(k, 12)} {k}") for k in range(9)] + [(20, prose(2, 30))]
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    order, write = [], decontaminate.written
    n, blocks = decontaminate.item_blocks(benchmark, 150)
    assert n > 3 and sorted(i for b in blocks for i in b) == sorted(items)

    def fetched(*given):
        n, blocks = item_blocks(*given)
        return n, (order.append("fetch") or b for b in blocks)

    item_blocks = decontaminate.item_blocks
    monkeypatch.setattr(decontaminate, "item_blocks", fetched)
    monkeypatch.setattr(decontaminate, "written", lambda df, label: order.append(label) or write(df, label))
    whole = {tuple(r) for r in decontaminate.benchmark_matches(odd, benchmark).collect()}
    kept = sorted(r.id for r in decontaminate.without_matches(odd, benchmark).collect())
    cut = {tuple(r) for r in decontaminate.benchmark_matches(odd, benchmark, 150).collect()}
    assert cut == whole and order[-2 * n - 1 :] == ["items", *["fetch", "matches"] * n]
    assert sorted(r.id for r in decontaminate.without_matches(odd, benchmark, 150).collect()) == kept
    assert order[-2 * n - 1 :] == ["items", *["fetch", "unclean"] * n] and len(kept) < len(ODD)
