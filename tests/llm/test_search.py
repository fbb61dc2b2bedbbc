"""Ranked search: against scoring every document for every item in plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labelmill.llm import ranked_search as module
from labelmill.llm.ranked_search import Best, Terms, ranked_search, search_segment

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(b.values()) for _, b in bags]
    big_n, big_l = sum(x > 0 for x in n), sum(n)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scored = []
        for (i, bag), length in zip(bags, n):
            score = 0
            for w in terms(text):
                if bag[w]:
                    m = 100 - 25 + (25 * length * big_n) // big_l
                    score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((1000000000 * bag[w]) // (1000 * bag[w] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if null else i, -s))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(spark, odd, odd_rows, nothing):
    items = [(1, "One line is here THREE"), (2, None), (3, ""), (4, "!! ??"), (5, "naïve 一二三 end 😀"), (5, "w5x5 w5x5 w900x20000 some"), (None, "words 12345"), (9, "absent")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, score int, TEXT string")
    for parts in (1, 4):
        assert found(ranked_search(odd.repartition(parts), table)) == plain(odd_rows, items)
    assert found(ranked_search(nothing, table)) == []
    assert ranked_search(odd, table.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
    assert found(ranked_search(odd, table.where("item_id in (2, 3, 4)"))) == []


def test_ties_and_repeated_rows(spark):
    docs = [(i, f"alpha beta {'gamma' if i % 3 else 'delta'}") for i in range(90)] + [(7, "alpha beta gamma")] * 3 + [(1000 + i, "other words here") for i in range(500)]
    items = [(1, "alpha"), (2, "delta gamma alpha alpha"), (2, "beta other"), (1, "alpha")]
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == plain(docs, items)


def test_small_segments_and_blocks_change_nothing(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(ranked_search(docs, items)) == expected
    monkeypatch.setattr(module, "BLOCK_CHARS", 3_000)
    assert found(ranked_search(docs.repartition(9), items)) == expected


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(1, 1500))
def test_a_segment_equals_adding_up_all(seed, n_lists, n_docs):
    rng = np.random.default_rng(seed)
    lists, whole = [], np.zeros(n_docs, np.int64)
    for _ in range(n_lists):
        docs = np.flatnonzero(rng.random(n_docs) < rng.choice([0.01, 0.1, 0.6, 1.0]))
        if len(docs):
            scores = rng.integers(1, rng.choice([3, 50, 1000]), len(docs))
            lists.append((docs, scores))
            whole[docs] += scores
    if not lists:
        return
    ids = rng.permutation(n_docs)
    best = Best.empty(20)
    search_segment(lists, n_docs, np.zeros(n_docs, bool), ids, best)
    expected = sorted((-int(whole[i]), int(ids[i])) for i in range(n_docs) if whole[i])[:20]
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == expected


def test_low_documents_are_skipped(monkeypatch):
    """With a high score to beat, long lists of small bounds are only looked up."""
    n = 100_000
    long = (np.arange(n), np.ones(n, np.int64))
    short = (np.arange(0, n, 4000), np.arange(25) + 100)
    seen = []
    real = module.accumulated
    monkeypatch.setattr(module, "accumulated", lambda lists: seen.append(sum(len(d) for d, _ in lists)) or real(lists))
    best = Best.empty(20)
    best.add(np.full(20, 90), np.zeros(20, bool), np.arange(20) + n)
    search_segment([long, short], n, np.zeros(n, bool), np.arange(n), best)
    assert best.scores.tolist() == [125 - i for i in range(20)]
    assert sum(seen) == 50  # the accumulators once, then as the only list with candidates


@pytest.mark.parametrize("size", [1, 7, 8, 9, 16, 40])
def test_terms_are_compared_by_bytes(size, monkeypatch):
    word, other = "a" * size, "a" * (size - 1) + "b"
    # all words share one hash: only the bytes tell them apart
    monkeypatch.setattr(module, "word_hashes", lambda d, o, b: (real := __import__("labelmill.llm.words", fromlist=["x"]).word_hashes(d, o, b)) and (real[0] * 0, real[1]))
    own = Terms([word])
    lengths, doc, term, tf = own.found(pa.array([f"{word} {other} {word.upper()}", "", other, f"{word}é {word}"]))
    assert lengths.tolist() == [3, 0, 1, 2] and doc.tolist() == [0, 3] and tf.tolist() == [2, 1]
