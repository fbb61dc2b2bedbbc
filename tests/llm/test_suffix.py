"""Suffix orders against sorting, removed bytes against counting every window."""

import random
import tempfile
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labelmill.llm import induced
from labelmill.llm.common import joined
from labelmill.llm.suffix_dedup import drop_repeats, least, sharing_halves


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.sampled_from([1, 2, 7, 1 << 17]))
def test_suffix_order_is_the_sorted_order(symbols, block):
    text = np.array([*symbols, 0], np.uint8)
    was, induced.BLOCK = induced.BLOCK, block
    try:
        with tempfile.TemporaryDirectory() as folder:
            order = induced.suffix_order(text, 4, induced.Files(folder)).tolist()
    finally:
        induced.BLOCK = was
    raw = text.tobytes()
    assert order == sorted(range(len(text)), key=lambda i: raw[i:])


@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(1, 40))
def test_least_of_windows(values, width):
    width = min(width, len(values))
    got = least(np.array(values, np.uint64), width).tolist()
    assert got == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (doc_id, _), raw in zip(rows, raws):
        spans = joined([(i, i + length) for i in range(len(raw) - length + 1) if seen[raw[i : i + length]] > 1])
        edges = [0, *(x for s in spans for x in s), len(raw)]
        out.append((doc_id, len(raw), spans, b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))))
    return sorted(out, key=str)


def mine(df, length):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in drop_repeats(df, length).collect()), key=str)


@pytest.mark.parametrize("length", [5, 13, 70])
def test_removed_bytes_equal_brute_force(spark, length):
    rng = random.Random(length)
    base = "".join(rng.choice("ab é") for _ in range(600))
    rows = []
    for doc_id in range(25):
        a = rng.randint(0, 500)
        shared = base[a : rng.randint(a, 600)]
        own = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
        rows.append((doc_id, own("abcdefgh", 60) + shared + own("xyz", 90)))
    rows += [(30, "a" * 3000), (31, "a" * (length + 1)), (32, "ab" * 300), (33, None), (33, ""), rows[3], (None, rows[4][1])]
    assert mine(spark.createDataFrame(rows, "doc_id long, text string"), length) == brute(rows, length)


def test_odd_rows(odd, odd_rows, nothing):
    assert mine(odd, 20) == brute(odd_rows, 20)
    assert drop_repeats(nothing).count() == 0


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert mine(docs, 400) == brute(rows, 400)


def test_a_half_of_many_contexts_is_split(spark, capsys):
    """The join on half prints deals out a half that many contexts share; others stay right."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    rows = [(1, i, 7, 100 + i) for i in range(4000)] + [(2, i, 0, i % 30) for i in range(59)] + [(3, 1, 5, 6), (3, 2, 6, 5)]
    was = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        shared = sharing_halves(spark.createDataFrame(rows, "key long, print long, lefts long, rights long").repartition(8))
        got = sorted(map(tuple, shared.collect()))
        shared.explain()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # prints 1 to 28 of key 2 have a partner, 0 has no half and 29 stands alone
    assert got == [(1, i) for i in range(4000)] + [(2, i) for i in range(59) if i % 30 not in (0, 29)]
    assert "skew=true" in capsys.readouterr().out
