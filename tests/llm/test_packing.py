"""Packing: an exact round trip of ids, and the tree against a plain search."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from labelmill.llm.packing import Encoder, best_fit_decreasing, pack, sequences
from labelmill.llm.queries import op2_packing

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_decreasing_equals_plain_search(lengths):
    rooms, plain = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        room = min(fits, default=16)
        rooms.remove(room) if fits else None
        rooms.append(room - lengths[i])
        plain[i] = 16 - room
    places, n = best_fit_decreasing(lengths, 16)
    assert n == len(rooms)
    assert sorted(o for _, o in places) == sorted(plain.values())
    filled = defaultdict(list)
    for (w, offset), length in zip(places, lengths):
        filled[w].append((offset, length))
    for spans in filled.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + x == b for (a, x), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 16


encoder = Encoder(PATH, RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Zé'sll\n\t\r .,!?12²ⅧÀ日本　\xa0​😀́ß€<|endoftext|>"), max_size=30))
def test_ids_equal_the_tokenizers_library(text):
    assert encoder.encode(text).tolist() == encoder.exact(text).tolist()


def check(rows, texts, window=1024):
    """rows of pieces with ids; texts: list of (doc_id, text)."""
    whole = Tokenizer.from_file(PATH)
    expected = sorted(((i, (*whole.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in texts), key=str)
    sequences_, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences_[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens, np.frombuffer(r.ids, "<u4").tolist()))
    for spans in sequences_.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + x == b for (a, x), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= window
    unique = defaultdict(list)
    for i, ids in expected:
        unique[i].append(ids)
    for i, docs in unique.items():
        pieces = sorted(by_doc[i])
        assert sum(len(p[3]) for p in pieces) == sum(map(len, docs))
        if len(docs) == 1:
            assert tuple(x for p in pieces for x in p[3]) == docs[0]
            assert all(p[0] == sum(q[1] for q in pieces[:k]) and p[2] == len(docs[0]) and p[1] == len(p[3]) for k, p in enumerate(pieces))
    return len(sequences_)


def test_round_trip(spark, odd, odd_rows, nothing):
    check(pack(odd, PATH, RANKS).collect(), odd_rows)
    check(pack(odd.repartition(3), PATH, None, window=64).collect(), odd_rows, 64)
    assert pack(nothing, PATH, RANKS).count() == 0


def test_given_documents_are_packed_tightly(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = pack(docs, PATH, RANKS)
    rows = packed.collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.length for r in rows) > 0.99 * 1024 * n
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in op2_packing(spark, sf_dir).collect()}
    assert crc == {(r.doc_id, r.start): zlib.crc32(r.ids) for r in rows}


def test_rests_of_many_small_partitions_are_packed_together(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(211)
    rows = pack(docs, PATH, RANKS).select("sequence_id", "length").collect()
    assert sum(r.length for r in rows) > 0.98 * 1024 * len({r.sequence_id for r in rows})


@pytest.mark.parametrize("window", [8])
def test_sequences_hold_their_pieces(spark, window):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m"), (2, "x"), (3, None)], "doc_id long, text string")
    out = sequences(pack(docs, PATH, RANKS, window=window)).collect()
    assert all(len(r.ids) == 4 * r.fill <= 4 * window for r in out)
    assert sorted(i for r in out for i in set(r.doc_ids)) == sorted([1] * 1 + [1, 2, 3]) or len(out) >= 2
