"""BPE: equal to the merges of another library, and an exact round trip."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from labelmill.llm.bpe import Vocabulary, decode, decoded, encode, vocabulary
from labelmill.llm.queries import op11_bpe

FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def plain(name):
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PLAIN = {name: plain(name) for name in FILES}


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(bodies=st.lists(st.one_of(
    st.text(max_size=40),
    st.text(st.sampled_from("aabnsteio áéñ ünßdie 日本語한국어русский́‍😀 \n\t\r.,!'123ⅧØ"), max_size=60),
    st.text(st.sampled_from("ab"), max_size=80),
), max_size=4))
def test_ids_equal_merging_by_rank(name, bodies):
    words = vocabulary(public_tokenizers.path(name))
    got = words.encode_batch(bodies)
    assert [g.tolist() for g in got] == [PLAIN[name].encode_ordinary(t) for t in bodies]
    assert [decoded(g, words.bytes_of) for g in got] == [t.encode() for t in bodies]


@pytest.mark.parametrize("name", FILES)
def test_long_pieces_take_linear_time(name):
    words = vocabulary(public_tokenizers.path(name))
    for body in ("a" * 100_000, "ab" * 50_000, "的一" * 20_000, " " * 50_000, "=-" * 30_000, "тест" * 20_000, "thetheirinthere" * 4_000):
        assert words.encode_batch([body])[0].tolist() == PLAIN[name].encode_ordinary(body)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=40),
    st.lists(st.text(st.sampled_from("abc"), max_size=14), max_size=5),
)
def test_any_order_of_merges(merges, bodies):
    """Vocabularies of random merges, where longest matches are mostly wrong."""
    ranks = {bytes([b]): b for b in range(256)}
    made = [b"a", b"b", b"c"]
    for x, y in merges:
        token = made[x % len(made)] + made[y % len(made)]
        if token not in ranks and len(token) < 9:
            ranks[token] = len(ranks)
            made.append(token)
    other = tiktoken.Encoding("random", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    try:
        own = Vocabulary(ranks, r"(?s).+")
    except ValueError:
        return  # some token is merged before its own part: refused
    assert [x.tolist() for x in own.encode_batch(bodies)] == [other.encode_ordinary(t) for t in bodies]


def test_ranks_out_of_order_are_refused():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257}
    with pytest.raises(ValueError, match="order of merges"):
        Vocabulary(ranks, r"(?s).+")
    with pytest.raises(ValueError, match="single byte"):
        Vocabulary({b"a": 0}, r"(?s).+")


def test_a_token_that_no_merge_makes_is_a_whole_piece():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 258, b"abcd": 259}
    other = tiktoken.Encoding("x", pat_str=r"\w+| ", mergeable_ranks=ranks, special_tokens={})
    own = Vocabulary(ranks, r"\w+| ")
    for body in ("abcd", "abcd abcde abc", "abcabcd", "ab", "ddabcd"):
        assert own.encode_batch([body])[0].tolist() == other.encode_ordinary(body)


def test_round_trip(spark, odd, odd_rows, nothing):
    path = public_tokenizers.path(FILES[0])
    out = decode(encode(odd.repartition(3), path), path).collect()
    expected = [(i, np.array(PLAIN[FILES[0]].encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in odd_rows]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in out), key=str) == sorted(expected, key=str)
    both = encode(odd.repartition(3), path, decoding=True).collect()
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in both), key=str) == sorted(expected, key=str)
    assert encode(nothing, path).count() == 0
    rows = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert decode(rows, path).first().decoded is None


def test_query_on_the_given_documents(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_bpe(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(PLAIN[FILES[0]].encode_ordinary(docs[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
