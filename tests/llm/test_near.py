"""Components against comparing every pair."""

import random
from itertools import combinations

import pytest

from labelmill.llm.components import merge_labels
from labelmill.llm.near_dedup import drop_near_copies, near_duplicates


def shingles(text, k):
    words = [w.lower() if w.isascii() else w.encode().lower().decode() for w in (text or "").encode().decode().replace(" ", "\x00").split(" ")]
    words = [p.replace("\x00", " ") for w in words for p in w.replace("\t", " ").replace("\n", " ").split(" ") if p]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, percent):
    """(doc_id, set size, component) of rows with distinct ids."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    top = {i: i for i, _ in sets if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return sorted((i, len(s), None if i is None else find(i)) for i, s in sets) if None not in dict(sets) else sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def mine(df, k, percent):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df, k, percent).collect()), key=str)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    rng = random.Random(k)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    rows = []
    for family in range(8):
        base = [word() for _ in range(rng.choice([4, 40, 200]))]
        for _ in range(12):  # chains of edits: links lead on through copies of copies
            rows.append((rng.randrange(10**9), " ".join(base)))
            for _ in range(rng.choice([0, 1, 2, 8])):
                base[rng.randrange(len(base))] = word()
    assert mine(spark.createDataFrame(rows, "doc_id long, text string"), k, percent) == sorted(map(tuple, brute(rows, k, percent)), key=str)


def test_group_of_near_copies_without_a_common_hub(spark):
    """Every copy is near its neighbours only; the group still is one component."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rng.randrange(100)] = f"v{i}"
    assert mine(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85) == sorted(map(tuple, brute(rows, 3, 85)), key=str)


def test_odd_rows(odd, nothing):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_duplicates(odd, 3, 85).collect()}
    assert got[2, 0] == (2, True) and got[3, 0] == (3, True) and got[4, 0] == (4, True)
    assert got[5, 29_998] == (5, True) and got[6, 29_998] == (5, False)
    assert {k: v for k, v in got.items() if k[0] is None} == {(None, 12): (None, True), (None, 0): (None, True)}
    assert near_duplicates(nothing).count() == 0
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r[0] is None, r[0] or 0) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 5, 7, 8)] + [(True, 0)] * 2
    assert drop_near_copies(nothing).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (1, a), (7, c), (7, c), (9, c + " more"), (None, a), (None, a), (8, ""), (8, "")]
    kept = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(5, b), (1, a), (7, c), (None, a), (None, a), (8, ""), (8, "")], key=str)


def test_labels_of_a_long_path(spark):
    labels = spark.range(50).selectExpr("id as node", "id as comp")
    links = spark.range(49).selectExpr("id as a", "id + 1 as b").where("a <> 20")
    got = {r.node: r.comp for r in merge_labels(labels, links).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(50)}
