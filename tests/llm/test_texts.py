"""Unit dedup, line dedup, decontamination, quality rules and HTML text on small rows."""

import re
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from labelmill.llm import decontaminate as d
from labelmill.llm.common import joined
from labelmill.llm.html_text import page_text, visible_text
from labelmill.llm.line_dedup import drop_repeated_chunks
from labelmill.llm.oracles import ORACLES
from labelmill.llm.quality import POLICIES, RULES, ablations, judge, ledger
from labelmill.llm.queries import QUERIES
from labelmill.llm.unit_dedup import PASSAGE_WORDS, drop_repeated_units, units


# unit dedup ------------------------------------------------------------------
def brute_units(rows, unit, min_words):
    seen, out = set(), []
    order = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    gone = {}
    for doc_id, text in order:
        spans = []
        for a, b, digest in units(text or "", unit, min_words):
            if digest in seen:
                spans.append((a, b))
            seen.add(digest)
        gone[doc_id, text] = spans
    for doc_id, text in rows:
        spans, kept, last = joined(gone[doc_id, text]), "", 0
        for a, b in spans:
            kept, last = kept + (text or "")[last:a], b
        out.append((doc_id, spans, kept + (text or "")[last:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence", "passage"])
def test_units_equal_brute_force(spark, sf_dir, unit):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.doc_id, [tuple(s) for s in r.removed], r.text) for r in drop_repeated_units(docs, unit, 5).collect()), key=str)
    assert got == brute_units(rows, unit, 5)
    assert any(spans for _, spans, _ in got)


def test_unit_offsets_and_normalisation(spark):
    rows = [(1, "Alpha beta, gamma!\nother line here\nALPHA  beta gamma"), (2, "x\nalpha-beta gamma\ny"), (3, None)]
    got = {r.doc_id: ([tuple(s) for s in r.removed], r.text) for r in drop_repeated_units(spark.createDataFrame(rows, "doc_id long, text string"), "line", 3).collect()}
    assert got == {1: ([(35, 52)], "Alpha beta, gamma!\nother line here\n"), 2: ([(2, 18)], "x\n\ny"), 3: ([], "")}


def test_units_of_odd_rows(odd, odd_rows, nothing):
    got = sorted(((r.doc_id, [tuple(s) for s in r.removed], r.text) for r in drop_repeated_units(odd, "line", 3).collect()), key=str)
    # rows equal in id and text are one document
    assert got == brute_units(odd_rows, "line", 3)
    assert drop_repeated_units(nothing).count() == 0


def test_passages_go_with_the_production_setting(spark):
    verse = "\n".join(f"  line {i} of a song" if i % 3 else f"ho {i}" for i in range(12))
    chinese = "这是一个没有空格的句子它在两个文件里都出现过" * 3
    rows = [
        (1, f"Own words one.\n{verse}\nA first end."), (2, f"Other start here\nand more\n{verse}\nno\nsecond end"),
        (3, "Short copy"), (4, "short copy!"), (5, f"甲乙\n{chinese}\n丙丁"), (6, f"x\n{chinese}\ny"),
        (7, "    an indented line with more than eight words stays here"), (8, "Yes. No. It is so. We saw that there. Go on."), (9, "Well then: so. Yes. No. It is so. We saw that there. Go on. Not this"),
        (10, "\n".join(["la la la la"] * 15)), (11, "This notice is licensed under some public licence, version 3.\nOne text."), (12, "Another text!\nThis notice is licensed under some public licence, version 3."),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in drop_repeated_units(table, "passage", PASSAGE_WORDS).collect()}
    # first occurrences stay, and so do short repeats among other words
    assert all(got[i] == t for i, t in rows if i in {1, 3, 5, 7, 8, 9, 11, 12})
    assert got[2].split() == "Other start here and more no second end".split()
    assert got[4] == "" and got[6].split() == ["x", "y"]
    assert got[10].split("\n")[:7] == ["la la la la"] * 7 and len(got[10].split()) < 4 * 15


def plain_passages(rows, min_words):
    """Removed offsets by doc_id, from sentences and words found with other means, every run compared as words."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        text, sentences, at = text or "", [], 0
        for line in text.split("\n"):
            start = None
            for i, ch in enumerate(line + "\n"):
                if start is None and not ch.isspace():
                    start = i
                ends = ch == "\n" or (ch in ".!?" and (line + "\n")[i + 1].isspace())
                if start is not None and ends:
                    stop = i if ch == "\n" else i + 1
                    words = "".join(c if c.isalnum() else " " for c in line[start:stop].lower()).split()
                    if words:
                        sentences.append((at + start, at + stop, tuple(words)))
                    start = None
            at += len(line) + 1
        sizes = [len(w) for _, _, w in sentences]
        found = set()
        if sentences and sum(sizes) < min_words:
            found.add((0, len(sentences) - 1))
        for i in range(len(sentences)):
            high = next((j for j in range(i, len(sentences)) if sum(sizes[i : j + 1]) >= min_words), None)
            low = next((j for j in range(i, -1, -1) if sum(sizes[j : i + 1]) >= min_words), None)
            found |= {(i, high)} if high is not None else set()
            found |= {(low, i)} if low is not None else set()
        gone, mine = [], {}
        for low, high in sorted(found, key=lambda r: (r[0], -r[1])):
            key = tuple(w for _, _, w in sentences[low : high + 1])
            a, b = sentences[low][0], sentences[high][1]
            if key in mine and a < mine[key]:
                continue
            if key in seen or key in mine:
                gone.append((a, b))
            mine.setdefault(key, b)
        seen |= set(mine)
        out[doc_id] = joined(gone)
    return out


def test_passages_equal_an_independent_brute_force(spark, sf_dir):
    """With the words that the query asks for; scripts without blanks do not occur in these tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 20000 OR text IS NULL")
    expected = plain_passages([(r.doc_id, r.text) for r in docs.collect()], PASSAGE_WORDS)
    got = drop_repeated_units(docs, "passage", PASSAGE_WORDS).collect()
    assert {r.doc_id: [tuple(s) for s in r.removed] for r in got} == expected
    assert sum(map(bool, expected.values())) > 50


# line dedup ------------------------------------------------------------------
def test_shared_lines_are_found_after_a_shift(spark):
    shared = [f"shared line number {i} with some words" for i in range(30)]
    rows = [(1, "\n".join(["intro a", *shared])), (2, "\n".join(["other", "two more", "lines", *shared, "end"])), (3, "\n".join(f"own {i}" for i in range(9)))]
    got = {r.doc_id: r for r in drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"), details=True).collect()}
    assert got[1].removed is None and got[3].removed is None and got[3].text == rows[2][1]
    left = got[2].text.split("\n")
    assert "other" in left and "end" in left and len(left) < 14
    assert [x for x in left if x not in shared] == ["other", "two more", "lines", "end"]


def test_whole_runs_go_out_of_other_texts(spark):
    """Every line of a repeated run goes, also those that share a chunk with lines of their own."""
    block = [f"repeated line {i} of the block" for i in range(9)]
    rows = [(0, "\n".join([f"first {i}" for i in range(5)] + block + [f"last {i}" for i in range(4)]))]
    rows += [(d, "\n".join([f"own {d} {i}" for i in range(d % 7)] + block + [f"tail {d} {i}" for i in range(d % 5)])) for d in range(1, 40)]
    out = drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), details=True).collect()
    for r in out:
        kept = [x for x in r.text.split("\n") if x]
        if r.doc_id == 0:
            assert r.removed is None
        else:
            assert kept == [f"own {r.doc_id} {i}" for i in range(r.doc_id % 7)] + [f"tail {r.doc_id} {i}" for i in range(r.doc_id % 5)]


def test_lines_next_to_a_repeat_stay_where_they_are_the_first_copy(spark):
    """A chunk that others are removed for keeps all its lines."""
    a, c = [f"alpha {i} words" for i in range(8)], [f"gamma {i} words" for i in range(8)]
    rows = [(1, "\n".join([*a, c[0], "other end"])), (2, "\n".join([*a, *c])), (3, "\n".join(["start here", *c]))]
    got = {r.doc_id: r.text for r in drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1]
    lines = {x for t in got.values() for x in t.split("\n")}
    assert lines >= {*a, *c, "other end", "start here"}
    assert len([x for t in got.values() for x in t.split("\n") if x in c]) <= len(c) + 3


def test_lines_of_odd_rows(odd, nothing):
    out = drop_repeated_chunks(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {(r[0], r[1]) for r in out.collect()}
    assert (2, None) in texts and (3, "") in texts and (4, " \n\t ") in texts
    assert drop_repeated_chunks(nothing).count() == 0


# decontamination -------------------------------------------------------------
BENCH = [(1, "The quick brown fox jumps over the lazy dog and then sleeps."), (2, "Two words"), (3, None), (4, "..."), (None, "nine lives of cats")]


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def test_hits(spark, bench):
    rows = [
        (1, "x QUICK brown-fox jumps over the lazy dog and then! y"), (2, "the quick brown fox"), (3, "TWO\nwords two words"),
        (4, None), (5, "nine lives of cats"), (6, "Ǆ quick É"),
    ]
    got = {r.doc_id: ([(s.first, s.last) for s in r.ranges], r.items, r.n_words) for r in d.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: ([(1, 10)], ["1"], 12), 2: ([], [], 4), 3: ([(0, 3)], ["2"], 4), 4: ([], [], 0), 5: ([(0, 3)], [], 4), 6: ([], [], 3)}


def test_blocks_of_a_large_benchmark_agree(spark, sf_dir, bench, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    show = lambda df: sorted((r.doc_id, r.n_words, str(r.ranges), str(r.items)) for r in df.collect())
    whole, clean = show(d.contamination(docs, items)), d.drop_contaminated(docs, items).count()
    monkeypatch.setattr(d, "BLOCK_CHARS", 9000)
    assert show(d.contamination(docs, items)) == whole
    assert d.drop_contaminated(docs, items).count() == clean == sum(r[2] == "[]" for r in whole)


def test_repeated_rows_stay_with_several_blocks(spark, bench, monkeypatch):
    rows = [(1, "x the quick brown fox jumps over the lazy dog and then sleeps two words")] * 3 + [(2, "clean")] * 2 + [(1, "clean"), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    show = lambda: sorted((r.doc_id, r.n_words, str(r.ranges), str(r.items)) for r in d.contamination(docs, bench).collect())
    whole = show()
    assert len(whole) == len(rows)
    monkeypatch.setattr(d, "BLOCK_CHARS", 20)
    assert show() == whole


def test_spans_are_cut(spark, bench):
    rows = [(1, "é Two words! tail", 17), (2, "clean", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, d.drop_contaminated(docs, bench, spans=True).collect())) == [(1, "é ! tail", 8), (2, "clean", 5)]


def test_contamination_of_odd_rows(odd, nothing, bench):
    assert d.contamination(odd, bench).count() == odd.count()
    kept = d.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert d.contamination(nothing, bench).count() == 0
    assert d.contamination(odd, bench.where("false")).where("size(ranges) > 0").count() == 0


# quality rules ---------------------------------------------------------------
def test_ledger_of_odd_rows(odd, nothing):
    rows = {(r.doc_id, r.n_words): r for r in judge(ledger(odd), "v2").collect()}
    assert rows[2, 0].kept is False and rows[2, 0].failed & 1
    assert rows[5, 30_000].n_repeat_words == 0
    assert ledger(odd).count() == odd.count() and ledger(nothing).count() == 0


def test_repeated_words_are_counted_once(spark):
    base = "a b c d e f g h"
    rows = [(1, f"{base} {base}"), (2, "z " * 20), (3, f"{base} x {base} y b c d"), (4, base)]
    got = {r.doc_id: r.n_repeat_words for r in ledger(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 16, 2: 20, 3: 16, 4: 0}


def test_ablations_follow_the_bits(spark, sf_dir):
    book = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).cache()
    bits = [r.failed for r in book.collect()]
    got = {r.rule: r for r in ablations(book, "v2").collect()}
    for i, rule in enumerate(RULES):
        r = got[rule.name]
        assert r.n_failed == sum(b >> i & 1 for b in bits)
        assert r.n_only == sum(b == 1 << i for b in bits)
        assert r.n_kept_without == sum(b in (0, 1 << i) for b in bits)
    assert set(POLICIES["base"]) <= set(POLICIES["v2"])


# HTML ------------------------------------------------------------------------
class Words(HTMLParser):
    """Words outside head, script and style, by the standard library."""

    def __init__(self):
        super().__init__()
        self.out, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("head", "script", "style", "title")

    def handle_endtag(self, tag):
        self.off -= tag in ("head", "script", "style", "title")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_pages_show_the_words_of_the_standard_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in page_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        p = Words()
        p.feed(r.html)
        p.close()
        bare = lambda s: re.sub(r"^- |\s+", "", s, flags=re.M)
        assert bare(got[r.page_id]) == bare("".join(p.out))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>One<p>Two <b>b</b>  x<br>y<div>z", "One\n\nTwo b x\ny\n\nz"),
        ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>t", "- a\n- b\n  3. c\n  4. d\n- e\n\nt"),
        ("<table><tr><th>Name<th>n<tr><td>pears<td>3<tr><td colspan=2>a spanning cell</table>", "Name   n\npears  3\na spanning cell"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>", "a  b\n   c  d"),
        ("a<script>x</script><style>.h{display:none}</style><i class='h'>no</i><i hidden>no</i><b style='display: none'>no</b>b", "ab"),
        ("<div style='visibility:hidden'>no<i style='visibility:visible'>yes</i></div>", "yes"),
        ("<pre>  a\n   b</pre>", "  a\n   b"),
        ("<details><summary>s</summary>no</details><details open>yes</details>", "s\nyes"),
        ("&lt;b&gt; &amp;nbsp x&nbsp;y <", "<b> &nbsp x y <"),
        ("<dl><dt>t<dd>d</dl><blockquote>q</blockquote>", "t\n  d\n\n  q"),
        ("<!-- <p>no --><![CDATA[no]]>yes</p></div>", "yes"),
        ("<p title='a > b'>x</p", "x"),
        ("<textarea> a\n b</textarea><title>no</title>", " a\n b"),
        ("", ""),
        ("plain  text", "plain text"),
    ],
)
def test_layout(html, text):
    assert visible_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<table><tr><td width=\"10\"\">Visible text</td></table><p>rest of page", "Visible text\n\nrest of page"),
        ("<a href=/it's>link</a><p>rest", "link\n\nrest"),
        ("<a it's>link</a> <b x=a=\"b>c</b> <i =\"d>e</i>", "link c e"),
        ("<p title = 'a > b' alt=\">\">x", "x"),
        ("<i style=\"display:none\"class='x'>no</i>yes", "yes"),
        ("<style>@media print { .p { display:none } } @media (max-width: 9px) { .p, b { display:none } } .h{display:none}</style><i class=p>yes</i><b>b</b><i class=h>no</i>", "yesb"),
        ("<style>@media screen { .p { color: red; display:none } } @import 'x;y{'; .q{content:'}'; display: none}</style><i class=p>no</i><i class=q>no</i>yes", "yes"),
        ("<style media=print>.p{display:none}</style><style>.a{display:none} .i{display:none!important}</style><style>.a,.i{display:block}</style><i class=p>p</i><i class=a>a</i><i class=i>no</i>", "pa"),
        ("x <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> <svg><title>no</title><desc>no</desc><path/><g>no<text>yes</text></g></svg> z", "x a=2 yes z"),
    ],
)
def test_malformed_tags_and_style_sheets(html, text):
    assert visible_text(html) == text


def test_deep_and_odd_pages(spark):
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<ul><li>" * 300 + "x").strip().endswith("x")
    rows = [(1, None), (2, ""), (2, ""), (None, "<p>a")]
    got = page_text(spark.createDataFrame([(*r, "no") for r in rows], "page_id long, html string, HTML string")).collect()
    assert sorted((r.text for r in got)) == ["", "", "", "a"]


# all queries -----------------------------------------------------------------
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sf_dir, name):
    folder = f"{sf_dir}/../sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = QUERIES[name](spark, folder)
    names = sorted(found.columns)
    result = con.sql(ORACLES[name])
    assert sorted(result.columns) == names
    order = [result.columns.index(c) for c in names]
    assert sorted(tuple(r[c] for c in names) for r in found.collect()) == sorted(tuple(r[i] for i in order) for r in result.fetchall())
