"""Quality rules as a ledger of bits, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule; a policy is a version with a mask of rules, and its verdict and
its ablations come from the bits alone, without reading a text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import texts

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a window that is looked for twice in a text.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A failing condition over the measurements; its place in RULES is its bit."""

    name: str
    fails: str


#: Bits are never given to another rule; new rules are added at the end.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule("few_letters", "100 * n_letters < 30 * word_chars"),
    Rule("shouting", "100 * n_upper > 60 * n_letters"),
)
BASE = ("few_words", "repeated_words")
#: Versions of policies: the rules that drop a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "short_words", "long_words", "repeated_lines", "few_letters"),
    "v2": tuple(r.name for r in RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    names = [r.name for r in RULES]
    return sum(1 << names.index(n) for n in rules)


def measured(df: DataFrame) -> DataFrame:
    """Adds the measurements of ``text``; an empty text has zeros."""
    text = F.col("text")
    df = df.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    df = df.withColumn("hashes", F.when(F.col("n_words") >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("windows", _windows(F.col("hashes")))
    # most texts repeat no window; only the others sort theirs
    repeats = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(_covered(F.col("windows")))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    df = df.withColumn("lines", lines)
    return df.withColumns({
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": repeats.cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long"),
        "n_upper": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
    }).drop("words", "hashes", "windows", "lines")


def _windows(h: Column) -> Column:
    """A hash of each WINDOW consecutive word hashes."""
    one = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)])
    return F.when(F.size(h) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), one)).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Number of words inside a window that occurs at least twice.

    Windows are sorted by hash, equal neighbours are repeats; their places are
    sorted again and the lengths up to the next place, WINDOW at most, add up.
    """
    by_hash = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def places(s: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(s, i)["w"] == F.get(s, j)["w"], F.lit(False))
        found = F.filter(F.transform(s, lambda x, k: F.when(same(k, k - 1) | same(k, k + 1), x["i"])), lambda x: x.isNotNull())
        return F.array_sort(found)

    def total(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, x: F.struct((a["n"] + x + WINDOW - F.greatest(a["end"], x)).alias("n"), (x + WINDOW).alias("end")), lambda a: a["n"])

    named = lambda column, f: F.get(F.transform(F.array(column), f), F.lit(0))  # noqa: E731  computed once, used by name
    return named(named(by_hash, places), total)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed``, the bits of the rules that a row fails.

    A null text counts as empty. Every row is judged by itself; repeated rows stay,
    other columns are not read, an empty table gives no rows.
    """
    df = measured(texts(docs)).drop("text")
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return df.withColumn("failed", failed.cast("long"))


def judge(book: DataFrame, version: str) -> DataFrame:
    """The ledger with ``kept`` by a policy: no bit of its mask is set."""
    return book.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablations(book: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    Documents are counted by their bits first, so at most 2^rules rows follow.
    """
    whole = mask(POLICIES[version])
    counts = book.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if whole >> i & 1])
    each = counts.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    some = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).alias
    return each.groupBy("rule").agg(
        some(F.col("bits").bitwiseAND(F.col("bit")) != 0)("n_failed"),
        some(F.col("bits") == F.col("bit"))("n_only"),
        some((F.col("bits") == 0) | (F.col("bits") == F.col("bit")))("n_kept_without"),
    )
