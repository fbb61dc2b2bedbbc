"""Language identification by mixture inference.

A language is a distribution of byte trigrams (letters, lower-cased where ASCII; the
rest is blank), hashed to 2^16 cells and counted over every labelled training text.
A document's language proportions come from expectation-maximisation over its
trigrams; then the languages of largest proportion are added one by one while the
likelihood, less a penalty per language, grows. The prediction is the language of
largest proportion in that set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import buffers, filter_rows, map_arrow, pick, pieces

CELLS = 1 << 16
#: Pseudo-count of a cell, and steps of each expectation-maximisation.
PRIOR, STEPS = 0.5, 8
#: Each further language must raise the log-likelihood by so many times half the log of the trigrams; they overlap threefold.
PENALTY = 6.0
#: More labels than this are no languages: the model's size is bounded by MAX_LANGUAGES * CELLS.
MAX_LANGUAGES = 1000
UNKNOWN = "und"
_letter = re.compile(r"[^\W\d_]")
_plain = np.full(256, 32, np.uint8)
_plain[97:123] = np.arange(97, 123)
_plain[65:91] = np.arange(97, 123)
_plain[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and text number of every trigram with at most one blank at its ends."""
    if len(data) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    b = _plain[data].astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    whole = (b[1:-1] != 32) & ((b[:-2] != 32) | (b[2:] != 32))
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint32), np.diff(offsets))
    whole &= owner[:-2] == owner[2:]
    return (code[whole] * np.uint32(0x9E3779B1)) >> np.uint32(16), owner[:-2][whole]


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        share = counts + PRIOR
        self.p = (share / share.sum(axis=1, keepdims=True)).astype(np.float32) if languages else share

    def mixtures(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: its best language's number, all proportions, and the chosen set (booleans)."""
        n, k = len(offsets) - 1, len(self.languages)
        cells, owner = trigrams(data, offsets)
        keys, counts = _counted((owner << np.uint32(16)) | cells)
        owner, cells = (keys >> np.uint32(16)).astype(np.int64), (keys & np.uint32(0xFFFF)).astype(np.int64)
        theta = np.full((k, n), 1 / k)
        found, starts = np.unique(owner, return_index=True)
        chosen = np.zeros((k, n), bool)
        if not len(found):
            chosen[0] = True
            return np.zeros(n, np.int64), theta, chosen
        p, counts = self.p[:, cells], counts.astype(np.float32)
        single = np.add.reduceat(np.log(p) * counts, starts, axis=1)
        sizes = np.add.reduceat(counts, starts)
        local = np.repeat(np.arange(len(found)), np.diff(np.append(starts, len(owner))))
        full, _ = _em(p, counts, local, starts, sizes, np.ones((k, len(found)), bool))
        order = np.argsort(-full, axis=0, kind="stable")
        best = single.argmax(axis=0)
        member = np.zeros((k, len(found)), bool)
        member[best, np.arange(len(found))] = True
        level, share = single.max(axis=0), member.astype(np.float64)
        live, size = np.arange(len(found)), 2
        while size <= k and len(live):
            trial = np.zeros((k, len(live)), bool)
            for r in range(size):
                trial[order[r, live], np.arange(len(live))] = True
            ends = np.append(starts, len(owner))
            rows = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in live]) if len(live) < len(found) else slice(None)
            lengths = (ends[1:] - ends[:-1])[live]
            cut = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            theta_k, ll = _em(p[:, rows], counts[rows], np.repeat(np.arange(len(live)), lengths), cut, sizes[live], trial)
            better = ll - level[live] > PENALTY * 0.5 * np.log(np.maximum(sizes[live], 2))
            up = live[better]
            member[:, up], share[:, up], level[up] = trial[:, better], theta_k[:, better], ll[better]
            live, size = up, size + 1
        top = np.zeros(n, np.int64)
        top[found] = share.argmax(axis=0)
        theta[:, found], chosen[:, found] = full, member
        return top, theta, chosen


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _em(p, counts, owner, starts, sizes, allowed) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages per text, and the log-likelihood under them."""
    theta = (allowed / allowed.sum(axis=0)).astype(np.float32)
    for _ in range(STEPS):
        w = p * theta[:, owner]
        w *= counts / w.sum(axis=0)
        theta = (np.add.reduceat(w, starts, axis=1) / sizes).astype(np.float32)
    ll = np.add.reduceat(np.log((p * theta[:, owner]).sum(axis=0)) * counts, starts)
    return theta.astype(np.float64), ll


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4; documents with 2 are held out of learning."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def fit(docs: DataFrame) -> Model:
    """Trigram counts of every labelled text that is not held out; text and lang are all that is read.

    Rows with a null lang, text or doc_id teach nothing. Counts are summed in each
    task before they are shuffled; what reaches the driver is bounded by
    MAX_LANGUAGES * CELLS numbers.
    """
    rows = pick(docs, "doc_id", "lang", "text").where("lang is not null and text is not null and doc_id is not null")
    rows = rows.where(remainder(F.col("doc_id")) != 2).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, table in sums.items():
                cells = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(table[cells])], schema=schema)
            sums.clear()

        for batch in batches:
            for a, b in pieces(batch.column("text")):
                langs = batch.column("lang").slice(a, b - a).dictionary_encode()
                cells, owner = trigrams(*buffers(batch.column("text").slice(a, b - a)))
                number = langs.indices.to_numpy()[owner]
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    if lang not in sums:
                        sums[lang] = np.zeros(CELLS, np.int64)
                    sums[lang] += np.bincount(cells[number == i], minlength=CELLS)
                if len(sums) > 64:
                    yield from flush()
        yield from flush()

    sums = map_arrow(rows, run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    per_lang = sums.groupBy("lang").agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("ns"))
    found = sorted(per_lang.limit(MAX_LANGUAGES + 1).toLocalIterator(), key=lambda r: r.lang)
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: lang is no language column")
    counts = np.zeros((len(found), CELLS))
    for i, r in enumerate(found):
        counts[i, r.cells] = r.ns
    return Model([r.lang for r in found], counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (its proportion), languages (the chosen set) of every row.

    A null text or one without a letter is ``und`` with score 0, and so is every
    text if the model has no language. Every row is judged by its text alone; a null
    doc_id is not held out; other columns are not read.
    """
    own = pick(docs, "doc_id", "text")
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    rows = own.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                part = batch.slice(a, b - a)
                langs, scores, sets = judged(sent, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string()))], schema=schema)

    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")


def judged(sent: Broadcast, column: pa.Array) -> tuple[list[str], list[float], list[list[str]]]:
    model: Model = sent.value
    langs, scores, sets = [], [], []
    for a in range(0, len(column), 50_000):  # text numbers have 16 bits
        part = column.slice(a, 50_000)
        if model.languages:
            top, theta, chosen = model.mixtures(*buffers(part))
        for i, text in enumerate(part.to_pylist()):
            known = bool(model.languages) and _letter.search(text) is not None
            langs.append(model.languages[top[i]] if known else UNKNOWN)
            scores.append(float(min(1.0, max(0.0, theta[top[i], i]))) if known else 0.0)
            sets.append([x for x, c in zip(model.languages, chosen[:, i]) if c] if known else [])
    return langs, scores, sets


def keep_languages(docs: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """The documents with a known language, or with one of ``languages``; all columns stay as they are.

    The model is learned from the documents themselves as in ``fit``. If nothing is
    labelled, every document is kept.
    """
    model = fit(docs)
    if not model.languages:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    wanted = frozenset(model.languages if languages is None else languages)
    return filter_rows(docs, partial(_wanted, sent, wanted))


def _wanted(sent: Broadcast, wanted: frozenset[str], column: pa.Array) -> np.ndarray:
    return np.array([x in wanted for x in judged(sent, column)[0]], bool)
