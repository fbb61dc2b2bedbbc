"""The pipeline's stages follow each other; the entry does without them."""

import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
from test_near import brute
from tokenizers import Tokenizer

from labelmill.llm.decontaminate import contamination
from labelmill.llm.near_dedup import near_duplicates
from labelmill.llm.oracles import ORACLES

ROOT = Path(corpus_pipeline.__file__).resolve().parent


def test_stages_keep_columns_and_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, counts = docs, []
    for i, (name, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, before, sf_dir).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(after.count())
        if i < 4:
            assert after.columns == docs.columns and after.schema == docs.schema, name
        if name == "near":
            assert near_duplicates(after).where("not kept").isEmpty()
            gone = near_duplicates(before).where("not kept").select("doc_id")
            assert after.join(gone, "doc_id", "left_semi").isEmpty() and gone.count() == before.count() - after.count()
        if name == "decontaminate":
            hits = contamination(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("size(ranges) > 0")
            assert after.join(hits, "doc_id", "left_semi").isEmpty() and hits.count() == before.count() - after.count()
        if name == "packing":
            assert after.select("doc_id").distinct().count() == before.count()
        before = after
    assert counts[0] == counts[1] > counts[2] > counts[3]
    assert corpus_pipeline.run(spark, sf_dir).count() == counts[4]


def test_result_equals_plain_stages(spark, sf_dir):
    """The pipeline's rows against each stage done by other means: SQL twins, all pairs, the tokenizers library."""
    small = f"{sf_dir}/../sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = {i: t for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{small}/benchmark.parquet'")

    def sql(name):
        con.execute("CREATE OR REPLACE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", list(rows.items()))
        found = con.sql(ORACLES[name])
        return [dict(zip(found.columns, r)) for r in found.fetchall()]

    rows = {r["doc_id"]: r["text"] for r in sql("op9_line_dedup")}
    rows = {i: rows[i] for i, n, comp in brute(sorted(rows.items()), 5, 80) if not n or i == comp}
    hit = {r["doc_id"] for r in sql("op5_decontamination") if r["contaminated"]}
    rows = {i: t for i, t in rows.items() if i not in hit}
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in rows.items()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, small).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == expected.keys()
    for i, ids in expected.items():
        at = 0
        for start, length, crc, total in sorted(pieces[i]):
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    for spans in windows.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 1024


def test_odd_rows_pass_every_stage(spark, sf_dir, odd, nothing):
    for docs in (odd, nothing):
        for _, work in corpus_pipeline.STAGES[:-1]:
            assert work(spark, docs, sf_dir).columns == odd.columns
            work(spark, docs, sf_dir).count()


def test_entry_lists_queries_without_the_subpackage(tmp_path):
    for part in ("labelmill/operators", "labelmill/plans", "labelmill/functions", "labelmill/sources"):
        (tmp_path / part).mkdir(parents=True)
        for f in (ROOT / part).glob("*.py"):
            (tmp_path / part / f.name).write_text(f.read_text())
    for f in ("labelmill/__init__.py", "labelmill/storage.py", "__spark_entry__.py"):
        (tmp_path / f).write_text((ROOT / f).read_text())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q)); e.oracle_sql()"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert out.stdout.strip().endswith("False")
