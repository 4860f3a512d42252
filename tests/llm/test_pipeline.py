"""The pipeline against its stages done by brute force, and the subpackage's removal."""

import os
import shutil
import subprocess
import sys

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from campaignlake.llm import packing, quality_rules

from .test_decontaminate import brute
from .test_packing import check
from .test_simhash_dedup import plain_components, plain_fingerprint
from .util import SF, empty_documents, odd_documents

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_pipeline_equals_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {}
    for r in sorted(source.collect(), key=lambda r: r["doc_id"]):
        j = quality_rules.judge(r["text"], quality_rules.Limits())
        if j["kept"]:
            rows[r["doc_id"]] = j["cleaned"]
    kept = corpus_pipeline.quality(spark, source, SF)
    assert kept.columns == source.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == rows
    known = corpus_pipeline.language(spark, kept, SF)
    assert known.columns == source.columns and known.count() == len(rows)  # clean documents stay
    ids = list(rows)
    roots = plain_components([plain_fingerprint(rows[i]) for i in ids], 2)
    rows = {ids[r]: rows[ids[r]] for r in set(roots)}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {d for d, _ in brute(list(rows.items()), bench)}
    rows = {d: t for d, t in rows.items() if d not in dirty}
    want = spark.createDataFrame(sorted(rows.items()), "doc_id long, text string")
    out = corpus_pipeline.run(spark, SF)
    check(want, out, corpus_pipeline.SEQUENCE_TOKENS)
    # The result alone holds the texts: its ids, sequence by sequence, decode to them.
    encoder = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    parts = {}
    for r in out.collect():
        assert len(r["ids"]) == r["length"]
        parts.setdefault(r["doc_id"], {})[r["piece"]] = r["ids"]
    for d, text in rows.items():
        ids = [i for _, piece in sorted(parts[d].items()) for i in piece]
        assert ids[-1] == 0 and encoder.decode(ids[:-1], skip_special_tokens=False) == text
    whole = packing.sequences(out).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(len(i) for p in parts.values() for i in p.values())


def test_stages_on_an_empty_table(spark):
    docs = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_stages_on_odd_documents(spark):
    """Nulls, repeated rows, very long texts and extra columns pass through every filtering stage."""
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert len(rows) <= docs.count()
        if name == "benchmark_decontamination":
            assert len(rows) == docs.count()  # clean documents, whatever else they are
    assert corpus_pipeline.pack(spark, docs, SF).where("piece = 0").count() == docs.count()


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and e.oracle_sql(); print(*q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": ""}).stdout.split()
    assert "month_report" in out and "pipeline" not in out and not any(n.startswith("op") for n in out)
