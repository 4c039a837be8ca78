"""Every stage of the corpus pipeline on edge rows and on an empty table."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

ROWS = [(1, None, "en", "s", 0, "more"), (2, "", "en", "s", 0, "more"), (3, "some plain words that repeat nothing at all here", None, None, None, "more"),
        (3, "some plain words that repeat nothing at all here", None, None, None, "more"), (None, "no id but other words than those of the rows above", "de", "t", 5, "more"),
        (5, " ".join(f"long{i}" for i in range(30_000)), "en", "s", 9, "more")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """An input folder of edge rows without labels or benchmark items."""
    d = str(tmp_path_factory.mktemp("edges"))
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name, stage", cp.STAGES, ids=[n for n, _ in cp.STAGES])
def test_stage_on_edge_rows_and_an_empty_table(spark, tables, name, stage):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = stage(spark, docs, tables)
    last = name == cp.STAGES[-1][0]
    assert last or out.columns == list(cp.COLUMNS)
    rows = out.collect()
    copies = name == "near duplicates"          # the repeated row goes, all else stays
    assert len(rows) == len(ROWS) - copies       # without labels the classifier rejects none
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, *_ in (dict.fromkeys(ROWS) if copies else ROWS))
    if last:
        assert {r["doc_id"]: r["n_tokens"] for r in rows}[5] > 30_000 and all(r["round_trip"] for r in rows if r["doc_id"] not in (1, 2))
    empty = stage(spark, docs.where(F.lit(False)), tables)
    assert empty.count() == 0 and empty.columns == out.columns


def test_run_on_edge_rows(spark, tables):
    assert os.path.isdir(f"{tables}/documents.parquet")
    out = cp.run(spark, tables).collect()
    assert len(out) == len(ROWS) - 1 and all("ids" in r.asDict() for r in out)
