"""Shared shingles, rows without an id and the last round's pairs of the n-gram join."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from costloom.llm import ngram_join as nj
from tests.llm.test_llm import docs_frame

WORDS = [f"w{i}" for i in range(61)]


def changed(k):
    return " ".join([*WORDS[:k], f"other{k}", *WORDS[k + 1:]])


def test_a_row_without_an_id_links_like_any_other(spark):
    rows = [(1, changed(0)), (5, changed(60)), (None, " ".join(WORDS)), (9, "nothing like them at all"), (None, "alone and without an id")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.group_documents(docs_frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 58, 1), (5, 58, 1), (None, 58, 1), (9, 2, 9), (None, 2, None)], key=str)
    # the row without an id alone ties two others together, which do not link themselves
    far = [(1, changed(2)), (5, changed(58)), (None, " ".join(WORDS))]
    params = nj.JoinParams(percent=87)
    assert {r["component_id"] for r in nj.group_documents(docs_frame(spark, far), params).collect()} == {1}
    assert {r["component_id"] for r in nj.group_documents(docs_frame(spark, far[:2]), params).collect()} == {1, 5}


def test_shared_shingles_with_one_in_a_third_of_all_nodes(spark):
    rows = [(7, i) for i in range(900)] + [(10_000 + i, i % 2400) for i in range(1800)] + [(20_000 + i % 50, i) for i in range(60)] + [(5, 3), (5, 3)]
    held = spark.createDataFrame(rows, "gram long, node long").repartition(6)
    many = {r["gram"] for r in held.groupBy("gram").agg(F.count_distinct("node").alias("n")).where("n > 1").collect()}
    for params in (nj.JoinParams(), nj.JoinParams(pending=10)):
        assert [r[0] for r in nj.shared_grams(held, params).orderBy("gram").collect()] == sorted(many)
    assert 7 in many and 5 not in many and len(many) == 11


def test_the_last_round_makes_no_pair_within_a_component(spark):
    """A linked group of 3,000 and one outsider share a shingle: rows looked at are as many as the group."""
    n = 3000
    lists = spark.range(n).select(F.lit(7).cast("long").alias("gram"), F.col("id").alias("a"), F.lit(9).alias("a_n"), F.lit(0).alias("a_pos"), F.lit(0).cast("long").alias("a_root"))
    lists = lists.unionByName(lists.limit(1).withColumns({"a": F.lit(n).cast("long"), "a_root": F.lit(n).cast("long")}))
    met = nj.meet_others(lists, "a_root")
    assert met.count() == n
    pairs = met.join(lists.toDF("gram", "b", "b_n", "b_pos", "b_root"), ["gram", "b_root"])
    assert pairs.count() == n and pairs.where("a_root = b_root").count() == 0
    many = lists.withColumn("a_root", F.col("a") % 40)  # forty components: each pair of rows once
    met = nj.meet_others(many, "a_root").join(many.toDF("gram", "b", "b_n", "b_pos", "b_root"), ["gram", "b_root"])
    sizes = [r[0] for r in many.groupBy("a_root").count().select("count").collect()]
    assert met.count() == (sum(sizes) ** 2 - sum(x * x for x in sizes)) // 2


def test_big_group_of_near_copies_and_outsiders(spark):
    """Near copies, of which every two differ in one word, are one group; a text that shares only
    their beginning stays out."""
    base = [f"b{i}" for i in range(120)]
    rng = random.Random(8)
    rows = []
    for i in range(700):
        words = list(base)
        words[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows.append((5000, " ".join(base[:40] + [f"z{i}" for i in range(80)])))
    got = {r["doc_id"]: r["component_id"] for r in nj.group_documents(docs_frame(spark, rows).repartition(5)).collect()}
    assert got.pop(5000) == 5000
    assert set(got.values()) == {0}


def test_shingler_holds_little_whatever_the_block(monkeypatch):
    """Hashes do not depend on the block, and what a task holds besides its texts and their hashes is small."""
    rng = random.Random(11)
    texts = [" ".join(f"W{rng.randrange(50_000)}" for _ in range(300)).encode() for _ in range(900)]
    texts += [b"", b" \t ", b"x" * 200_000, b"a b", "Ä 　 b c d".encode()]
    tracemalloc.start()
    got = nj.Shingler(4)(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28e6
    for block in (1 << 9, 1 << 20):
        monkeypatch.setattr(nj, "_BLOCK", block)
        assert all(np.array_equal(x, y) for x, y in zip(got, nj.Shingler(4)(texts), strict=True))


def test_a_task_holds_the_sets_of_half_a_megabyte_at_once():
    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, f, _):
            return f

    texts = [" ".join(f"w{k}x{i}" for i in range(900)) for k in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = list(nj.survey(Docs(), nj.JoinParams())(iter([batch])))
    assert sum(len(t) for t in texts) > 4 << 20 and sum(b.num_rows for b in out[:-1]) == 600
    assert max(b.num_rows for b in out[:-1]) * min(map(len, texts)) <= 1 << 20
    counted = np.frombuffer(b"".join(out[-1].column("vector").to_pylist()), "<i8")
    assert counted.sum() == sum(out[i].column("n").to_numpy().sum() for i in range(len(out) - 1)) == 600 * 897
