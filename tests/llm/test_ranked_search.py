"""Dual-tree search against scores of every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from costloom.llm import queries as Q
from costloom.llm import ranked_search as rs
from tests.llm.test_llm import EDGE, SF, docs_frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    big_n, big_l = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in held:
            m = 50 + 50 * sum(c.values()) * big_n // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(split(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k + 1, doc_id, -s) for k, (s, _, _, doc_id) in enumerate(sorted(scores, key=lambda r: r[:3])[:top])]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=key)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "item_id long, text string, score string, rank int")


def test_terms_follow_the_rule():
    for t in ["A-b_C9é\x7fÀ ÀÉx", "\x00a\x1fb", "日本 x/y@z[q]{r}~", "", "...", "Ünï code"]:
        assert [w.decode() for w in rs.terms(t.encode())] == split(t)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(Q.queries()["op13_search"](spark, SF)) == sorted(brute(docs, items), key=key)


@pytest.mark.parametrize("seed", range(4))
def test_small_trees_rounds_blocks_and_ties(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]

    def text(n):
        return " ".join(rng.choice(words[:rng.choice([6, 20, 60])]) for _ in range(n))

    docs = [(rng.randrange(200), text(rng.randrange(0, 40))) for _ in range(300)]
    docs += [(1000 + i, docs[0][1]) for i in range(150)] + [(7, docs[3][1])] * 20 + [(None, docs[5][1])] * 3 + EDGE
    items = [(i, text(rng.randrange(0, 12))) for i in range(30)] + [(3, docs[0][1]), (None, "w1 w2"), (99, None), (100, "nowhere")]
    params = rs.SearchParams(top=7, item_leaf=3, doc_leaf=4, fan=2, chunk=64, block_terms=[10**6, 90, 1, 10**6][seed], share=3, least_round=20, cells=[4_000_000, 50, 4_000_000, 7][seed])
    got = found(rs.search(docs_frame(spark, docs).repartition(3), items_frame(spark, items), params))
    assert got == sorted(brute(docs, items, 7), key=key)


def test_most_pairs_are_never_scored():
    """Items and documents of twenty subjects: a document is scored for few items of others."""
    rng = np.random.default_rng(3)
    n_terms, subjects = 2000, 20
    common = np.arange(50)

    def member(subject, n):
        own = rng.choice(np.arange(100 + subject * 90, 190 + subject * 90), n, replace=False)
        return np.unique(np.concatenate([own, rng.choice(common, 5)]))

    items = [member(i % subjects, 10) for i in range(200)]
    bases = [member(int(rng.integers(subjects)), int(rng.integers(5, 40))) for _ in range(250)]
    docs = [np.setdiff1d(bases[int(rng.integers(250))], rng.choice(n_terms, 2)) for _ in range(4000)]
    df = np.bincount(np.concatenate(docs), minlength=n_terms)
    weight = np.floor(1000 * np.log((2 * len(docs) + 2) / (2 * df + 1))).astype(np.int64)
    params = rs.SearchParams(top=5)
    tree = rs.ItemTree(items, n_terms, df, params)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    term = np.concatenate(docs)
    value = np.full(len(term), 500, np.int64)
    ids = np.arange(len(docs))
    full = np.zeros((len(docs), len(items)), np.int64)
    for j, r in enumerate(tree.rows):
        full[:, j] = np.bincount(doc, np.isin(term, items[r]) * value * weight[term], len(docs)).astype(np.int64)
    best = rs.Best(tree.n, 5, np.sort(full, 0)[-5])
    scored = rs.search_chunk(tree, best, weight, ids, np.zeros(len(ids), bool), doc, term, value, params)
    assert scored < 0.3 * (full > 0).sum()
    for j in range(tree.n):
        want = sorted(range(len(docs)), key=lambda d: (-full[d, j], d))[:5]
        rows = best.rows[best.rows["item"] == j]
        assert rows["doc_id"].tolist() == want and rows["score"].tolist() == full[want, j].tolist()


def test_empty_tables(spark):
    some, none = docs_frame(spark, [(1, "a b")]), docs_frame(spark, [])
    items, no_items = items_frame(spark, [(1, "a")]), items_frame(spark, [])
    for d, i in ((none, items), (some, no_items), (none, no_items), (docs_frame(spark, [(1, None), (2, " .")]), items)):
        out = rs.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
