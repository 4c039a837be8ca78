"""Token alignment against a plain count over byte ranges."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from costloom.llm import alignment as al
from costloom.llm import bpe
from costloom.llm import queries as Q
from tests.llm.test_llm import EDGE, SF, docs_frame

A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
ODD = ["▁a▁b", "<|endoftext|> <s> </s> <0x0A> <unk>", "  two  spaces ", "\n\n\tx", "日本語 テスト", "\U0001f600‍\U0001f600 aaaa aaaaaaaaa", "AAAAAA", "\x00nul", " ", "a" * 3000]
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(docs):
    ta, sp = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    ta.encode_special_tokens = True
    letters, vocab = bpe.byte_letters(), {i: t for t, i in ta.get_vocab().items()}

    def b_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    rows, pairs = [], Counter()
    for doc_id, text in docs:
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        sa, sb = [bytes(letters[c] for c in vocab[i]) for i in a], [b_bytes(i) for i in b]
        if not text or not b"".join(sa) == b"".join(sb) == (" " + text).encode():
            rows.append((doc_id, [], [], [], []))
            continue
        ends = [[sum(map(len, s[:k + 1])) for k in range(len(s))] for s in (sa, sb)] if len(a) < 400 else None
        if ends is None:
            ends = []
            for s in (sa, sb):
                at, out = 0, []
                for x in s:
                    at += len(x)
                    out.append(at)
                ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links, i = [], 0
        for j in range(len(b)):
            start, end = ends[1][j] - len(sb[j]), ends[1][j]
            while i < len(a) and ends[0][i] <= start:
                i += 1
            k = i
            while k < len(a) and ends[0][k] - len(sa[k]) < end:
                links.append((a[k], b[j]))
                k += 1
        pairs.update(links)
        rows.append((doc_id, list(zip(a, ends[0])), list(zip(b, ends[1])), cuts, links))
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, a, b, cuts, links in rows:
        lo, groups = 0, []
        ai = bi = 0
        for c in cuts:
            ga, gb = [], []
            while ai < len(a) and a[ai][1] <= c:
                ga.append(str(a[ai][0]))
                ai += 1
            while bi < len(b) and b[bi][1] <= c:
                gb.append(str(b[bi][0]))
                bi += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        out.append((doc_id, len(a), len(b), len(cuts), len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return out


def rows_of(df):
    return sorted((tuple(r[c] for c in NAMES) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.fixture(scope="module")
def models():
    return al.load(A_PATH, B_PATH)


@pytest.fixture(scope="module")
def mixed(spark):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    return real + [(10_000 + i, t) for i, t in enumerate(ODD)] + EDGE


def test_edge_rows_equal_brute_force(spark, models, mixed):
    got = rows_of(al.digest(docs_frame(spark, mixed).repartition(3), models))
    assert got == order(brute(mixed))
    assert {r[0]: r[1] for r in got}[10_000] == 0


@pytest.mark.parametrize("most", [0, 40])
def test_pairs_beyond_the_broadcast(spark, models, mixed, most):
    assert rows_of(al.digest(docs_frame(spark, mixed), models, broadcast_pairs=most)) == order(brute(mixed))


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(Q.queries()["op12_align"](spark, SF)) == order(brute(docs))


def test_groups_hold_the_same_bytes(spark, models, mixed):
    for r in al.align(docs_frame(spark, mixed), models).collect():
        a, b = iter(r["a_ids"]), iter(r["b_ids"])
        assert len(r["a_counts"]) == len(r["b_counts"]) and sum(r["a_counts"]) == len(r["a_ids"]) and sum(r["b_counts"]) == len(r["b_ids"])
        for x, y in zip(r["a_counts"], r["b_counts"]):
            assert b"".join(models.a.spelling[next(a)] for _ in range(x)) == b"".join(models.b_spelling[next(b)] for _ in range(y))


def test_counting_in_small_parts_changes_nothing(spark, models, mixed):
    linked = al.materialize(al.align(docs_frame(spark, mixed), models, (al._link_batches, al.LINKS)), "t")

    def total(**more):
        return {r[0]: r[1] for r in al.count_links(linked, models, **more).where("key is not null").groupBy("key").sum("n").collect()}

    assert total() == total(pending=5)


def test_empty_table(spark, models):
    out = al.digest(docs_frame(spark, []), models)
    assert out.columns == NAMES and out.count() == 0
    assert rows_of(al.digest(docs_frame(spark, [(1, None), (2, "")]), models)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
