"""Byte-level BPE against the tokenizers library, against plain merging, and on edge rows."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import numpy as np
import pytest
from tokenizers import Tokenizer

from costloom.llm import bpe
from costloom.llm import queries as Q
from tests.llm.test_llm import EDGE, SF, docs_frame

PATH = "/opt/tokenizers/byte_bpe_50k.json"
ODD = ["", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext", "I'M don't 'tis we'll'll", " " * 40 + "b", "\t\t x\r\n\n y ",
       "日本語 テスト ٣٤ Ⅷ", "\U0001f600‍\U0001f600", "՘՘a \U0003d000x", "á \x00\x1f\x85\xa0", "x" * 5000 + "é" * 300, "�"]


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def merged_plainly(symbols, merges):
    """The best pair anywhere, one at a time."""
    while True:
        found = [(merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in merges]
        if not found:
            return symbols
        _, i = min(found)
        symbols = [*symbols[:i], merges[symbols[i], symbols[i + 1]][1], *symbols[i + 2:]]


def test_ids_and_text_equal_the_library(spark, model, library):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + EDGE
    got = bpe.decode(bpe.encode(docs_frame(spark, rows), model, decoded=True), model, into="again").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got if r["doc_id"] is not None) == sorted((False, i) for i, _ in rows if i is not None)
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert r["ids"] == ids, r["doc_id"]
        assert r["decoded"] == r["again"] == library.decode(ids, skip_special_tokens=False) == r["text"]


def test_added_tokens_as_ordinary_text(spark, model):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    for r in bpe.encode(docs_frame(spark, list(enumerate(ODD))), model, whole=True).collect():
        assert r["ids"] == plain.encode(r["text"], add_special_tokens=False).ids


def test_words_split_alike_for_every_letter(model, library):
    e = bpe.Encoder(model)
    some = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000
            and (c < 0x3400 or c % 97 == 0 or (unicodedata.category(chr(c))[0] in "LNZ" and c % 7 == 0) or any(abs(c - x) < 2 for r in bpe.YOUNGER for x in r))]
    for c in some:
        t = f"a{chr(c)}b 1{chr(c)}1 {chr(c)}{chr(c)}.{chr(c)} "
        assert e.pieces(t) == [t[a:z] for _, (a, z) in library.pre_tokenizer.pre_tokenize_str(t)], hex(c)


def test_queue_equals_plain_merging():
    rng = random.Random(5)
    for _ in range(300):
        merges, top = {}, 4
        for rank in range(rng.randrange(1, 25)):
            pair = (rng.randrange(top), rng.randrange(top))
            if pair not in merges:
                merges[pair] = (rank, top)
                top += 1
        word = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
        assert bpe.merge(list(word), merges) == merged_plainly(list(word), merges)


def test_a_long_word_takes_no_square_time(model):
    word = "".join(random.Random(1).choice("abcdefgh") for _ in range(100_000))
    ids = np.frombuffer(bpe.Encoder(model)(word), "<u4").tolist()
    assert bpe.decode_ids(ids, model.spelling) == word


def test_forgetting_words_changes_nothing(model):
    e, few = bpe.Encoder(model), bpe.Encoder(model, remember=3)
    for t in ["one two three four five", "six seven one two", "one eight nine ten eleven"]:
        assert e(t) == few(t)


def test_broken_bytes_and_null_ids(spark, model):
    rows = spark.createDataFrame([(1, [model.single[0xE3], model.single[0x81]]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, model).collect()}
    assert got == {1: "�", 2: "", 3: ""}


def test_query_digests(spark, library):
    got = {r["doc_id"]: r for r in Q.queries()["op11_bpe"](spark, SF).collect()}
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = got[doc_id]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark, model):
    out = bpe.encode(docs_frame(spark, []), model, then=bpe.DIGESTS, decoded=True)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0
