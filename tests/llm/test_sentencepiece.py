"""The unit table of the sentencepiece operator: bounded groups, whole look-ups, plain memory."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from costloom.llm import sentencepiece
from costloom.llm.common import pack_table
from tests.llm.test_llm import docs_frame


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.load_model("/opt/tokenizers/piece_bpe_32k.model")


def mixed_texts() -> list[str | None]:
    draw = random.Random(5)
    words = ["the", "Über", "naïve", "x9_", "▁", "日本語", "tab\t", "end\n\n", " " * 20, "🙂", "a" * 300, "\x00", "l'été"]
    return [None, "", " ", *[" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(40)]]


@pytest.mark.parametrize("bound", [8_000_000, 7, 0])
def test_ids_and_decoded_texts_equal_the_library(spark, pieces, bound):
    import sentencepiece as library
    sp = library.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    texts = mixed_texts()
    got = sentencepiece.encode(docs_frame(spark, list(enumerate(texts))), pieces, broadcast_units=bound, decoded=True).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]] or ""
        assert r["ids"] == (sp.encode(t) if t else [])
        assert r["decoded"] == sentencepiece.decode_ids(r["ids"], sentencepiece.spellings(pieces)) == t.replace("▁", " ")


def test_partitions_of_the_lattice_are_small(spark, pieces, monkeypatch):
    """No task folds more than some 60,000 units, so what it holds does not follow the corpus."""
    asked = []
    width = sentencepiece.shuffle_width
    monkeypatch.setattr(sentencepiece, "shuffle_width", lambda rows, per, least: asked.append(per) or width(rows, per, least))
    sentencepiece.encode(docs_frame(spark, [(1, "some words")]), pieces).collect()
    assert asked and max(asked) <= 60_000


def test_worker_remembers_no_units(spark):
    table, _ = pack_table(spark.createDataFrame([("a", 1, [7, 8]), ("b", 2, [9])], "unit string, n long, ids array<int>"), "unit", "n", {}, 10, payload="ids")
    assert not hasattr(table, "known")
    at = table.find([b"b", b"a", b"c"])
    assert at[2] == -1
    offsets, ids = sentencepiece.pick(table.offsets, table.payload, at[:2])
    assert (offsets.tolist(), ids.tolist()) == ([0, 1, 3], [9, 7, 8])
    assert table.offsets.dtype == np.uint32


def test_spread_equals_pick():
    offsets, flat, at = np.array([0, 0, 3, 4]), np.array([5, 6, 70000, 9], "<u4"), pa.array([2, 0, 1, 1, 2], pa.int32())
    for a, b in zip(sentencepiece.spread(offsets, flat, at), sentencepiece.pick(offsets, flat, at.to_numpy())):
        assert a.tolist() == b.tolist()
    assert [x.tolist() for x in sentencepiece.spread(offsets, flat, at[:0])] == [[0], []]
