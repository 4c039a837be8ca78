"""Byte-level BPE encoding and decoding.

A text is cut at the model's added tokens, then into words by the model's split rule. A word's
bytes are a doubly linked list of symbols; a priority queue holds (rank, place) of every pair of
neighbours that has a merge. The best is taken, the leftmost of equals first; an entry whose pair
has changed since is stale and skipped. Each merge links its neighbours anew and offers two pairs.
A word costs O(n log n) whatever its length. ``decode`` concatenates vocabulary strings and reads
them as UTF-8 (a broken sequence becomes U+FFFD).

Rows are independent: one pass, no shuffle. The model (a vocabulary, whatever the corpus) is
broadcast; a worker remembers the ids of about ``remember`` recent pieces and as many before them, and works through a
batch in parts of 2 MB, so its memory does not follow the corpus.

Defined cases: a null text is the empty text, which has no ids and decodes to the empty text; an
empty table gives an empty result; a repeated row is encoded again; texts and words of any length
are encoded whole; of two pairs with one rank the left one merges first; further columns of the
input are ignored unless named in ``keep``; ids of null decode to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import Store, documents, slices

#: Fixed value: the split rule of byte-level models.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers that the standard took up after version 16, which such models
#: are split by. There they are neither letter nor number.
YOUNGER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F)]
_YOUNGER = re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in YOUNGER) + "]")
_SPLIT = regex.compile(SPLIT)
#: Neither letter, number nor space.
PRIVATE = "\ue000"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself for
    visible Latin-1 characters, the others in order from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class ByteModel:
    """``spelling``: the bytes of each id. ``merges``: (left id, right id) to (rank, merged id).
    ``added``: added tokens, which a text holds as they are."""

    spelling: list[bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    added: dict[str, int]
    single: list[int] = field(init=False)
    encoders: dict[bool, Encoder] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        ids = {s: i for i, s in reversed(list(enumerate(self.spelling))) if i not in self.added.values()}
        self.single = [ids[bytes([b])] for b in range(256)]

    def encoder(self, whole: bool, remember: int) -> Encoder:
        """One for all tasks of a worker, as a broadcast model is one object there."""
        if whole not in self.encoders:
            self.encoders[whole] = Encoder(self, whole, remember)
        return self.encoders[whole]


def load_model(path: str) -> ByteModel:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind, before, model = spec["model"]["type"], spec["pre_tokenizer"], spec["model"]
    plain = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if kind != "BPE" or before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or spec["normalizer"] or not plain:
        raise ValueError("only byte-level BPE without normaliser, prefix space or stripping tokens is supported")
    letters, vocab = byte_letters(), model["vocab"]
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    spelling = [b""] * (1 + max([*vocab.values(), *added.values()]))
    for token, i in vocab.items():
        spelling[i] = bytes(letters[c] for c in token)
    for token, i in added.items():
        spelling[i] = token.encode()
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
    return ByteModel(spelling, merges, added)


def merge(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges. A queue entry is rank * 2^32 + place."""
    n, get = len(symbols), merges.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(m[0] << 32) + i for i, pair in enumerate(zip(symbols, symbols[1:])) if (m := get(pair))]
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if j >= n or symbols[i] < 0 or not (m := get((symbols[i], symbols[j]))) or m[0] != entry >> 32:
            continue  # stale
        merged = m[1]
        symbols[i], symbols[j] = merged, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if m := get((merged, symbols[k])):
                heapq.heappush(queue, (m[0] << 32) + i)
        h = before[i]
        if h >= 0 and (m := get((symbols[h], merged))):
            heapq.heappush(queue, (m[0] << 32) + h)
    return [s for s in symbols if s >= 0]


#: A longer piece is merged anew wherever it occurs, so the store holds no long strings.
LONG_PIECE = 64


class Encoder:
    """Encodes texts in a task. With ``whole`` the strings of added tokens are ordinary text.
    Remembers the ids of the split rule's pieces."""

    def __init__(self, model: ByteModel, whole: bool = False, remember: int = 300_000):
        self.model, self.known = model, Store(remember)
        self.added = None if whole or not model.added else re.compile("(" + "|".join(map(re.escape, sorted(model.added, key=len, reverse=True))) + ")")

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and _YOUNGER.search(text):
            return [text[m.start():m.end()] for m in _SPLIT.finditer(_YOUNGER.sub(PRIVATE, text))]
        return _SPLIT.findall(text)

    def _merged(self, piece: str) -> bytes:
        single = self.model.single
        return np.array(merge([single[b] for b in piece.encode()], self.model.merges), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """The ids of a text by its pieces."""
        found, known = self.pieces(text), self.known
        try:
            return b"".join(map(known.__getitem__, found))
        except KeyError:
            long = {}
            for p in known.lacking(found):
                (known if len(p) <= LONG_PIECE else long)[p] = self._merged(p)
            return b"".join(long[p] if p in long else known[p] for p in found)

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        return b"".join(np.array([self.model.added[t]], "<u4").tobytes() if k % 2 else self._plain(t) for k, t in enumerate(self.added.split(text)))


def decode_ids(ids: list[int], spelling: list[bytes]) -> str:
    return b"".join(map(spelling.__getitem__, ids)).decode("utf-8", "replace")


def _encode_batches(batches: Iterator[pa.RecordBatch], model: ByteModel, names: list[str], decoded: bool, whole: bool, remember: int) -> Iterator[pa.RecordBatch]:
    encoder = model.encoder(whole, remember)
    for b in slices(batches):
        ids = [np.frombuffer(encoder(t), "<i4") for t in b.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
        back = [pa.array([decode_ids(x.tolist(), model.spelling) for x in ids], pa.string())] if decoded else []
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], lists, *back], [*names, "ids", *(["decoded"] if decoded else [])])


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def encode(docs: DataFrame, model: ByteModel, keep: tuple[str, ...] = (), decoded: bool = False, whole: bool = False, remember: int = 300_000,
           then: tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str] | None = None) -> DataFrame:
    """(doc_id, text, the columns of ``keep``, ids) for every row of ``docs`` (doc_id, text); with
    ``decoded`` also what ``decode`` gives. ``then`` is a function over the batches of that result
    and its schema, applied in the same pass."""
    docs = documents(docs, *keep)
    shared, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    schema = _fields(docs) + ", ids array<int>" + (", decoded string" if decoded else "")
    step = then[0] if then else iter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return step(_encode_batches(batches, shared.value, names, decoded, whole, remember))

    return docs.mapInArrow(run, then[1] if then else schema)


def decode(encoded: DataFrame, model: ByteModel, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids spell."""
    spelling = encoded.sparkSession.sparkContext.broadcast(model.spelling)

    @F.pandas_udf("string")
    def spell(column):  # noqa: ANN001, ANN202
        s = spelling.value
        return column.map(lambda x: "" if x is None else decode_ids(x, s))

    return encoded.withColumn(into, spell(F.col(ids)))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest columns of encoded and decoded rows."""
    for b in batches:
        ids = b.column("ids")
        ends = ids.offsets.to_numpy()
        flat = ids.values.to_numpy().astype("<u4", copy=False)
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)),
            pa.array([hashlib.sha256(flat[a:z].tobytes()).hexdigest() for a, z in zip(ends, ends[1:])], pa.string()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in b.column("decoded").to_pylist()], pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


DIGESTS = (digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
