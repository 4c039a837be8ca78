"""Alignment of two tokenizers' tokens over the same texts.

A is a byte-level BPE (``costloom.llm.bpe``), B a SentencePiece model. A encodes space + text, B text (it
adds the space). Byte offsets at which tokens of both end cut them into groups. Two tokens are linked
where their bytes overlap; a pair of ids counts as often as it is linked in the corpus.

1. ``align``: one pass over the texts. Ends are running sums of token lengths; a text's links are the
   stretches between consecutive ends of either side.
2. A fixed array maps each A id to the B id of the same bytes. Groups of one token each that this
   map explains are counted in a vector over A's vocabulary; vectors are summed in a tree. Only
   links of other groups are counted as pairs, in each task first, and shuffled by pair.
3. Counts return to the texts: those of mapped pairs and each B id's highest as vectors, the most
   frequent ``broadcast_pairs`` other pairs as one packed table. Links of rarer pairs fetch their counts
   by a join. The texts are encoded once: what a text needs later is written.

Defined cases: a text that is null or empty, or whose tokens of A or B do not spell space + text (B reads
U+2581 as a space) has no tokens, all numbers 0 and an empty digest; strings of special tokens are
ordinary text; a repeated row is aligned and counted again; of B ids with the same bytes an
ordinary piece comes before a byte piece, then the smaller id, and pairs with the others count as
pairs; ties for a B id's highest count all count; texts of any length are used whole; an empty table
gives an empty result; a null doc_id stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm import bpe
from costloom.llm.common import documents, heaviest, materialize, slices, sum_vectors, vector_rows

NORMAL, BYTE = 1, 6
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_counts array<int>, b_counts array<int>"
LINKS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "same binary, same_n binary, pairs binary, pairs_n binary")


@dataclass
class Tokenizers:
    """Both models, the byte lengths of their tokens and the map from A's ids to B's."""

    a: bpe.ByteModel
    b_file: bytes
    b_spelling: list[bytes]
    same: np.ndarray

    @property
    def key_type(self) -> str:
        return "<u4" if len(self.same) * len(self.b_spelling) < 1 << 32 else "<u8"


def load(a_path: str, b_path: str) -> Tokenizers:
    from sentencepiece import sentencepiece_model_pb2 as pb
    a, proto = bpe.load_model(a_path), pb.ModelProto()
    with open(b_path, "rb") as f:
        raw = f.read()
    proto.ParseFromString(raw)
    spelling = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace("▁", " ").encode() for p in proto.pieces]
    first = {}
    for i in sorted(range(len(spelling)), key=lambda i: (proto.pieces[i].type != NORMAL, i)):
        if proto.pieces[i].type in (NORMAL, BYTE):
            first.setdefault(spelling[i], i)
    return Tokenizers(a, raw, spelling, np.array([first.get(s, -1) for s in a.spelling], np.int64))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _align_batches(batches: Iterator[pa.RecordBatch], t: Tokenizers) -> Iterator[pa.RecordBatch]:
    import sentencepiece
    encode_a = t.a.encoder(True, 300_000)
    encode_b = sentencepiece.SentencePieceProcessor(model_proto=t.b_file)
    a_len, b_len = (np.array(list(map(len, s)), np.int64) for s in (t.a.spelling, t.b_spelling))
    none = np.empty(0, np.int64)
    for batch in slices(batches, max_bytes=1 << 20):
        texts = batch.column("text").to_pylist()
        a_ids, b_ids = [], []
        for text, ids in zip(texts, encode_b.encode(texts, num_threads=1)):
            raw = (" " + text).encode()
            own = np.frombuffer(encode_a(" " + text), "<u4").astype(np.int64) if text else none
            # A's tokens are cut from the bytes themselves, so their total length tells
            if not text or int(a_len[own].sum()) != len(raw) or b"".join(map(t.b_spelling.__getitem__, ids)) != raw:
                own, ids = none, none
            a_ids.append(own), b_ids.append(np.array(ids, np.int64))
        a_n, b_n = (np.array(list(map(len, x)), np.int64) for x in (a_ids, b_ids))
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        a_end, b_end = np.cumsum(a_len[a]), np.cumsum(b_len[b])
        at = np.minimum(np.searchsorted(b_end, a_end), max(len(b_end) - 1, 0))
        both = b_end[at] == a_end
        a_cut, b_cut = np.flatnonzero(both) + 1, at[both] + 1
        groups = np.diff(np.searchsorted(a_cut, np.concatenate([[0], np.cumsum(a_n)]), "right"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(a, a_n), _lists(b, b_n),
                                          _lists(np.diff(a_cut, prepend=0), groups), _lists(np.diff(b_cut, prepend=0), groups)],
                                         ["doc_id", "a_ids", "b_ids", "a_counts", "b_counts"])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0]:offsets[-1]].astype(np.int64), np.diff(offsets).astype(np.int64)


def _blobs(values: np.ndarray, sizes: np.ndarray, kind: str) -> pa.Array:
    raw, ends = values.astype(kind), np.cumsum(sizes)
    return pa.array([raw[z - n:z].tobytes() for z, n in zip(ends.tolist(), sizes.tolist())], pa.binary())


def _link_batches(batches: Iterator[pa.RecordBatch], t: Tokenizers) -> Iterator[pa.RecordBatch]:
    """Numbers and digest of aligned rows, and their distinct links with how often they occur:
    ``same`` as A ids, ``pairs`` as A id * size of B + B id."""
    a_len, b_len = (np.array(list(map(len, s)), np.int64) for s in (t.a.spelling, t.b_spelling))
    names = [f.split()[0] for f in LINKS.split(", ")]
    inner, last_a, last_b = ([[str(i).encode() + e for i in range(n)] for e, n in ((b",", max(len(a_len), len(b_len))), (b"|", len(a_len)), (b";", len(b_len)))])
    words = np.array(inner + last_a + last_b, object)
    for batch in batches:
        (a, a_n), (b, b_n), (ga, g_n), (gb, _) = (_flat(batch.column(c)) for c in ("a_ids", "b_ids", "a_counts", "b_counts"))
        a_to, b_to = np.cumsum(ga), np.cumsum(gb)  # where groups end
        # the digest's text: tokens by group, A before B
        a_group, b_group = np.repeat(np.arange(len(ga)), ga), np.repeat(np.arange(len(gb)), gb)
        word = np.empty(len(a) + len(b), np.int64)
        x, y = a.copy(), b.copy()
        x[a_to - 1] += len(inner)
        y[b_to - 1] += len(inner) + len(last_a)
        word[np.arange(len(a)) + (b_to - gb)[a_group]] = x
        word[np.arange(len(b)) + a_to[b_group]] = y
        ends, digests = np.cumsum(a_n + b_n), []
        for z, n in zip(ends.tolist(), (a_n + b_n).tolist()):
            digests.append(hashlib.sha256(b"".join(words[word[z - n:z]].tolist())[:-1]).hexdigest() if n else "")
        # links: stretches between ends of either side
        a_end, b_end = np.cumsum(a_len[a]), np.cumsum(b_len[b])
        cuts = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        cuts = cuts[np.diff(cuts, prepend=-1) > 0]
        i, j = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        doc = np.repeat(np.arange(len(a_n)), a_n)[i]
        left, right = a[i], b[j]
        single = ((ga == 1) & (gb == 1))[a_group[i]]
        plain = single & (t.same[left] == right)
        out = []
        for keep, key, width in ((plain, left, len(a_len)), (~plain, left * len(b_len) + right, len(a_len) * len(b_len))):
            found, times = np.unique(doc[keep] * width + key[keep], return_counts=True)
            sizes = np.bincount(found // width, minlength=len(a_n))
            out += [_blobs(found % width, sizes, "<u4" if width < 1 << 32 else "<u8"), _blobs(times, sizes, "<u4")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (a_n, b_n, g_n, np.bincount(doc, minlength=len(a_n)))), pa.array(digests, pa.string()), *out], names)


def align(docs: DataFrame, models: Tokenizers, then: tuple[Callable[..., Iterator[pa.RecordBatch]], str] | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_counts, b_counts) for every row of ``docs`` (doc_id, text): the tokens, and
    how many of each side stand in each group. ``then`` is a function over the batches of that
    result and the models, and its schema, applied in the same pass."""
    docs = documents(docs)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _align_batches(batches, shared.value)
        return then[0](rows, shared.value) if then else rows

    return docs.mapInArrow(run, then[1] if then else ALIGNED)


def count_links(linked: DataFrame, models: Tokenizers, pending: int = 1_000_000) -> DataFrame:
    """Each task's counts: the vector of mapped A ids, (key, n) of other pairs."""
    kind, size = models.key_type, len(models.same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, held, waiting = np.zeros(size, np.int64), [], 0
        names = ["key", "n", "slot", "vector"]

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.bincount(back, np.concatenate([c for _, c in held]).astype(float)).astype(np.int64)
            held.clear()
            return keys, n

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)

        for b in slices(batches, "pairs"):
            raw = [b"".join(b.column(c).to_pylist()) for c in ("same", "same_n", "pairs", "pairs_n")]
            np.add.at(vector, np.frombuffer(raw[0], "<u4").astype(np.int64), np.frombuffer(raw[1], "<u4"))
            held.append((np.frombuffer(raw[2], kind), np.frombuffer(raw[3], "<u4")))
            waiting += len(held[-1][0])
            if waiting > pending:
                keys, n = merged()
                waiting = len(keys)
                if waiting > pending // 2:
                    yield rows(keys, n)
                    waiting = 0
                else:
                    held.append((keys, n))
        if held:
            yield rows(*merged())
        slots, blobs = vector_rows(vector)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(blobs), pa.int64()), pa.nulls(len(blobs), pa.int64()), slots, blobs], names)

    return linked.select("same", "same_n", "pairs", "pairs_n").mapInArrow(run, "key long, n long, slot int, vector binary")


@dataclass
class Counts:
    """What goes to every task: per A id the count of its mapped pair, per B id the highest
    count, and the most frequent other pairs by key."""

    mapped: np.ndarray
    highest: np.ndarray
    keys: np.ndarray
    n: np.ndarray


def corpus_counts(linked: DataFrame, models: Tokenizers, broadcast_pairs: int) -> tuple[Counts, DataFrame | None]:
    """Counts over all texts, and a frame (key, n, top) of the pairs beyond ``broadcast_pairs``."""
    spark, width = linked.sparkSession, len(models.b_spelling)
    raw = materialize(count_links(linked, models), "al-counts")
    vector = sum_vectors(raw.where("slot is not null").select("slot", "vector"))
    if not len(vector):
        vector = np.zeros(len(models.same), np.int64)
    used = np.flatnonzero(vector)
    own = spark.createDataFrame([(int(a) * width + int(models.same[a]), int(vector[a])) for a in used], "key long, n long")
    pairs = materialize(raw.where("key is not null").select("key", "n").unionByName(own).groupBy("key").agg(F.sum("n").alias("n")), "al-pairs")
    highest = np.zeros(width, np.int64)
    for b, n in pairs.groupBy((F.col("key") % width).alias("b")).agg(F.max("n")).collect():  # at most B's vocabulary
        highest[b] = n
    mapped = vector.copy()
    for key, n in pairs.join(F.broadcast(own.select("key")), "key", "left_semi").collect():  # at most A's vocabulary
        mapped[key // width] = n
    head, rest = heaviest(pairs, "n", broadcast_pairs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("key", "n")], ["key", "n"])

    got = head.select("key", "n").mapInArrow(pack, "key binary, n binary").collect()
    keys, n = (np.frombuffer(b"".join(r[c] for r in got), "<i8") for c in ("key", "n"))
    order = np.argsort(keys)
    return Counts(mapped, highest, keys[order], n[order]), rest


def apply_counts(linked: DataFrame, counts: Counts, models: Tokenizers) -> DataFrame:
    """``linked`` with n_best and count_sum over the links whose counts are at hand, and the keys and
    numbers of the others."""
    spark, kind = linked.sparkSession, models.key_type
    shared, same, width = spark.sparkContext.broadcast(counts), models.same, len(models.b_spelling)
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in linked.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        top_mapped = c.mapped == np.where(same >= 0, c.highest[same], -1)
        for b in slices(batches, "pairs"):
            raw = [b.column(x).to_pylist() for x in ("same", "same_n", "pairs", "pairs_n")]
            a, a_n, n = (np.frombuffer(b"".join(x), k).astype(np.int64) for x, k in ((raw[0], "<u4"), (raw[1], "<u4"), (raw[3], "<u4")))
            key = np.frombuffer(b"".join(raw[2]), kind).astype(np.int64)
            a_size, size = (np.array([len(x) // 4 for x in raw[k]]) for k in (1, 3))
            at = np.minimum(np.searchsorted(c.keys, key), max(len(c.keys) - 1, 0))
            known = c.keys[at] == key if len(c.keys) else np.zeros(len(key), bool)
            total = np.where(known, c.n[at], 0) if len(c.keys) else np.zeros(len(key), np.int64)
            best = _sums(a_n * top_mapped[a], a_size) + _sums(n * (known & (total == c.highest[key % width])), size)
            score = _sums(a_n * c.mapped[a], a_size) + _sums(n * total, size)
            lost = _sums(~known, size)
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in names], pa.array(best), pa.array(score), _lists64(key[~known], lost), _lists64(n[~known], lost)],
                                             [*names, "n_best", "count_sum", "keys", "times"])

    return linked.mapInArrow(run, fields + ", n_best long, count_sum long, keys array<long>, times array<long>")


def _lists64(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.astype(np.int64)))


def digest(docs: DataFrame, models: Tokenizers, broadcast_pairs: int = 2_000_000) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    linked = materialize(align(docs, models, (_link_batches, LINKS)).withColumn("row", F.monotonically_increasing_id()), "al-links", codec="zstd")
    counts, rest = corpus_counts(linked, models, broadcast_pairs)
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    done = apply_counts(linked, counts, models)
    if rest is None:
        return done.select(*out)
    done, width = materialize(done, "al-first"), len(models.b_spelling)
    highest = docs.sparkSession.createDataFrame([(b, int(n)) for b, n in enumerate(counts.highest) if n], "b long, highest long")
    rare = rest.withColumn("b", F.col("key") % width).join(F.broadcast(highest), "b").select("key", "n", (F.col("n") == F.col("highest")).cast("long").alias("top"))
    links = done.select("row", F.explode(F.arrays_zip("keys", "times")).alias("l")).select("row", F.col("l.keys").alias("key"), F.col("l.times").alias("times"))
    late = links.join(rare, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("top")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return (done.join(late, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(*out))
