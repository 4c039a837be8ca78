"""Helpers that several operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.session import materialize

__all__ = ["materialize", "read_table", "documents", "remainder", "slices", "Store", "PackedTable", "heaviest", "pack_table", "shuffle_width", "sum_vectors", "vector_rows"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator works on, so further columns of the caller (whatever
    their names) cannot clash with its own; a null text counts as the empty text. Texts are long rows: where
    the session still has Spark's 10,000 rows an Arrow batch, batches of 1,000 bound what a task holds."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``max_bytes`` of text, so that what a task makes of one part
    stays small however large Spark's batches are. A longer text is a part of its own."""
    for b in batches:
        if not b.num_rows:
            continue
        step = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False)) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            yield b.slice(a, z - a)


def key_hash(keys: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(k) for k in keys), np.uint64, len(keys))


class Store(dict):
    """What a worker remembers between texts: at most about ``limit`` recent entries and as many
    before them. Entries that are used again move on, so the frequent ones stay."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def lacking(self, keys: Iterable) -> list:
        """The keys that must be made; makes room for them first."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        out = []
        for k in set(keys):
            if k not in self:
                if k in self.older:
                    self[k] = self.older[k]
                else:
                    out.append(k)
        return out


@dataclass
class PackedTable:
    """A lookup table as sorted key hashes with aligned value arrays: about 8 bytes a key
    plus its values, shared by all tasks of an executor's worker as one broadcast."""

    hashes: np.ndarray
    values: dict[str, np.ndarray] = field(default_factory=dict)
    offsets: np.ndarray | None = None
    payload: np.ndarray | None = None

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Row of each key, or -1."""
        if not len(self.hashes):
            return np.full(len(keys), -1, np.int64)
        h = key_hash(keys)
        order = np.argsort(h)  # searched in order, so near places of the table are read together
        at = np.empty(len(h), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, h[order]), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


def heaviest(table: DataFrame, weight: str, max_rows: int, always: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """At most ``max_rows`` rows of the greatest weight (and those of ``always``), and the rest, None if all fit."""
    bucket = F.floor(F.log2(F.greatest(F.col(weight), F.lit(1)).cast("double")) * 16).cast("int")
    sizes = {r[0]: r[1] for r in table.groupBy(bucket.alias("b")).count().collect()}
    total, cut = 0, None
    for b in sorted(sizes, reverse=True):
        if total + sizes[b] > max_rows:
            cut = b
            break
        total += sizes[b]
    if cut is None:
        return table, None
    heavy = (bucket > cut) if always is None else (bucket > cut) | always
    return table.where(heavy), table.where(~heavy)


def pack_table(table: DataFrame, key: str, weight: str, values: dict[str, str], max_rows: int, always: Column | None = None,
               payload: str | None = None, payload_dtype: str = "<u2") -> tuple[PackedTable, DataFrame | None]:
    """The ``max_rows`` heaviest rows of ``table`` and those of ``always`` (whose number the caller
    bounds) packed for a broadcast, and a frame of the rest (None if all fit), which the
    caller joins by a shuffle.

    ``max_rows`` bounds what passes the driver. Rows are taken by a weight cut-off that
    one small histogram decides, so nothing is sorted globally."""
    head, rest = heaviest(table, weight, max_rows, always)
    cols = [F.col(key).alias("k"), *[F.col(c).alias(c) for c in values], *([F.col(payload)] if payload else [])]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h = key_hash(b.column(0).cast(pa.binary()).to_pylist())
            parts = [h.tobytes()]
            for i, t in enumerate(values.values()):
                parts.append(b.column(1 + i).to_numpy(zero_copy_only=False).astype(t).tobytes())
            if payload:
                lists = b.column(1 + len(values))
                parts.append(np.diff(lists.offsets.to_numpy()).astype("<u4").tobytes())
                parts.append(lists.flatten().to_numpy(zero_copy_only=False).astype(payload_dtype).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts],
                                             [f"p{i}" for i in range(len(parts))])

    n = 1 + len(values) + (2 if payload else 0)
    got = head.select(*cols).mapInArrow(pack, ", ".join(f"p{i} binary" for i in range(n))).toArrow()

    def join(i: int, dtype: str) -> np.ndarray:
        """The parts of a column in one array; the driver holds each part once."""
        nonlocal got
        chunks = [c for c in got.column(f"p{i}").chunks if len(c)]
        got = got.drop_columns(f"p{i}")
        sizes = [pc.sum(pc.binary_length(c)).as_py() for c in chunks]
        whole, at = np.empty(sum(sizes), np.uint8), 0
        while chunks:
            chunk, size = chunks.pop(0), sizes.pop(0)
            first = int(np.frombuffer(chunk.buffers()[1], "<i4")[chunk.offset])
            whole[at:at + size] = np.frombuffer(chunk.buffers()[2], np.uint8, size, first)
            at += size
        return whole.view(dtype)

    hashes = join(0, "<u8")
    order = np.argsort(hashes, kind="stable")
    out = PackedTable(hashes[order], {c: join(1 + i, t)[order] for i, (c, t) in enumerate(values.items())})
    del hashes
    if payload:
        lengths, flat = join(n - 2, "<u4"), join(n - 1, payload_dtype)
        place = np.uint32 if len(flat) < 1 << 32 else np.int64
        starts = (np.cumsum(lengths, dtype=place) - lengths)[order].astype(place)
        lengths = lengths[order]
        del order
        out.offsets = np.zeros(len(lengths) + 1, place)
        np.cumsum(lengths, out=out.offsets[1:])
        out.payload = np.empty(len(flat), payload_dtype)
        for a in range(0, len(lengths), 200_000):  # in steps, so the index arrays stay small
            z = min(a + 200_000, len(lengths))
            first, last = int(out.offsets[a]), int(out.offsets[z])
            out.payload[first:last] = flat[np.repeat(starts[a:z].astype(np.int64) - out.offsets[a:z], lengths[a:z]) + np.arange(first, last)]
    return out, rest


def shuffle_width(rows: int, per_partition: int = 200_000, least: int = 12) -> int:
    """Partitions for an explicit repartition, in step with the rows."""
    return max(least, math.ceil(rows / per_partition))


def vector_rows(vector: np.ndarray, slot: int = 8192) -> tuple[pa.Array, pa.Array]:
    """A task's vector of counts as (slot, bytes) columns, ``slot`` numbers a row."""
    parts = [vector[a:a + slot].astype("<i8").tobytes() for a in range(0, len(vector), slot)]
    return pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())


def sum_vectors(rows: DataFrame, branches: int = 256) -> np.ndarray:
    """The sum of all tasks' vectors, given as rows (slot, vector). First the vectors of
    ``branches`` groups of tasks meet, then the groups' sums, so no group holds a row of every task."""

    def add(table: pa.Table) -> pa.Table:
        total = 0
        for x in table.column("vector").to_pylist():
            total = total + np.frombuffer(x, "<i8")
        return pa.table({"slot": pa.array([table.column("slot")[0].as_py()], pa.int32()), "vector": pa.array([total.tobytes()], pa.binary())})

    some = (rows.withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(branches))).groupBy("slot", "branch")
            .applyInArrow(lambda t: add(t.select(["slot", "vector"])), "slot int, vector binary"))
    got = some.groupBy("slot").applyInArrow(add, "slot int, vector binary").collect()
    return np.concatenate([np.frombuffer(r[1], "<i8") for r in sorted(got)]) if got else np.zeros(0, np.int64)
