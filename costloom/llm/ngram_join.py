"""N-gram Jaccard join: groups of texts whose word-shingle sets are similar, exactly.

A text's set holds the 64-bit hashes of its distinct runs of ``width`` words (A-Z lower-cased,
words ``[^\\x20\\x09-\\x0D]+``; a shorter text is one shingle). Two texts link when
100 * intersection >= ``percent`` * union.

1. Texts with the same set are one node from the start (a hash of the sorted set), so exact
   copies never meet as pairs.
2. Rare-first prefixes. All shingles are ordered by a table of counts over the whole corpus,
   hashed to ``count_bits`` bits (a fixed size), then by hash. Any order gives exact results; the
   counts keep common passages out of prefixes. A node's first n - ceil(t n) + 1 shingles are
   its prefix: linked nodes share one. A task sends each node once.
3. A prefix shingle counts if two nodes have it. Each task sends a shingle once, with its lowest
   and highest node, packed by hash range; shingles whose ends differ are joined back to the
   prefixes. However many nodes hold a shingle, a range gets one record of it a task.
4. Pairs from a shared shingle pass the length and positional filters, then the suffix
   filter (the overlap is at most the sum of the smaller counts over 256 hash ranges), then
   exact verification, once per pair.
5. Pairs within one component need no test. So that near copies do not meet as all pairs,
   some rounds first test each node against one pivot per round (of the shared shingle's
   nodes outside its component), linking most of a group; a last round then tests all
   remaining pairs between different components: a shingle's rows meet its other components,
   then their rows, so pairs within a component are never made. It comes as soon as those are no
   more than ``open_factor`` times the shared prefix rows. Together: the exact components.

Defined cases: null and word-less texts have an empty set and link with nothing; repeated rows
are copies of each other; a row with a null doc_id links like any other, and its component_id is
null if no member of its group has an id; an empty table gives an empty result; a text of any length is used whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize, slices, sum_vectors, vector_rows
from costloom.llm.components import connected_components

RANGES = 256
RECORD = np.dtype([("gram", "<u8"), ("low", "<i8"), ("high", "<i8")])
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


@dataclass(frozen=True)
class JoinParams:
    width: int = 4
    percent: int = 85
    count_bits: int = 20
    pivot_rounds: int = 6
    open_factor: int = 1
    group: int = 256
    broadcast_rows: int = 1_000_000
    pending: int = 250_000


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


#: Bytes with A-Z lower-cased, and white space.
_LOWER = np.array([b | 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9FB21C651E98DF25
_BLOCK = 1 << 16  # bytes of text that are hashed at once
_SLICE = 1 << 19  # bytes of text whose sets a task holds at once


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Shingler:
    """Sorted distinct shingle hashes of texts. A word's hash is a polynomial in its bytes, modulo
    2^64 and mixed; running sums give it for all words of a block of text at once."""

    def __init__(self, width: int):
        self.width = width
        self._up, self._down = powers(_BLOCK, _BASE), powers(_BLOCK, pow(_BASE, -1, 1 << 64))

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of the words of a block that ends with white space."""
        if len(data) > len(self._up):  # one word longer than a block
            self._up, self._down = powers(len(data), _BASE), powers(len(data), pow(_BASE, -1, 1 << 64))
        data = _LOWER[data]
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        start, end = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[:len(data)])])
        return mix((sums[end] - sums[start]) * self._down[start] + (end - start).astype(np.uint64) * _ODD[0]), start

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        borders = np.cumsum([0, *(len(t) + 1 for t in texts)])
        hashes, starts, at = [], [], 0
        while at < len(data):
            end = at + _BLOCK
            if end < len(data):  # back to the last white space, else on to the next
                gaps = np.flatnonzero(_SPACE[data[at:end]])
                end = at + gaps[-1] + 1 if len(gaps) else end + int(np.argmax(_SPACE[data[end:]])) + 1
            h, s = self._words(data[at:end])
            hashes.append(h)
            starts.append(s + at)
            at = end
        h = np.concatenate([*hashes, np.empty(0, np.uint64)])
        cuts = np.searchsorted(np.concatenate([*starts, np.empty(0, np.int64)]), borders)
        whole = self._runs(h, self.width)
        out = []
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            n = z - a
            x = np.sort(whole[a:z - self.width + 1]) if n >= self.width else self._runs(h[a:z], n) if n else np.empty(0, np.uint64)
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x)
        return out

    @staticmethod
    def _runs(h: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all runs of k words."""
        n = max(len(h) - k + 1, 0)
        out = mix(np.full(n, k, np.uint64) + h[:n])
        for i in range(1, k):
            out = mix(out ^ (h[i:i + n] * _ODD[i % len(_ODD)]))
        return out


def signature(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)))


def histogram(shingles: np.ndarray) -> bytes:
    return np.minimum(np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=RANGES), 65535).astype("<u2").tobytes()


def least_overlap(n: Column | np.ndarray, m: Column | np.ndarray, percent: int):  # noqa: ANN201
    """Smallest intersection that links sets of n and m shingles."""
    return -((-percent * (n + m)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def survey(docs: DataFrame, params: JoinParams) -> DataFrame:
    """Rows (doc_id, n, node) of all documents, and after each partition's last its shingle
    counts by hash (slot, vector)."""
    size = 1 << params.count_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingler(params.width), np.zeros(size, np.int64)
        names = ["doc_id", "n", "node", "slot", "vector"]
        for b in slices(batches, max_bytes=_SLICE):
            sets = shingles(b.column("text").cast(pa.binary()).to_pylist())
            ns, nodes = [len(s) for s in sets], [signature(s) if len(s) else None for s in sets]
            np.add.at(counts, (np.concatenate(sets) >> np.uint64(64 - params.count_bits)).astype(np.int64), 1)
            k = len(ns)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        slots, blobs = vector_rows(counts)
        k = len(blobs)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), slots, blobs], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, node long, slot int, vector binary")


def count_table(rows: DataFrame, params: JoinParams) -> np.ndarray:
    """The corpus counts: ``2 ** count_bits`` numbers whatever the corpus."""
    got = sum_vectors(rows.where("slot is not null").select("slot", "vector"))
    return got if len(got) else np.zeros(1 << params.count_bits, np.int64)


def prefixes(docs: DataFrame, counts: np.ndarray, params: JoinParams) -> DataFrame:
    """(gram, node, n, pos): each node's prefix shingles, once a task."""
    table = docs.sparkSession.sparkContext.broadcast(counts.astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(params.width), set()
        shift = np.uint64(64 - params.count_bits)
        for b in slices(batches, max_bytes=_SLICE):
            grams, nodes, sizes, places = [], [], [], []
            for s in shingles(b.column("text").cast(pa.binary()).to_pylist()):
                if not len(s) or (node := signature(s)) in seen:
                    continue
                seen.add(node)
                first = np.lexsort((s, table.value[s >> shift]))[:prefix_length(len(s), params.percent)]
                k = len(first)
                grams.append(s[first].astype(np.int64))
                nodes.append(np.full(k, node, np.int64))
                sizes.append(np.full(k, len(s), np.int32))
                places.append(np.arange(k, dtype=np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (grams, nodes, sizes, places)], ["gram", "node", "n", "pos"])

    return docs.select("text").mapInArrow(run, "gram long, node long, n int, pos int")


def shared_grams(rows: DataFrame, params: JoinParams) -> DataFrame:
    """(gram) of two nodes or more. Records are combined in each task before they are sent."""
    parts = max(12, 2 * rows.rdd.getNumPartitions())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def combine() -> np.ndarray:
            x = np.concatenate(held)
            x = x[np.argsort(x["gram"], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], x["gram"][1:] != x["gram"][:-1]]))
            out = x[first]
            out["low"], out["high"] = np.minimum.reduceat(x["low"], first), np.maximum.reduceat(x["high"], first)
            return out

        def flush(x: np.ndarray) -> pa.RecordBatch:
            part = (mix(x["gram"]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            blobs = [(p, x[order[a:z]].tobytes()) for p, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in blobs], pa.int32()), pa.array([r for _, r in blobs], pa.binary())], ["part", "rows"])

        for b in batches:
            x = np.empty(b.num_rows, RECORD)
            x["gram"], x["low"] = b.column("gram").to_numpy().view(np.uint64), b.column("node").to_numpy()
            x["high"] = x["low"]
            held.append(x)
            size += len(x)
            if size > params.pending:
                held[:] = [combine()]
                size = len(held[0])
                if size > params.pending // 2:
                    yield flush(held.pop())
                    size = 0
        if size:
            yield flush(combine())

    def meet(table: pa.Table) -> pa.Table:
        x = np.concatenate([np.frombuffer(r, RECORD) for r in table.column("rows").to_pylist()])
        x = x[np.argsort(x["gram"], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], x["gram"][1:] != x["gram"][:-1]]))
        both = np.minimum.reduceat(x["low"], first) < np.maximum.reduceat(x["high"], first)
        return pa.table({"gram": pa.array(x["gram"][first][both].astype(np.int64))})

    return rows.select("gram", "node").mapInArrow(send, "part int, rows binary").groupBy("part").applyInArrow(meet, "gram long")


def shared_prefixes(docs: DataFrame, counts: np.ndarray, params: JoinParams) -> DataFrame:
    """(gram, node, n, pos) for prefix shingles that two nodes or more share."""
    rows = materialize(prefixes(docs, counts, params), "nj-prefixes", codec="zstd")
    grams = materialize(shared_grams(rows, params), "nj-grams")
    # a node in several tasks comes several times; of the rows that count, few do
    return only(rows, grams, "gram", params).dropDuplicates(["gram", "node"])


def can_link(a: str, b: str, percent: int) -> Column:
    """Length and positional filters for rows of one shared shingle (columns a_n, a_pos, ...)."""
    an, bn, ap, bp = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}pos"), F.col(f"{b}pos")
    bound = F.least(ap, bp) + 1 + F.least(an - ap, bn - bp) - 1
    return (100 * F.least(an, bn) >= percent * F.greatest(an, bn)) & ((100 + percent) * bound >= percent * (an + bn))


def only(rows: DataFrame, keys: DataFrame, on: str, params: JoinParams) -> DataFrame:
    """``rows`` whose ``on`` is among ``keys`` (one long column, counted first): at most
    ``broadcast_rows`` keys go to the tasks, so texts or sets need no shuffle; more are joined."""
    return rows.join(F.broadcast(keys) if keys.count() <= params.broadcast_rows else keys, on, "left_semi")


def candidate_sets(docs: DataFrame, listed: DataFrame, shared: DataFrame, params: JoinParams) -> DataFrame:
    """(node, histogram, shingles) for nodes with a shared prefix shingle, from one text each
    (of a node that only texts without an id have, from one of these)."""
    wanted = materialize(shared.select("node").distinct(), "nj-wanted")
    one = materialize(listed.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nj-one")
    bare = one.where("doc_id is null").select("node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(params.width), set()
        for b in slices(batches, max_bytes=_SLICE):
            sets = {}
            for s in shingles(b.column("text").cast(pa.binary()).to_pylist()):
                if len(s) and (node := signature(s)) not in seen:  # repeated rows of an id
                    seen.add(node)
                    sets[node] = s
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array([histogram(s) for s in sets.values()], pa.binary()),
                                              pa.array([s.tobytes() for s in sets.values()], pa.binary())], ["node", "histogram", "shingles"])

    schema = "node long, histogram binary, shingles binary"
    some = only(docs.where("doc_id is not null"), one.where("doc_id is not null").select("doc_id").distinct(), "doc_id", params)
    sets = some.select("text").mapInArrow(run, schema)
    if bare.isEmpty():
        return sets
    more = only(docs.where("doc_id is null").select("text").mapInArrow(run, schema), bare, "node", params)
    return sets.unionByName(more.groupBy("node").agg(F.first("histogram").alias("histogram"), F.first("shingles").alias("shingles")))


def suffix_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose histograms allow enough overlap."""
    small = sets.select("node", "histogram")
    rows = (pairs.join(small.withColumnsRenamed({"node": "a", "histogram": "ha"}), "a")
            .join(small.withColumnsRenamed({"node": "b", "histogram": "hb"}), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, RANGES).astype(np.int64) for c in ("ha", "hb"))
            n = x.sum(1) + y.sum(1)
            ok = (100 + percent) * np.minimum(x, y).sum(1) >= percent * n
            ok |= (x == 65535).any(1) | (y == 65535).any(1)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return rows.select("a", "b", "ha", "hb").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """The pairs (a, b) that link. Each b's partners are dealt into groups of about ``group``
    sets, each with its own copy of b's set, so a hub is spread over many tasks."""
    percent = params.percent
    sizes = materialize(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / params.group).cast("int").alias("buckets")), "nj-hubs")
    dealt = materialize(pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("buckets")).cast("int").alias("bucket")), "nj-dealt")
    needed = materialize(dealt.select(F.col("a").alias("node")).union(dealt.select("b")).distinct(), "nj-needed")
    own = only(sets.select("node", "shingles"), needed, "node", params)
    members = dealt.join(own.withColumnRenamed("node", "a"), "a").select("b", "bucket", F.col("a").alias("node"), "shingles")
    hubs = dealt.select("b", "bucket").distinct().join(own.withColumnRenamed("node", "b"), "b").select("b", "bucket", F.col("b").alias("node"), "shingles")

    def test(table: pa.Table) -> pa.Table:
        hub = table.column("b")[0].as_py()
        all_sets = dict(zip(table.column("node").to_pylist(), table.column("shingles").to_pylist()))
        base = np.frombuffer(all_sets.pop(hub), "<u8")
        found = []
        for node, raw in all_sets.items():
            s = np.frombuffer(raw, "<u8")
            at = np.minimum(np.searchsorted(base, s), len(base) - 1)
            both = int((base[at] == s).sum())
            if 100 * both >= percent * (len(base) + len(s) - both):
                found.append(node)
        return pa.table({"a": pa.array(found, pa.int64()), "b": pa.array([hub] * len(found), pa.int64())})

    return members.unionByName(hubs).groupBy("b", "bucket").applyInArrow(test, "a long, b long")


def link_nodes(shared: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """(node, root) of all linked nodes."""
    spark = shared.sparkSession
    links = tried = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    rows = shared.count()
    for step in range(params.pivot_rounds + 1):
        known = shared.withColumn("root", F.col("node")) if step == 0 else materialize(
            shared.join(roots, "node", "left").select(*shared.columns, F.coalesce("root", "node").alias("root")), "nj-known")
        last = step == params.pivot_rounds or open_pairs(known) <= params.open_factor * rows
        mixed = materialize(known.groupBy("gram").agg(
            F.min("root").alias("low"), F.max("root").alias("high"),
            F.min(F.struct(F.xxhash64("node", F.lit(step)).alias("order"), F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("pos").alias("b_pos"),
                           F.col("root").alias("b_root"))).alias("pivot")).where("low < high").select("gram", "pivot.*"), "nj-pivots")
        side = known.select("gram", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos"), F.col("root").alias("a_root"))
        if last:
            open_lists = materialize(side.join(mixed.select("gram"), "gram", "left_semi"), "nj-open")
            other = open_lists.toDF("gram", "b", "b_n", "b_pos", "b_root")
            met = meet_others(open_lists, "a_root").join(other, ["gram", "b_root"])
        else:
            met = side.join(mixed, "gram").where("a_root != b_root")
        pairs = (met.where(can_link("a_", "b_", params.percent))
                 .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b").groupBy("x", "y", "a", "b").count())
        pairs = pairs.join(tried.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")), ["x", "y"], "left_anti")
        if not last:  # the pivot that shares most prefix shingles
            pairs = pairs.groupBy("a").agg(F.max_by(F.col("b"), F.struct("count", "b")).alias("b"))
        pairs = materialize(pairs.select("a", "b"), "nj-pairs")
        if pairs.count():
            good = materialize(verify(materialize(suffix_filter(pairs, sets, params.percent), "nj-likely"), sets, params), "nj-links")
            tried = materialize(tried.unionByName(pairs), "nj-tried")
            if good.count():
                links = materialize(links.unionByName(good), "nj-all-links")
                roots = connected_components(links)
        if last:
            return roots
    return roots


def meet_others(lists: DataFrame, root: str) -> DataFrame:
    """Each row of a shingle with each greater component that the shingle has."""
    roots = lists.select("gram", F.col(root).alias("b_root")).distinct()
    return lists.join(roots, "gram").where(F.col(root) < F.col("b_root"))


def open_pairs(known: DataFrame) -> int:
    """How many rows the last round would look at: pairs of different components by shingle."""
    sizes = known.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("gram").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    return int(sizes.agg(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()[0] or 0)


def group_documents(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row; component_id is the smallest doc_id of
    the group."""
    docs = documents(docs)
    rows = materialize(survey(docs, params), "nj-survey")
    listed = rows.where("slot is null").select("doc_id", "n", "node")
    shared = materialize(shared_prefixes(docs, count_table(rows, params), params), "nj-shared")
    sets = materialize(candidate_sets(docs, listed, shared, params), "nj-sets")
    roots = link_nodes(shared, sets, params)
    nodes = listed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    rooted = materialize(nodes.join(roots, "node", "left").withColumn("linked", F.col("root").isNotNull())
                         .select("node", "low", F.coalesce("root", "node").alias("root"), "linked", "copies"), "nj-nodes")
    lowest = materialize(rooted.where("linked").groupBy("root").agg(F.min("low").alias("lowest")), "nj-lowest")
    named = materialize(rooted.where("linked or copies > 1").join(lowest, "root", "left").select("node", F.coalesce("lowest", "low").alias("component_id")), "nj-named")
    return (listed.join(named, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
