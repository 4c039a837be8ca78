"""SentencePiece encoding and decoding through a relational lattice.

1. ``count_units``: the distinct units of the corpus. A unit is a run of letters or a run of
   other characters, with the spaces before it; the model's pieces never reach across a
   unit's border (``unit_pattern`` makes sure), so a text's ids are the ids of its units in
   order.
2. ``lattice``: explode every substring of a unit that may be a piece by its first three characters, equi-join it to
   the piece table, group the edges by unit, and fold them with a Spark higher-order
   ``aggregate``. The units arrive hash-partitioned from step 1 and the piece table (its
   size is the model's vocabulary) is broadcast, so explode, join and grouping need no
   further shuffle.
   * A unigram model's fold is Viterbi: edges in order of their end, the best score and
     the last edge for each position.
   * A BPE model's right answer is its merge order, which no sum of scores gives. Its fold
     visits the edges by (rank, start, end) and takes an edge when its two ends are token
     borders with exactly one border between them. That is the exact result if every piece
     folds to itself (a pair could otherwise form after its turn); the loader tests each
     piece, and units with one of the few others (a run of 16 spaces) or with more than
     ``long_unit`` characters are merged one pair at a time instead (``merge_by_rank``).
3. ``encode``: the unit table, packed, goes to all tasks; documents look their units up.
   At most ``broadcast_units`` units are broadcast, the most frequent ones; units beyond
   that reach their documents through a shuffle join.

Characters without a piece become byte pieces. ``decode`` joins pieces and bytes again and
drops the space that encoding puts in front, so it restores the text; a literal U+2581 is
the model's space sign and returns as a space.

Defined cases: a null text is the empty text, which has no ids and decodes to the empty
text; an empty table gives an empty result; a repeated row is encoded again; texts and
units of any length are encoded whole; ids of null decode to the empty text.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize, pack_table, shuffle_width, slices

SPACE = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
HEAD = 3


@dataclass
class PieceModel:
    """Pieces of a SentencePiece file. ``rank`` orders merges (BPE); ``score`` adds up (unigram)."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    unknown: int
    kind: str = "bpe"
    ids: dict[str, int] = field(init=False)
    rank: dict[str, float] = field(init=False)
    longest: int = field(init=False)
    odd: list[str] = field(init=False)
    pattern: re.Pattern = field(init=False)

    def __post_init__(self) -> None:
        self.ids = {p: i for p, i, _ in self.pieces}
        self.rank = {p: -s for p, _, s in self.pieces}
        self.longest = max((len(p) for p in self.ids), default=1)
        self.pattern = unit_pattern(list(self.ids))
        self.odd = [p for p in self.ids if self.kind == "bpe" and len(p) > 1 and fold_by_rank(p, self) != [p]]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(p, i, float(s if self.kind == "unigram" else -s)) for p, i, s in self.pieces]
        return spark.createDataFrame(rows, "piece string, id int, weight double")

    def reach(self) -> list[tuple[str, int]]:
        """The length of the longest piece by its first ``HEAD`` characters; a start with another head
        begins no piece as long as that."""
        out: dict[str, int] = {}
        for p in self.ids:
            if len(p) >= HEAD:
                out[p[:HEAD]] = max(len(p), out.get(p[:HEAD], 0))
        return list(out.items())

    def spell(self, token: str) -> list[int]:
        """Ids of a token that may have no piece."""
        i = self.ids.get(token)
        if i is not None:
            return [i]
        return [self.byte_ids[b] for b in token.encode()] if self.byte_ids else [self.unknown]


def unit_pattern(pieces: list[str]) -> re.Pattern:
    """Splits a text (with plain spaces) where no piece can reach across: between letters and
    other characters, and around line ends. Letters that share a piece with other characters
    count as such; if that does not end, a unit is what stands between spaces."""
    across, own = [], ""
    for _ in range(6):
        x = re.escape(own)
        found = re.compile(rf" *[^\W\d_{x}]+| *(?:[^\w \n]|[\d_{x}])+| +|\n+")
        across = [p for p in pieces if len(p) > 1 and len(found.findall(p.replace(SPACE, " "))) > 1]
        if not across:
            return found
        own = "".join(sorted(set(own) | {c for p in across for c in p if re.match(r"[^\W\d_]", c)}))
    coarse = re.compile(r" *[^ \n]+| +|\n+")
    for p in pieces:
        if len(p) > 1 and len(coarse.findall(p.replace(SPACE, " "))) > 1:
            raise ValueError(f"a piece reaches across units: {p!r}")
    return coarse


def load_model(path: str) -> PieceModel:
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n, t = m.normalizer_spec, m.trainer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not (n.add_dummy_prefix and n.escape_whitespaces):
        raise ValueError("only models with the identity normaliser and a leading space are supported")
    byte_ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == BYTE}
    return PieceModel([(p.piece, i, p.score) for i, p in enumerate(m.pieces) if p.type == NORMAL],
                      [byte_ids[f"<0x{b:02X}>"] for b in range(256)] if byte_ids else [],
                      next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN),
                      {1: "unigram", 2: "bpe"}[t.model_type])


def fold_by_rank(unit: str, model: PieceModel) -> list[str]:
    """The BPE fold of one unit, as the Spark expression does it (the loader's test)."""
    n = len(unit)
    edges = sorted((model.rank[unit[s:e]], s, e) for s in range(n) for e in range(s + 2, min(n, s + model.longest) + 1)
                   if unit[s:e] in model.rank)
    end = list(range(1, n + 1))
    for _, s, e in edges:
        mid = end[s]
        if 0 < mid < e and end[mid] == e:
            end[s], end[mid] = e, 0
    return [unit[s:e] for s, e in enumerate(end) if e]


def merge_by_rank(unit: str, model: PieceModel) -> list[str]:
    """BPE one pair at a time: the best rank first, the leftmost of equals."""
    n = len(unit)
    end, start, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

    def offer(a: int) -> None:
        if a >= 0 and end[a] < n:
            rank = model.rank.get(unit[a:end[end[a]]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, end[a], end[end[a]]))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, mid, e = heapq.heappop(heap)
        if end[a] != mid or end[mid] != e:
            continue
        end[a], end[mid] = e, 0
        if e < n:
            start[e] = a
        offer(a)
        offer(start[a])
    return [unit[s:e] for s, e in enumerate(end) if e]


#: Bytes of text that a task splits into units at once; each unit is a Python string meanwhile.
SLICE = 1 << 20


def units(text: str, pattern: re.Pattern) -> list[str]:
    return pattern.findall(" " + text.replace(SPACE, " ")) if text else []


def count_units(docs: DataFrame, pattern: re.Pattern, max_pending: int = 300_000) -> DataFrame:
    """(unit, n): every distinct unit, spaces as the model writes them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def combine() -> pa.Table:
            return pa.concat_tables(held).group_by("unit", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

        def flush(seen: pa.Table) -> Iterator[pa.RecordBatch]:
            unit = pc.replace_substring(seen.column("unit"), " ", SPACE)
            return iter(pa.table({"unit": unit, "n": seen.column("n")}).combine_chunks().to_batches())

        for b in slices(batches, max_bytes=SLICE):
            found = pa.array(list(chain.from_iterable(units(t, pattern) for t in b.column("text").to_pylist())), pa.string()).value_counts()
            held.append(pa.table({"unit": found.field("values"), "n": found.field("counts")}))
            size += len(found)
            if size > max_pending:
                held[:] = [combine()]
                size = len(held[0])
                if size > max_pending // 2:
                    yield from flush(held.pop())
                    size = 0
        if size:
            yield from flush(combine())

    return (docs.select("text").mapInArrow(count, "unit string, n long")
            .groupBy("unit").agg(F.sum("n").alias("n")))


def _token(end: Column, piece: Column) -> Column:
    """A token's end and piece (-1: none) in one number; 0 where no token starts."""
    return F.shiftleft(end.cast("long"), 32) + piece + 1


def _merge_fold(edges: Column, size: Column) -> Column:
    """Tokens by their start, as ``_token`` writes them."""
    end = lambda state, at: F.shiftright(F.element_at(state, at + 1), 32)
    first = F.transform(F.sequence(F.lit(1), size), lambda e: _token(e, F.lit(-1)))

    def take(state: Column, edge: Column) -> Column:
        mid = end(state, edge["start"])
        fits = (mid > 0) & (mid < edge["end"]) & (end(state, F.greatest(mid, F.lit(0)).cast("int")) == edge["end"])
        merged = F.transform(state, lambda t, i: F.when(i == edge["start"], _token(edge["end"], edge["id"])).when(i == mid, F.lit(0).cast("long")).otherwise(t))
        return F.when(F.coalesce(fits, F.lit(False)), merged).otherwise(state)

    return F.aggregate(F.filter(edges, lambda e: e["end"] > e["start"] + 1), first, take)


def _viterbi_fold(edges: Column, size: Column, unknown: float) -> Column:
    """Best path to each position; edges come by end, so all before an edge's start is final.
    A position that no edge ends at is reached by a single unknown character."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start"), F.lit(-1).alias("id")))

    def step(state: Column, end: Column) -> Column:
        into = F.filter(edges, lambda e: e["end"] == end)
        paths = F.transform(into, lambda e: F.struct((F.element_at(state, e["start"] + 1)["score"] + e["weight"]).alias("score"),
                                                     e["start"].alias("start"), e["id"].alias("id")))
        lone = F.struct((F.element_at(state, end)["score"] + F.lit(unknown)).alias("score"),
                        (end - 1).cast("int").alias("start"), F.lit(-1).alias("id"))
        single = F.exists(into, lambda e: e["start"] == end - 1)
        return F.concat(state, F.array(F.array_max(F.when(single, paths).otherwise(F.concat(paths, F.array(lone))))))

    best = F.aggregate(F.sequence(F.lit(1), size), start, step)
    back = F.aggregate(F.reverse(F.sequence(F.lit(1), size)),
                       F.struct(size.alias("at"), F.array().cast("array<struct<start:int,end:int,id:int>>").alias("path")),
                       lambda s, p: F.when(s["at"] == p, F.struct(
                           F.element_at(best, p + 1)["start"].alias("at"),
                           F.concat(F.array(F.struct(F.element_at(best, p + 1)["start"].alias("start"), p.alias("end"),
                                                     F.element_at(best, p + 1)["id"].alias("id"))), s["path"]).alias("path"))).otherwise(s))
    tokens = back["path"]
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(
        F.get(F.transform(F.filter(tokens, lambda t: t["start"] == i), lambda t: _token(t["end"], t["id"])), F.lit(0)), F.lit(0).cast("long")))


def lattice(unit_counts: DataFrame, model: PieceModel, long_unit: int = 256) -> DataFrame:
    """(unit, n, ids) for every distinct unit; see the module's text."""
    spark = unit_counts.sparkSession
    pieces = F.broadcast(model.table(spark))
    size = F.char_length("unit")
    odd = F.lit(False)
    for p in model.odd:
        odd = odd | F.contains("unit", F.lit(p))
    apart = (size > long_unit) | odd if model.kind == "bpe" else F.lit(False)
    reach = F.broadcast(spark.createDataFrame(model.reach(), "head string, reach int"))
    starts = (unit_counts.where(~apart)
              .select("unit", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
              .withColumn("head", F.substring("unit", F.col("start") + 1, F.lit(HEAD)))
              .join(reach, "head", "left"))
    edges = (starts.select("unit", "n", "start", F.explode(F.sequence(F.lit(1), F.least(F.coalesce("reach", F.lit(HEAD - 1)), size - F.col("start")))).alias("len"))
             .select("unit", "n", "start", (F.col("start") + F.col("len")).alias("end"),
                     F.substring("unit", F.col("start") + 1, F.col("len")).alias("piece")))
    least = 2 if model.kind == "bpe" else 1
    edge = F.struct("weight", "start", "end", "id")
    grouped = (edges.where((F.col("end") - F.col("start") >= least) | (F.col("end") == 1))
               .join(pieces, "piece", "left").where("id is not null or end = 1")
               .groupBy("unit").agg(F.first("n").alias("n"), F.collect_list(F.when(F.col("id").isNotNull(), edge)).alias("edges")))
    length = F.char_length("unit")
    if model.kind == "bpe":
        tokens = _merge_fold(F.sort_array("edges"), length)
    else:
        tokens = _viterbi_fold(F.col("edges"), length, min((s for _, _, s in model.pieces), default=0.0) - 10.0)
    folded = grouped.select("unit", "n", tokens.alias("tokens"))
    shared = spark.sparkContext.broadcast(model)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            us, ts = b.column("unit").to_pylist(), b.column("tokens")
            bounds, flat = ts.offsets.to_numpy() - ts.offsets[0].as_py(), ts.flatten().to_numpy(zero_copy_only=False)
            ends, ids = flat >> 32, (flat & 0xFFFFFFFF) - 1  # as ``_token`` wrote them
            token = np.flatnonzero(ends > 0)
            row = np.searchsorted(bounds, token, "right") - 1
            start, value = token - bounds[row], ids[token]
            bare = np.flatnonzero(value < 0)  # tokens without a merge: their own piece or bytes
            spelled = [m.spell(us[r][s:e]) for r, s, e in zip(row[bare].tolist(), start[bare].tolist(), ends[token[bare]].tolist())]
            size = np.ones(len(token), np.int64)
            size[bare] = [len(x) for x in spelled]
            place = np.cumsum(size) - size
            out = np.empty(int(size.sum()), np.int32)
            out[place] = value
            for k, x in zip(place[bare].tolist(), spelled):
                out[k:k + len(x)] = x
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, size, b.num_rows).astype(np.int64))])
            yield pa.RecordBatch.from_arrays([b.column("unit"), b.column("n"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))], ["unit", "n", "ids"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = [[i for t in merge_by_rank(u, m) for i in m.spell(t)] for u in b.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("unit"), b.column("n"), pa.array(out, pa.list_(pa.int32()))], ["unit", "n", "ids"])

    schema = "unit string, n long, ids array<int>"
    done = folded.mapInArrow(finish, schema)
    if model.kind == "bpe":
        done = done.unionByName(unit_counts.where(apart).mapInArrow(merge, schema))
    return done


def decode_ids(ids: list[int], spelling: list[bytes]) -> str:
    text = b"".join(map(spelling.__getitem__, ids)).decode("utf-8", "replace")
    return text.removeprefix(" ")


def spellings(model: PieceModel) -> list[bytes]:
    out = [b""] * (max([model.unknown, *model.byte_ids, *model.ids.values()]) + 1)
    out[model.unknown] = " ⁇ ".encode()
    for p, i in model.ids.items():
        out[i] = p.replace(SPACE, " ").encode()
    for b, i in enumerate(model.byte_ids):
        out[i] = bytes([b])
    return out


def pick(offsets: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists number ``rows`` of a table of lists (``offsets`` into ``flat``), as one of the same form."""
    first = offsets[rows].astype(np.int64)
    out = np.concatenate([np.zeros(1, np.int64), np.cumsum(offsets[rows + 1].astype(np.int64) - first)])
    return out, flat[np.repeat(first - out[:-1], np.diff(out)) + np.arange(out[-1])]


def spread(offsets: np.ndarray, flat: np.ndarray, at: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``pick`` for many places ``at`` of a small table, by Arrow, without an index for each number."""
    width = flat.itemsize
    table = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("<i8") * width), pa.py_buffer(flat)])
    out = table.take(at)
    ends = np.frombuffer(out.buffers()[1], "<i8", len(at) + 1, 8 * out.offset) // width
    return ends, np.frombuffer(out.buffers()[2], flat.dtype)[:ends[-1]] if ends[-1] else np.empty(0, flat.dtype)


def encode(docs: DataFrame, model: PieceModel, broadcast_units: int = 8_000_000, keep: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """(doc_id, text, the columns of ``keep``, ids) for every row of ``docs`` (doc_id, text); with
    ``decoded`` also what ``decode`` gives, in the same pass."""
    spark = docs.sparkSession
    docs = documents(docs, *keep)
    names = docs.columns
    counts = materialize(count_units(docs, model.pattern), "sp-units")
    total = counts.count()
    parts = shuffle_width(total, 60_000, spark.sparkContext.defaultParallelism)
    lexicon = materialize(lattice(counts.repartition(parts, "unit"), model), "sp-lexicon")
    kind = "<u2" if max([model.unknown, *model.byte_ids, *model.ids.values()]) < 1 << 16 else "<u4"
    table, rest = pack_table(lexicon, "unit", "n", {}, broadcast_units, payload="ids", payload_dtype=kind)
    packed = spark.sparkContext.broadcast(table)
    pattern, spelled = model.pattern, spellings(model) if decoded else []
    spelling = spark.sparkContext.broadcast((np.cumsum([0, *map(len, spelled)]), np.frombuffer(b"".join(spelled), np.uint8)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, numbers = packed.value, np.dtype(kind)
        for b in slices(batches, max_bytes=SLICE):
            lists = [units(x, pattern) for x in b.column("text").to_pylist()]
            border = np.cumsum([0, *map(len, lists)])
            found = pa.array(list(chain.from_iterable(lists)), pa.string()).dictionary_encode()
            del lists
            at, keys = found.indices.to_numpy(), pc.replace_substring(found.dictionary, " ", SPACE).cast(pa.binary()).to_pylist()
            rows = t.find(keys)
            own, small = pick(t.offsets, t.payload, np.maximum(rows, 0)) if len(t.hashes) else (np.zeros(len(rows) + 1, np.int64), np.empty(0, numbers))
            lost = rows < 0
            if lost.any():  # units beyond the broadcast: a text's own, fetched by the join, or none yet
                extra = b.column("extra").to_pylist() if "extra" in b.schema.names else []
                more = {e["unit"].encode(): e["ids"] for x in extra for e in x or []}
                ids = [np.array(more.get(keys[i], []), numbers) if out else small[own[i]:own[i + 1]] for i, out in enumerate(lost.tolist())]
                lost &= np.array([k not in more for k in keys])
                own, small = np.cumsum([0, *map(len, ids)]), np.concatenate(ids)
            token, ids = spread(own, small, found.indices)
            gaps = np.concatenate([[0], np.cumsum(lost[at])])
            without = np.diff(gaps[border]) > 0
            missing = [[keys[i].decode() for i in np.unique(at[a:z][lost[at[a:z]]])] if out else [] for a, z, out in zip(border[:-1].tolist(), border[1:].tolist(), without.tolist())]
            back = []
            if decoded:
                per_id, raw = spelling.value
                inside, some = pick(per_id, raw, small.astype(np.int64))  # the bytes of each distinct unit, then those of the texts
                ends, text = spread(inside[own], some, found.indices)
                ends, text = ends[border].tolist(), text.tobytes()
                back.append(pa.array([None if out else text[a:z].decode("utf-8", "replace").removeprefix(" ") for a, z, out in zip(ends, ends[1:], without.tolist())], pa.string()))
            lengths = pa.array(token[border], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.ListArray.from_arrays(lengths, pa.array(ids.astype("<i4")), mask=pa.array(without)), *back, pa.array(missing, pa.list_(pa.string()))],
                [*names, "ids", *made, "missing"])

    made = ["decoded"] if decoded else []
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema) + ", ids array<int>, " + ("decoded string, " if decoded else "") + "missing array<string>"
    if rest is None:
        return docs.mapInArrow(look_up, schema).drop("missing")
    first = materialize(docs.mapInArrow(look_up, schema).withColumn("row", F.monotonically_increasing_id()), "sp-first")
    extra = (first.where("ids is null").select("row", F.explode("missing").alias("unit")).join(rest, "unit")
             .groupBy("row").agg(F.collect_list(F.struct("unit", "ids")).alias("extra")))
    late = first.where("ids is null").select("row", *names).join(extra, "row").select(*names, "extra")
    return first.where("ids is not null").select(*names, "ids", *made).unionByName(
        late.mapInArrow(look_up, schema).drop("missing"))


def decode(encoded: DataFrame, model: PieceModel, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids spell."""
    spelling = encoded.sparkSession.sparkContext.broadcast(spellings(model))

    @F.pandas_udf("string")
    def spell(column):  # noqa: ANN001, ANN202
        s = spelling.value
        return column.map(lambda x: "" if x is None else decode_ids(x, s))

    return encoded.withColumn(into, spell(F.col(ids)))
