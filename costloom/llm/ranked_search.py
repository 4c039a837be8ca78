"""Ranked lexical search: for each item its best documents, exactly, by a dual-tree search.

Terms are maximal runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII characters. With N
documents that have terms, L terms in all of them, n in one, df documents that hold a term: its
weight w is floor(1000 ln((2N+2)/(2df+1))), a document's m is 50 + (50 n N div L), and its score sums
w * (10^9 tf div (1000 tf + 20 m)) over the item's distinct terms. The ``top`` highest scores above 0
are an item's result, equal scores by ascending doc_id.

1. ``match``: one pass over the documents keeps of each its length and the terms that any item has
   (as numbers, with tf), and one vector a task: N, L and df. These are summed in a tree.
2. ``search``: a task takes its matched documents in chunks. Documents that share their rarest
   terms stand side by side, and nodes of 8, 32, 128, ... of them hold each term's maximum; items
   form a tree of nodes of 4, 16, ... of them with each term's weight. Both trees are descended in turns:
   the dot product of two nodes bounds every score below them, and a pair is dropped if it is under
   the weakest ``top``-th score so far among the node's items. What is left at the leaves is scored.
3. Rounds over 1/64^r of the documents (by hash) come first. The ``top``-th score of any part is a
   lower bound of the whole's, so each round starts from bounds near the last one's and a task
   returns few rows; the result is exact. A window per item takes the best of all tasks.

Items go to the tasks in blocks of at most ``block_terms`` terms (one longer item is a block of its own);
every block is one pass over the documents. Nothing of the documents but N, L, df and each item's
bound reaches the driver.

Defined cases: null, empty and term-less texts have no score and do not count in N; a repeated
row is ranked again; a null doc_id comes last of equal scores; every row of items is an item of its own, also with
a repeated or null item_id; empty tables give an empty result; texts are used whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize, slices, sum_vectors, vector_rows

_KEEP = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
MATCHED = "doc_id long, n long, terms binary, counts binary, slot int, vector binary"


@dataclass(frozen=True)
class SearchParams:
    top: int = 50
    item_leaf: int = 4
    doc_leaf: int = 8
    fan: int = 4
    chunk: int = 4096
    block_terms: int = 400_000
    share: int = 64
    least_round: int = 2048
    cells: int = 4_000_000


def terms(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def number_items(items: DataFrame) -> DataFrame:
    """(row, item_id, text, size): every row of ``items`` under a written key."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.octet_length("text") / 2 + 1), "rs-items")


def item_blocks(items: DataFrame, block_terms: int) -> list[DataFrame]:
    """``items`` cut into parts that hold at most ``block_terms`` terms or one item."""
    total = items.agg(F.sum("size")).first()[0] or 0
    n = max(1, math.ceil(total / block_terms))
    while True:
        cut = items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
        sizes = cut.groupBy("block").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("c")).collect()
        if all(r["s"] <= block_terms or r["c"] == 1 for r in sizes):
            return [cut.where(F.col("block") == r["block"]).drop("block") for r in sizes]
        n = 2 * n + 1


def match(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of documents that hold a term of ``vocabulary``, and each
    partition's vector N, L, df."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(shared.value)}
        vector = np.zeros(2 + len(place), np.int64)
        names = [f.split()[0] for f in MATCHED.split(", ")]
        for b in slices(batches):
            found = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                words = terms(text)
                if words:
                    vector[0] += 1
                    vector[1] += len(words)
                    held, counts = np.unique(np.array([place[w] for w in words if w in place], "<u4"), return_counts=True)
                    if len(held):
                        vector[2 + held.astype(np.int64)] += 1
                        found.append((doc_id, len(words), held.tobytes(), counts.astype("<u4").tobytes()))
            k = len(found)
            if k:
                yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))),
                                                  pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        slots, blobs = vector_rows(vector)
        k = len(blobs)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), slots, blobs], names)

    return docs.select("doc_id", "text").mapInArrow(run, MATCHED)


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... (count of them) of every entry, one after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def level_sizes(n: int, leaf: int, fan: int) -> list[int]:
    """Sizes of a tree's nodes from single members to one node that holds all n."""
    out = [1]
    while out[-1] < n:
        out.append(leaf if len(out) == 1 else out[-1] * fan)
    return out


class ItemTree:
    """``rows[i]`` is the place in the given order of the tree's i-th item. A level lists its
    (term, node) entries by term; ``child`` is where an entry's entries start one level below."""

    def __init__(self, items: list[np.ndarray], n_terms: int, spread_of: np.ndarray, params: SearchParams):
        rank = np.argsort(np.argsort(-spread_of, kind="stable"))  # items that share frequent terms stand side by side
        self.rows = sorted(range(len(items)), key=lambda i: np.sort(rank[items[i]]).tolist())
        self.n, self.sizes = len(items), level_sizes(len(items), params.item_leaf, params.fan)
        term = np.concatenate([items[i] for i in self.rows]).astype(np.int64)
        item = np.repeat(np.arange(self.n), [len(items[i]) for i in self.rows])
        order = np.lexsort((item, term))
        term, node = term[order], item[order]
        self.levels, below = [], None
        for k, size in enumerate(self.sizes):
            if k:
                up = node // (size // self.sizes[k - 1])
                new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (up[1:] != up[:-1])]))
                below = np.append(new, len(term))
                term, node = term[new], up[new]
            self.levels.append((np.searchsorted(term, np.arange(n_terms + 1)), node, below))


def doc_levels(node: np.ndarray, term: np.ndarray, value: np.ndarray, sizes: list[int], n_terms: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(node, term, largest value) of every level of a chunk's tree."""
    out = [(node, term, value)]
    for k in range(1, len(sizes)):
        key = (node // (sizes[k] // sizes[k - 1])) * n_terms + term
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        value = np.maximum.reduceat(value[order], new)
        node, term = key[new] // n_terms, key[new] % n_terms
        out.append((node, term, value))
    return out


class Best:
    """The best ``top`` (score, doc_id) of each item so far, and the bounds they began with."""

    def __init__(self, n: int, top: int, bounds: np.ndarray):
        self.n, self.top, self.bounds = n, top, bounds
        self.rows = np.empty(0, np.dtype([("item", "<i4"), ("score", "<i8"), ("null", "?"), ("doc_id", "<i8")]))
        self.least = bounds.copy()

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> None:
        more = np.empty(len(item), self.rows.dtype)
        more["item"], more["score"], more["null"], more["doc_id"] = item, score, null, doc_id
        rows = np.concatenate([self.rows, more])
        rows = rows[np.lexsort((rows["doc_id"], rows["null"], -rows["score"], rows["item"]))]
        first = np.searchsorted(rows["item"], np.arange(self.n + 1))
        self.rows = rows[np.arange(len(rows)) - first[rows["item"]] < self.top]
        first = np.searchsorted(self.rows["item"], np.arange(self.n + 1))
        full = np.flatnonzero(np.diff(first) >= self.top)
        self.least[full] = np.maximum(self.bounds[full], self.rows["score"][first[full] + self.top - 1])


def search_chunk(tree: ItemTree, best: Best, weight: np.ndarray, doc_id: np.ndarray, null: np.ndarray, doc: np.ndarray, term: np.ndarray,
                 value: np.ndarray, params: SearchParams) -> int:
    """Adds to ``best`` what a chunk of documents holds; ``value`` is a term's share of the score
    without its weight. Returns how many pairs of a document and an item were scored."""
    n_docs, n_terms = len(doc_id), len(weight)
    # documents by their rarest term, then by the rarest of the others
    lead = np.lexsort((term, -weight[term], doc))
    first = np.searchsorted(doc[lead], np.arange(n_docs))
    second = np.minimum(first + 1, np.append(first[1:], len(lead)) - 1)
    order = np.lexsort((term[lead[second]], term[lead[first]]))
    place = np.empty(n_docs, np.int64)
    place[order] = np.arange(n_docs)
    doc_id, null, doc = doc_id[order], null[order], place[doc]
    sizes = level_sizes(n_docs, params.doc_leaf, params.fan)
    levels = doc_levels(doc, term, value, sizes, n_terms)
    path = [(len(sizes) - 1, len(tree.sizes) - 1)]
    while path[-1] != (0, 0):  # items first, so that a node of documents meets single items before it is opened
        d, i = path[-1]
        path.append((d, i - 1) if i and (i >= d or not d) else (d - 1, i))
    alive, scored = np.ones((1, 1), bool), 0
    for (dp, ip), (d, i) in zip([path[0], *path], path):
        node, t, v = levels[d]
        up = node // (sizes[dp] // sizes[d])
        some = alive.any(1)[up]
        node, t, v, up = node[some], t[some], v[some] * weight[t[some]], up[some]
        at = np.argsort(node, kind="stable")
        node, t, v, up = node[at], t[at], v[at], up[at]
        starts, parents, below = tree.levels[ip]
        width, high = -(-tree.n // tree.sizes[i]), -(-n_docs // sizes[d])
        least = np.minimum.reduceat(best.least, np.arange(0, tree.n, tree.sizes[i]))
        final = d == 0 and i == 0
        after = np.zeros((0, 0), bool) if final else np.zeros((high, width), bool)
        rows = max(1, params.cells // width)
        for a in range(0, high, rows):
            z = min(a + rows, high)
            x, y = np.searchsorted(node, (a, z))
            total = np.zeros((z - a) * width)
            cuts = np.flatnonzero(np.diff(np.cumsum(starts[t[x:y] + 1] - starts[t[x:y]]) // params.cells)) + 1
            for s, e in zip([x, *(x + cuts)], [*(x + cuts), y]):
                count = starts[t[s:e] + 1] - starts[t[s:e]]
                entry, source = spread(starts[t[s:e]], count), np.repeat(np.arange(s, e), count)
                open_ = alive[up[source], parents[entry]]
                entry, source = entry[open_], source[open_]
                if ip != i:
                    count = below[entry + 1] - below[entry]
                    nodes, source = tree.levels[i][1][spread(below[entry], count)], np.repeat(source, count)
                else:
                    nodes = parents[entry]
                total += np.bincount((node[source] - a) * width + nodes, v[source].astype(float), len(total))
            total = total.reshape(z - a, width)
            near = (total > 0) & (total >= least)
            if not final:
                after[a:z] = near
                continue
            scored += int((total > 0).sum())
            r, c = np.nonzero(near)
            best.add(c, total[r, c].astype(np.int64), null[a + r], doc_id[a + r])
            least = best.least
        alive = after
    return scored


def run_search(matched: DataFrame, tree: ItemTree, weight: np.ndarray, totals: tuple[int, int], bounds: np.ndarray, params: SearchParams) -> DataFrame:
    """(item, score, doc_id): each task's best rows at or above the bounds; ``item`` is a place in the tree."""
    sc = matched.sparkSession.sparkContext
    shared = sc.broadcast((tree, weight, bounds))
    n_docs, n_words = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, weight, bounds = shared.value
        best = Best(tree.n, params.top, bounds)
        for b in slices(batches, "terms", 1 << 20):
            for at in range(0, b.num_rows, params.chunk):
                c = b.slice(at, params.chunk)
                sizes = np.array([len(x) // 4 for x in c.column("terms").to_pylist()])
                term = np.frombuffer(b"".join(c.column("terms").to_pylist()), "<u4").astype(np.int64)
                tf = np.frombuffer(b"".join(c.column("counts").to_pylist()), "<u4").astype(np.int64)
                n = c.column("n").to_numpy()
                m = 50 + (50 * n * n_docs) // n_words
                doc = np.repeat(np.arange(len(n)), sizes)
                value = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
                ids = c.column("doc_id")
                search_chunk(tree, best, weight, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), doc, term, value, params)
        r = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(r["item"].copy()), pa.array(r["score"].copy()), pa.array(r["doc_id"].copy(), mask=r["null"].copy())], ["item", "score", "doc_id"])

    return matched.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item int, score long, doc_id long")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, items: DataFrame, params: SearchParams) -> DataFrame:
    """(row, rank, doc_id, score) for one block of items."""
    spark = docs.sparkSession
    block = [(r["row"], terms(r["text"].encode())) for r in items.select("row", "text").collect()]
    block = sorted((row, sorted(set(words))) for row, words in block if words)
    vocabulary = sorted({t for _, words in block for t in words})
    if not block:
        return spark.createDataFrame([], "row long, rank int, doc_id long, score long")
    matched = materialize(match(docs, vocabulary), "rs-matched")
    vector = sum_vectors(matched.where("slot is not null").select("slot", "vector"))
    if not len(vector) or not vector[0]:
        return spark.createDataFrame([], "row long, rank int, doc_id long, score long")
    n_docs, n_words, df = int(vector[0]), int(vector[1]), vector[2:]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    place = {t: i for i, t in enumerate(vocabulary)}
    tree = ItemTree([np.array([place[t] for t in words], np.int64) for _, words in block], len(vocabulary), df, params)
    rows = matched.where("slot is null")
    found, bounds = rows.count(), np.zeros(tree.n, np.int64)
    share = 1
    while found // (share * params.share) >= params.least_round:
        share *= params.share
    while share > 1:
        some = rows.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(share)) == 0)
        last = ranked(run_search(some, tree, weight, (n_docs, n_words), bounds, params), params.top).where(F.col("rank") == params.top)
        for item, score in last.select("item", "score").collect():
            bounds[item] = max(bounds[item], score)
        share //= params.share
    best = ranked(run_search(rows, tree, weight, (n_docs, n_words), bounds, params), params.top)
    keys = spark.createDataFrame([(i, block[r][0]) for i, r in enumerate(tree.rows)], "item int, row long")
    return best.join(F.broadcast(keys), "item").select("row", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score) for all rows of ``items`` (item_id, text) against all of
    ``docs`` (doc_id, text)."""
    docs, listed = documents(docs), number_items(items)
    out = None
    for block in item_blocks(listed, params.block_terms):
        part = search_block(docs, block, params)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return listed.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.join(listed.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")
