"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact check.

For each benchmark item of L words, every window of L words of a document is a candidate
place; a document of fewer words is one window as a whole. A window is worth a fingerprint only if it can pass the exact check, for which it must
share a shingle with the item: one Aho-Corasick pass over the normalised text (lower-case
words, ``\\w+``, single spaces) finds all shared shingles, and only windows with enough of
those to pass are fingerprinted. So this search chooses the windows, and of what follows:

* SimHash: 64 bits, each the sign of the sum of the shingles' hash bits, weighted by how
  often the shingle occurs in the window;
* multi-index blocks: the fingerprints are cut into 8 blocks of 8 bits; item fingerprints are
  listed under every block value within ``radius // 8`` bits. Two fingerprints within
  ``radius`` bits have such a block, so a lookup in the task by (item length, block, value)
  finds all pairs within the radius; true matches beyond it (rare) are dropped;
* exact check: weighted Jaccard similarity of the two shingle multisets (sum of the smaller
  over sum of the larger counts) of at least ``percent`` / 100.

The benchmark is taken in blocks of at most ``block`` items, each small enough for a
broadcast, so its size never bounds the job.

Defined cases: null texts are empty and match nothing; an item with fewer than ``width`` words
has no shingle and matches nothing; an item repeated under several ids matches under each; a
null item_id or doc_id is carried along; empty tables give an empty result; repeated rows
match each; texts of any length are searched whole. Of equally similar windows the first
counts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize

WORD = re.compile(r"\w+")
BLOCKS, BLOCK_BITS = 8, 8
MATCH = "doc_id long, item_id long, start_word int, end_word int, hamming int, similarity double"


@dataclass(frozen=True)
class MatchParams:
    width: int = 5
    percent: int = 80
    radius: int = 20
    block: int = 5000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles_of(words: list[str], width: int) -> list[str]:
    return [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]


def simhash(counts: dict[str, int]) -> int:
    h = np.fromiter((xxhash.xxh64_intdigest(s) for s in counts), np.uint64, len(counts))
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64) * 2 - 1
    total = (bits * np.fromiter(counts.values(), np.int64, len(counts))[:, None]).sum(0)
    return int(np.packbits(total > 0).view(np.uint64)[0])


def weighted_similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def near_values(value: int, bits: int) -> Iterator[int]:
    """All 8-bit values within ``bits`` bits of ``value``."""
    return (v for v in range(1 << BLOCK_BITS) if (v ^ value).bit_count() <= bits)


class Index:
    """One block of benchmark items, ready for the tasks."""

    def __init__(self, items: list[tuple[int | None, str]], params: MatchParams):
        self.params, self.ids, self.sets, self.hashes, self.length = params, [], [], [], []
        self.places: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        owners: dict[str, dict[int, int]] = defaultdict(dict)
        for item_id, text in items:
            words = words_of(text)
            grams = shingles_of(words, params.width)
            if not grams:
                continue
            k, counts = len(self.ids), Counter(grams)
            h = simhash(counts)
            self.ids.append(item_id)
            self.sets.append(counts)
            self.hashes.append(h)
            self.length.append(len(words))
            for i, g in enumerate(grams):
                owners[g].setdefault(k, i)
            for block in range(BLOCKS):
                for v in near_values((h >> (block * BLOCK_BITS)) & 0xFF, params.radius // BLOCKS):
                    self.places[len(words), block, v].append(k)
        self.automaton = ahocorasick.Automaton()
        for g, own in owners.items():
            self.automaton.add_word(f" {g} ", (g.count(" ") + 1, sorted({self.length[k] for k in own})))
        if owners:
            self.automaton.make_automaton()

    def near(self, length: int, h: int) -> list[tuple[int, int]]:
        """(item, Hamming distance) of the items of that length within the radius."""
        found = {k for b in range(BLOCKS) for k in self.places.get((length, b, (h >> (b * BLOCK_BITS)) & 0xFF), ())}
        return [(k, d) for k in found if (d := (h ^ self.hashes[k]).bit_count()) <= self.params.radius]

    def search(self, text: str) -> list[tuple[int | None, int, int, int, float]]:
        """Best window of each item that the text holds."""
        words = words_of(text)
        if len(words) < self.params.width or not self.ids:
            return []
        line = f" {' '.join(words)} "
        # ends of shared shingles, by item length; a window must cover enough of them
        hits: dict[int, list[int]] = defaultdict(list)
        starts = None
        for end, (n, lengths) in self.automaton.iter(line):
            if starts is None:
                starts = np.cumsum([0] + [len(w) + 1 for w in words])
            first = int(np.searchsorted(starts, end)) - n
            for length in lengths:
                hits[length].append(first)
        best: dict[int, tuple[float, int, int, int]] = {}
        for length, at in hits.items():
            size = min(length, len(words))  # a shorter document is one window
            grams, own = length - self.params.width + 1, size - self.params.width + 1
            least = -(-(grams + own) * self.params.percent // (100 + self.params.percent))
            at, windows = np.array(sorted(at)), set()
            for a in at:
                windows.update(range(max(0, a - own + 1), min(a, len(words) - size) + 1))
            for a in sorted(windows):
                if np.searchsorted(at, a + own) - np.searchsorted(at, a) < least:
                    continue
                counts = Counter(shingles_of(words[a:a + size], self.params.width))
                for k, d in self.near(length, simhash(counts)):
                    s = weighted_similarity(counts, self.sets[k])
                    if 100 * s >= self.params.percent and (k not in best or (-s, a) < (-best[k][0], best[k][1])):
                        best[k] = (s, a, a + size, d)
        return [(self.ids[k], a, z, d, s) for k, (s, a, z, d) in sorted(best.items())]


def find_matches(docs: DataFrame, benchmark: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """One row for each document and item that it holds: the item's best window."""
    spark = docs.sparkSession
    docs = documents(docs)
    items = materialize(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                        .distinct().repartition(F.col("item_id")).select("item_id", "text", F.monotonically_increasing_id().alias("row")), "bench-items")
    n = items.count()
    blocks = max(1, -(-n // params.block))
    out = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("item_id", "text").collect()
        index = spark.sparkContext.broadcast((rows and [(r[0], r[1]) for r in rows]) or [])

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = Index(index.value, params)
            for batch in batches:
                found = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for m in own.search(t)]
                if found:
                    cols = list(zip(*found))
                    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                     ["doc_id", "item_id", "start_word", "end_word", "hamming", "similarity"])

        one = docs.mapInArrow(search, MATCH)
        out = one if out is None else out.unionByName(one)
    return out
