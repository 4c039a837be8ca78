"""Language-model scoring with a probabilistic suffix tree over words.

A text is its words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end token; these
tokens are the symbols. A state is a run of up to ``depth`` preceding tokens of the text.

* counts: one pass gathers the count of every distinct word, and one pass a length gathers
  the runs of 2 .. ``depth`` + 1 words that occur ``LEAST`` times or more, at every size of
  corpus. A run can only be that frequent if the run without its last word and that word
  are, so each pass looks at extensions of the last pass's runs only. The passes read the
  texts as places in the word table (by the words' training counts), written once;
* while no length has more than ``broadcast_runs`` runs (counted before anything is
  collected), the tables of runs go to all tasks as broadcasts. Beyond, and for texts that
  surely have more, each position (a token and the ``depth`` before it) goes to a unit by the
  word before the token, in one exchange. So a unit has all positions of its contexts, counts
  their runs, tests and smooths them, and scores these positions; the texts get sums back;
* a context that occurs more than ``unit_tokens`` times (more in a large corpus, which has some
  ``MOST_UNITS`` units) has units of its own, which the word before the context chooses. Runs of
  such contexts are counted first, by ranges of their last words, and go to those units. Both
  ways give the same scores;
* divergence test: a context stays if n(context) * KL(next | context, next | its suffix) is
  at least ``min_divergence`` nats, next words below the count bound taken as one symbol;
* smoothing: P(w | context) = c(context, w) / (n + k) + rest * P(w | suffix), where rest is
  what the stored next words leave over; the empty context has the add-one unigrams;
* scoring: the longest kept suffix of the preceding tokens is the state of a token.

Defined cases: a null text is the empty text (one token, the end); an empty table gives an
empty result; repeated rows are counted and scored as often as they occur; a null doc_id
takes part with the empty id text; a word or a text of any length is scored whole; with no
training rows every probability is that of the empty counts.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import PackedTable, documents, materialize, pack_table, remainder, slices
from costloom.session import remove_stages

END = b"\xff"
LEAST = 2  # occurrences of a stored run
MOST_UNITS = 8000  # by which the tokens are divided for the size of a unit, if that is more than unit_tokens


@dataclass(frozen=True)
class TreeParams:
    depth: int = 3
    min_divergence: float = 6.0
    smoothing: float = 5.0
    broadcast_words: int = 8_000_000
    broadcast_runs: int = 1_500_000
    unit_tokens: int = 250_000


def word_list(text: bytes) -> list[bytes]:
    """bytes.lower and bytes.split treat exactly A-Z and space, \\t, \\n, \\v, \\f, \\r."""
    return text.lower().split()


def count_words(docs: DataFrame, max_pending: int = 300_000) -> DataFrame:
    """(word, train, total): occurrences in training rows and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            train, held = seen[True], seen[False]
            words = list(train.keys() | held.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()),
                 pa.array([train[w] + held[w] for w in words], pa.int64())], ["word", "train", "total"])
            train.clear()
            held.clear()
            return out

        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for t, is_train in zip(texts, b.column("train").to_pylist()):
                seen[is_train].update(word_list(t))
                seen[is_train][END] += 1
                if len(seen[True]) + len(seen[False]) > max_pending:
                    yield flush()
        if seen[True] or seen[False]:
            yield flush()

    return (docs.select("text", "train").mapInArrow(count, "word binary, train long, total long")
            .groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total")))


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


@dataclass
class Runs:
    """Frequent word runs of one length: sorted keys (index of the run without its last
    word, word) and counts; a run's index is its place."""

    keys: np.ndarray
    counts: np.ndarray

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Index of each run, or -1 (also where context or word is -1)."""
        if not len(self.keys):
            return np.full(len(word), -1, np.int64)
        k = pair_keys(context, word)
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where((context >= 0) & (word >= 0) & (self.keys[at] == k), at, -1)


@dataclass
class SuffixTree:
    """``words`` holds the counts of the frequent words, whose places are the symbols;
    ``levels[l]`` holds the runs of l + 2 words, thus the next words of contexts of l + 1
    words; ``kept[l]`` and ``rest[l]`` belong to those contexts."""

    params: TreeParams
    words: np.ndarray
    levels: list[Runs] = field(default_factory=list)
    kept: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)
    suffixes: np.ndarray | None = None

    def symbols(self, places: np.ndarray) -> np.ndarray:
        """Places of stored words (the first ones) are the symbols; -1 for other words."""
        return np.where(places < len(self.words), places, -1)

    def context_counts(self, level: int) -> np.ndarray:
        return self.words if level == 0 else self.levels[level - 1].counts

    def contexts(self, words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each token and l, the index of the context of l + 1 tokens before it, or -1.
        ``words`` are the tokens' indices, ``starts`` tells first tokens of texts."""
        out, inside = [], ~starts
        now = np.where(inside, np.concatenate([[-1], words[:-1]]), -1)
        for level in range(len(self.levels)):
            out.append(now)
            before = np.where(inside, np.concatenate([[-1], now[:-1]]), -1)
            last = out[0]
            now = self.levels[level].find(before, last)
        out.append(now)
        return out

    def log_probability(self, words: np.ndarray, starts: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """log10 P of each token, from ``unigram`` = log10 of its add-one probability."""
        p, k = 10.0 ** unigram, self.params.smoothing
        for level, context in enumerate(self.contexts(words, starts)[:len(self.levels)]):
            runs = self.levels[level]
            at = np.flatnonzero((context >= 0) & self.kept[level][context]) if len(self.kept[level]) else np.empty(0, int)
            c = context[at]
            i = runs.find(c, words[at])
            seen = np.where(i >= 0, runs.counts[i], 0) if len(runs.counts) else 0.0
            p[at] = seen / (self.context_counts(level)[c] + k) + self.rest[level][c] * p[at]
        return np.log10(p)

    def add_level(self, runs: Runs, unigram: np.ndarray) -> None:
        """Take the runs of the next length; test and smooth their contexts."""
        level, k = len(self.levels), self.params.smoothing
        self.levels.append(runs)
        n = self.context_counts(level).astype(float)
        context, word = (runs.keys >> np.uint64(32)).astype(np.int64), (runs.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        stored = np.bincount(context, runs.counts, len(n)).astype(float)
        suffix, lower = self._suffix_probability(level, context, word, unigram)
        share = runs.counts / np.maximum(n[context], 1)
        kl = np.bincount(context, share * np.log(share / lower), len(n)).astype(float)
        other, other_lower = np.maximum(1 - stored / np.maximum(n, 1), 0), np.maximum(1 - np.bincount(context, lower, len(n)), 1e-12)
        kl += np.where(other > 0, other * np.log(np.maximum(other, 1e-300) / other_lower), 0)
        self.suffixes = suffix
        self.kept.append(n * kl >= self.params.min_divergence)
        self.rest.append((np.maximum(n - stored, 0) + k) / (n + k))

    def _suffix_probability(self, level: int, context: np.ndarray, word: np.ndarray, unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix of each context of this level (index one level below; -1 at the lowest), and
        P(word | suffix of context) for each run."""
        n = len(self.context_counts(level))
        if level == 0:
            return np.full(n, -1, np.int64), 10.0 ** unigram[word]
        own = self.levels[level - 1]
        shorter, last = (own.keys >> np.uint64(32)).astype(np.int64), (own.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        suffix = last if level == 1 else self.levels[level - 2].find(self.suffixes[shorter], last)
        return suffix, self._probability(level - 1, suffix[context], word, unigram)

    def _probability(self, level: int, context: np.ndarray, word: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        if level < 0:
            return 10.0 ** unigram[word]
        shorter = self._shorten(level, context)
        p = self._probability(level - 1, shorter, word, unigram)
        on = (context >= 0) & self.kept[level][context]
        i = self.levels[level].find(context, word)
        seen = np.where(i >= 0, self.levels[level].counts[i], 0)
        return np.where(on, seen / (self.context_counts(level)[context] + self.params.smoothing) + self.rest[level][context] * p, p)

    def _shorten(self, level: int, context: np.ndarray) -> np.ndarray:
        if level == 0:
            return np.full(len(context), -1, np.int64)
        own = self.levels[level - 1]
        shorter, last = (own.keys >> np.uint64(32)).astype(np.int64), (own.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if level == 1:
            return np.where(context >= 0, last[context], -1)
        return np.where(context >= 0, self.levels[level - 2].find(self._shorten(level - 1, shorter[context]), last[context]), -1)


class WordCache:
    """Places of words in a packed table, remembered between the batches of a task."""

    def __init__(self, table: PackedTable, limit: int = 400_000):
        self.table, self.limit, self.at = table, limit, {}

    def lists(self, lists: list[list[bytes]]) -> np.ndarray:
        if len(self.at) > self.limit:  # places are in the order of the counts: the frequent words stay
            self.at = {w: k for w, k in self.at.items() if 0 <= k < self.limit // 4}
        words = list(chain.from_iterable(lists))
        at = np.fromiter(map(self.at.get, words, repeat(-2)), np.int32, len(words))
        lacking = np.flatnonzero(at == -2).tolist()
        new = list({words[i] for i in lacking})
        row = self.table.find(new)
        self.at.update(zip(new, np.where(row >= 0, np.append(self.table.values["place"], -1)[row], -1).tolist()))
        at[lacking] = [self.at[words[i]] for i in lacking]
        return at


def place_words(docs: DataFrame, packed: Broadcast) -> DataFrame:
    """(row, doc_id, train, places, tail): each token's place in the table; words that are not
    in it have place -1 and stand in ``tail``. Rows are numbered by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(packed.value)
        done = TaskContext.get().partitionId() << 32
        for b in slices(batches):
            lists = [word_list(t) + [END] for t in b.column("text").cast(pa.binary()).to_pylist()]
            at = cache.lists(lists)
            ends = np.cumsum([len(x) for x in lists])
            out = at < 0
            tails = [[w for w, o in zip(ws, out[z - len(ws):z]) if o] for ws, z in zip(lists, ends)] if out.any() else [[]] * len(lists)
            places = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(done, done + b.num_rows)), b.column("doc_id"), b.column("train"), places, pa.array(tails, pa.list_(pa.binary()))],
                                             ["row", "doc_id", "train", "places", "tail"])
            done += b.num_rows

    return docs.mapInArrow(run, "row long, doc_id long, train boolean, places array<int>, tail array<binary>")


def token_parts(batches: Iterator[pa.RecordBatch], tokens: int = 400_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of the batches with their tokens' places one after the other, the place of each
    row's first token, and a mark on those."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = np.diff(b.column("places").offsets.to_numpy()).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // tokens)) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            part = b.slice(a, z - a)
            flat = part.column("places").flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(sizes[a:z]) - sizes[a:z]
            starts = np.zeros(len(flat), bool)
            starts[first] = True
            yield part, flat, first, starts


def count_runs(placed: DataFrame, tree: Broadcast, least: int, parts: int) -> DataFrame:
    """Runs one word longer than the tree's longest, as (keys, counts) blobs by key range.

    A task adds up its own runs first, so a run that fills a third of the corpus is one
    entry a task; ranges are by a hash of the key, hence even."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, pending, size = tree.value, [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(pending), return_counts=True)
            pending.clear()
            part = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [order[a:z] for a, z in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, r in enumerate(rows) if len(r)], pa.int32()),
                 pa.array([keys[r].tobytes() for r in rows if len(r)], pa.binary()),
                 pa.array([counts[r].astype("<u4").tobytes() for r in rows if len(r)], pa.binary())], ["part", "keys", "counts"])

        for _, places, _, starts in token_parts(batches):
            words = t.symbols(places)
            context = t.contexts(words, starts)[-1]
            ok = (context >= 0) & (words >= 0)
            pending.append(pair_keys(context[ok], words[ok]))
            size += len(pending[-1])
            if size > 3_000_000:
                yield flush()
                size = 0
        if pending:
            yield flush()

    def add(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("keys").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
        keys, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, counts).astype("<i8")
        keys, counts = keys[counts >= least], counts[counts >= least]
        return pa.table({"keys": pa.array([keys.astype("<u8").tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    return (placed.where("train").select("places").mapInArrow(count, "part int, keys binary, counts binary")
            .groupBy("part").applyInArrow(add, "keys binary, counts binary"))


def fit_tree(placed: DataFrame, frequent: np.ndarray, tokens: int, distinct: int, params: TreeParams) -> SuffixTree | None:
    """The tree, or None if a length has more runs than may be broadcast."""
    spark = placed.sparkSession
    unigram = np.log10(frequent + 1.0) - math.log10(tokens + distinct + 1)
    tree = SuffixTree(params, frequent)
    parts = max(12, 2 * placed.rdd.getNumPartitions())
    for _ in range(params.depth):
        shared = spark.sparkContext.broadcast(tree)
        written: list[str] = []
        runs = materialize(count_runs(placed, shared, LEAST, parts), "lm-runs", written)
        few = (runs.agg(F.sum(F.octet_length("keys"))).first()[0] or 0) <= 8 * params.broadcast_runs
        got = runs.collect() if few else []
        remove_stages(spark, written)
        if not few:
            return None
        keys = np.concatenate([np.frombuffer(r[0], "<u8") for r in got] or [np.empty(0, "<u8")])
        counts = np.concatenate([np.frombuffer(r[1], "<i8") for r in got] or [np.empty(0, "<i8")])
        del got
        order = np.argsort(keys)
        tree = replace(tree, levels=list(tree.levels), kept=list(tree.kept), rest=list(tree.rest), suffixes=tree.suffixes)
        tree.add_level(Runs(keys[order], counts[order]), unigram)
        shared.unpersist()
        if not len(keys):
            break
    return tree


def score_documents(docs: DataFrame, modulus: int = 7, held: int = 2, params: TreeParams = TreeParams()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    spark = docs.sparkSession
    docs = documents(docs).withColumn("train", remainder(F.col("doc_id"), modulus) != held)
    words = materialize(count_words(docs), "lm-words")
    n, v = words.agg(F.sum("train"), F.sum(F.when(F.col("train") > 0, 1).otherwise(0))).first()
    n, v = n or 0, v or 0
    unit = math.log10(n + v + 1)
    often = words.where(F.col("train") >= LEAST).count()
    whole = often <= params.broadcast_words  # else stored words lie beyond the table
    table, rest = pack_table(words, "word", "total", {"train": "<i4"}, params.broadcast_words, F.col("train") >= LEAST if whole else None)
    order = np.argsort(-table.values["train"], kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    train = np.append(table.values["train"][order], 0)  # place -1 has count 0
    stored = int((train >= LEAST).sum())
    placed = materialize(place_words(docs, spark.sparkContext.broadcast(PackedTable(table.hashes, {"place": place}))), "lm-places", codec="zstd")
    del table, order, place
    counts = spark.sparkContext.broadcast(train)
    fitted = None
    if whole and n <= 8 * params.broadcast_runs:
        fitted = fit_tree(placed, train[:stored].astype(np.int64), n, v, params)
    columns = ("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
    if fitted is None:
        tails = rest is not None and not whole
        scored = _score_units(_tail_symbols(placed, rest, len(train) - 1) if tails else placed, counts, stored, n, v, tails, params)
        if rest is not None and whole:  # the counts of other tails are known
            scored = _add_tail(materialize(scored, "lm-scored"), placed.where(~F.col("train")).select("row", "tail"), rest)
        return scored.select(*columns)
    tree = spark.sparkContext.broadcast(fitted)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, places, first, starts in token_parts(batches):
            c = counts.value[places]
            base = np.log10(c + 1.0) - unit
            model = tree.value.log_probability(tree.value.symbols(places), starts, base)
            add = lambda x: pa.array(np.add.reduceat(x, first))
            sizes = np.diff(np.append(first, len(places)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([not x for x in b.column("train").to_pylist()]), pa.array(sizes, pa.int64()),
                 add((c > 0).astype(np.int64)), add(base), add(model), b.column("tail")],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"])

    scored = placed.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                                    "score double, tail array<binary>")
    if rest is not None:
        scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
        scored = _add_tail(scored, scored.select("row", "tail"), rest)
    return scored.select(*columns)


def _add_tail(scored: DataFrame, tails: DataFrame, rest: DataFrame) -> DataFrame:
    """Counts of words beyond the broadcast table: one shuffle of just their occurrences.
    Such a word is rarer than any stored run and was scored with count 0, so its true count
    adds log10(c + 1) to both sums."""
    sums = (tails.select("row", F.explode("tail").alias("word")).groupBy("row", "word").count()
            .join(rest, "word").groupBy("row")
            .agg(F.sum(F.when(F.col("train") > 0, F.col("count")).otherwise(0)).alias("k"),
                 F.sum(F.log10(F.col("train") + 1.0) * F.col("count")).alias("b")))
    add = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    return scored.join(sums, "row", "left").select("doc_id", "held_out", "n_tokens", add("n_known", "k"),
                                                   add("base_score", "b"), add("score", "b"))


def _tail_symbols(placed: DataFrame, rest: DataFrame, size: int) -> DataFrame:
    """``placed`` with the training counts of its tails' words and their symbols beside them: numbers from
    ``size`` (that of the table) on for words that occur ``LEAST`` times, else -1. One shuffle of those words."""
    rest = materialize(rest.select("word", F.col("train").alias("c"), F.monotonically_increasing_id().alias("id")), "lm-rest")
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    first, at = [], size
    for p, m in sorted(rest.groupBy(part.alias("p")).agg(F.max(place)).collect()):
        first.append((p, at))
        at += m + 1
    if at >= 1 << 31:
        raise ValueError("more distinct words than symbols")
    first = rest.sparkSession.createDataFrame(first, "p long, first long")
    symbol = F.when(F.col("c") >= LEAST, F.col("first") + place).otherwise(-1).cast("int")
    rest = rest.withColumn("p", part).join(F.broadcast(first), "p").select("word", "c", symbol.alias("s"))
    found = (placed.select("row", F.posexplode("tail").alias("at", "word")).join(rest, "word")
             .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "c", "s"))).alias("found")))
    beside = [F.coalesce(F.col(f"found.{x}"), F.array().cast(f"array<{t}>")).alias(name) for x, t, name in (("c", "long", "tail_train"), ("s", "int", "tail_symbol"))]
    return materialize(placed.join(found, "row", "left").select("row", "doc_id", "train", "places", *beside), "lm-tails", codec="zstd")


def history(symbols: np.ndarray, before: np.ndarray, depth: int) -> list[np.ndarray]:
    """The symbol 1 .. ``depth`` tokens before each token; -1 where the text has none, and before that."""
    out: list[np.ndarray] = []
    for level in range(1, depth + 1):
        x = np.full(len(symbols), -1, symbols.dtype)
        x[level:] = symbols[:-level]
        x[before < level] = -1
        if out:
            x[out[-1] < 0] = -1
        out.append(x)
    return out


@dataclass
class Heavy:
    """Contexts of 1 .. words that are too frequent for one unit. Those of one word are the places below
    ``words``; ``runs[l]`` are those of l + 2 words (index of the context without its last word, word),
    ``texts[l]`` the words of those of l + 1 words. n, rest, kept belong to those of l + 1 words."""

    words: int
    runs: list[Runs] = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    n: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)
    kept: list[np.ndarray] = field(default_factory=list)

    def ids(self, past: list[np.ndarray]) -> list[np.ndarray]:
        """Index of the context of 1 .. words before each token among the heavy ones, or -1. A heavy
        context's suffix and prefix are heavy."""
        out = [np.where(past[0] < self.words, past[0], -1).astype(np.int32)]
        for level in range(2, min(len(past), len(self.runs) + 1) + 1):
            on = np.flatnonzero((out[-1] >= 0) & (past[level - 1] >= 0))
            first = past[level - 1][on]
            at = np.where(first < self.words, first, -1).astype(np.int64)
            for j in range(level - 1):
                at = self.runs[j].find(at, past[level - 2 - j][on])
            out.append(np.full(len(past[0]), -1, np.int32))
            out[-1][on] = at
        return out

    def chain(self, level: int) -> list[np.ndarray]:
        """For the heavy contexts of ``level`` words, the index of their last 1 .. ``level`` words."""
        text = self.texts[level - 1]
        return self.ids([text[:, level - 1 - j] for j in range(level)])


@dataclass
class Corpus:
    """What the tasks of the units need to know: training counts by place (how many of them are
    symbols), training tokens and distinct words."""

    params: TreeParams
    counts: Broadcast
    stored: int
    tokens: int
    distinct: int
    tails: bool

    @property
    def columns(self) -> tuple[str, ...]:
        return ("train", "places", *(("tail_train", "tail_symbol") if self.tails else ()))

    def unigram(self, symbols: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """Add-one probability of symbols; ``tails`` are the counts of those beyond the table."""
        size = len(self.counts.value) - 1
        beyond = symbols >= size
        c = self.counts.value[np.where(beyond, -1, symbols)].astype(float)
        c[beyond] = tails
        return (c + 1) / (self.tokens + self.distinct + 1)

    def tail_counts(self, symbols: np.ndarray, c: np.ndarray) -> np.ndarray:
        return c[symbols >= len(self.counts.value) - 1]

    def tokens_of(self, part: pa.RecordBatch, places: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol of each token (-1: none), its training count, and how many tokens of its text stand before it."""
        symbols = np.where(places < self.stored, places, -1).astype(np.int32)
        c = self.counts.value[places].astype(np.int64)
        sizes = np.diff(np.append(first, len(places)))
        out = places < 0
        if out.any() and self.tails:
            symbols[out] = part.column("tail_symbol").flatten().to_numpy(zero_copy_only=False)
            c[out] = part.column("tail_train").flatten().to_numpy(zero_copy_only=False)
        elif out.any():  # a word beyond the table is no symbol, hence occurs once at most in training texts
            c[out] = np.repeat(part.column("train").to_numpy(zero_copy_only=False), sizes)[out]
        return symbols, c, np.arange(len(places)) - np.repeat(first, sizes)


def gathered(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about ``tokens`` tokens."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += len(b.column("places").flatten())
        if size > tokens:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def context_sums(context: np.ndarray, c: np.ndarray, n: np.ndarray, low: np.ndarray, size: int) -> list[np.ndarray]:
    """Of each context (``n`` is its count for each run): occurrences of stored runs, their lower
    probability, and their part of n * KL."""
    return [np.bincount(context, x, size).astype(float) for x in (c, low, c * np.log(c / n / low))]


def tested(n: np.ndarray, stored: np.ndarray, lows: np.ndarray, kl: np.ndarray, params: TreeParams) -> tuple[np.ndarray, np.ndarray]:
    """Which contexts stay, and what their stored next words leave over."""
    other, other_low = 1 - stored / np.maximum(n, 1), np.maximum(1 - lows, 1e-12)
    kl = kl + np.where(other > 0, n * other * np.log(np.maximum(other, 1e-300) / other_low), 0)
    return (stored > 0) & (kl >= params.min_divergence), (np.maximum(n - stored, 0) + params.smoothing) / (n + params.smoothing)


def _spread(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int64).view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)


HEAVY_ROWS = "part int, level int, keys binary, counts binary, tails binary"


def _heavy_runs(placed: DataFrame, tables: list[DataFrame], corpus: Corpus, shared: Broadcast, level: int, parts: int) -> DataFrame:
    """The stored runs whose context is a heavy one of ``level`` words, by ranges of their last word, and
    ``sums``, each context's share of its sums. ``tables`` has those of the shorter contexts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0

        def flush() -> pa.RecordBatch:
            keys, i, n = np.unique(np.concatenate([x for x, _ in pending]), return_index=True, return_counts=True)
            c = np.concatenate([x for _, x in pending])[i]
            pending.clear()
            symbol = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            part = _spread(symbol) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, order[a:z]) for p, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
            blobs = lambda f: pa.array([f(r).tobytes() for _, r in rows], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in rows], pa.int32()), pa.array([level] * len(rows), pa.int32()), blobs(lambda r: keys[r]),
                 blobs(lambda r: n[r].astype("<i8")), blobs(lambda r: corpus.tail_counts(symbol[r], c[r]))], ["part", "level", "keys", "counts", "tails"])

        for b, places, first, _ in token_parts(batches):
            symbols, c, before = corpus.tokens_of(b, places, first)
            context = shared.value.ids(history(symbols, before, level))[-1]
            ok = (context >= 0) & (symbols >= 0)
            pending.append((pair_keys(context[ok], symbols[ok]), c[ok]))
            size += len(pending[-1][0])
            if size > 3_000_000:
                yield flush()
                size = 0
        if size:
            yield flush()

    def add(table: pa.Table) -> pa.Table:
        heavy, rows = shared.value, table.to_pylist()
        read = lambda name, of, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows if r["level"] == of] or [np.empty(0, kind)])
        keys, counts, tails = read("keys", level, "<u8"), read("counts", level, "<i8"), read("tails", level, "<i8")
        low = corpus.unigram((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), tails)
        size, own = len(corpus.counts.value) - 1, np.zeros(len(keys), np.int64)
        own[(keys & np.uint64(0xFFFFFFFF)) >= size] = tails
        keys, i, at = np.unique(keys, return_index=True, return_inverse=True)
        counts = np.bincount(at, counts, len(keys)).astype("<i8")
        ok = counts >= LEAST
        keys, counts, low, own = keys[ok], counts[ok], low[i][ok], own[i][ok]
        context, symbol = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for shorter, suffix in enumerate(heavy.chain(level)[:-1], 1):
            k, order = read("keys", shorter, "<u8"), slice(None)
            order = np.argsort(k)
            under, x = Runs(k[order], read("counts", shorter, "<i8")[order]), suffix[context].astype(np.int64)
            place = under.find(x, symbol)
            seen = np.where(place >= 0, np.append(under.counts, 0)[place], 0)
            low = np.where(heavy.kept[shorter - 1][x], seen / (heavy.n[shorter - 1][x] + corpus.params.smoothing) + heavy.rest[shorter - 1][x] * low, low)
        sums = context_sums(context, counts, heavy.n[level - 1][context], low, len(heavy.n[level - 1]))
        some = np.flatnonzero(sums[0])
        sums = np.stack([some.astype(float), *(x[some] for x in sums)])
        return pa.table({"part": table.column("part")[:1], "level": pa.array([level], pa.int32()), "keys": pa.array([keys.astype("<u8").tobytes()], pa.binary()),
                         "counts": pa.array([counts.tobytes()], pa.binary()), "tails": pa.array([corpus.tail_counts(symbol, own).tobytes()], pa.binary()),
                         "sums": pa.array([sums.tobytes()], pa.binary())})

    found = placed.where("train").select(*corpus.columns).mapInArrow(count, HEAVY_ROWS)
    for t in tables:
        found = found.union(t.select("part", "level", "keys", "counts", "tails"))
    return found.groupBy("part").applyInArrow(add, f"{HEAVY_ROWS}, sums binary")


def fit_heavy(placed: DataFrame, corpus: Corpus, most: int, parts: int) -> tuple[Heavy, list[DataFrame]]:
    """The contexts that occur more than ``most`` times, and the tables of their stored runs."""
    spark, counts = placed.sparkSession, corpus.counts.value[:corpus.stored]
    words = int((counts > most).sum())  # places are in the order of the counts
    heavy, tables = Heavy(words, [], [np.arange(words).reshape(-1, 1)], [counts[:words].astype(np.int64)]), []

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                x = np.frombuffer(x).reshape(4, -1)
                yield pa.RecordBatch.from_arrays([pa.array(x[0].astype(np.int32)), *map(pa.array, x[1:])], ["context", "stored", "lows", "kl"])

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(*(b.column(x).to_pylist() for x in ("keys", "counts"))):
                k, c = np.frombuffer(k, "<i8"), np.frombuffer(c, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(k[c > most]), pa.array(c[c > most])], ["key", "c"])

    for level in range(1, corpus.params.depth + 1):
        n = heavy.n[-1]
        if not len(n):
            heavy.n.pop()
            heavy.texts.pop()
            heavy.runs = heavy.runs[:max(level - 2, 0)]
            break
        shared = spark.sparkContext.broadcast(heavy)
        table = materialize(_heavy_runs(placed, tables, corpus, shared, level, parts), f"lm-heavy-{level}", codec="zstd")
        tables.append(table)
        all_sums = np.zeros((3, len(n)))
        for context, *x in (table.select("sums").mapInArrow(sums, "context int, stored double, lows double, kl double")
                            .groupBy("context").agg(F.sum("stored"), F.sum("lows"), F.sum("kl")).collect()):
            all_sums[:, context] = x
        kept, rest = tested(n, *all_sums, corpus.params)
        heavy = replace(heavy, runs=list(heavy.runs), texts=list(heavy.texts), n=list(heavy.n), rest=[*heavy.rest, rest], kept=[*heavy.kept, kept])
        shared.unpersist()
        if level < corpus.params.depth:
            got = sorted(table.select("keys", "counts").mapInArrow(frequent, "key long, c long").collect())
            keys, c = np.array([r[0] for r in got], np.int64).astype(np.uint64), np.array([r[1] for r in got], np.int64)
            heavy.runs.append(Runs(keys, c))
            heavy.n.append(c)
            last = heavy.texts[-1][(keys >> np.uint64(32)).astype(np.int64)]
            heavy.texts.append(np.column_stack([last, (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]).reshape(len(keys), level + 1))
    return heavy, tables


@dataclass
class Units:
    """Places of the work: the first ``light`` units take the positions after light words, by that word. Each
    heavy context has ``shares[l]`` units of its own from ``first[l]`` on, by the word before the context."""

    light: int
    heavy: Heavy
    shares: list[np.ndarray]
    first: list[np.ndarray]
    total: int

    @classmethod
    def of(cls, heavy: Heavy, tokens: int, most: int) -> Units:
        light = max(1, math.ceil(1.5 * max(tokens - (int(heavy.n[0].sum()) if heavy.n else 0), 0) / most))
        shares, first, total = [], [], light
        for n in heavy.n:
            shares.append(-(-n // most))
            first.append(total + np.cumsum(shares[-1]) - shares[-1])
            total += int(shares[-1].sum())
        return cls(light, heavy, shares, first, total)

    def place(self, past: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        """The unit of each position. Where nothing longer than the heavy context decides, any of its units will do."""
        out = (_spread(past[0]) % np.uint64(self.light)).astype(np.int32)
        if not self.heavy.n:
            return out
        for level, ids in enumerate(self.heavy.ids(past)[:len(self.heavy.n)], 1):
            on = np.flatnonzero(ids >= 0)
            i, by = ids[on], rows[on]
            if level < len(past):
                by = np.where(past[level][on] >= 0, past[level][on], by)
            out[on] = self.first[level - 1][i] + (_spread(by) % self.shares[level - 1][i].astype(np.uint64)).astype(np.int64)
        return out

    def owner(self, unit: int) -> tuple[int, int]:
        """Length and index of the heavy context whose unit this is; (0, -1) for light words."""
        if unit < self.light:
            return 0, -1
        level = max(k for k, x in enumerate(self.first) if len(x) and x[0] <= unit)
        return level + 1, int(np.searchsorted(self.first[level], unit, "right")) - 1

    def readers(self) -> dict[tuple[int, int], list[int]]:
        """For each heavy context the units that look its runs up: its own, and those of contexts it is a suffix of."""
        out: dict[tuple[int, int], list[int]] = {}
        for level in range(1, len(self.heavy.n) + 1):
            chain = self.heavy.chain(level)
            for i in range(len(self.heavy.n[level - 1])):
                own = range(int(self.first[level - 1][i]), int(self.first[level - 1][i] + self.shares[level - 1][i]))
                for shorter in range(level):
                    out.setdefault((shorter + 1, int(chain[shorter][i])), []).extend(own)
        return out


PLANES = 4


def planes(a: np.ndarray, kind: str = "<u4") -> list[np.ndarray]:
    """The bytes of the numbers by their weight: the high ones are nearly all zero and compress."""
    v = np.ascontiguousarray(a.astype(kind)).view(np.uint8).reshape(len(a), -1)
    return [np.ascontiguousarray(v[:, k]) for k in range(v.shape[1])]


def numbers(parts: list[np.ndarray], kind: str = "<u4") -> np.ndarray:
    out = np.empty((len(parts[0]), len(parts)), np.uint8)
    for k, x in enumerate(parts):
        out[:, k] = x
    return out.reshape(-1).view(kind)


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def positions(placed: DataFrame, corpus: Corpus, units: Broadcast, tokens: int = 2_000_000) -> DataFrame:
    """(unit, level 0, data): the positions that follow a symbol, dealt out to the units."""
    depth = corpus.params.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in gathered(batches, tokens):
            for b, places, first, _ in token_parts(iter([whole]), 2 * tokens):
                symbols, c, before = corpus.tokens_of(b, places, first)
                past = history(symbols, before, depth)
                on = np.flatnonzero(past[0] >= 0)
                sizes = np.diff(np.append(first, len(places)))
                row = b.column("row").to_numpy() * 2 + b.column("train").to_numpy(zero_copy_only=False)
                row = np.repeat(row, sizes)[on]
                past = [x[on] for x in past]
                unit = units.value.place(past, row >> 1)
                order = np.argsort(unit.astype(np.uint16) if units.value.total <= 65536 else unit, kind="stable")
                unit, row, on = unit[order], row[order], on[order]
                symbols, c = symbols[on], c[on]
                new = np.append(True, (row[1:] != row[:-1]) | (unit[1:] != unit[:-1])) if len(row) else np.empty(0, bool)
                texts = np.flatnonzero(new)
                cuts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else np.empty(0, int)
                ends, of = np.append(cuts[1:], len(unit)), np.searchsorted(texts, np.append(cuts, len(unit)))
                per = np.diff(np.append(texts, len(unit)))
                step = np.diff(row[texts], prepend=0)
                step[of[:-1]] = row[texts[of[:-1]]]
                heads, columns = planes(step, "<i8") + planes(per), [y for x in (symbols, *(x[order] for x in past)) for y in planes(x + 1)]
                data = []
                for k, (a, z) in enumerate(zip(cuts.tolist(), ends.tolist())):
                    i, j = int(of[k]), int(of[k + 1])
                    tail = corpus.tail_counts(symbols[a:z], c[a:z]).astype("<i8").tobytes() if corpus.tails else b""
                    data.append(squeeze(b"".join([np.array([z - a, j - i], "<i8").tobytes(), *(x[i:j] for x in heads), *(x[a:z] for x in columns), tail])))
                for a in range(0, len(data), 200):
                    part = data[a:a + 200]
                    yield pa.RecordBatch.from_arrays([pa.array(unit[cuts[a:a + 200]]), pa.array([0] * len(part), pa.int32()), pa.array(part, pa.binary())], ["unit", "level", "data"])

    return placed.select("row", *corpus.columns).mapInArrow(run, "unit int, level int, data binary")


def looked_up(tables: list[DataFrame], units: Broadcast) -> DataFrame:
    """(unit, level, data): the stored runs of heavy contexts, for each unit that looks them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = units.value.readers()
        for b in batches:
            for level, keys, counts in zip(*(b.column(x).to_pylist() for x in ("level", "keys", "counts"))):
                keys, counts = np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<i8")
                cuts = np.append(np.flatnonzero(np.diff(keys >> np.uint64(32), prepend=np.uint64(1 << 32))), len(keys))  # the keys are sorted
                for a, z in zip(cuts, cuts[1:]):
                    data = squeeze(np.concatenate([(keys[a:z] & np.uint64(0xFFFFFFFF)).astype("<i8"), counts[a:z]]).tobytes())
                    to = readers[level, int(keys[a]) >> 32]
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([level] * len(to), pa.int32()), pa.array([data] * len(to), pa.binary())], ["unit", "level", "data"])

    found = tables[0].select("level", "keys", "counts")
    for t in tables[1:]:
        found = found.union(t.select("level", "keys", "counts"))
    return found.mapInArrow(run, "unit int, level int, data binary")


def unit_gains(unit: int, texts: list[bytes], tables: dict[int, list[bytes]], corpus: Corpus, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Row of each text of the unit, and what its positions add to the sum of log10 P over that of single words.

    All positions that share a context that is not heavy are in one unit, with all they need: counts of
    the context, of its runs, and of those of its suffixes; the rest comes from ``tables``."""
    params, k = corpus.params, corpus.params.smoothing
    heads: list[list[np.ndarray]] = [[] for _ in range(12)]
    columns: list[list[np.ndarray]] = [[] for _ in range(PLANES * (params.depth + 1))]
    firsts, tails, done = [], [], 0
    for data in texts:
        data = np.frombuffer(unsqueeze(data), np.uint8)
        n, m = map(int, data[:16].view("<i8"))
        at = 16
        for x in heads:
            x.append(data[at:at + m])
            at += m
        for x in columns:
            x.append(data[at:at + n])
            at += n
        firsts.append(np.full(1, done))
        tails.append(np.frombuffer(data[at:].tobytes(), "<i8"))
        done += m
    joined = [np.concatenate(x) for x in heads]
    step, per = numbers(joined[:8], "<i8"), numbers(joined[8:]).astype(np.int64)
    cuts = np.concatenate(firsts)
    total = np.cumsum(step)
    row = total - np.repeat(np.append(0, total[cuts[1:] - 1]), np.diff(np.append(cuts, done)))
    first = np.cumsum(per) - per
    train = np.repeat(row & 1, per).astype(bool)
    word, *past = (numbers([np.concatenate(x) for x in columns[PLANES * j:PLANES * (j + 1)]]).astype(np.int64) - 1 for j in range(params.depth + 1))

    known = word >= 0
    p = np.ones(len(word))  # for a word that is no symbol, only the factor of the contexts
    p[known] = corpus.unigram(word[known], np.concatenate(tails))
    start = p.copy()
    level, i = units.owner(unit)
    chain = [int(x[i]) for x in units.heavy.chain(level)] if level else []
    for j, x in enumerate(chain):
        if units.heavy.kept[j][x]:
            pairs = [np.frombuffer(unsqueeze(t), "<i8").reshape(2, -1) for t in tables.get(j + 1, [])]
            of, c = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
            order = np.argsort(of)
            of, c = np.append(of[order], np.iinfo(np.int64).max), np.append(c[order], 0)
            place = np.searchsorted(of, word)
            seen = np.where(of[place] == word, c[place], 0)
            p = seen / (units.heavy.n[j][x] + k) + units.heavy.rest[j][x] * p
    if level < params.depth:
        on = np.flatnonzero(past[level] >= 0)
        parent, stored = np.zeros(len(on), np.int64), word[on] >= 0
        for j in range(level, params.depth):
            # on: positions whose context one word shorter has stored runs; stored: their own run is one
            keys, context = np.unique(parent << 32 | past[j][on], return_inverse=True)
            n = np.bincount(context[train[on]], minlength=len(keys))
            at = np.flatnonzero(stored & (n[context] >= LEAST))
            runs, one, run = np.unique(context[at] << 32 | word[on[at]], return_index=True, return_inverse=True)
            c = np.bincount(run[train[on[at]]], minlength=len(runs))
            c[c < LEAST] = 0
            most = np.flatnonzero(c)
            of = runs[most] >> 32
            sums = context_sums(of, c[most], n[of], p[on[at[one[most]]]], len(keys))
            kept, rest = tested(n, *sums, params)
            seen = np.zeros(len(on))
            seen[at] = c[run]
            use = kept[context]
            x = context[use]
            p[on[use]] = seen[use] / (n[x] + k) + rest[x] * p[on[use]]
            if j + 1 < params.depth:
                use = (sums[0][context] > 0) & (past[j + 1][on] >= 0)
                on, parent, stored = on[use], context[use], seen[use] > 0
    return row >> 1, np.add.reduceat(np.log10(p / start), first)


BLOCK = 13  # bits of a row's place in its block


def _score_units(placed: DataFrame, counts: Broadcast, stored: int, n: int, v: int, tails: bool, params: TreeParams) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, n_known, base_score, score) with the runs in units.

    A position meets all others that share its context in one unit, by one exchange: a context's last
    word decides, and for a heavy context the word before it. Runs of heavy contexts are counted first."""
    spark, unit = placed.sparkSession, math.log10(n + v + 1)
    corpus = Corpus(params, counts, stored, n, v, tails)
    most = max(params.unit_tokens, n // MOST_UNITS)
    heavy, tables = fit_heavy(placed, corpus, most, max(12, n // 8_000_000))
    units = spark.sparkContext.broadcast(Units.of(heavy, n, most))

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size, now, texts, found = [], 0, None, [], {}

        def flush(first: int) -> Iterator[pa.RecordBatch]:
            rows, at = np.unique(np.concatenate([r for r, _ in pending]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([x for _, x in pending]))
            pending.clear()
            cuts = np.append(np.flatnonzero(np.diff(rows >> BLOCK, prepend=-1)), len(rows))
            for a, z in zip(cuts, cuts[1:]):
                data = squeeze(b"".join([*planes(rows[a:z] & (1 << BLOCK) - 1, "<u2"), *planes(sums[a:z], "<f8")]))
                yield pa.RecordBatch.from_arrays([pa.array([rows[a] >> BLOCK], pa.int64()), pa.array([first], pa.int32()), pa.array([data], pa.binary())], ["block", "unit", "data"])

        def end() -> int:
            if texts:
                pending.append(unit_gains(now, texts, found, corpus, units.value))
            texts.clear()
            found.clear()
            return sum(len(r) for r, _ in pending)

        for b in batches:
            for u, level, data in zip(*(x.to_pylist() for x in b.columns)):
                if u != now:
                    size = end()
                    if size > 4_000_000:
                        yield from flush(now)
                    now = u
                if level:
                    found.setdefault(level, []).append(data)
                else:
                    texts.append(data)
        if end():
            yield from flush(now)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, places, first, _ in token_parts(batches):
            _, c, _ = corpus.tokens_of(b, places, first)
            add = lambda x: pa.array(np.add.reduceat(x, first))
            row = b.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(row >> BLOCK), b.column("row"), b.column("doc_id"), pa.array([not x for x in b.column("train").to_pylist()]),
                 pa.array(np.diff(np.append(first, len(places)))), add((c > 0).astype(np.int64)), add(np.log10(c + 1.0) - unit)],
                ["block", "row", "doc_id", "held_out", "n_tokens", "n_known", "base_score"])

    def score(own: pa.Table, found: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK)
        for _, data in sorted(zip(found.column("unit").to_pylist(), found.column("data").to_pylist())):
            data = np.frombuffer(unsqueeze(data), np.uint8).reshape(10, -1)
            total[numbers(list(data[:2]), "<u2")] += numbers(list(data[2:]), "<f8")
        at = own.column("row").to_numpy() & (1 << BLOCK) - 1
        return own.drop_columns("block").append_column("score", pa.array(own.column("base_score").to_numpy() + total[at]))

    rows = positions(placed, corpus, units)
    if tables:
        rows = rows.union(looked_up(tables, units))
    width = max(12, min(500, math.ceil(n / 4_000_000)))
    added = rows.repartition(width, "unit").sortWithinPartitions("unit").mapInArrow(gains, "block long, unit int, data binary")
    known = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double"
    return (placed.select("row", "doc_id", *corpus.columns).mapInArrow(texts, f"block long, {known}").groupBy("block").cogroup(added.groupBy("block"))
            .applyInArrow(score, f"{known}, score double"))
