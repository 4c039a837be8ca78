"""Toxicity: a factorization machine over hashed terms.

Terms are the distinct lower-cased words (``\\w+``) of a text and their first 3 to 6 and last 4 and 5
characters, hashed to ``2 ** bits`` places. From a sample of at most ``max_train`` labelled rows (a documented
bound; the rows with the smallest hash of doc_id, so the same at every size) the terms whose likelihood
ratio between the classes stands out among all terms tried (twice the logarithm of their number) become features,
however few texts hold them: at most the ``max_terms`` most telling ones, the size of the model. Terms are counted by Spark; the driver
gets the features' counts and, of each sampled text, the features it holds.
The machine
    w0 + sum w_i + 1/2 * sum_f ((sum_i v_if)^2 - sum_i v_if^2)
is fitted on that sample by Adagrad with the logistic loss; the pairwise part learns
combinations (an insult with the mention of a group) that single weights miss. Scoring runs
over every whole text.

Defined cases: a null text is the empty text, its score follows from w0; label rows with a
null doc_id or label are left out, a document labelled twice counts once (mean of its labels
at least one half); without both classes among the training rows every score is the smoothed
share of class 1; an empty table gives an empty result; repeated rows are scored each; a text
of any length is scored whole; terms that tell the classes apart equally are taken in the order of their places.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize, remainder, slices
from costloom.llm.quality import clean_labels

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class MachineParams:
    bits: int = 26
    max_train: int = 20_000
    max_terms: int = 4096
    factors: int = 8
    epochs: int = 25
    rate: float = 0.1
    l2: float = 1e-4
    seed: int = 17


def word_terms(word: str, bits: int) -> list[int]:
    """Places of one word's terms."""
    own = [word, *("^" + word[:k] for k in (3, 4, 5, 6) if len(word) > k), *(word[-k:] + "$" for k in (4, 5) if len(word) > k)]
    return [zlib.crc32(t.encode()) >> (32 - bits) for t in own]


class TermCache(dict):
    """Terms of words, remembered between the texts of a task; ``only`` keeps just those places."""

    def __init__(self, bits: int, only: frozenset[int] | None = None, limit: int = 300_000):
        super().__init__()
        self.bits, self.only, self.limit = bits, only, limit

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        self[word] = got = tuple(p for p in word_terms(word, self.bits) if self.only is None or p in self.only)
        return got

    def text(self, text: str) -> np.ndarray:
        """Sorted distinct places of the text's terms."""
        return np.array(sorted(set().union(*map(self.__getitem__, set(WORD.findall(text.lower()))))), np.int32)


@dataclass
class Machine:
    places: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Margins of the rows whose feature indices lie one after the other."""
        pad = lambda a: np.concatenate([a, np.zeros((1, *a.shape[1:]))])
        total = lambda a: np.diff(pad(np.cumsum(np.concatenate([np.zeros((1, *a.shape[1:])), a]), 0))[starts], axis=0)
        s = total(self.v[index])
        return self.w0 + total(self.w[index]) + 0.5 * (s ** 2 - total(self.v[index] ** 2)).sum(1)

    def select(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Feature indices of the rows and the starts of the rows (one more than rows)."""
        flat = np.concatenate([*places, np.empty(0, np.int32)]).astype(np.int32)
        row = np.repeat(np.arange(len(places)), [len(p) for p in places])
        if not len(self.places):
            return np.empty(0, np.int64), np.zeros(len(places) + 1, np.int64)
        at = np.minimum(np.searchsorted(self.places, flat), len(self.places) - 1)
        ok = self.places[at] == flat
        return at[ok], np.concatenate([[0], np.cumsum(np.bincount(row[ok], minlength=len(places)))])


def share_margin(n1: int, n: int) -> float:
    return float(np.log((n1 + 0.5) / (n - n1 + 0.5)))


def count_terms(sample: DataFrame) -> DataFrame:
    """(place, seen, pos): how many sampled texts, and how many of class 1, hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "places", 8 << 20):
            flat = [np.frombuffer(x, np.int32) for x in b.column("places").to_pylist()]
            label = np.repeat(b.column("label").to_numpy(), [len(x) for x in flat])
            place, back = np.unique(np.concatenate(flat), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.bincount(back, minlength=len(place))),
                                              pa.array(np.bincount(back, label, len(place)).astype(np.int64))], ["place", "seen", "pos"])

    return (sample.select("label", "places").mapInArrow(count, "place int, seen long, pos long")
            .groupBy("place").agg(F.sum("seen").alias("seen"), F.sum("pos").alias("pos")))


def telling(counts: DataFrame, n1: int, n: int, params: MachineParams) -> list[int]:
    """Places of the features: terms with a likelihood ratio (G) above that of chance."""
    share = n1 / n
    part = lambda k, expected: F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    seen, pos = F.col("seen").cast("double"), F.col("pos").cast("double")
    g = 2 * (part(pos, seen * share) + part(seen - pos, seen * (1 - share)))
    tried = counts.count()
    best = counts.select("place", g.alias("g")).where(F.col("g") > 2 * math.log(max(tried, 2))).orderBy(F.desc("g"), "place").limit(params.max_terms)
    return sorted(r["place"] for r in best.collect())


def fit(features: list[int], places: list[np.ndarray], y: np.ndarray, params: MachineParams) -> Machine:
    """The machine over ``features`` for texts that hold ``places``."""
    empty = Machine(np.empty(0, np.int32), share_margin(int(y.sum()), len(y)), np.empty(0), np.empty((0, params.factors)))
    if not features:
        return empty
    best = np.array(sorted(features), np.int32)
    m = Machine(best, empty.w0, np.zeros(len(best)), np.empty(0))
    rng = np.random.default_rng(params.seed)
    m.v = rng.normal(0, 0.05, (len(best), params.factors))
    index, starts = m.select(places)
    g0, gw, gv = 1e-8, np.full(len(best), 1e-8), np.full(m.v.shape, 1e-8)
    rows = np.arange(len(y))
    for _ in range(params.epochs):
        rng.shuffle(rows)
        for batch in np.array_split(rows, max(1, len(rows) // 256)):
            parts = [index[starts[r]:starts[r + 1]] for r in batch]
            i = np.concatenate(parts)
            size = np.array([len(p) for p in parts])
            cuts = np.concatenate([[0], np.cumsum(size)])
            d = (1 / (1 + np.exp(-np.clip(m.margin(i, cuts), -40, 40))) - y[batch]) / len(batch)
            r = np.repeat(np.arange(len(batch)), size)
            s = np.zeros((len(batch), params.factors))
            np.add.at(s, r, m.v[i])
            w, v = params.l2 * m.w, params.l2 * m.v
            np.add.at(w, i, d[r])
            np.add.at(v, i, d[r, None] * (s[r] - m.v[i]))
            g0 += d.sum() ** 2
            gw += w ** 2
            gv += v ** 2
            m.w0 -= params.rate * d.sum() / np.sqrt(g0)
            m.w -= params.rate * w / np.sqrt(gw)
            m.v -= params.rate * v / np.sqrt(gv)
    return m


def train(texts: DataFrame, params: MachineParams) -> Machine:
    """From distinct sampled texts (label, places)."""
    n, n1 = (int(x or 0) for x in texts.agg(F.count(F.lit(1)), F.sum("label")).first())
    features = telling(count_terms(texts), n1, n, params) if 0 < n1 < n else []
    if not features:
        return Machine(np.empty(0, np.int32), share_margin(n1, n), np.empty(0), np.empty((0, params.factors)))
    wanted = texts.sparkSession.sparkContext.broadcast(np.array(features, np.int32))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.frombuffer(x, np.int32) for x in b.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("label"), pa.array([x[np.isin(x, wanted.value)].tobytes() for x in own], pa.binary())], ["digest", "label", "places"])

    got = sorted(texts.mapInArrow(keep, "digest long, label int, places binary").collect())
    return fit(features, [np.frombuffer(r["places"], np.int32) for r in got], np.array([r["label"] for r in got], float), params)


def sampled_texts(rows: DataFrame, labels: DataFrame, modulus: int, params: MachineParams) -> DataFrame:
    """(digest, places, label): distinct labelled texts that may teach, at most ``max_train`` documents."""
    known = clean_labels(labels, "toxic").where(remainder(F.col("doc_id"), modulus) != 0)
    chosen = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.max_train), "toxic-sample")
    bits = params.bits

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TermCache(bits)
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()), b.column("label"),
                 pa.array([cache.text(t).tobytes() for t in texts], pa.binary())], ["digest", "label", "places"])

    return materialize(rows.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
                       .mapInArrow(sample, "digest long, label int, places binary")
                       .groupBy("digest", "places").agg(F.max("label").alias("label")), "toxic-texts")


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, modulus: int = 5,
                    params: MachineParams = MachineParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; rows whose remainder is 0 never teach."""
    rows = documents(docs).withColumn("held_out", remainder(F.col("doc_id"), modulus) == 0)
    bits = params.bits
    model = train(sampled_texts(rows, labels, modulus, params), params)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = TermCache(bits, frozenset(m.places.tolist()))
        for b in slices(batches):
            margin = m.margin(*m.select([cache.text(t) for t in b.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(1 / (1 + np.exp(-np.clip(margin, -60, 60))))],
                                             ["doc_id", "held_out", "score"])

    return (rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
