"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes ``FEATURES`` transformed statistics (lengths, shares of letters, capitals,
digits, punctuation and symbols, repetition of words and lines, entropy). Per class the mean
and covariance come from one distributed aggregate of sums and cross products over every
labelled training row. The covariance is shrunk, first to the classes' pooled covariance
(``pool``), then to a multiple of the identity (``ridge``), so it always has a Cholesky
factor; the factors are computed once and sent to the tasks. The score is
1 / (1 + exp(-d)) with d the difference of the two log densities (their Mahalanobis
distances and log determinants) plus the log odds of the classes, ``temper`` times.

Defined cases: a null text is the empty text and is scored like any other; a label row with
a null doc_id or label is left out; a document labelled twice counts once, as 1 if the mean
of its labels is at least one half; without training rows of both classes every score is the
share of class 1 (one half without any); an empty table gives an empty result; repeated
document rows are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize, remainder

FEATURES = ("chars", "words", "word_length", "letters", "capitals", "digits", "punctuation", "symbols",
            "distinct_words", "top_word", "repeated_lines", "entropy", "longest_word", "short_words", "line_length")
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CAPITALS, _DIGITS = np.zeros(256, bool), np.zeros(256, bool)
_CAPITALS[65:91], _DIGITS[48:58] = True, True
_PUNCTUATION, _SYMBOLS = np.zeros(256, bool), np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in ".,;:?'\"()-"]] = True
_SYMBOLS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = True


@dataclass(frozen=True)
class QualityParams:
    pool: float = 0.3
    ridge: float = 0.05
    temper: float = 0.5


def statistics(text: bytes) -> list[float]:
    n = len(text)
    b = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    words = text.split()
    w = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = int(b[_LETTERS].sum())
    p = b[b > 0] / max(n, 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return [np.log1p(n), np.log1p(len(words)), np.log1p(letters / w), letters / max(n, 1),
            np.sqrt(int(b[_CAPITALS].sum()) / max(letters, 1)), np.sqrt(int(b[_DIGITS].sum()) / max(n, 1)),
            np.sqrt(int(b[_PUNCTUATION].sum()) / w), np.sqrt(int(b[_SYMBOLS].sum()) / w),
            (len(counts) / w) * np.log1p(w) / 6, np.sqrt(max(counts.values(), default=0) / w),
            np.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0, float(-(p * np.log(p)).sum()) if n else 0.0,
            np.log1p(int(lengths.max())) if words else 0.0, float((lengths <= 3).mean()) if words else 0.0,
            np.log1p(w / max(len(lines), 1))]


def features(docs: DataFrame) -> DataFrame:
    """``docs`` without its text but with the array ``x`` of statistics."""
    keep = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    return docs.mapInArrow(run, f"{schema}, x array<double>")


def clean_labels(labels: DataFrame, column: str) -> DataFrame:
    """One row (doc_id, label) for each labelled document."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("double").alias("v"))
            .where("doc_id is not null and v is not null").groupBy("doc_id")
            .agg((F.avg("v") >= 0.5).cast("int").alias("label")))


@dataclass
class Discriminant:
    """means, inverse Cholesky factors and log determinants by class; ``prior`` is the log odds."""

    means: list[np.ndarray]
    whiten: list[np.ndarray]
    log_det: list[float]
    prior: float
    temper: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            d = np.full(len(x), self.prior)
        else:
            dens = [-0.5 * ((((x - m) @ w.T) ** 2).sum(1) + ld) for m, w, ld in zip(self.means, self.whiten, self.log_det)]
            d = self.temper * (dens[1] - dens[0]) + self.prior
        return 1 / (1 + np.exp(-np.clip(d, -60, 60)))


def fit(rows: DataFrame, params: QualityParams) -> Discriminant:
    """``rows`` holds label and x; only sums and cross products reach the driver."""
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    got = {r["label"]: r for r in rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p")).collect()}
    n = [got[k]["n"] if k in got else 0 for k in (0, 1)]
    if min(n) < 2:
        return Discriminant([], [], [], float(np.log((n[1] + 0.5) / (n[0] + 0.5))) if sum(n) else 0.0, params.temper)
    means, cov = [], []
    for k in (0, 1):
        m, c = np.array(got[k]["s"]) / n[k], np.zeros((d, d))
        for (i, j), v in zip(pairs, got[k]["p"]):
            c[i, j] = c[j, i] = v / n[k] - m[i] * m[j]
        means.append(m)
        cov.append(c)
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    whiten, log_det = [], []
    for c in cov:
        r = ((1 - params.pool) * c + params.pool * pooled) / np.outer(scale, scale)
        r = (1 - params.ridge) * r + params.ridge * max(np.trace(r) / d, 1e-6) * np.eye(d)
        low = np.linalg.cholesky(r)
        whiten.append(np.linalg.inv(low) / scale)
        log_det.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(means, whiten, log_det, float(np.log(n[1] / n[0])), params.temper)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 5,
                    params: QualityParams = QualityParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns of ``keep``, held_out, score, predicted) for each row; rows whose
    remainder is 0 never teach."""
    rows = documents(docs, *keep).withColumn("held_out", remainder(F.col("doc_id"), modulus) == 0)
    table = materialize(features(rows), "quality-features")
    model = fit(table.where(~F.col("held_out")).join(clean_labels(labels, "quality"), "doc_id").select("label", "x"), params)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(shared.value.score(x))], [*names, "score"])

    names = ["doc_id", *keep, "held_out"]
    schema = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names)
    return (table.mapInArrow(run, f"{schema}, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
