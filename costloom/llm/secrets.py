"""Secret scans: fixed patterns, and character Markov models for strings without a pattern.

Base spans, leftmost and non-overlapping for each kind, shorter matches dropped:

* ``assign``: a password, secret, token or API key assignment, value of 6 characters or more;
* ``access``: ``AKIA`` identifiers of 20 characters or more;
* ``hex``: lower-case hexadecimal runs of 24 characters or more.

The method adds ``markov`` spans. Two first-order character Markov models are each the mean of one
trained on labelled samples and one trained on the whole corpus. Random strings: drawn strings
over the usual alphabets; the values of base spans. Ordinary identifiers: names of standard modules and what
is commonly built of them (constants, camel case, paths), numbers, dates, alphabets and repeated characters; all
other text of the corpus (one aggregate of 67 x 67 counts). Base spans are cut out of the runs of identifier
characters; what is left of a run, in pieces of 16 or more characters, is a secret if its
log-likelihood ratio per character, random against ordinary, exceeds the margin for its length: the mean ratio of ordinary
samples and ``deviations`` standard errors above it, so shorter pieces must stand out more, but never
less than ``least_margin``. UUIDs name things: they are cut out like base spans, but are no secrets. Nothing
else decides, so a random string of letters alone is found like any other.

Spans are code points, end exclusive. Defined cases: a null text is the empty text with no
spans; an empty table gives an empty result and leaves uniform models; repeated rows are
scanned each; a text or a run of any length is scanned whole; equal starts sort in the order
assign, access, hex, markov.
"""

from __future__ import annotations

import importlib
import math
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import documents, slices

KINDS = ("assign", "access", "hex", "markov")
# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

LEAST_RUN = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET)
_CODE = np.full(256, 255, np.uint8)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(SIZE)

Span = tuple[int, int, str]
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])")
#: Modules whose names, and those of their classes, are the labelled ordinary identifiers.
NAMED_BY = ("argparse", "ast", "base64", "builtins", "calendar", "codecs", "collections", "concurrent.futures", "configparser", "contextlib",
            "csv", "datetime", "decimal", "difflib", "email.message", "enum", "errno", "fractions", "functools", "gettext", "gzip", "hashlib",
            "html.parser", "http.client", "http.cookiejar", "inspect", "io", "ipaddress", "itertools", "json", "locale", "logging.handlers",
            "mimetypes", "multiprocessing", "numbers", "operator", "os", "pathlib", "pickle", "platform", "plistlib", "pprint", "queue", "random",
            "sched", "selectors", "shelve", "shutil", "signal", "smtplib", "socket", "socketserver", "ssl", "stat", "statistics", "string",
            "subprocess", "tarfile", "tempfile", "textwrap", "threading", "time", "tokenize", "traceback", "types", "typing", "unittest.mock",
            "urllib.parse", "urllib.request", "uuid", "warnings", "weakref", "xml.dom.minidom", "xml.etree.ElementTree", "xml.sax.handler", "zipfile")


@dataclass(frozen=True)
class ScanParams:
    least_margin: float = 0.35
    deviations: float = 4.5
    smoothing: float = 0.5


def base_spans(text: str) -> list[Span]:
    """A maximal hexadecimal run is what the pattern matches, so looking for long runs alone
    gives the same spans as dropping the short matches."""
    low = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    low += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    low += [(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]
    return low


def sort_spans(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def digest_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in sort_spans(spans))


def pair_counts(data: bytes) -> np.ndarray:
    """Counts of neighbouring identifier characters; pairs with any other byte do not count."""
    c = _CODE[np.frombuffer(data, np.uint8)]
    a, b = c[:-1], c[1:]
    ok = (a < SIZE) & (b < SIZE)
    return np.bincount(a[ok].astype(np.int64) * SIZE + b[ok], minlength=SIZE * SIZE)


def count_samples(docs: DataFrame) -> np.ndarray:
    """[random, ordinary] pair counts of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for b in slices(batches):
            whole, found = b.column("text").cast(pa.binary()), []
            for t in b.column("text").to_pylist():
                for m in ASSIGN.finditer(t):
                    if len(m[2]) >= LEAST_ASSIGN:
                        found.append(m[2])
                found += [m[0] for m in ACCESS.finditer(t) if len(m[0]) >= LEAST_ACCESS]
                found += HEX_LONG.findall(t)
            total[0] += pair_counts("\n".join(found).encode())
            total[1] += pair_counts(b"\n".join(whole.to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(total), pa.list_(pa.int64()))], ["class", "n"])

    n = SIZE * SIZE
    rows = (docs.select("text").mapInArrow(count, "class int, n array<long>")
            .select("class", F.posexplode("n").alias("pair", "n")).where("n > 0")
            .groupBy("class", "pair").agg(F.sum("n").alias("n")).collect())
    out = np.zeros((2, n), np.int64)
    for r in rows:
        out[r["class"], r["pair"]] = r["n"]
    out[1] = np.maximum(out[1] - out[0], 0)  # what is not a sample of random strings
    return out.reshape(2, SIZE, SIZE)


def ordinary_samples(rng: random.Random, rounds: int = 6000) -> list[str]:
    """Labelled ordinary identifiers; every kind is drawn alike."""
    names = set()
    for module in map(importlib.import_module, NAMED_BY):
        for name in dir(module):
            names.add(name)
            own = getattr(module, name, None)
            names.update(dir(own) if isinstance(own, type) else ())
    names = sorted(n.strip("_") for n in names if len(n.strip("_")) > 2)
    low = [n for n in names if n.islower()]
    out = []
    for _ in range(rounds):
        parts = [rng.choice(low) for _ in range(rng.randrange(2, 5))]
        words = "_".join(parts).split("_")
        camel = "".join(w.capitalize() for w in words)
        out += [rng.choice(names), "/" + "/".join(parts), "-".join(parts), "_".join(parts).upper(), camel, words[0] + "".join(w.capitalize() for w in words[1:]),
                "/".join(parts) + rng.choice(["", "2", "3", "64"]) + "/" + rng.choice(names)]
    for i in range(rounds // 20):
        out += [f"{rng.randrange(1990, 2040)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}", "".join(str((i + j) % 10) for j in range(20))]
    return out + [c * 30 for c in ALPHABET] * 100 + [string.ascii_lowercase, string.ascii_uppercase] * 100


def random_samples(rng: random.Random, rounds: int = 20_000) -> list[str]:
    letters = string.ascii_letters + string.digits
    return ["".join(rng.choices(letters + "+/" if i % 2 else letters, k=40)) for i in range(rounds)]


@dataclass(frozen=True)
class RatioModel:
    """Log ratio of every pair of characters; mean and deviation over ordinary samples."""

    ratio: np.ndarray
    mean: float
    deviation: float
    params: ScanParams

    def margin(self, n: int) -> float:
        """What a piece of n characters must exceed."""
        return max(self.params.least_margin, self.mean + self.params.deviations * self.deviation / math.sqrt(n - 1))

    def is_secret(self, piece: str) -> bool:
        c = _CODE[np.frombuffer(piece.encode(), np.uint8)]
        return self.ratio[c[:-1], c[1:]].mean() > self.margin(len(piece))


def train(corpus: np.ndarray, params: ScanParams = ScanParams()) -> RatioModel:
    """From the corpus's [random, ordinary] counts and the labelled samples."""
    own = np.stack([pair_counts("\n".join(x).encode()) for x in (random_samples(random.Random(1)), ordinary_samples(random.Random(2)))]).reshape(2, SIZE, SIZE)
    p = sum(0.5 * (c + params.smoothing) / (c + params.smoothing).sum(2, keepdims=True) for c in (own, corpus))
    ratio = np.log(p[0] / p[1])
    weight = own[1] / own[1].sum()
    mean = float((weight * ratio).sum())
    return RatioModel(ratio, mean, math.sqrt(float((weight * (ratio - mean) ** 2).sum())), params)


def pieces(a: int, z: int, base: list[Span]) -> Iterator[tuple[int, int]]:
    """What the base spans leave of a run, where ``LEAST_RUN`` characters or more."""
    for s, e, _ in sorted(base):
        if s < z and a < e:
            if s - a >= LEAST_RUN:
                yield a, s
            a = max(a, e)
    if z - a >= LEAST_RUN:
        yield a, z


def markov_spans(text: str, base: list[Span], model: RatioModel) -> list[Span]:
    out = []
    for m in RUN.finditer(text):
        named = [(m.start() + u.start(), m.start() + u.end(), "uuid") for u in UUID.finditer(m[0])]
        out += [(a, z, "markov") for a, z in pieces(*m.span(), [*base, *named]) if model.is_secret(text[a:z])]
    return out


def scan(docs: DataFrame, params: ScanParams = ScanParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, the columns of ``keep``, spans: array of (start, end, kind)) for each row."""
    docs = documents(docs, *keep)
    names = docs.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    model = docs.sparkSession.sparkContext.broadcast(train(count_samples(docs), params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for b in slices(batches):
            out = []
            for t in b.column("text").to_pylist():
                base = base_spans(t)
                spans = sort_spans(base + markov_spans(t, base, model.value))
                out.append([{"start": a, "end": z, "kind": k} for a, z, k in spans])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], [*names, "spans"])

    return docs.mapInArrow(run, f"{schema}, spans array<struct<start:int,end:int,kind:string>>")


def redact_text(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """``text`` with each stretch covered by spans replaced by one mask."""
    out, at = [], 0
    for a, z, _ in sorted(spans):
        if z <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = z
    return "".join(out) + text[at:]


def redact(scanned: DataFrame) -> DataFrame:
    """``scan``'s rows with ``redacted`` beside the text."""

    @F.pandas_udf("string")
    def clean(text, spans):  # noqa: ANN001, ANN202
        import pandas as pd
        return pd.Series([redact_text(t, [(s["start"], s["end"], s["kind"]) for s in ss]) if len(ss) else t for t, ss in zip(text, spans)])

    return scanned.withColumn("redacted", F.when(F.size("spans") == 0, F.col("text")).otherwise(clean("text", "spans")))


def summary(scanned: DataFrame) -> DataFrame:
    """Counts and digests of ``scan``'s spans, natively."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"),
                          F.sha2(text(F.filter("spans", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
                          text(F.col("spans")).alias("spans"))
