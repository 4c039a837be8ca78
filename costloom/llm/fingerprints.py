"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only.

A text's shingles are its runs of ``width`` words (``\\s+`` splits them; a shorter text is one
shingle, a text without words has none), hashed to 64 bits. The sketch keeps every distinct
hash below ``fraction`` of the hash range; so sketches of any two texts are comparable, and
the sketch of a union is the union of the sketches below the lower bound. A text with fewer than ``least``
hashes below the bound keeps its ``least`` smallest instead and carries the bound that this
means (the largest kept hash, or none if all are kept), so short texts have usable sketches.

``likeness`` is the share of common hashes among all below the lower of two bounds (an
estimate of the Jaccard similarity); ``containment`` relates them to one side's.
Fingerprint string: the bound and the sorted hashes in hexadecimal, joined by "-".

``with_neighbours`` pairs each row with the next in descending doc_id order. The order
comes from a range sort of ids, lengths and text hashes alone; a document's text crosses the network once, and of the
next document only the piece the edit needs.

Defined cases: a null text is the empty text (empty sketch; two empty sketches are alike 1,
an empty and another 0); every row counts: of rows with one doc_id the shorter text comes first (of equals the
one with the smaller 64-bit hash), and rows with one doc_id and one text follow each other; a null doc_id comes
last; a single row is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import documents, materialize

HALF = 2.0 ** 63


def sketch(text: Column, width: int = 5, fraction: float = 0.125, least: int = 24) -> Column:
    """struct(bound, hashes): hashes are sorted longs; those up to ``bound`` are all there."""
    bound = F.lit(int(-HALF + fraction * 2 * HALF))
    words = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def of(w: Column) -> Column:
        long = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)),
                           lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(width)]))
        hashes = (F.when(F.size(w) >= width, long).when(F.size(w) > 0, F.array(F.aggregate(w, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x))))
                  .otherwise(F.array().cast("array<bigint>")))

        def choose(h: Column) -> Column:
            low = F.array_distinct(F.filter(h, lambda x: x <= bound))
            return _bind(low, lambda below: F.when(F.size(below) >= least, F.struct(bound.alias("bound"), F.array_sort(below).alias("hashes")))
                         .otherwise(_bind(F.array_sort(F.array_distinct(h)), lambda s: F.when(F.size(s) <= least, F.struct(
                             F.lit(2 ** 63 - 1).alias("bound"), s.alias("hashes"))).otherwise(F.struct(
                                 F.get(s, F.lit(least - 1)).alias("bound"), F.slice(s, 1, least).alias("hashes"))))))

        return _bind(hashes, choose)

    return _bind(words, of)


def _bind(value: Column, body) -> Column:  # noqa: ANN001
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(a: Column, b: Column) -> tuple[Column, Column, Column]:
    bound = F.least(a["bound"], b["bound"])
    below = lambda s: F.filter(s["hashes"], lambda h: h <= bound)
    return below(a), below(b), F.array_intersect(below(a), below(b))


def likeness(a: Column, b: Column) -> Column:
    x, y, both = _parts(a, b)
    n = F.size(x) + F.size(y) - F.size(both)
    return F.when(n == 0, F.lit(1.0)).otherwise(F.size(both) / n)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has."""
    x, _, both = _parts(a, b)
    return F.when(F.size(x) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(x))


def merge(a: Column, b: Column) -> Column:
    """Sketch of the union of two texts' shingles."""
    bound = F.least(a["bound"], b["bound"])
    return F.struct(bound.alias("bound"), F.array_sort(F.filter(F.array_union(a["hashes"], b["hashes"]), lambda h: h <= bound)).alias("hashes"))


def as_text(s: Column) -> Column:
    return F.concat_ws("-", F.lower(F.hex(s["bound"])), F.transform(s["hashes"], lambda h: F.lower(F.hex(h))))


#: What tells documents apart. Rows that agree in it are copies with one doc_id and one text.
#: ``id`` is 0 where ``none`` says that there is no doc_id, so the key has no nulls and plain joins and groups share exchanges.
KEY = ("id", "none", "n_chars", "digest")


def next_ids(docs: DataFrame) -> DataFrame:
    """KEY, copies, and KEY with ``p_`` for distinct documents with their
    number of copies: the document whose last copy each one follows in descending order. Ranks come from
    a range sort and the row counts of its parts."""
    order = materialize(docs.orderBy("none", F.col("id").desc(), "n_chars", "digest")
                        .select("*", F.monotonically_increasing_id().alias("place")), "fp-order")
    part = F.shiftright("place", 33)
    sizes = sorted((r[0], r[1]) for r in order.groupBy(part.alias("p")).count().collect())
    before, starts = 0, []
    for p, n in sizes:
        starts.append((p, before))
        before += n
    offsets = F.broadcast(docs.sparkSession.createDataFrame(starts, "p long, start long"))
    rank = (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("rank")
    ranked = materialize(order.join(offsets, part == F.col("p")).select(*KEY, "copies", rank), "fp-ranks")
    earlier = ranked.select(((F.col("rank") + 1) % max(before, 1)).alias("rank"), *[F.col(k).alias(f"p_{k}") for k in KEY])
    return ranked.join(earlier, "rank").drop("rank")


def edited_text(text: Column, n_chars: Column, piece: Column) -> Column:
    return F.concat(F.substring(text, F.lit(1), (n_chars - F.floor(n_chars / 3)).cast("int")), piece)


def first_part(text: Column, n_chars: Column) -> Column:
    """What the edit of a text of ``n_chars`` code points takes of the next."""
    return F.substring(text, F.lit(1), F.floor(n_chars / 3).cast("int"))


def with_neighbours(docs: DataFrame, width: int = 5, fraction: float = 0.125) -> DataFrame:
    """(doc_id, n_chars, text, sketch, edited, next_sketch) for each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = documents(docs, F.char_length(text).cast("long").alias("n_chars"), F.xxhash64(text).alias("digest")).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "n_chars", "digest", "text")
    order = materialize(next_ids(sized.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))), "fp-next")
    # grouped by the key of the joins that follow: the texts are exchanged this once
    own = sized.groupBy(*KEY).agg(F.min("text").alias("text"))
    base = (own.join(order, list(KEY))
            .select(*KEY, "copies", "text", *[f"p_{k}" for k in KEY], sketch(F.col("text"), width, fraction).alias("sketch")))
    following = base.select(*[F.col(f"p_{k}").alias(k) for k in KEY], first_part(F.col("text"), F.col("p_n_chars")).alias("piece"),
                            F.col("sketch").alias("next_sketch"))
    last = base.select(*KEY, "copies", "text", "sketch").join(following, list(KEY))
    # the last copy is followed by the next document, the others by a copy
    copies = F.when(F.col("copies") > 1, F.sequence(F.lit(1).cast("long"), F.col("copies"))).otherwise(F.array(F.col("copies")))
    each = last.withColumn("copy", F.explode(copies))
    end = F.col("copy") == F.col("copies")
    return each.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_chars", "text", "sketch",
                       edited_text(F.col("text"), F.col("n_chars"), F.when(end, F.col("piece")).otherwise(first_part(F.col("text"), F.col("n_chars")))).alias("edited"),
                       F.when(end, F.col("next_sketch")).otherwise(F.col("sketch")).alias("next_sketch"))


def digest(docs: DataFrame, width: int = 5, fraction: float = 0.125) -> DataFrame:
    """Fingerprints of the texts and their edited texts, and their likenesses."""
    rows = with_neighbours(docs, width, fraction).select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "sketch", "next_sketch",
        sketch(F.col("edited"), width, fraction).alias("edited_sketch"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
                       as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
