"""The queries of this package; ``__spark_entry__.py`` adds them when the package is there."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from costloom.llm.common import read_table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTES = "/opt/tokenizers/byte_bpe_50k.json"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def piece_model_path() -> str:
    return os.environ.get("PIECE_MODEL", PIECES)


def byte_model_path() -> str:
    return os.environ.get("BYTE_MODEL", BYTES)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from costloom.llm import sentencepiece as op
    model = op.load_model(piece_model_path())
    done = op.encode(_docs(spark, sf_dir), model, decoded=True)
    return done.select("doc_id", F.size("ids").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.col("text")).alias("round_trip"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from costloom.llm import chat as op
    from costloom.llm.common import remainder
    raw = op.transcript(read_table(spark, sf_dir, "conversations"))
    model = op.fit(raw.where(remainder(F.col("conv_id"), 5) != 0))
    return op.parse(raw, model)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import quality as op
    return op.score_documents(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import ngram_join as op
    return op.group_documents(_docs(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import decontaminate as op
    return op.find_matches(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import suffix_tree as op
    return op.score_documents(_docs(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import toxicity as op
    return op.score_documents(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import fingerprints as op
    return op.digest(_docs(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import secrets as op
    return op.summary(op.scan(_docs(spark, sf_dir)))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import warc as op
    return op.round_trip(read_table(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import bpe as op
    return op.encode(_docs(spark, sf_dir), op.load_model(byte_model_path()), decoded=True, then=op.DIGESTS)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import alignment as op
    return op.digest(_docs(spark, sf_dir), op.load(byte_model_path(), piece_model_path()))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from costloom.llm import ranked_search as op
    return op.search(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_toxicity": op7_toxicity,
    "op8_fingerprints": op8_fingerprints,
    "op9_secrets": op9_secrets,
    "op10_warc": op10_warc,
    "op11_bpe": op11_bpe,
    "op12_align": op12_align,
    "op13_search": op13_search,
}
SQL: dict[str, str] = {
    "op4_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.a = w.doc_id GROUP BY w.doc_id""",
    # base 32 of a SHA-1: each 10 hexadecimal digits are 40 bits, so 8 characters
    "op10_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT) >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1) for i in range(32)], '') AS payload_digest
  FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS leader FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < leader THEN leader END AS refers_to
FROM g""",
    "op13_search": r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM len),
w AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, big_n),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN w USING (t) JOIN tf USING (t) JOIN len USING (doc_id), total GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
}


def with_workers(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``f`` with Python workers on this machine importing the package from here; a cluster gets
    it by --py-files."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
        return f(spark, sf_dir)
    run.__name__ = f.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: with_workers(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
