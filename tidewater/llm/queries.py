"""One query for each operator, over its whole table, and DuckDB SQL where SQL can
express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import read_table

from .alignment import aligned_tokens
from .containment import contained_items
from .encoding import sample_pieces
from .exact_dedup import exact_groups, normalised
from .jaccard_join import jaccard_components
from .lm_scoring import lattice_scores
from .near_dedup import near_duplicates
from .secrets import secret_spans
from .sharding import kd_shards, with_slots
from .substring_dedup import substring_dedup
from .toxicity import fit_toxicity, toxicity_scores
from .warc import archive_pages
from .whitening import whiten

#: The vocabulary file; the environment may name another place.
MODEL = os.environ.get("TIDEWATER_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
#: The byte-level vocabulary, likewise.
BPE = os.environ.get("TIDEWATER_BPE", "/opt/tokenizers/byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_slots(kd_shards(read_table(spark, sf_dir, "documents"), shards=8))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(read_table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2(normalised(F.col("text")), 256).alias("text_sha256")
    )
    return exact_groups(docs, digest="text_sha256").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_pages(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(read_table(spark, sf_dir, "documents"), MODEL)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), n=4)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, read_table(spark, sf_dir, "labels")))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text, decoded again."""
    docs = read_table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(F.col("text"), 256))
    decoded = sample_pieces(docs, MODEL, carry=("text_sha256",), into="decoded")
    return decoded.select(
        "doc_id", "pieces", "n_pieces", "text_sha256", F.sha2("decoded", 256).eqNullSafe(F.col("text_sha256")).alias("lossless")
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_spans(read_table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    rank = lambda s: F.when(s.kind == "assign", 0).when(s.kind == "access", 1).otherwise(2)
    every = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s.start.alias("start"), rank(s).alias("rank"), s.end.alias("end"), s.kind.alias("kind"))),
        F.transform("decoded", lambda s: F.struct(s.start.alias("start"), rank(s).alias("rank"), s.end.alias("end"), s.kind.alias("kind"))),
    ))
    return out.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"),
        F.size("decoded").cast("long").alias("n_decoded"), "layers", "oversized",
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the items they hold."""
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers, and their pairs' document counts."""
    return aligned_tokens(read_table(spark, sf_dir, "documents"), BPE, MODEL)[0]


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"), components=32)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), n=5)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_substring_dedup, op3_exact_dedup, op4_warc, op5_lm_scoring, op6_near_dedup,
        op7_toxicity, op8_sentencepiece, op9_secret_scan, op10_decontamination,
        op11_alignment, op12_whitening, op13_jaccard_join,
    )
}

WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op4_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS hex FROM p),
             e AS (SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
                     substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                            ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest FROM d),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lead FROM e)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> lead THEN lead END AS refers_to
        FROM f""",
    "op2_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
             win AS (SELECT doc_id, i, sha256(array_to_string(w[i + 1 : i + 50], ' ')) AS h
                     FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM d)),
             late AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS lead FROM win) WHERE lead < doc_id),
             gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM late),
             flat AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS pos FROM d),
             kept AS (SELECT doc_id, count(gone.pos) AS n_removed, string_agg(x, ' ' ORDER BY flat.pos) FILTER (WHERE gone.pos IS NULL) AS kept
                      FROM flat LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_near_dedup": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
             s AS (SELECT doc_id, list_distinct(list_transform(range(0, greatest(len(w) - 3, least(len(w), 1))), lambda k: array_to_string(w[k + 1 : k + 4], ' '))) AS s FROM d),
             flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
             links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b USING (x) WHERE a.doc_id <> b.doc_id
                       GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
             reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, coalesce(m, doc_id) >= doc_id AS kept
        FROM s LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)""",
    "op13_jaccard_join": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
             s AS (SELECT doc_id, list_distinct(list_transform(range(0, greatest(len(w) - 4, least(len(w), 1))), lambda k: array_to_string(w[k + 1 : k + 5], ' '))) AS s FROM d),
             flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
             links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b USING (x) WHERE a.doc_id <> b.doc_id
                       GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
             reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
        FROM s LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)""",
    "op10_decontamination": rf"""
        WITH d AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
             i AS (SELECT item_id, text, {WORDS.format(LOWER.format('text'))} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
             m AS (SELECT DISTINCT least(len(w), 5) AS m FROM i WHERE len(w) > 0),
             ds AS (SELECT doc_id, list_distinct(list_transform(range(0, greatest(len(w) - m + 1, 0)), lambda k: array_to_string(w[k + 1 : k + m], ' '))) AS s FROM d, m),
             ix AS (SELECT item_id, list_distinct(list_transform(range(0, greatest(len(w) - 4, least(len(w), 1))), lambda k: array_to_string(w[k + 1 : k + 5], ' '))) AS s FROM i),
             flat AS (SELECT item_id, len(s) AS n_item, unnest(s) AS x FROM ix),
             hits AS (SELECT doc_id, item_id, n_item, count(*) AS n_shared
                      FROM (SELECT doc_id, unnest(s) AS x FROM ds) JOIN flat USING (x) GROUP BY ALL)
        SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
        FROM hits WHERE 100 * n_shared >= 80 * n_item""",
}
