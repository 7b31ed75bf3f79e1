"""A training corpus in five stages: toxic documents go, then exact and near
copies, then documents that hold benchmark passages; what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept; all but the last return the columns of ``documents``. Null, empty and
repeated rows follow the operators' own rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.containment import decontaminated
from tidewater.llm.encoding import sample_pieces
from tidewater.llm.exact_dedup import keep_first
from tidewater.llm.near_dedup import keep_one
from tidewater.llm.queries import MODEL
from tidewater.llm.toxicity import fit_toxicity, without_toxic
from tidewater.session import read_table, scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic (score 0.7 or more) go."""
    return without_toxic(docs, fit_toxicity(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space normalised), the smallest doc_id stays."""
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at 0.8, the smallest doc_id stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 of a benchmark item's five-word shingles go."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, and the sampled pieces of each text, their number and
    whether they decode to it again. Where ``docs`` has a column of one of those names
    itself, that one keeps its name and value and the new one ends in ``_new``."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"r{i}" for i, c in enumerate(docs.columns)])
    names = [c for c in plain.columns if c not in ("doc_id", "text")]
    tagged = plain.withColumn("digest", F.sha2(F.col("text"), 256))
    decoded = sample_pieces(tagged, MODEL, carry=(*names, "digest"), into="decoded")
    lossless = F.sha2("decoded", 256).eqNullSafe(F.col("digest")).alias("lossless")
    new = [c + "_new" if c in rest else c for c in ("pieces", "n_pieces", "lossless")]
    return decoded.select("doc_id", *names, "pieces", "n_pieces", lossless).toDF("doc_id", *rest, *new)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Scores, sketches and samples have no SQL form; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared
    folder and read again, so a lost executor repeats one stage at most."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
