"""A corpus pipeline: quality, toxicity, line deduplication, near-duplicate documents, packing.

Each stage reads what the one before has written, and its decisions take effect. Near duplicates are decided
on five-word shingles at a similarity of 0.8; of a group one row stays, that with the least id (null ids last).
Texts without words are only grouped with rows of the same id and text. A document that line deduplication
leaves without text goes. The last stage packs what is left into sequences.

In every stage null and empty texts, repeated rows, null ids and columns of any other name pass without harm; an
empty table gives an empty one. What each stage makes of them is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.jaccard_join import jaccard_components
from valuemark.llm.line_dedup import dedup_lines
from valuemark.llm.packing import CAPACITY, packed_documents
from valuemark.llm.quality import good_documents
from valuemark.llm.toxicity import civil_documents
from valuemark.llm.common import discard, materialize, table, unused

SHINGLE_WORDS, SIMILARITY = 5, (80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score reaches 0.3. A null text is judged as an empty one; rows that repeat are judged alike."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays below one half. Null and empty texts have no clause and stay."""
    return civil_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and rows that they leave empty. Other rows keep their text, null too; equal rows lose the same lines."""
    cut, total = unused(docs.columns, "removed_lines_", "n_lines_")
    done = dedup_lines(docs, counts=(total, cut)).filter((F.col(cut) == 0) | (F.col("text") != ""))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col(cut) == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return done.select([F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that with the least id (null last), ties by a hash of the text.

    Rows are told apart by a number of their own, so rows that repeat an id, or have none, are grouped by their
    text like all others; texts without words are grouped with rows of the same id and text only.
    """
    row = unused(docs.columns, "row")[0]
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    groups = jaccard_components(keyed.select(F.col(row).alias("doc_id"), "text"), SHINGLE_WORDS, *SIMILARITY)
    rows = keyed.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("own"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"))
    placed = groups.withColumnRenamed("doc_id", "row").join(rows, "row")
    worded = F.col("n_shingles") > 0
    group = [F.when(worded, F.col("component_id")).alias("component"), *[F.when(~worded, F.col(c)).alias(f"bare_{c}") for c in ("own", "th")], worded.alias("worded")]
    first = F.min(F.struct(F.col("own").isNull().alias("last"), "own", "th", "row")).alias("first")
    stay = placed.groupBy(*group).agg(first).select(F.col("first.row").alias(row))
    return keyed.join(stay, row, "left_semi").select([F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places. A null text counts as empty: its end id is packed; rows that repeat are packed each."""
    import public_tokenizers

    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, with_ids=False)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("packing", packing),
]

#: Two stages learn from labels, which SQL cannot express; a test holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if before is not None:
            discard(before)  # its successor is whole
        before = docs
    return docs
