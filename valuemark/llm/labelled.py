"""A bounded sample of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuemark.llm.common import held_out, materialize, texts


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float]:
    """doc_id, text and y (0 or 1) of at most ``per_class`` labelled, not held-out documents of each class; and the share of ones.

    Rows are picked by a hash of their id, so every part of the table has the same chance; equal texts with
    equal labels count once. A document that has several labels is positive if any of them is; of several texts of
    one id that with the least hash counts, so the sample is bounded whatever ids repeat. The share of ones is that
    of all rows which may be learned from.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    share = known.agg(F.avg("y")).first()[0]
    picked = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most two times per_class rows of two numbers
    one = texts(docs).join(ids, "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    rows = one.groupBy(F.sha2("text", 256).alias("k"), "y").agg(F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id"))
    return materialize(rows.select("doc_id", "text", "y"), "labelled"), 0.5 if share is None else float(share)
