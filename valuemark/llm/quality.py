"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are words, those that most documents of a bounded labelled sample have, weighted by how rare they
are there; and its shape: runs of three character classes, and repeated words. Term shares are square-rooted,
centred and projected on the leading singular vectors of the sample (latent semantic analysis), so that texts
are alike that use words and shapes which go together, not only the same ones. The sample's vectors, at most
``2 * per_class`` of ``rank`` numbers, go to every task; each takes exact cosine products of its documents with
all of them in blocks, and the nearest neighbours vote with their labels, weighted by a power of their similarity.
"""

from __future__ import annotations

import functools
import operator
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.common import held_out, kept_rows, sliced, table, texts
from valuemark.llm.labelled import training_sample

PER_CLASS, RANK, NEIGHBOURS, POWER = 1500, 32, 15, 8
THRESHOLD = 0.3
BLOCK = 256
#: Words of the latent space, how much they count beside the shape, and the part of the sample that must have a word.
VOCABULARY, WORD_WEIGHT, LEAST_SHARE = 1000, 0.5, 0.002
WORDS = re.compile(r"[^\W\d_]+")

CLASSES = 11
_LETTER, _CAPITAL, _DIGIT, _SPACE, _LINE, _STOP, _CALL, _BAR, _SIGN, _OTHER, _HIGH = range(CLASSES)
TERMS = CLASSES**3 + 2


def _class_table() -> np.ndarray:
    of = np.full(256, _OTHER, "u1")
    for kind, chars in ((_LETTER, range(97, 123)), (_CAPITAL, range(65, 91)), (_DIGIT, range(48, 58)), (_SPACE, b" \t"), (_LINE, b"\n\r"), (_STOP, b".,;:"), (_CALL, b"!?"), (_BAR, b"|"), (_SIGN, b"%&$#*@^~=<>"), (_HIGH, range(128, 256))):
        of[list(chars)] = kind
    return of


CLASS_OF = _class_table()


def term_shares(texts: list[str], words: dict[str, int], rarity: np.ndarray) -> np.ndarray:
    """Square roots of the shares of each term, a row a text: the shape first, then ``words`` by their ``rarity``; zeros for an empty text."""
    out = np.zeros((len(texts), TERMS + len(words)), "f4")
    for row, text in zip(out, texts):
        cls = CLASS_OF[np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")].astype("i4")
        if len(cls) > 2:
            counts = np.bincount((cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:], minlength=TERMS - 2)
            row[: TERMS - 2] = np.sqrt(counts / (len(cls) - 2))
        parts = text.split()
        if len(parts) > 1:
            row[TERMS - 2] = np.sqrt(sum(map(operator.eq, parts, parts[1:])) / len(parts))
        row[TERMS - 1] = 1 / np.sqrt(1 + len(parts))
        found = WORDS.findall(text.lower()) if words else []
        known = [k for k in map(words.get, found) if k is not None]
        if known:
            row[TERMS:] = WORD_WEIGHT * np.sqrt(np.bincount(known, minlength=len(words)) / len(found)) * rarity
    return out


def vocabulary(sample: DataFrame, size: int = VOCABULARY) -> tuple[dict[str, int], np.ndarray]:
    """The words that most of the sample's documents have, at most ``size``, and their rarity (scaled inverse document frequency)."""
    total = sample.count()
    each = sample.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w")).filter("w <> ''")
    best = each.groupBy("w").count().filter(F.col("count") >= LEAST_SHARE * total).orderBy(F.desc("count"), "w").limit(size).collect()
    rarity = np.log1p(total / np.array([r["count"] for r in best], "f8")) if best else np.zeros(0)
    return {r.w: k for k, r in enumerate(best)}, (rarity / max(rarity.max(initial=0), 1e-9)).astype("f4")


def _sample_terms(batches, words: dict[str, int], rarity: np.ndarray):
    for b in sliced(batches):
        shares = term_shares(b.column("text").to_pylist(), words, rarity)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([r.tobytes() for r in shares], pa.binary())], ["doc_id", "y", "terms"])


def fit(sample: DataFrame, rank: int = RANK) -> dict:
    """Words, centre, projection, unit vectors and labels of the sample, which the driver may hold: its size is bounded."""
    words, rarity = vocabulary(sample)
    seen = functools.partial(_sample_terms, words=words, rarity=rarity)
    rows = sorted((r.doc_id, r.y, bytes(r.terms)) for r in sample.mapInArrow(seen, "doc_id long, y int, terms binary").collect())
    x = np.array([np.frombuffer(r[2], "f4") for r in rows]).reshape(len(rows), TERMS + len(words))
    y = np.array([r[1] for r in rows], "f4")
    centre = x.mean(0) if len(x) else np.zeros(x.shape[1], "f4")
    turn = leading(x - centre, rank)
    return {"words": words, "rarity": rarity, "centre": centre, "turn": turn, "vectors": _unit((x - centre) @ turn), "y": y}


def leading(x: np.ndarray, rank: int, more: int = 16, rounds: int = 12) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration with ``more`` vectors than are wanted."""
    turn = np.random.default_rng(7).normal(size=(x.shape[1], min(rank + more, x.shape[1]))).astype("f4")
    for _ in range(rounds):
        turn = np.linalg.qr(x.T @ (x @ turn))[0]
    along = np.linalg.svd((x @ turn).astype("f8"), full_matrices=False)[2]
    return np.ascontiguousarray(turn @ along.T[:, :rank].astype("f4"))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype("f4")


def votes(x: np.ndarray, model: dict, neighbours: int, power: float, share: float) -> np.ndarray:
    """Weighted share of ones among the nearest; the prior share where no neighbour is alike."""
    if not len(model["y"]):
        return np.full(len(x), share)
    k, out = min(neighbours, len(model["y"])), np.zeros(len(x))
    for at in range(0, len(x), BLOCK):
        cosines = _unit((x[at : at + BLOCK] - model["centre"]) @ model["turn"]) @ model["vectors"].T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, 1).astype("f8"), 0) ** power
        out[at : at + BLOCK] = (weight * model["y"][near]).sum(1) + 1e-6 * share
        out[at : at + BLOCK] /= weight.sum(1) + 1e-6
    return np.clip(out, 0, 1)


def scores(found: list[str], model: dict, neighbours: int, power: float, share: float) -> np.ndarray:
    blocks = (found[i : i + BLOCK] for i in range(0, len(found), BLOCK))
    return np.concatenate([np.zeros(0), *(votes(term_shares(b, model["words"], model["rarity"]), model, neighbours, power, share) for b in blocks)])


def _scored(batches, model: dict, neighbours: int, power: float, share: float):
    for b in sliced(batches):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores(b.column("text").to_pylist(), model, neighbours, power, share))], ["doc_id", "score"])


def _model(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[dict, float]:
    sample, share = training_sample(docs, labels, "quality", per_class)
    return fit(sample), share


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, neighbours: int = NEIGHBOURS, power: float = POWER) -> DataFrame:
    """doc_id and score (0 to 1, higher: rather quality 1) of every row, from its whole text alone.

    Null texts count as empty. Rows map one to one, repeated ids and null ids included; without labels every
    score is one half, with an empty table the result is empty.
    """
    model, share = _model(docs, labels, per_class)
    scored = functools.partial(_scored, model=model, neighbours=neighbours, power=power, share=share)
    return texts(docs).mapInArrow(scored, "doc_id long, score double")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose quality score reaches ``threshold``."""
    model, share = _model(docs, labels, per_class)
    return kept_rows(docs, functools.partial(_good, model=model, share=share, threshold=threshold))


def _good(found: list[str], model: dict, share: float, threshold: float) -> np.ndarray:
    return scores(found, model, NEIGHBOURS, POWER, share) >= threshold


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
