import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from valuemark.llm import quality as Q


def accuracy(rows, labels, column):
    kept = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return np.mean([r.predicted == y for r, y in kept]), np.mean([r.predicted for r, y in kept if y == 1])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = Q.op10_quality(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    right, kept = accuracy(rows, labels, "quality")
    assert right > 0.97 and kept > 0.99


def test_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    model = {"centre": np.zeros(6, "f4"), "turn": np.eye(6, 4, dtype="f4"), "vectors": Q._unit(rng.normal(size=(40, 4))), "y": (rng.random(40) < 0.5).astype("f4")}
    x = rng.normal(size=(9, 6)).astype("f4")
    got = Q.votes(x, model, 5, 2, 0.5)
    for row, score in zip(x, got):
        v = row[:4] / np.linalg.norm(row[:4])
        near = sorted(((float(m @ v), y) for m, y in zip(model["vectors"], model["y"])), reverse=True)[:5]
        w = [max(c, 0) ** 2 for c, _ in near]
        assert abs(score - sum(a * y for a, (_, y) in zip(w, near)) / sum(w)) < 1e-4


def shares_brute(text, words, rarity):
    """Term shares by counting in dictionaries."""
    kind = lambda c: int(Q.CLASS_OF[c])
    data = (text or "").encode("utf-8", "surrogatepass")
    out = dict.fromkeys(range(Q.TERMS + len(words)), 0.0)
    grams = Counter(zip(map(kind, data), map(kind, data[1:]), map(kind, data[2:])))
    for (a, b, c), n in grams.items():
        out[(a * Q.CLASSES + b) * Q.CLASSES + c] = math.sqrt(n / (len(data) - 2))
    parts = (text or "").split()
    if len(parts) > 1:
        out[Q.TERMS - 2] = math.sqrt(sum(a == b for a, b in zip(parts, parts[1:])) / len(parts))
    out[Q.TERMS - 1] = 1 / math.sqrt(1 + len(parts))
    found = re.findall(r"[^\W\d_]+", (text or "").lower())
    for w, n in Counter(found).items():
        if w in words:
            out[Q.TERMS + words[w]] = Q.WORD_WEIGHT * math.sqrt(n / len(found)) * float(rarity[words[w]])
    return np.array([out[k] for k in range(len(out))])


def test_query_equals_brute_force(spark):
    """Every document of the table against every labelled vector, one by one."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model, share = Q._model(docs, labels, Q.PER_CLASS)
    assert len(model["words"]) > 100
    got = {r.doc_id: r.score for r in Q.op10_quality(spark, sf).collect()}
    for r in docs.collect():
        v = (shares_brute(r.text, model["words"], model["rarity"]) - model["centre"]) @ model["turn"]
        v /= max(np.linalg.norm(v), 1e-12)
        near = sorted(((float(m @ v), float(y)) for m, y in zip(model["vectors"], model["y"])), reverse=True)[: Q.NEIGHBOURS]
        w = [max(c, 0) ** Q.POWER for c, _ in near]
        want = (sum(a * y for a, (_, y) in zip(w, near)) + 1e-6 * share) / (sum(w) + 1e-6)
        assert abs(got[r.doc_id] - want) < 1e-2


def test_leading_vectors_span_what_a_whole_decomposition_gives():
    x = (np.random.default_rng(3).normal(size=(200, 60)) * np.linspace(9, 0.1, 60)).astype("f4")
    got, want = Q.leading(x, 8), np.linalg.svd(x)[2][:8].T
    assert np.abs(np.abs((got * want).sum(0)) - 1).max() < 1e-2


def test_odd_rows(spark, docs_of):
    rows = [(i, "Good words stand here, and more of them.") for i in range(30)] + [(100 + i, "AAA!! " * 9) for i in range(30)]
    odd = [(500, None), (501, ""), (502, "x"), (503, "ü" * 50000), (503, "ü"), (None, "AAA!! BBB!!")]
    labels = spark.createDataFrame([(d, int(d < 100), 0) for d, _ in rows] + [(None, 1, 0), (1, None, 0), (1, 1, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows + odd).selectExpr("*", "1 AS y", "2 AS score", "'k' AS k")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[5] > 0.9 and by[105] < 0.1
    assert Q.quality_scores(docs_of([]), labels).count() == 0
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
