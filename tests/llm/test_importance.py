import math
import re
from binascii import crc32
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from valuemark.llm import importance as I


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def features(text, max_n=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return words, [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, max_n=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for _, text in rows for f in features(text, max_n)[1]) for rows in (docs, target))
    total, wanted, scored = sum(s.values()), sum(t.values()), []
    for doc_id, text in docs:
        words, found = features(text, max_n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in map(bucket, found))
        h = int(sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((len(words) >= least, doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[0]), key=lambda r: (-r[4], r[1] is None, r[1]))
    ranks = [k + 1 if k < percent * len(able) // 100 else None for k in range(len(able))]
    return Counter([(*r[1:], k) for r, k in zip(able, ranks)] + [(*r[1:], None) for r in scored if not r[0]])


def rows_of(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_the_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    docs, target = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = rows_of(I.op11_importance(spark, sf))
    assert got == brute(docs, target)
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        cur = db.sql(I.OP11_SQL)
        assert cur.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert Counter(cur.fetchall()) == got


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_runs_across_lines(spark, docs_of, max_n):
    rng = np.random.default_rng(max_n)
    word = lambda: "abcd"[rng.integers(4)] * rng.integers(1, 3)
    text = lambda: "\n".join(" ".join(word() for _ in range(rng.integers(0, 6))) for _ in range(rng.integers(1, 9)))
    docs, target = ([(k, text()) for k in range(n)] for n in (80, 9))
    got = I.resampled(docs_of(docs), docs_of(target), max_n, 50, 30, 5)
    assert rows_of(got) == brute(docs, target, max_n, 50, 30, 5)


def test_crossing_runs_in_words():
    assert I.crossing(b"a b\n\nc\nd e f", 3) == [b"a b c", b"b c", b"b c d", b"c d", b"c d e"]
    assert I.crossing(b"one line", 4) == [] == I.crossing(b"", 2)


def test_odd_rows(spark, docs_of):
    word = "x1 \u00e9t\u00c9 " * 12
    docs = [(1, None), (2, ""), (None, word), (None, "y"), (3, word), (3, word), (4, word), (5, "\n\n"), (6, "z" * 2_000_000), (7, "q " * 500_000), (8, "A\x00B " * 30)]
    target = [(1, word), (2, None)]
    got = I.resampled(docs_of(docs).selectExpr("*", "1 AS row", "'h' AS h1", "2 AS score"), docs_of(target), percent=60)
    want = brute(docs, target, percent=60)
    assert rows_of(got) == want
    assert I.resampled(docs_of([]), docs_of(target)).count() == 0
    assert rows_of(I.resampled(docs_of(docs[:5]), docs_of([]))) == brute(docs[:5], [])


def test_ties_go_to_the_smaller_id(spark, docs_of, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(I, "_noise", lambda salt: F.lit(0).cast("long"))
    got = I.resampled(docs_of([(k, "same words " * 10) for k in range(40)]), docs_of([(0, "same")]), percent=50).collect()
    assert {r.doc_id: r["rank"] for r in got} == {k: k + 1 if k < 20 else None for k in range(40)}
