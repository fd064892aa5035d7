import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from valuemark.llm import lexical as L


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, best=10):
    bags = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        terms, scores = set(words(text)), []
        for doc_id, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms & bag.keys())
            scores.append((-score, doc_id is None, doc_id))
        first = sorted(s for s in scores if s[0] < 0)[:best]
        out += [(item_id, k + 1, s[2], -s[0]) for k, s in enumerate(first)]
    return Counter(out)


def rows_of(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_the_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = rows_of(L.op12_lexical(spark, sf))
    assert got == brute(docs, items)
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        cur = db.sql(L.OP12_SQL)
        assert cur.columns == ["item_id", "rank", "doc_id", "score"] and Counter(cur.fetchall()) == got


@pytest.mark.parametrize("shard, postings, wave, most, number", [(7, 1 << 20, 256, 1 << 18, 4), (4096, 40, 3, 1 << 18, 3), (50, 1 << 20, 5, 2, 1), (4096, 1 << 20, 256, 1 << 18, 6)])
def test_shards_waves_and_owners_do_not_matter(spark, docs_of, monkeypatch, shard, postings, wave, most, number):
    monkeypatch.setattr(L, "MOST_TERMS", most)
    rng = np.random.default_rng(shard + number)
    vocabulary = [f"w{k}" for k in range(60)]
    text = lambda: " ".join(vocabulary[min(59, int(k))] for k in rng.exponential(9, rng.integers(0, 40)))
    docs, items = [(k, text()) for k in range(300)], [(k, text()) for k in range(12)]
    got = rows_of(L.ranked_search(docs_of(docs), docs_of(items).withColumnRenamed("doc_id", "item_id"), number=number, wave=wave, shard=shard, postings=postings))
    assert got == brute(docs, items)


def test_owners_hold_more_the_more_frequent_their_terms():
    df = {f"t{k}": 2**k for k in range(12)}
    of = L.owners(df, 4)
    assert [of[f"t{k}"] for k in range(12)] == sorted(of.values()) and of["t11"] == 3 and of["t0"] == 0
    assert L.owners({}, 4) == {}


def test_odd_rows(spark, docs_of):
    docs = [(1, None), (2, ""), (None, "alpha beta"), (None, "alpha beta"), (3, "Alpha \u00e9t\u00e9"), (3, "alpha b\u00cata \u00c9"), (4, "beta " * 400_000), (5, "z" * 2_000_000), (6, "...")]
    items = [(1, "ALPHA beta"), (1, "ALPHA beta"), (None, "\u00e9t\u00e9 \u00c9"), (2, None), (3, ""), (4, "nowhere")]
    named = docs_of(items).withColumnRenamed("doc_id", "item_id").selectExpr("*", "1 AS row", "2 AS shard")
    got = rows_of(L.ranked_search(docs_of(docs).selectExpr("*", "'q' AS term", "1 AS score"), named))
    assert got == brute(docs, items)
    none = docs_of([]).withColumnRenamed("doc_id", "item_id")
    assert L.ranked_search(docs_of([]), named).count() == 0 == L.ranked_search(docs_of(docs), none).count()


def test_ties_go_to_the_smaller_id(spark, docs_of):
    docs = [(k, "same words") for k in range(40, 0, -1)] + [(99, "other text")]
    got = L.ranked_search(docs_of(docs), docs_of([(7, "same")]).withColumnRenamed("doc_id", "item_id")).collect()
    assert sorted((r["rank"], r.doc_id) for r in got) == [(k, k) for k in range(1, 11)]
