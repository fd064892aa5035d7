"""Proposed links against a sequential greedy over every pair, on names that share words."""

import random

import pytest

from valuemark.config import Settings
from valuemark.functions import scalars as X
from valuemark.functions.matching import token_set_similarity
from valuemark.operators import linkage
from valuemark.plans import registry

SF = "/root/testdata/sf0.01"


def similarity(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    both = x & y
    if both and (x <= y or y <= x):
        return 100.0
    base = " ".join(sorted(both))
    left, right = (" ".join(filter(None, (base, " ".join(sorted(z - both))))) for z in (x, y))
    return max([similarity(left, right)] + ([similarity(base, left), similarity(base, right)] if base else []))


def normalised(spark, names):
    c = X.normalize_name(registry.F.col("n"))
    return {r.n: (r.norm, set(r.tokens)) for r in spark.createDataFrame([(n,) for n in set(names)], "n string").select("n", c.alias("norm"), X.significant_tokens(c).alias("tokens")).collect()}


def greedy(spark, providers, names, cutoff=60):
    """providers: (id, name, volume)."""
    of = normalised(spark, [p[1] for p in providers] + names)
    spelt = {}
    for n in names:
        spelt[of[n][0]] = min(n, spelt.get(of[n][0], n))
    out, taken = {}, set()
    for p, name, volume in sorted(providers, key=lambda p: (-p[2], p[0])):
        norm, tokens = of[name]
        wishes = []
        for other, n in spelt.items():
            if n in taken:
                continue
            score = 100.0 if norm == other else round(token_set(norm, other), 2) if tokens & of[n][1] else 0
            if norm == other or score >= cutoff:
                wishes.append((norm != other, -score, n))
        if wishes:
            _, score, out[p] = min(wishes)
            taken.add(out[p])
    return out


def test_the_query_scores_every_pair_of_the_whole_names(spark):
    left, right = registry._name_sets(spark, SF)
    got = registry.queries()["M2_propose_links"](spark, SF).collect()
    want = greedy(spark, [(r.provider_id, r.provider_name, r.volume) for r in left.collect()], [r.facility_name for r in right.collect()])
    assert len(got) == left.count() and {r.provider_id: r.facility_name for r in got if r.facility_name} == want
    assert all("SUPPLIER" in r.provider_name for r in got)


@pytest.mark.parametrize("depth, block", [(64, 128), (0, 3)])
def test_names_that_share_words_and_are_fewer_than_providers(spark, monkeypatch, depth, block):
    for name, value in (("DEPTH", depth), ("BLOCK", block)):
        monkeypatch.setattr(linkage, name, value)
    rng = random.Random(5)
    name = lambda: f"Saint Supplier {rng.choice(['North', 'South', ''])} {rng.randrange(60):06d}"
    providers = [(k, name() if k % 4 else "Saint Supplier 000007", rng.randrange(6)) for k in range(24)] + [(90, "Lone Clinic", 9), (91, "", 3)]
    names = [f"The {name()} Hospital" for _ in range(15)] + ["saint supplier 000007"]
    df = spark.createDataFrame([(p, "c", n, v) for p, n, v in providers], "provider_id int, certificate string, provider_name string, volume int")
    none = df.limit(0).selectExpr("provider_id", "provider_name AS facility_name", "false AS reviewed")
    got = linkage.propose(df, spark.createDataFrame([(n,) for n in names], "facility_name string"), none, Settings()).collect()
    assert len(got) == len(providers) and {r.provider_id: r.facility_name for r in got if r.facility_name} == greedy(spark, providers, names)


def test_similarity_equals_its_table():
    rng = random.Random(1)
    text = lambda: " ".join("".join(rng.choice("abc1") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 6)))
    assert all(token_set_similarity(a, b) == token_set(a, b) for a, b in ((text(), text()) for _ in range(2000)))


def blocks_of(rng, n):
    words = ["hospital", "clinic", "north", "south", "saint", "supplier", "of", "a1", "mercy", "memorial"]
    name = lambda: " ".join(rng.sample(words, rng.randrange(1, 5)) + [f"{rng.randrange(40):04d}"][: rng.randrange(2)])
    return [(x, sorted({w for w in x.split() if len(w) >= 4})) for x in (f"hospital {name()}" for _ in range(n))]


def test_bounds_hold_and_spare_most_pairs(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    left = [{"norm": x, "tokens": t, "rank": None, "depth": 3} for x, t in {x: t for x, t in blocks_of(rng, 60)}.items()]
    right = [{"norm": x, "tokens": t, "facility_name": x, "best": None} for x, t in {x: t for x, t in blocks_of(rng, 300)}.items()]
    words, tokens = {}, {}
    a, b = (linkage.Side(rows, "hospital", words, tokens) for rows in (left, right))
    most = linkage.bounds(a, b, words, tokens)
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            least = min(set(x["tokens"]) & set(y["tokens"]))
            assert most[i, j] == -1 if least < "hospital" else most[i, j] + 1e-3 >= token_set_similarity(x["norm"], y["norm"])
    scored = []
    monkeypatch.setattr(linkage, "word_set_similarity", lambda p, q, was=linkage.word_set_similarity: scored.append(1) or was(p, q))
    rows = [{"token": "hospital", "block": 0, "left": left, "right": right[k : k + 50]} for k in range(0, len(right), 50)]
    (out,) = linkage._scored([pa.RecordBatch.from_pylist(rows)], 60.0)
    got = {}
    for r in out.to_pylist():
        got.setdefault(r["key"], []).append((-r["score"], r["facility_name"]))
    for x in left:
        all_of = sorted((-round(token_set(x["norm"], y["norm"]), 2), y["norm"]) for y in right if y["norm"] != x["norm"] and min(set(x["tokens"]) & set(y["tokens"])) == "hospital" and token_set(x["norm"], y["norm"]) >= 60)
        assert got.get(x["norm"], []) == all_of[:3]
    assert len(scored) < 0.35 * len(left) * len(right)


def test_rounds_are_few_and_equal_choosing_in_order(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(p, p, f"n{n:03d}", False, float(rng.randrange(60, 100))) for p in range(200) for n in rng.sample(range(220), 12)]
    taken, want = set(), {}
    for p in range(200):
        for _, _, n, _, score in sorted((r for r in rows if r[0] == p), key=lambda r: (-r[4], r[2])):
            if n not in taken:
                want[p] = n
                taken.add(n)
                break
    rounds = []
    monkeypatch.setattr(linkage, "materialize", lambda df, label, was=linkage.materialize: rounds.append(label) or was(df, label))
    got = linkage.one_to_one(spark.createDataFrame(rows, "provider_id int, priority int, facility_name string, exact boolean, score double")).collect()
    assert {r.provider_id: r.facility_name for r in got} == want and len(rounds) <= 14


def test_review_candidates_equal_all_pairs(spark):
    rng = random.Random(2)
    words = ["North", "South", "Mercy", "Saint Mary", "Hospital", "Clinic", "Memorial"]
    name = lambda: " ".join(rng.sample(words, rng.randrange(1, 4))) + f" {rng.randrange(30):04d}"
    providers, names = [(k, name()) for k in range(25)] + [(99, "xy")], [name() for _ in range(60)] + ["xy"]
    of = normalised(spark, [p[1] for p in providers] + names)
    spelt = {}
    for n in names:
        spelt[of[n][0]] = min(n, spelt.get(of[n][0], n))
    got = {}
    links = spark.createDataFrame([(1, names[0])], "provider_id int, facility_name string")
    for r in linkage.review_candidates(spark.createDataFrame(providers, "provider_id int, provider_name string"), spark.createDataFrame([(n,) for n in names], "facility_name string"), links).collect():
        got.setdefault(r.provider_id, []).append((r.place, r.facility_name, r.score, r.claimed))
    for p, x in providers:
        fit = sorted((-round(token_set(of[x][0], norm), 2), n) for norm, n in spelt.items() if of[x][1] & of[n][1])
        assert sorted(got.get(p, [])) == [(k + 1, n, -score, n == names[0]) for k, (score, n) in enumerate(fit[:8])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_signatures_and_bounds_lose_no_name(spark, monkeypatch, seed):
    monkeypatch.setattr(linkage, "RARE", 4)
    rng = random.Random(seed)
    words = ["north", "south", "mercy", "saint", "mary", "memorial", "no", "west", "supplier"]
    name = lambda: " ".join(rng.sample(words, rng.randrange(1, 4)) + [f"{rng.randrange(300):0{rng.choice([3, 5])}d}"][: rng.randrange(4)])
    asks, names = sorted({name() for _ in range(40)}), sorted({name() for _ in range(150)})
    best = {n: rng.choice([None, 3, 50]) for n in names}
    left = spark.createDataFrame([(x, 5, rng.choice([None, 10])) for x in asks], "norm string, depth long, rank long")
    rank = {r.norm: r.rank for r in left.collect()}
    got = {}
    for r in linkage.top_names(left, spark.createDataFrame([(n, n.upper(), best[n]) for n in names], "norm string, facility_name string, best long"), 60.0).collect():
        got.setdefault(r.key, []).append((not r.exact, -r.score, r.facility_name))
    tokens = lambda x: {w for w in x.split() if len(w) >= 4}
    for x in asks:
        open_ = [n for n in names if best[n] is None or rank[x] is None or best[n] >= rank[x]]
        fit = [(n != x, -100.0 if n == x else -round(token_set(x, n), 2), n.upper()) for n in open_ if n == x or tokens(x) & tokens(n)]
        assert sorted(got.get(x, [])) == sorted(f for f in fit if f[1] <= -60.0)[:5]


def test_names_of_one_pattern_are_not_compared_all_with_all(spark, monkeypatch):
    monkeypatch.setattr(linkage, "block_names", lambda rest, *_: pytest.fail(f"{rest.count()} names are compared with all"))
    compared = linkage.near_names(
        spark.range(2000).selectExpr("concat('saint supplier ', lpad(id, 9, '0')) AS norm", "9L AS depth", "CAST(NULL AS BIGINT) AS rank"),
        spark.range(2000).selectExpr("concat('saint supplier ', if(id % 5 = 0, 'no ', ''), lpad(id, 9, '0')) AS norm", "CAST(id AS STRING) AS facility_name", "CAST(NULL AS BIGINT) AS best"), 0.0)
    assert compared[0].groupBy("key").count().filter("count = 9").count() == 2000 and compared[1].isEmpty()
