import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from valuemark.llm import jaccard_join as J
from valuemark.llm.shingles import set_digest, shingle_sets


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, num, den):
    sets = [(d, shingles(t, n)) for d, t in rows]
    distinct = list({s for _, s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    holders = {}
    for s in distinct:
        for g in s:
            holders.setdefault(g, []).append(s)
    for s in distinct:
        met = {}
        for g in s:
            for o in holders[g]:
                met[o] = met.get(o, 0) + 1
        for o, k in met.items():
            if o is not s and den * k >= num * (len(s) + len(o) - k):
                a, b = find(s), find(o)
                if a is not b:
                    root[a] = b
    least = {}
    for d, s in sets:
        if s:
            r = find(s)
            least[r] = min(least.get(r, d), d)
    return sorted((d, len(s), least[find(s)] if s else d) for d, s in sets)


def run(spark, rows, *args):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "'x' AS sig", "2 AS size", "3 AS owner", "4 AS others")
    return sorted(tuple(r) for r in J.jaccard_components(df, *args).collect())


@pytest.mark.parametrize("bits", [1, 5])
def test_sets_whose_names_clash_are_told_apart(spark, bits):
    rows = corpus(5)
    assert run(spark, rows, 4, 85, 100, bits) == brute(rows, 4, 85, 100)


def test_lists_are_broadcast_by_what_their_partners_take(spark, monkeypatch):
    """Few rows of many partners count as what they are; both ways of joining give the same."""
    monkeypatch.setattr(J, "BROADCAST_BYTES", 1000)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(J._small(spark.createDataFrame([(1, [2, 3])], "owner long, others array<long>")))
    assert not hinted(J._small(spark.createDataFrame([(1, list(range(200)))], "owner long, others array<long>")))
    assert not spark.createDataFrame([], "owner long, others array<long>").join(J._small(spark.createDataFrame([], "owner long, others array<long>")), "owner").count()
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    rows = corpus(6)
    assert run(spark, rows, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_shingle_hashes_stand_for_the_shingles():
    texts = ["", "  ", "One two\tTHREE four five", "a", "a b c d", "é B\x0bc d e f g", "x " * 40, "w1 w2 w3 w4 w5 w6 " * 3] * 2
    sets = list(shingle_sets(texts, 4))
    names = {}
    for t, s in zip(texts, sets):
        assert len(s) == len(shingles(t, 4))
        names.setdefault(shingles(t, 4), set()).add(set_digest(s))
    assert all(len(v) == 1 for v in names.values()) and len({next(iter(v)) for v in names.values()}) == len(names)


def corpus(seed, groups=12, size=6):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(40))
    line = [word() for _ in range(60)]
    rows, d = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE  two")], 5
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 8, 30, 90, 200]))] + line[: rng.choice([0, 20, 60])]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                text[rng.randrange(len(text))] = word()
            rows.append((d, " ".join(text)))
            d += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("least", [2, 8])
def test_equals_brute_force(spark, monkeypatch, seed, least):
    monkeypatch.setattr(J, "LEAST_FREQUENT", least)
    rows = corpus(seed)
    assert run(spark, rows, 4, 85, 100) == brute(rows, 4, 85, 100)


@pytest.mark.parametrize("spread", [1 << 20, 1 << 48])
def test_counting_takes_a_row_a_bucket(spread):
    """However far apart the keys are; repeats within and between tasks add up."""
    rng = np.random.default_rng(2)
    tasks = [rng.choice(rng.integers(0, spread, 900, dtype="u8"), 4000) for _ in range(5)]
    rows = [J._counts(keys, 64) for keys in tasks]
    assert all(r.num_rows == len({int(k) >> 42 for k in keys}) for r, keys in zip(rows, tasks))
    table = pa.Table.from_batches(rows)
    got = {}
    for b in set(table.column("bucket").to_pylist()):
        common = J._common(table.filter(pc.equal(table.column("bucket"), b)), 3)
        got |= dict(zip(common.column("key").to_pylist(), common.column("n").to_pylist()))
    assert got == {int(k): n for k, n in Counter(np.concatenate(tasks).tolist()).items() if n >= 3}


def test_long_texts_and_passages_that_many_share(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = [word() for _ in range(300)]
    rows = [(k, " ".join(shared + [word() for _ in range(rng.choice([10, 40, 400, 3000]))])) for k in range(60)]
    rows += [(100, " ".join(word() for _ in range(40000)))]
    rows += [(101, rows[-1][1] + " more"), (102, rows[0][1] + " end")]
    assert run(spark, rows, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(3)
    for trial in range(400):
        size = int(rng.integers(6, 400))
        x = rng.integers(0, 2**63, size, dtype="u8")
        keep = x[: size - int(rng.integers(0, max(2, size * 0.09)))]
        y = np.r_[keep, rng.integers(0, 2**63, int(rng.integers(0, max(2, size * 0.09))), dtype="u8")]
        common = len(keep)
        if 100 * common < 85 * (len(x) + len(y) - common):
            continue
        mark = rng.integers(0, 3)
        often = lambda t: (t % np.uint64(10) < np.uint64([0, 5, 10][mark]))  # noqa: E731, B023
        a, b = (J.signatures(np.unique(t), often(np.unique(t)), 85, 100) for t in (x, y))
        assert len(np.intersect1d(a, b)), (trial, size, mark)


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "LEAST_FREQUENT", 4)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 70] + [f"z{i}"] + base[i % 70 + 1 :])) for i in range(60)] + [(900, " ".join(base[:40] + [f"q{i}" for i in range(40)]))]
    assert run(spark, rows, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_odd_rows(spark):
    assert run(spark, [], 4, 85, 100) == [] and run(spark, [(1, None)], 4, 85, 100) == [(1, 0, 1)]
    got = J.jaccard_components(spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (7, "x y"), (None, "k l m")], "doc_id long, text string"), 4, 85, 100).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 1, 0), (0, 2, 7), (7, 1, 7), (7, 2, 7), (7, 2, 7)]


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in J.op4_jaccard(spark, sf).collect()) == brute(rows, 4, 85, 100)


def test_sketches_never_differ_in_more_bits_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 2**63, int(rng.integers(0, 300)), dtype="u8")) for _ in "xy")
        y = np.unique(np.r_[x[: int(rng.integers(0, len(x) + 1))], y[: int(rng.integers(0, 40))]])
        apart = sum(bin(int(a) & (2**64 - 1)).count("1") for a in J.sketch(x) ^ J.sketch(y))
        assert apart <= len(np.setxor1d(x, y))


def test_sketches_tell_large_unlike_sets_apart_and_drop_no_link():
    import numpy as np

    from valuemark.llm.jaccard_join import SKETCH, sketch

    rng = np.random.default_rng(4)
    apart = lambda a, b: sum(int(x).bit_count() for x in sketch(a).view("u8") ^ sketch(b).view("u8"))
    for size in (5, 100, 1500):
        tokens = rng.integers(0, 2**63, 2 * size, dtype="u8")
        for common in (0, size // 2, size - size // 10):
            a, b = np.sort(tokens[:size]), np.sort(tokens[size - common : 2 * size - common])
            assert len(sketch(a)) == len(SKETCH) and apart(a, b) <= 2 * (size - common)
            if common == size // 2 and size > 5:  # a third alike
                assert apart(a, b) * 185 > 2 * size * 15
