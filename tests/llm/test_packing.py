import array
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from valuemark.llm import packing as P

WORD = public_tokenizers.path("word_bpe_49k.json")


def least_bins(sizes, capacity):
    """Exact, for small instances."""
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in sorted(set(bins)):
            if k >= sizes[i]:
                rest = list(bins)
                rest[rest.index(k)] = k - sizes[i]
                go(i + 1, rest)
        go(i + 1, [*bins, capacity - sizes[i]])

    go(0, [])
    return best[0]


def bins(patterns):
    return sum(t for _, t in patterns)


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum_and_the_plan_is_whole(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([10, 20, 37]))
    sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 11))).tolist()
    counts = np.bincount(sizes, minlength=capacity + 1)
    rest = counts.copy()
    fixed = P.reduced(rest, capacity)
    left = list(itertools.chain.from_iterable([s] * int(n) for s, n in enumerate(rest)))
    assert bins(fixed) + (least_bins(left, capacity) if left else 0) == least_bins(sizes, capacity)
    whole = P.plan(counts, capacity)
    assert all(sum(p) <= capacity for p, _ in whole)
    assert sorted(s for p, t in whole for s in p * t) == sorted(sizes)


def test_patterns_do_not_grow_with_the_pieces():
    rng = np.random.default_rng(4)
    lengths = np.minimum(2048, rng.gamma(1.2, 600, 4277).astype(int) + 1)
    few, many = (P.plan(np.bincount(lengths, minlength=2049) * k, 2048) for k in (1, 1000))
    assert len(many) < 3 * 2048 and len(P.reduced(np.bincount(lengths, minlength=2049) * 1000, 2048)) <= 2 * 2048
    thirds = np.zeros(2049, "i8")
    thirds[1500], thirds[500], thirds[30] = 10**9, 10**9, 10**9
    assert len(P.plan(thirds, 2048)) < 20 and sum(t for p, t in P.plan(thirds, 2048) for _ in p) == 3 * 10**9
    assert len(few) <= 4277


def test_best_fit_equals_piece_by_piece():
    rng = np.random.default_rng(9)
    for _ in range(40):
        sizes = rng.integers(1, 60, 80)
        rooms = []
        for s in sorted(sizes.tolist(), reverse=True):
            fit = min((r for r in rooms if r >= s), default=None)
            if fit is None:
                rooms.append(100 - s)
            else:
                rooms[rooms.index(fit)] = fit - s
        assert bins(P.best_fit(np.bincount(sizes, minlength=101), 100)) == len(rooms)


def check(rows, texts_of, capacity):
    library = Tokenizer.from_file(WORD)
    taken, seen = {}, []
    for r in rows:
        taken.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen.append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
    for spans in taken.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for d, t in texts_of:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((d, k // capacity, k, len(part), zlib.crc32(array.array("I", part).tobytes())))
    assert sorted(seen, key=str) == sorted(want, key=str)
    return len(taken), sum(w[3] for w in want)


def test_query_packs_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, total = check(P.op1_packing(spark, sf).collect(), docs, 2048)
    assert used <= -(-total // 2048) * 1.01 + 1


def test_odd_rows_and_small_shares(spark, docs_of, monkeypatch):
    monkeypatch.setattr(P, "SHARE_ROWS", 3)
    rows = [(i, "a " * (i % 13)) for i in range(50)] + [(100, None), (101, ""), (7, "a b"), (7, "a b"), (None, "x"), (200, "w " * 9000)]
    df = docs_of(rows).selectExpr("*", "1 AS share", "2 AS length", "3 AS piece", "4 AS rank", "5 AS offset")
    check(P.packed_documents(df, WORD, 16, with_ids=False).collect(), rows, 16)
    assert P.packed_documents(docs_of([]), WORD, 16).count() == 0
    r = P.packed_documents(docs_of([(1, "a b")]), WORD, 16).first()
    assert len(r.ids) == 4 * r.length == 12
