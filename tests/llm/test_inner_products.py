import numpy as np
import pytest
from pyspark.sql import functions as F

from valuemark.llm import inner_products as T

KIND = "vec_id long, embedding array<double>, label int, v string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], KIND)


def whole(x):
    return int(x) * 64 if abs(x) >= 1 << 53 else int(np.floor(64 * x))


def brute(rows, k, each):
    ok = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (qi, q) in enumerate(ok):
        if qi % each == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), ci) for k_, (ci, c) in enumerate(ok) if k_ != at)
            out += [(qi, r + 1, ci, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, ci) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=3, each=2):
    v = T.materialize(T.quantized(frame(spark, rows)), "vectors")
    dim = v.agg(F.max(F.size("x"))).first()[0] or 1
    return sorted(tuple(r) for r in T.top_products(v.filter(F.col("vec_id") % each == 0), v, k, dim).collect())


@pytest.fixture
def small(monkeypatch):
    for name, n in (("SHARE_ROWS", 40), ("GROUP_ROWS", 30), ("BLOCK_ROWS", 8)):
        monkeypatch.setattr(T, name, n)


@pytest.mark.parametrize("scale", [1.0, 4e5, 1e9])
def test_equals_brute_force_in_small_blocks(spark, small, scale):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 6)) * scale * np.exp(rng.normal(size=(150, 1)))
    rows = [(i % 140, [float(x) for x in base[i % 130]]) for i in range(150)]  # repeated vectors: ties; repeated ids
    assert run(spark, rows) == brute(rows, 3, 2)


def test_long_vectors_stay(spark, small):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(-2, 12)]) for i in range(90)]
    rows += [(100, [1e30, 0.0, 1.0, 0.0]), (101, [-1e300, 1e300, 0.0, 0.0]), (102, [1e308, 1e308, 1e-308, 0.0]), (103, [1e308, 1e308, 1e-308, 0.0]), (104, [0.0] * 4)]
    assert run(spark, rows, 5) == brute(rows, 5, 2)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (2, None), (4, [nan, 1.0]), (6, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (1, [0.0, 0.0]), (10, [-1.5, 0.01]), (3, [5.0])]
    padded = [(i, v + [0.0] if i == 3 else v) for i, v in rows]
    assert run(spark, rows) == brute(padded, 3, 2)
    assert run(spark, [(0, [1e10, 0.0]), (2, [1e8, 1.0]), (3, [1.0, 0.0])]) == brute([(0, [1e10, 0.0]), (2, [1e8, 1.0]), (3, [1.0, 0.0])], 3, 2)
    assert run(spark, []) == []


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute(T.OP2_SQL).fetchall())
    assert sorted(tuple(r) for r in T.op2_inner_products(spark, sf).collect()) == want
