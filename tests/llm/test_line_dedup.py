import random

import duckdb
import pytest

from valuemark.llm import line_dedup as L


def brute(rows, least):
    """By the definition: every window from or up to a line that has stood earlier loses its lines."""
    seen, gone = {}, {}
    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in distinct:
        lines = [(i, x) for i, x in enumerate((t or "").split("\n")) if x.strip(" ")]
        spans = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(len(x) for _, x in lines[a : b + 1]) >= least:
                    spans.add((a, b))
                    break
        for b in range(len(lines)):
            for a in range(b, -1, -1):
                if sum(len(x) for _, x in lines[a : b + 1]) >= least:
                    spans.add((a, b))
                    break
        for a, b in sorted(spans):
            key = tuple(x for _, x in lines[a : b + 1])
            if key in seen and seen[key] != (d, t, a):
                gone.setdefault((d, t), set()).update(range(lines[a][0], lines[b][0] + 1))
            seen.setdefault(key, (d, t, a))
    out = []
    for d, t in rows:
        g = gone.get((d, t), set())
        rest = "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in g)
        out.append((d, (rest if rest.strip() else "") if g else t, len(g)))
    return sorted(out, key=str)


def run(spark, rows, least):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS th", "2 AS gone", "'x' AS lines", "3 AS n_lines", "4 AS `from_pos`")
    got = L.dedup_lines(df, least)
    assert got.columns == ["doc_id", "th", "gone", "lines", "from_pos", "text", "n_lines", "removed_lines"]
    return sorted(((r.doc_id, r.text, r.removed_lines) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abc ") for _ in range(rng.choice([0, 3, 8, 20]))) for _ in range(14)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    assert run(spark, rows, 24) == brute(rows, 24)


def test_odd_rows(spark):
    p = "first line of a passage\nand its second line"
    rows = [(1, None), (2, ""), (3, p), (4, "intro\n" + p + "\n\nend"), (5, p), (5, p), (None, p), (6, p + "\n" + p), (7, "a\n" * 20000)]
    got = {(d, t): n for d, t, n in run(spark, rows, 30)}
    assert got[None, p] == 0 and got[3, ""] == 2 and got[4, "intro\n\nend"] == 2 and got[5, ""] == 2 and got[1, None] == 0 and got[2, ""] == 0
    assert run(spark, [], 30) == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(L.OP5_SQL).fetchall(), key=str)
    got = sorted((tuple(r) for r in L.op5_line_dedup(spark, sf).collect()), key=str)
    assert got == want and sum(r[3] > 0 for r in got) > 20
