import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from valuemark.llm import chat as C


def test_markers():
    assert C.parsed("User: hi") == (1, "hi")
    assert C.parsed("### Assistant\nhi\nyou") == (2, "hi\nyou")
    assert C.parsed("<|system|>\nbe kind") == (0, "be kind")
    assert C.parsed("<|im_start|>user\nq") == (1, "q")
    assert C.parsed("**Human**: q") == (1, "q")
    assert C.parsed("[AI] q") == (2, "q")
    assert C.parsed("Note: the user: x") == (-1, "Note: the user: x") and C.parsed("") == (-1, "")


def model(rng):
    m = {"start": np.log(rng.dirichlet(np.ones(3))), "move": np.log(rng.dirichlet(np.ones(3), 3))}
    m["names"] = np.log(rng.dirichlet(np.ones(4), 3))
    return m | {f"emit{i}": np.log(rng.dirichlet(np.ones(a), 3)) for i, a in enumerate(C.ALPHABETS)}


@pytest.mark.parametrize("seed", range(12))
def test_segments_bridge_to_the_best_path(seed):
    rng = np.random.default_rng(seed)
    m, n = model(rng), 7
    turns = pd.DataFrame({"conv_id": 1, "turn": range(n), "nth": range(n), "role": None, "body": "", "marker": rng.choice([-1, -1, 0, 1, 2], n), **{f"f{i}": rng.integers(0, a, n) for i, a in enumerate(C.ALPHABETS)}})
    turns["segment"] = turns["nth"] // 3
    e = C.scores(turns, m)
    score = lambda p: m["start"][p[0]] + e[0, p[0]] + sum(m["move"][a, b] + e[k + 1, b] for k, (a, b) in enumerate(zip(p, p[1:])))
    best = max(itertools.product(range(3), repeat=n), key=score)
    cuts = [(a, min(a + 3, n)) for a in range(0, n, 3)]
    fixed = C.ends([C.bridge(e[a:b], a == 0, m) for a, b in cuts])
    assert [k for (a, b), (x, y) in zip(cuts, fixed) for k in C.viterbi(e[a:b], a == 0, x, y, m)] == list(best)


def test_groups_survive_batch_edges():
    pdf = pd.DataFrame({"key": [1, 1, 2, 2, 2, 3], "v": range(6)})
    for size in range(1, 7):
        got = [g["v"].tolist() for f in C._runs([pdf.iloc[i : i + size] for i in range(0, 6, size)], ["key"]) for _, g in f.groupby("key")]
        assert got == [[0, 1], [2, 3, 4], [5]]


def test_held_out_roles_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = C.op3_chat(spark, sf).withColumn("out", C.held_out(F.col("conv_id"))).collect()
    assert len(rows) == turns.count()
    out = [r for r in rows if r.out]
    assert np.mean([r.given == r.role for r in out]) > 0.97
    assert all(r.rendered.startswith(f"<|{r.role}|>\n") and r.rendered.endswith("\n<|end|>") for r in rows)


def test_texts_are_cut_at_speaker_lines():
    text = "User: one\nstill one\n\nAssistant: Answer: two\n```\nUser: code\n```\n### System\nthree\nNote: x\n**Human**: four"
    assert C.parts(text) == [(1, "one\nstill one\n"), (2, "Answer: two\n```\nUser: code\n```"), (0, "three\nNote: x"), (1, "four")]
    assert C.parts("plain\ntext") == [(-1, "plain\ntext")] and C.parts("") == [(-1, "")] and C.parts("\nUser: x") == [(1, "x")]


def brute(spark, turns):
    """Roles of every conversation by Viterbi over its whole list of parts, in plain Python, with the learned model."""
    m = C.learned(C.placed(turns))
    seen = sorted(C.observed(turns).collect(), key=lambda r: (r.turn is not None, r.turn or 0, r.tie, r.part))
    out = []
    for conv in {r.conv_id for r in seen}:
        rows = [r for r in seen if r.conv_id == conv]
        at, back = None, []
        for r in rows:
            e = [m["names"][k, r.marker + 1] + sum(m[f"emit{i}"][k, r[f"f{i}"]] for i in range(4)) for k in range(3)]
            if at is None:
                at = [m["start"][k] + e[k] for k in range(3)]
                continue
            best = [max(range(3), key=lambda j, k=k: at[j] + m["move"][j, k]) for k in range(3)]
            at = [at[best[k]] + m["move"][best[k], k] + e[k] for k in range(3)]
            back.append(best)
        path = [max(range(3), key=lambda k: at[k])]
        for best in reversed(back):
            path.append(best[path[-1]])
        out += [(conv, r.turn, r.part, n, C.ROLES[k], r.body) for n, (r, k) in enumerate(zip(rows, reversed(path)))]
    return sorted(out, key=str)


def plain(df):
    return sorted(((r.conv_id, r.turn, r.part, r.nth, r.role, r.body) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert plain(C.recovered(turns)) == brute(spark, turns)
    assert C.op3_chat(spark, "/root/testdata/sf0.001").count() >= turns.count()


def test_one_long_conversation_spreads_over_tasks(spark):
    """Null ids and one id hold nearly all rows; some texts hold several turns."""
    body = lambda i: "User: ask?\nAssistant: told." if i % 7 == 0 else "why not?" if i % 2 else "Because it is so, and it is long enough. " * 4
    rows = [(None if i % 3 else 5, i // 2, "user" if i % 2 else "assistant", body(i)) for i in range(400)] + [(7, 0, "user", "x?"), (7, 1, "owl", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = C.recovered(df, 16)
    assert plain(got) == brute(spark, df)
    assert got.filter("part = 1").select("role").distinct().collect() == [("assistant",)]


def test_odd_rows(spark):
    long_one = [(9, i, None, "User: q" if i % 2 == 0 else "Assistant: a") for i in range(40)]
    rows = [(1, 0, "user", "hi?"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, 0, "owl", ""), (None, 0, "user", "x"), (None, None, None, "y"), (3, 0, "user", "z" * 100000)]
    df = spark.createDataFrame(rows + long_one, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS nth", "'b' AS body", "2 AS segment")
    got = C.recovered(df, 7).collect()
    assert len(got) == len(rows) + len(long_one)
    assert [r.role for r in sorted((r for r in got if r.conv_id == 9), key=lambda r: r.nth)] == ["user", "assistant"] * 20
    assert C.recovered(df.limit(0)).count() == 0
