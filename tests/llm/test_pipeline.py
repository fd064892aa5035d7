import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_jaccard_join import brute as near_brute
from test_line_dedup import brute as line_brute
from test_packing import check as packing_check
from test_quality import shares_brute
from test_toxicity import brute as clause_brute

import corpus_pipeline as C
from valuemark.llm import quality as Q
from valuemark.llm import toxicity as T
from valuemark.session import materialize, table

SF = "/root/testdata/sf0.01"


def test_every_stage_equals_brute_force_on_its_input(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents")
    columns = docs.columns
    held = {}
    for name, stage in C.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF), "t")
        held[name] = ([r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()])
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            model, share = Q._model(before, labels, Q.PER_CLASS)
            rows = held[name][0]
            x = np.array([shares_brute(r["text"], model["words"], model["rarity"]) for r in rows], "f4")
            scored = dict(zip([r["doc_id"] for r in rows], Q.votes(x, model, Q.NEIGHBOURS, Q.POWER, share)))
            stayed = {r["doc_id"] for r in held[name][1]}
            # Scores within rounding of the threshold may fall on either side.
            assert {d for d, s in scored.items() if s >= 0.301} <= stayed <= {d for d, s in scored.items() if s >= 0.299}
        if name == "toxicity":
            sample, share = T.training_sample(before, labels, "toxic", T.PER_CLASS)
            weights = T.lexicon(sample)
            context, b = T.curve(sample, weights, share)
            grammar = T.Grammar(weights)
            want = []
            for r in held[name][0]:
                found = clause_brute(grammar, r["text"] or "", context)
                if np.dot([1.0, min(max(found, default=0), T.CAP), min(sum(found), T.CAP)], b) < 0:
                    want.append(r["doc_id"])
            assert sorted(r["doc_id"] for r in held[name][1]) == sorted(want)
    rows, kept = held["line dedup"]
    want = {d: t for d, t, n in line_brute([(r["doc_id"], r["text"]) for r in rows], 160) if not n or t}
    assert {r["doc_id"]: r["text"] for r in kept} == want and all(r["n_chars"] == len(r["text"]) for r in kept)
    rows, kept = held["near duplicates"]
    want = [d for d, _, c in near_brute([(r["doc_id"], r["text"]) for r in rows], 5, 80, 100) if d == c]
    assert sorted(r["doc_id"] for r in kept) == want
    rows, packed = held["packing"]
    from types import SimpleNamespace

    packing_check([SimpleNamespace(**r) for r in packed], [(r["doc_id"], r["text"]) for r in rows], 2048)
    assert 0 < len(rows) < len(held["quality"][0])


def test_clean_documents_stay(spark):
    """Labelled good, not toxic and not held out or not: nearly all pass the two classifiers."""
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    docs = table(spark, SF, "documents")
    left = {r.doc_id for r in C.toxicity(spark, materialize(C.quality(spark, docs, SF), "t"), SF).collect()}
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(d in left for d in clean) > 0.97 * len(clean)


def test_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF), "t")
    assert docs.count() == 0


def test_one_row_of_each_group_stays(spark, docs_of):
    """Repeated rows, null ids and several texts of an id."""
    one, two, three, four = (" ".join(f"{w}{k}" for k in range(30)) for w in ("a", "b", "c", "d"))
    rows = [(1, one), (1, one), (2, one), (None, one), (None, two), (None, two), (5, three), (5, four), (7, four), (3, four), (None, ""), (None, ""), (8, None), (8, "."), (8, ".")]
    kept = C.near_duplicates(spark, docs_of(rows), SF)
    assert kept.columns == ["doc_id", "text"]
    want = [(1, one), (None, two), (5, three), (3, four), (None, ""), (8, None), (8, ".")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_odd_rows_pass_every_stage(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and columns of clashing names."""
    base = table(spark, SF, "documents").select("doc_id", "text").limit(150)
    long_text = "\n".join(f"A line of words number {k} that stands nowhere else, and so it stays." for k in range(6000))
    odd = [(None, None), (None, "x"), (900001, None), (900001, ""), (900002, " \n\t "), (900003, long_text), (900003, long_text), (900003, "Other text of the same id, with words enough to be one."), (None, long_text)]
    docs = base.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    clash = {"row": 1, "_row": 2, "stays": "x", "th": 4, "known": True, "gone": None, "removed_lines": 5, "n_lines": "y", "removed_lines_": 6, "component_id": 7, "n_shingles": 8, "piece": 9, "length": 10, "score": 0.5, "y": 1, "a.b": 2}
    for k, v in clash.items():
        docs = docs.withColumn(k, F.lit(v) if v is not None else F.lit(None).cast("int"))
    docs, columns = materialize(docs, "odd"), docs.columns
    for name, stage in C.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, SF), "t")
        assert docs.columns == columns, name
        assert docs.filter("n_shingles <> 8 OR removed_lines <> 5 OR `a.b` <> 2").count() == 0
        assert docs.count() <= before.count()
    kept = [r.doc_id for r in docs.filter(F.length("text") > 100000).collect()]
    assert kept == [None]  # of three copies of a long text the first: line deduplication takes null ids before all others
    packed = C.packing(spark, docs, SF)
    assert packed.agg(F.max("length")).first()[0] <= 2048 and packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
