import hashlib

from pyspark.sql import functions as F

from valuemark.llm import fingerprints as P


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), edited, following)
    return out


def test_edits_and_likeness_follow_the_definition(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, got = brute(rows), {r.doc_id: r for r in P.op7_fingerprints(spark, sf).collect()}
    assert len(got) == len(rows)
    prints, better = {}, 0
    for doc_id, text in rows:
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == want[doc_id][:2]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        better += r.near_edited > r.near_next
    assert len(set(prints.values())) == len(prints)
    assert better > 0.95 * len(rows)
    # the written fingerprints alone give the same figures
    again = P.op7_fingerprints(spark, sf).limit(40).withColumn("x", P.likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).collect()
    assert all(abs(r.x - r.near_edited) < 1e-9 for r in again)


def prints(spark, docs_of, *found):
    return {r.doc_id: r.fingerprint for r in P.fingerprints(docs_of(list(enumerate(found)))).collect()}


def test_order_insertion_and_deletion(spark, docs_of):
    p = prints(spark, docs_of, "one\ntwo, three\nfour", "four\none\ntwo, three", "two, three\nfour", "one", "one\none\ntwo, three\nfour")
    assert p[0] == p[1] != p[2]
    df = spark.createDataFrame([(p[2], p[3], p[0])], "a string, b string, whole string")
    r = df.select(P.combined(F.col("a"), F.col("b")).alias("s"), P.combined(F.col("whole"), F.col("b"), remove=True).alias("d")).first()
    assert (r.s, r.d) == (p[0], p[2]) and p[4] != p[0]


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x. y"), (5, "\n\n"), (6, "w " * 60000), (7, "…,.  é\n" * 3)]
    got = P.edited_fingerprints(docs_of(rows).selectExpr("*", "1 AS n", "'q' AS fingerprint", "2 AS bucket")).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((d or 0, len(t or "")) for d, t in rows)
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_edited == 1.0
    assert P.edited_fingerprints(docs_of([])).count() == 0
    (r,) = P.edited_fingerprints(docs_of([(4, "abcdef")])).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_a_clause_repeated_beyond_sixteen_bits(spark, docs_of):
    rows = [(3, "0," * 70_000), (2, "0," * 60_000), (1, "one, two, three")]
    got = {r.doc_id: r for r in P.edited_fingerprints(docs_of(rows)).withColumn("x", P.likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).collect()}
    assert got[3].near_edited > 0.99 and got[3].near_next > 0.99 and abs(got[3].x - got[3].near_edited) < 1e-9
    many, few, rest = (P.fingerprints(docs_of([(1, "0,\n" * n + "0,")])).first().fingerprint for n in (139_999, 69_999, 69_999))
    r = spark.createDataFrame([(many, few)], "a string, b string").select(P.combined(F.col("a"), F.col("b"), remove=True).alias("d"), P.likeness(F.col("a"), F.col("b")).alias("x")).first()
    assert r.d == rest and r.x > 0.99


def test_lines_of_megabytes(spark, docs_of):
    rows = [(4, "word, other. " * 80_000), (3, "x" * 1_000_000), (2, "a b, " * 4_000_000), (1, "short")]
    got = {r.doc_id: r for r in P.edited_fingerprints(docs_of(rows)).select("doc_id", "n_chars", "near_edited", "fingerprint").collect()}
    assert {k: r.n_chars for k, r in got.items()} == {k: len(t) for k, t in rows}
    assert int(got[2].fingerprint[:8], 16) == 4_000_000 and got[4].near_edited > 0.5
