import re
from binascii import crc32
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF
from valuemark.llm import rules as R


def brute(text):
    text = text or ""
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^ \t\n\x0b\x0c\r]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside), len(words) < 20 or 100 * len(inside) > 30 * len(words)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_the_query_counts_as_brute_force_does_and_tells_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = R.op13_rules(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    right = total = 0
    for r in got:
        assert counts(r) == brute(rows[r.doc_id])
        assert r.kept == (not r.base_failed and r.score >= R.LEAST)
        if r.doc_id in labels and crc32(str(r.doc_id).encode()) % 5 == 0 and not r.base_failed:
            total += 1
            right += r.kept == (labels[r.doc_id] == 1)
    assert total > 40 and right >= 0.95 * total


def test_held_out_labels_have_no_part_in_the_model(spark, docs_of):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = ({r.doc_id: r.score for r in R.ruled(docs, x).collect()} for x in (labels, turned))
    assert a == b


@pytest.mark.parametrize("words, want", [("a b c d e f g h " * 2, 16), ("a " * 9, 9), ("a " * 8, 0), ("a b c d e f g h x a b c d e f g h", 16), ("", 0), (" ".join(map(str, range(50))), 0)])
def test_repeated_windows(words, want):
    assert R.repeated_words(words.split()) == want == brute(words)[4]


def test_random_windows():
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = " ".join("ab"[k] for k in rng.integers(0, 2, rng.integers(0, 60)))
        assert R.base_counts(text) == brute(text)[:5]


def test_hashed_characters_are_crc32_and_pieces_do_not_matter(monkeypatch):
    data = "héllo wörld, " * 20
    whole = R.hashed_counts(data)
    assert R.hashed_counts("abc").sum() == 2 and R.hashed_counts("abc")[crc32(b"abc") % R.COLUMNS] == 2
    monkeypatch.setattr(R, "PIECE", 7)
    assert (R.hashed_counts(data) == whole).all()


def test_odd_rows(spark, docs_of):
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    plain = "these are plain words of a text that is long enough to be judged by the model and not by rules alone here"
    rows = [(k, (f"{chr(97 + k % 26)}{k} " + plain) if k % 2 else (f"{chr(97 + k % 26)}{k} " + plain).upper().replace(" ", "!!! ")) for k in range(40)]
    odd = [(None, "x"), (None, None), (50, ""), (50, ""), (51, "\n\n \t"), (52, "w" * 2_500_000), (53, "a b " * 400_000), (54, "…\u00a0é " * 30)]
    docs = docs_of(rows + odd).selectExpr("*", "'q' AS kept", "1 AS n_words", "2 AS score")
    got = R.ruled(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    texts = Counter((d, t or "") for d, t in rows + odd)
    assert Counter((r.doc_id, *counts(r)) for r in got) == Counter((d, *brute(t)) for (d, t), n in texts.items() for _ in range(n))
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert sum(by[k].kept == bool(k % 2) for k in range(40)) == 40
    assert R.ruled(docs_of([]), labels).count() == 0
    bare = {r.doc_id: r for r in R.ruled(docs_of(rows), labels.filter("quality = 7")).collect()}
    assert all(abs(r.score - 0.5) < 1e-6 and r.kept for r in bare.values())
