"""Importance resampling towards a target: documents whose features look like the target's are drawn more often.

Features are runs of 1 to ``max_n`` consecutive words, hashed to buckets. The gain of a bucket is the logarithm of
how much more often the target has it than the corpus; a document's weight is the sum over its features, and
perturbed by Gumbel noise of its id, so that the highest scores are a draw without replacement.

Texts repeat lines, so segments are deduplicated: line ends cut texts into lines, equal lines are grouped by their
text, and each distinct line's features are found and hashed once. Their counts enter the corpus counts times the
line's occurrences, and the line's sum of gains goes to every document that has it, joined by a 128-bit digest. Runs
of words across line ends belong to no line; they are found in the documents themselves, from the outermost words of
each line, and added separately.

The driver holds ``buckets`` numbers. Ranks come from rows dealt out by ranges of the score, counted by part.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.common import discard, materialize, sliced, table, texts, worker_state

#: In bytes, of a text whose A-Z are lower-cased: what is not ASCII belongs to words as letters and digits do.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MAX_N, BUCKETS, SALT = 1, 10_000, "2024"
LEAST_WORDS, PERCENT = 20, 10
#: Features whose bucket a worker keeps.
KEPT = 1 << 19


class Hashed(dict):
    """Bucket by feature, found when first asked for."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        self[feature] = at = crc32(feature) % self.buckets
        return at


def _hashed(buckets: int) -> Hashed:
    return worker_state(("buckets", buckets), functools.partial(Hashed, buckets))


def runs(words: list[bytes], max_n: int) -> list[bytes]:
    """All runs of 1 to ``max_n`` consecutive words."""
    return words + [b" ".join(words[i : i + n]) for n in range(2, max_n + 1) for i in range(len(words) - n + 1)]


def _ends(line: bytes, most: int) -> tuple[list[bytes], list[bytes]]:
    """The first and the last ``most`` words of a line, without reading what lies between."""
    head = [m[0] for m in itertools.islice(WORD.finditer(line), most)]
    if len(head) < most:
        return head, head
    return head, [m[0][::-1] for m in itertools.islice(WORD.finditer(line[::-1]), most)][::-1]


def crossing(text: bytes, max_n: int) -> list[bytes]:
    """Runs of up to ``max_n`` words that lie in more than one line."""
    before: list[bytes] = []
    found = []
    for line in text.split(b"\n"):
        head, tail = _ends(line, max_n - 1)
        for i in range(len(before)):
            for j in range(1, min(len(head), max_n - (len(before) - i)) + 1):
                found.append(b" ".join(before[i:] + head[:j]))
        before = (before + tail)[-(max_n - 1) :]
    return found


def _lowered(column: pa.Array) -> list[bytes]:
    return [t.lower() for t in column.cast(pa.binary()).to_pylist()]  # of bytes, so A-Z alone


def _kind(buckets: int) -> str:
    return "u2" if buckets <= 1 << 16 else "u4"


def _line_features(batches, max_n: int, buckets: int):
    for b in sliced(batches, 1024):
        of = _hashed(buckets)
        words = [WORD.findall(t) for t in _lowered(b.column("line"))]
        found = [np.fromiter(map(of.__getitem__, runs(w, max_n)), _kind(buckets)).tobytes() for w in words]
        yield pa.RecordBatch.from_arrays([b.column("h1"), b.column("h2"), b.column("occurrences"), pa.array([len(w) for w in words], pa.int64()), pa.array(found, pa.binary())], LINE_ROW_NAMES)


LINE_ROW = "h1 long, h2 long, occurrences long, n_words long, features binary"
LINE_ROW_NAMES = [c.split()[0] for c in LINE_ROW.split(", ")]


def _cross_features(batches, max_n: int, buckets: int):
    for b in sliced(batches):
        of = _hashed(buckets)
        found = [np.fromiter(map(of.__getitem__, crossing(t, max_n)), _kind(buckets)).tobytes() for t in _lowered(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(found, pa.binary())], ["row", "doc_id", "features"])


def _flat(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All features of a batch one behind the other, and how many each row has."""
    each = column.to_pylist()
    flat = np.frombuffer(b"".join(each), _kind(buckets))
    return flat, np.fromiter(map(len, each), "i8", len(each)) // flat.itemsize


def _counted(batches, buckets: int):
    total = np.zeros(buckets, "i8")
    for b in batches:
        flat, sizes = _flat(b.column("features"), buckets)
        times = np.repeat(b.column("occurrences").to_numpy(), sizes)
        total += np.bincount(flat, times, buckets).astype("i8")
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])


def _weighed(batches, gains: np.ndarray):
    """Features and sum of gains of each row; its other columns stay."""
    for b in batches:
        flat, sizes = _flat(b.column("features"), len(gains))
        ends = np.concatenate([[0], np.cumsum(gains[flat])])
        stops = np.cumsum(sizes)
        names = [n for n in b.schema.names if n not in ("features", "occurrences")]
        yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(sizes), pa.array(ends[stops] - ends[stops - sizes])], [*names, "n", "weight"])


def _digest(line: str | Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), line).alias(name) for seed, name in ((41, "h1"), (97, "h2"))]


class Features:
    """The features of a corpus: of its distinct lines with their occurrences, and those across lines by row."""

    def __init__(self, docs: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS):
        self.rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
        if max_n > 1:
            self.rows = materialize(self.rows, "rows")  # lines and runs across them are found apart and must number rows alike
        self.buckets = buckets
        # Line ends are in no word, so what a line has for features does not depend on the lines around it.
        self.placed = self.rows.select("row", "doc_id", F.explode(F.split("text", "\n")).alias("line"))
        distinct = self.placed.groupBy("line").agg(F.count("*").alias("occurrences")).select(*_digest("line"), "line", "occurrences")
        found = functools.partial(_line_features, max_n=max_n, buckets=buckets)
        self.lines = materialize(distinct.mapInArrow(found, LINE_ROW), "lines")
        across = functools.partial(_cross_features, max_n=max_n, buckets=buckets)
        self.across = materialize(self.rows.mapInArrow(across, "row long, doc_id long, features binary"), "across") if max_n > 1 else None

    def counts(self) -> np.ndarray:
        """How often each bucket occurs, over all texts."""
        parts = [self.lines.select("features", "occurrences")]
        if self.across is not None:
            parts.append(self.across.select("features", F.lit(1).cast("long").alias("occurrences")))
        told = functools.reduce(DataFrame.unionByName, parts).mapInArrow(functools.partial(_counted, buckets=self.buckets), "bucket long, n long")
        total = np.zeros(self.buckets, "i8")
        for r in told.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most a row a bucket
            total[r.bucket] = r.n
        return total

    def weights(self, gains: np.ndarray) -> DataFrame:
        """row, doc_id, n_words, n_features and weight of every row."""
        weighed = functools.partial(_weighed, gains=gains)
        lines = self.lines.select("h1", "h2", "n_words", "features").mapInArrow(weighed, "h1 long, h2 long, n_words long, n long, weight long")
        rows = self.placed.select("row", "doc_id", *_digest("line")).join(lines, ["h1", "h2"]).select("row", "doc_id", "n_words", "n", "weight")
        if self.across is not None:
            rows = rows.unionByName(self.across.mapInArrow(weighed, "row long, doc_id long, n long, weight long").withColumn("n_words", F.lit(0).cast("long")))
        return rows.groupBy("row", "doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("n").alias("n_features"), F.sum("weight").alias("weight"))

    def discard(self) -> None:
        for t in (self.lines, self.across, self.rows):
            if hasattr(t, "_folder"):
                discard(t)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over that in the corpus, both smoothed by one."""
    total, wanted, buckets = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(total + buckets)) / (float(s + 1) * float(wanted + buckets)))) for s, t in zip(corpus.tolist(), target.tolist())], "i8")


def _noise(salt: str) -> Column:
    """Gumbel noise of an id, in thousandths; a null id counts as the text null."""
    named = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their place (from 1) in an order over all of them: dealt out by ranges, numbered in each part behind the parts before."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    spread = materialize(spread, "ranges")
    part, nth = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes, starts, at = sorted((r.part, r.n) for r in spread.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()), [], 0  # a row a part
    for p, n in sizes:
        starts.append((p, at))
        at += n
    before = F.broadcast(rows.sparkSession.createDataFrame(starts, "part long, start long"))
    return spread.withColumn("part", part).join(before, "part").withColumn("rank", F.col("start") + nth + 1).drop("part", "start", "_id")


def resampled(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, salt: str = SALT) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank numbers the drawn ones by descending score, the others have none.

    Of the rows with ``least_words`` words the highest ``percent`` in 100 are drawn, ties to the smaller id (null ids
    last), then to the place of the row. Null texts have no features and weight 0. Repeated rows are rows of their own
    with equal scores. Columns beside doc_id and text are left behind; an empty table gives an empty one; with an empty
    target each gain compares with an even spread.
    """
    wanted = Features(target, max_n, buckets)
    own = Features(docs, max_n, buckets)
    scored = own.weights(gains(own.counts(), wanted.counts())).withColumn("score", F.col("weight") + _noise(salt))
    scored = materialize(scored, "scored", short=True)
    own.discard()
    wanted.discard()
    able = F.col("n_words") >= least_words
    drawn = percent * scored.filter(able).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    placed = ranked(scored.filter(able), order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return resampled(table(spark, sf_dir, "documents"), target)


#: crc32 by half bytes, its table made by the polynomial's rule.
OP11_SQL = f"""
WITH RECURSIVE step(k, n, c) AS (
  SELECT 0, n, n FROM (SELECT unnest(range(16))::BIGINT AS n)
  UNION ALL
  SELECT k + 1, n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 4
), halves AS (SELECT list(c ORDER BY n) AS t FROM step WHERE k = 4),
found AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 't', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark
), words AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM found),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x)), lambda i: (instr('0123456789ABCDEF', substr(x, (i + 1 + CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END)::INT, 1)) - 1)::BIGINT)),
    lambda c, n: xor(c >> 4, t[(xor(c, n) & 15) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM words, halves
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM found JOIN hashed USING (w) GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS big_s, coalesce(sum(t), 0)::DOUBLE AS big_t FROM counts),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (big_s + {BUCKETS})) / ((s + 1)::DOUBLE * (big_t + {BUCKETS}))))::BIGINT AS g FROM counts, totals),
weights AS (SELECT id AS doc_id, count(*) AS n_features, sum(g)::BIGINT AS weight FROM found JOIN hashed USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SALT}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= {LEAST_WORDS}) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM placed
"""
