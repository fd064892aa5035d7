"""Ranked lexical search: items pass term owners one after the other and carry their documents' scores along.

One pass over the documents cuts them into shards of a few thousand and writes, for each shard, a posting list for
every term that an item asks for, and its documents' ids and lengths. Terms have owners by how frequent they are:
the first owner has the rarest, the last the most frequent, so that lists grow while scores settle.

A shard's bundles, one an item with the documents scored so far (places and integers), are cogrouped with the
first owner's lists of that shard, gain those terms' contributions, and go on to the next owner by a shuffle. On the
way a document leaves an item's bundle when all terms to come could not lift it to the item's tenth score in the
shard; that bound is exact. The last owner's stage picks each item's best of the shard, and a window limited in
every task picks the best of all shards.

Whatever the size of the corpus, a task holds one shard: at most ``SHARD`` documents, ``POSTINGS`` entries, and
scores of ``WAVE`` items; more items go in waves, which is all that the driver and the tasks see of them.
"""

from __future__ import annotations

import functools
import math
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import discard, materialize, sliced, table, texts

#: In bytes, of a text whose A-Z are lower-cased.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BEST, OWNERS = 10, 4
#: Documents and entries of a shard, items of a wave (about), and terms that tasks may get to choose by; with more, every term is indexed.
SHARD, POSTINGS, WAVE, MOST_TERMS = 4096, 1 << 21, 256, 1 << 18
#: What a term adds is below its weight times this.
UNIT = 1_000_000
INDEX_ROW = "shard long, term string, n long, total long, places binary, counts binary, doc_ids array<bigint>"
INDEX_NAMES = [c.split()[0] for c in INDEX_ROW.split(", ")]
BUNDLE = "shard long, item int, places binary, scores binary, doc_ids array<bigint>"
FOUND = "item int, doc_id long, score long"


def words(text: str) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def _rows(columns: list, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class Shard:
    """Posting lists of the documents at hand."""

    KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def __init__(self, number: int, documents: int, postings: int):
        self.most, self.most_entries = documents, postings
        self.number, self.ids, self.lengths, self.entries = number, [], array("I"), 0
        self.lists: dict[bytes, tuple[array, array]] = {}

    def add(self, doc_id: int | None, text: str, wanted: frozenset | None) -> None:
        found = words(text)
        place, counts = len(self.ids), Counter(found)
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        for term in counts if wanted is None else wanted & counts.keys():
            entry = self.lists.get(term)
            if entry is None:
                entry = self.lists[term] = array("H"), array("I")
            entry[0].append(place)
            entry[1].append(counts[term])
            self.entries += 1

    def full(self) -> bool:
        return len(self.ids) >= self.most or self.entries >= self.most_entries

    def batches(self):
        """The documents as one row without a term (n counts those with words, total their words), then a row a term."""
        yield _rows([[self.number], [None], [sum(map(bool, self.lengths))], [sum(self.lengths)], [self.lengths.tobytes()], [None], [self.ids]], self.KINDS, INDEX_NAMES)
        terms = list(self.lists)
        for at in range(0, len(terms), 2000):
            some = terms[at : at + 2000]
            lists = [self.lists[t] for t in some]
            k = len(some)
            yield _rows([[self.number] * k, [t.decode("utf-8", "replace") for t in some], [len(a) for a, _ in lists], [None] * k, [a.tobytes() for a, _ in lists], [b.tobytes() for _, b in lists], [None] * k], self.KINDS, INDEX_NAMES)


def _indexed(batches, wanted: frozenset | None, documents: int, postings: int):
    number = TaskContext.get().partitionId() << 32
    shard = Shard(number, documents, postings)
    for b in sliced(batches):
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            shard.add(doc_id, text, wanted)
            if shard.full():
                yield from shard.batches()
                number += 1
                shard = Shard(number, documents, postings)
    if shard.ids:
        yield from shard.batches()


def _item_terms(batches):
    for b in sliced(batches):
        terms = [sorted({w.decode("utf-8", "replace") for w in words(t)}) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(terms, pa.list_(pa.string()))], ["row", "item_id", "terms"])


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def owners(df: dict[str, int], number: int = OWNERS) -> dict[str, int]:
    """An owner for each term by frequency: the last has half of all entries, the one before half of the rest, and so on."""
    total, before, of = sum(df.values()), 0, {}
    edges = [total >> (number - 1 - k) for k in range(number - 1)]
    for term in sorted(df, key=lambda t: (df[t], t)):
        before += df[term]
        of[term] = sum(before > e for e in edges)
    return of


class Stage:
    """One owner's turn: bundles of a shard meet the owner's lists of that shard."""

    def __init__(self, items: list[list[tuple[str, int]]], rest: list[int], documents: int, total: int, last: bool, best: int):
        self.items, self.rest, self.documents, self.total, self.last, self.best = items, rest, documents, total, last, best

    def __call__(self, key: tuple, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        own = {i: (p, s, d) for i, p, s, d in zip(*(bundles.column(c).to_pylist() for c in ("item", "places", "scores", "doc_ids")))}
        packed, _, ids = own.pop(-1)
        lengths = np.frombuffer(packed, "u4").tolist()
        m = np.array([10 + 90 * n * self.documents // self.total for n in lengths], "i8") if self.total else np.zeros(0, "i8")
        gained = {}
        for term, places, counts in zip(*(lists.column(c).to_pylist() for c in ("term", "places", "counts"))):
            at, tf = np.frombuffer(places, "u2"), np.frombuffer(counts, "u4").astype("i8")
            gained[term] = at, 1_000_000_000 * tf // (1000 * tf + 8 * m[at])
        out = []
        for item, (terms, rest) in enumerate(zip(self.items, self.rest)):
            mine = [(w, *gained[t]) for t, w in terms if t in gained]
            if not mine and item not in own:
                continue
            scores = np.zeros(len(ids), "i8")
            if item in own:
                scores[np.frombuffer(own[item][0], "u2")] = np.frombuffer(own[item][1], "i8")
            for w, at, part in mine:
                scores[at] += w * part
            at = np.flatnonzero(scores)
            if len(at) > self.best:
                floor = np.partition(scores[at], len(at) - self.best)[len(at) - self.best]
                at = at[scores[at] + (0 if self.last else rest * UNIT) >= floor]
            if len(at):
                out.append((item, at, scores[at]))
        return self.chosen(ids, out) if self.last else self.bundles(key[0].as_py(), packed, ids, out)

    def chosen(self, ids: list, out: list[tuple]) -> pa.Table:
        rows = []
        for item, at, scores in out:
            order = sorted(zip(scores.tolist(), (ids[k] for k in at.tolist())), key=lambda r: (-r[0], r[1] is None, r[1]))
            rows += [(item, doc_id, score) for score, doc_id in order[: self.best]]
        return pa.Table.from_batches([_rows(list(zip(*rows)) if rows else [()] * 3, [pa.int32(), pa.int64(), pa.int64()], ["item", "doc_id", "score"])])

    def bundles(self, shard: int, packed: bytes, ids: list, out: list[tuple]) -> pa.Table:
        items = [-1, *(i for i, _, _ in out)]
        places = [packed, *(at.astype("u2").tobytes() for _, at, _ in out)]
        scores = [None, *(s.tobytes() for _, _, s in out)]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.Table.from_batches([_rows([[shard] * len(items), items, places, scores, [ids, *[None] * len(out)]], kinds, [c.split()[0] for c in BUNDLE.split(", ")])])


def _turn(stage: Stage):
    return lambda key, bundles, lists: stage(key, bundles, lists)


def _wave(index: DataFrame, frequency: DataFrame, items: list, documents: int, total: int, best: int, number: int) -> DataFrame:
    """doc_id and score of the best of each shard for each item of a wave, by the item's place in the wave."""
    spark = index.sparkSession
    asked = spark.createDataFrame([(t,) for t in sorted({t for r in items for t in r.terms})], "term string")
    df = {r.term: r.df for r in frequency.join(F.broadcast(asked), "term").collect()}  # terms of one wave
    of, weight = owners(df, number), {t: term_weight(documents, n) for t, n in df.items()}
    bundles = index.filter("term IS NULL").select("shard", F.lit(-1).alias("item"), "places", F.lit(None).cast("binary").alias("scores"), "doc_ids")
    for k in range(number):
        terms = [[(t, weight[t]) for t in r.terms if of.get(t) == k and weight[t]] for r in items]
        rest = [sum(weight[t] for t in r.terms if of.get(t, -1) > k) for r in items]
        mine = spark.createDataFrame([(t,) for t in sorted(of) if of[t] == k], "term string")
        lists = index.join(F.broadcast(mine), "term").select(*[F.col(c).alias(c) for c in ("shard", "term", "places", "counts")])  # columns of its own beside the bundles'
        stage = Stage(terms, rest, documents, total, k == number - 1, best)
        bundles = bundles.groupBy("shard").cogroup(lists.groupBy("shard")).applyInArrow(_turn(stage), FOUND if stage.last else BUNDLE)
    return bundles


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, number: int = OWNERS, wave: int = WAVE, shard: int = SHARD, postings: int = POSTINGS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``best`` documents of every item (columns item_id and text).

    Only scores above 0 count; equal scores go to the smaller id, null ids last. Every row is a document and every
    row an item of its own, whatever ids repeat, so an item that stands twice is answered twice. Null and empty texts
    have no terms: such items get no row. Other columns are left behind; an empty table on either side gives an empty one.
    """
    spark = docs.sparkSession
    numbered = texts(items.select(F.col("item_id").alias("doc_id"), "text")).withColumn("row", F.monotonically_increasing_id())
    asked = materialize(numbered.mapInArrow(_item_terms, "row long, item_id long, terms array<string>"), "items")
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    some = [r.term for r in terms.limit(MOST_TERMS + 1).collect()]
    wanted = frozenset(t.encode("utf-8") for t in some) if len(some) <= MOST_TERMS else None
    index = materialize(texts(docs).mapInArrow(functools.partial(_indexed, wanted=wanted, documents=shard, postings=postings), INDEX_ROW), "index")
    size = index.filter("term IS NULL").agg(F.sum("n").alias("documents"), F.sum("total").alias("total")).first()
    frequency = materialize(index.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df")), "frequency")
    waves, found = -(-asked.count() // wave), []
    for k in range(waves):
        own = sorted(asked.filter(F.pmod(F.xxhash64("row"), F.lit(waves)) == k).collect(), key=lambda r: r.row)
        names = spark.createDataFrame([(i, r.row, r.item_id) for i, r in enumerate(own)], "item int, row long, item_id long")
        scored = _wave(index, frequency, own, size.documents or 0, size.total or 0, best, number)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        first = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        found.append(materialize(first.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "found", short=True))
    for t in (asked, index, frequency):
        discard(t)
    return functools.reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_FOUND = "unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
OP12_SQL = f"""
WITH words AS (SELECT doc_id, {_FOUND} AS term FROM documents),
postings AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
size AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_FOUND} AS term FROM benchmark)),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, size WHERE term IN (SELECT term FROM asked) GROUP BY term, big_n),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), size GROUP BY item_id, doc_id
), placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {BEST}
"""
