"""Near-duplicate documents: an exact Jaccard join on word shingles by token-combination prefixes.

A text's set is its distinct n-word shingles. Equal sets are one node from the start. Tokens are ordered by
class (rare before frequent), then by hash. A link needs a common part of at least t = ceil(J * size), so the
least common token of two linked sets lies in the first size - t + 1 tokens of both:

* if that token is rare, it is a signature of both on its own;
* if it is frequent, all common tokens are. The prefix is then extended by g tokens, in which both sets share
  at least g + 1 frequent ones; with these dealt into g groups by hash, two of them fall into one group, so
  every pair of frequent tokens in a group (a two-token combination) is a signature. g depends on the size's
  power of two, and a set signs for each power that a partner of its may have.

So no link is lost, frequent tokens never make long lists of unlike sets, and a set whose prefix nobody
shares costs nothing further. Which tokens are frequent is counted over all texts.

Sets with a common signature are compared by size and by a parity sketch (each token flips one of 1,024 bits, so
two sketches never differ in more bits than the sets in tokens): that drops most unlike pairs and no link.
What is left is verified exactly. To find components without all pairs of a large group,
each set is first verified against the least set of each signature; signatures that still join several components
are then led by another set each; and where components are still apart, every pair from different ones is verified. Links inside a component change
nothing and are left out.

A set is named by 64 bits. A second 64 tell which names two different sets have (among 10^10 sets a few): these
few names are told to all tasks, and their sets take the second 64 instead; so two unlike sets are one node with a
chance of one in 2^128, or where names clash 2^64.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.common import discard, materialize, sliced, table, texts
from valuemark.llm.components import stars
from valuemark.llm.shingles import mixed, set_check, set_digest, shingle_sets

#: Bits of a token that are counted, tokens in a counting bucket, least count of a frequent token.
KEY_BITS, BUCKET_TOKENS, LEAST_FREQUENT = 48, 1 << 20, 8
#: At most so many tokens are called frequent (the most common ones); they are marked in a table of so many bits.
MOST_FREQUENT, MARK_BITS = 1 << 21, 26
#: Bytes up to which a list of document ids and their partners is broadcast, by about so many a row and a partner; longer ones are joined by exchange.
BROADCAST_BYTES, ROW_BYTES, PARTNER_BYTES = 12_000_000, 30, 8
COUNT_CHUNK = 1 << 20


#: A sketch has 64 parities a column. With few of them large unlike sets are half apart at most, which rules nothing out.
SKETCH = tuple(f"s{k}" for k in range(16))


def name(tokens: np.ndarray, bits: int, clashes: frozenset[int] = frozenset()) -> int:
    """What a set is called: the first ``bits`` of its digest, or its second digest where others have these too."""
    first = set_digest(tokens) >> (64 - bits)
    return set_check(tokens) if first in clashes else first


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities, 64 to a number."""
    width = 64 * len(SKETCH)
    bits = (np.bincount(((tokens >> np.uint64(8)) % np.uint64(width)).astype("i8"), minlength=width) & 1).astype("u1")
    return np.packbits(bits).view("<i8")


def _described(batches, n: int, bits: int):
    """n_shingles, node (name of the set), second digest and parity sketch of each text."""
    for b in sliced(batches):
        sets = list(shingle_sets(b.column("text").to_pylist(), n))
        marks = np.array([sketch(s) for s in sets], "i8").reshape(-1, len(SKETCH))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([name(s, bits) for s in sets], pa.int64()), pa.array([set_check(s) for s in sets], pa.int64()), *[pa.array(marks[:, k]) for k in range(len(SKETCH))]], ["doc_id", "n_shingles", "node", "second", *SKETCH])


def _fresh(batches, n: int, called):
    """Sets and nodes of a task, each node once (within a bounded memory)."""
    seen: set[int] = set()
    for b in sliced(batches):
        for tokens in shingle_sets(b.column("text").to_pylist(), n):
            if not len(tokens):
                continue
            node = called.value(tokens)
            if node not in seen:
                if len(seen) > 50_000:
                    seen.clear()
                seen.add(node)
                yield node, tokens


def _keys(tokens: np.ndarray) -> np.ndarray:
    return tokens >> np.uint64(64 - KEY_BITS)


def _counted(batches, n: int, called, buckets: int):
    """Tokens of a task for counting: a row for each bucket that has any, with its distinct keys and how often they stand there."""
    held, size = [], 0
    for _, tokens in _fresh(batches, n, called):
        held.append(_keys(tokens))
        size += len(tokens)
        if size >= COUNT_CHUNK:
            yield _counts(np.concatenate(held), buckets)
            held, size = [], 0
    if held:
        yield _counts(np.concatenate(held), buckets)


def _counts(keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows bucket, first key, steps to the next keys, and place and count of keys that repeat; steps take four bytes where they fit."""
    keys, counts = np.unique(keys, return_counts=True)
    bucket = (keys >> np.uint64(KEY_BITS - buckets.bit_length() + 1)).astype("i8")
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        steps, again = np.diff(keys[a:b]), np.flatnonzero(counts[a:b] > 1)
        narrow = not len(steps) or steps.max() < 1 << 32
        rows.append((int(bucket[a]), int(keys[a]), narrow, steps.astype("<u4" if narrow else "<u8").tobytes(), np.stack([again, counts[a:b][again]]).astype("<u4").tobytes()))
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "first", "narrow", "steps", "again"])


COUNT_ROW = "bucket long, first long, narrow boolean, steps binary, again binary"


def _common(t: pa.Table, least: int) -> pa.Table:
    """Keys of a bucket that are found at least ``least`` times, and how often."""
    parts, times = [], []
    for first, narrow, steps, again in zip(*(t.column(c).to_pylist() for c in ("first", "narrow", "steps", "again"))):
        parts.append(np.cumsum(np.r_[np.uint64(first), np.frombuffer(steps, "<u4" if narrow else "<u8").astype("u8")], dtype="u8"))
        times.append(np.ones(len(parts[-1]), "i8"))
        at, count = np.frombuffer(again, "<u4").reshape(2, -1)
        times[-1][at] = count
    keys, times = np.concatenate(parts), np.concatenate(times)
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.add.reduceat(times, starts)
    many = counts >= least
    return pa.table({"key": pa.array(keys[starts][many].astype("i8")), "n": pa.array(counts[many])})


def frequent_marks(rows: DataFrame, n: int, called, total: int) -> bytes:
    """A bit for each mark that a frequent token has. Tokens are counted over all texts; an unlucky rare token that shares a mark counts as frequent, which costs time but no link."""
    buckets = 1 << max(6, math.ceil(math.log2(max(total / BUCKET_TOKENS, 1))))
    counted = rows.select("text").mapInArrow(functools.partial(_counted, n=n, called=called, buckets=buckets), COUNT_ROW)
    least = LEAST_FREQUENT
    common = materialize(counted.groupBy("bucket").applyInArrow(lambda t: _common(t, least), "key long, n long"), "common", short=True)
    sizes = common.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()  # at most 60 rows
    power = LEAST_FREQUENT.bit_length() - 1
    while sum(r["count"] for r in sizes if r.p >= power) > MOST_FREQUENT:
        power += 1
    marks = np.zeros(1 << MARK_BITS, bool)
    for r in common.filter(F.col("n") >= 1 << power).select(F.shiftrightunsigned("key", KEY_BITS - MARK_BITS).alias("m")).distinct().toLocalIterator(prefetchPartitions=True):
        marks[r.m] = True
    return np.packbits(marks).tobytes()


def _is_frequent(tokens: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = tokens >> np.uint64(64 - MARK_BITS)
    return (marks[(at >> np.uint64(3)).astype("i8")] >> (np.uint8(7) - (at & np.uint64(7)).astype("u1"))) & 1 == 1


def signatures(tokens: np.ndarray, frequent: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of a set at the similarity num / den."""
    size = len(tokens)
    base = size - -(-num * size // den) + 1
    rare, often = tokens[~frequent], tokens[frequent]
    found = [rare[:base]]
    if len(rare) < base:
        for power in {size.bit_length(), max(1, -(-num * size // den)).bit_length()}:
            groups = max(1, ((1 << (power - 1)) * (den - num)) // (3 * den))
            part = often[: base - len(rare) + groups]
            group = mixed(part) % np.uint64(groups)
            order = np.argsort(group, kind="stable")
            part, group = part[order], group[order]
            for step in range(1, int(np.bincount(group.astype("i8")).max(initial=0))):
                same = np.flatnonzero(group[step:] == group[:-step])
                found.append(mixed(part[same] * np.uint64(3) + mixed(part[same + step] + np.uint64(power))))
    return np.unique(np.concatenate(found))


def _signed(batches, n: int, called, num: int, den: int, marks):
    bits = np.frombuffer(marks.value, "u1")
    held, nodes, size = [], [], 0
    for node, tokens in _fresh(batches, n, called):
        held.append(signatures(tokens, _is_frequent(tokens, bits), num, den))
        nodes.append(node)
        size += len(held[-1])
        if size > 200_000:
            yield _signature_rows(held, nodes)
            held, nodes, size = [], [], 0
    if held:
        yield _signature_rows(held, nodes)


def _signature_rows(held, nodes) -> pa.RecordBatch:
    each = [len(h) for h in held]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).astype("i8")), pa.array(np.repeat(np.array(nodes, "i8"), each))], ["sig", "node"])


def _tokens(batches, n: int, called):
    for b in sliced(batches):
        sets = list(shingle_sets(b.column("text").to_pylist(), n))
        yield pa.RecordBatch.from_arrays([pa.array([called.value(s) for s in sets], pa.int64()), pa.array([s.astype("i8") for s in sets], pa.list_(pa.int64())), b.column("others")], ["node", "tokens", "others"])


def _small(df: DataFrame) -> DataFrame:
    size = df.agg(F.sum(ROW_BYTES + PARTNER_BYTES * F.size("others"))).first()[0]
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df


def verified(pairs: DataFrame, rows: DataFrame, owners: DataFrame, n: int, called, num: int, den: int) -> DataFrame:
    """The pairs a, b of nodes that are linked, by their whole sets; ``owners`` has the document that stands for a node."""
    others = pairs.groupBy(F.col("b").alias("node")).agg(F.collect_set("a").alias("others"))
    leads = pairs.select(F.col("a").alias("node")).distinct()

    def sets(nodes: DataFrame) -> DataFrame:
        wanted = _small(materialize(nodes.join(owners, "node").select("owner", "others"), "wanted", short=True))
        return rows.join(wanted, rows.doc_id.eqNullSafe(F.col("owner"))).select("text", "others").mapInArrow(functools.partial(_tokens, n=n, called=called), "node long, tokens array<long>, others array<long>")

    b = sets(others).select(F.col("node").alias("b"), F.col("tokens").alias("right"), F.explode("others").alias("a"))
    a = sets(leads.withColumn("others", F.array().cast("array<long>"))).select(F.col("node").alias("a"), F.col("tokens").alias("left")).dropDuplicates(["a"])
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    return a.join(b, "a").filter(common * den >= union * num).select("a", "b").distinct()


def alone(lists: DataFrame) -> DataFrame:
    """Of the signatures that the very same sets have (a passage that they share gives hundreds), one: they join the same pairs."""
    marks = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(20,0)")).alias(f"m{k}") for k in (1, 2)]
    alike = lists.groupBy("sig").agg(F.count("*").alias("n"), *marks).groupBy("n", "m1", "m2").agg(F.min("sig").alias("sig"))
    return materialize(lists.join(alike.select("sig"), "sig", "left_semi"), "alone", short=True)


def clashing(described: DataFrame) -> list[int]:
    """Names that different sets have. Of m sets about m^2 / 2^65 are to be found here: 300 of 10^11."""
    both = described.filter("n_shingles > 0").groupBy("node").agg(F.min("second").alias("least"), F.max("second").alias("most"))
    return [r.node for r in both.filter("least <> most").select("node").collect()]


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, bits: int = 64) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links of similarity num / den) of every row.

    Null and wordless texts have no shingles and are linked with nothing; repeated rows are linked with each
    other; null ids take part, and a component of null ids alone has a null id. No rows give no rows.
    ``bits`` of a set's digest name it (fewer than 64 in tests, so that names clash).
    """
    rows = texts(docs)
    sparks = docs.sparkSession
    described = materialize(rows.mapInArrow(functools.partial(_described, n=n, bits=bits), ", ".join(f"{c} long" for c in ("doc_id", "n_shingles", "node", "second", *SKETCH))), "described")
    total = described.agg(F.sum("n_shingles")).first()[0] or 0
    if not total:
        return described.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    clashes = clashing(described)
    if clashes:
        described = described.withColumn("node", F.when(F.col("node").isin(clashes), F.col("second")).otherwise(F.col("node")))
    called = sparks.sparkContext.broadcast(functools.partial(name, bits=bits, clashes=frozenset(clashes)))
    owners = described.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("owner"))
    marks = sparks.sparkContext.broadcast(frequent_marks(rows, n, called, total))
    signed = rows.select("text").mapInArrow(functools.partial(_signed, n=n, called=called, num=num, den=den, marks=marks), "sig long, node long")
    shared = materialize(signed.groupBy("sig").agg(F.min("node").alias("lead"), F.max("node").alias("other")).filter("lead <> other").select("sig", "lead"), "shared", short=True)
    every = materialize(signed.join(shared, "sig").distinct(), "lists", short=True)
    lists = alone(every)
    discard(every)

    about = described.filter("n_shingles > 0").dropDuplicates(["node"]).select("node", F.col("n_shingles").alias("size"), *SKETCH)
    of = lambda p: about.select(*[F.col(c).alias(p + c) for c in about.columns])

    def near(p: str, q: str) -> Column:
        """What two sets must fulfil to be linked, as far as their sizes and sketches tell."""
        x, y = F.col(f"{p}size"), F.col(f"{q}size")
        apart = sum((F.bit_count(F.col(p + c).bitwiseXOR(F.col(q + c))) for c in SKETCH), F.lit(0))
        return (F.least(x, y) * den >= F.greatest(x, y) * num) & (apart * (den + num) <= (x + y) * (den - num))

    first = lists.filter("node <> lead").select(F.col("lead").alias("a_node"), F.col("node").alias("b_node")).distinct().join(of("a_"), "a_node").join(of("b_"), "b_node").filter(near("a_", "b_")).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    links = materialize(verified(materialize(first, "pairs", short=True), rows, owners, n, called, num, den), "verified", short=True)
    star = stars(links)

    def opened(star: DataFrame) -> DataFrame:
        """Rows of the signatures that still join several components, with their set's size and sketch."""
        placed = lists.join(star.select(F.col("hi").alias("node"), F.col("lo").alias("root")), "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
        by_root = placed.groupBy("sig", "root").agg(F.count("*").alias("members"))
        mixed_sigs = by_root.groupBy("sig").agg(F.max_by("root", F.struct("members", "root")).alias("largest"), F.count("*").alias("roots")).filter("roots > 1").select("sig", "largest")
        return materialize(placed.join(mixed_sigs, "sig").join(about, "node"), "open", short=True)

    # Another set of each open signature leads now, a different one in each, so that groups grow together.
    open_lists = opened(star)
    members = F.struct(*[F.col(c).alias(f"a_{c}") for c in ("node", "root", "size", *SKETCH)])
    leads = open_lists.groupBy("sig").agg(F.min_by(members, F.xxhash64("sig", "node")).alias("a")).select("sig", "a.*")
    joined = open_lists.select("sig", *[F.col(c).alias(f"b_{c}") for c in ("node", "root", "size", *SKETCH)]).join(leads, "sig")
    pairs = joined.filter((F.col("a_root") != F.col("b_root")) & near("a_", "b_")).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
    star = stars(star.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(verified(materialize(pairs, "pairs", short=True), rows, owners, n, called, num, den)))

    open_lists = opened(star)
    side = lambda p: open_lists.select("sig", *[F.col(c).alias(p + c) for c in ("node", "root", "largest", "size", *SKETCH)])
    meet = (F.col("x_root") != F.col("y_root")) & near("x_", "y_")
    second = side("x_").filter("x_root <> x_largest").join(side("y_"), "sig").filter(meet).select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    more = verified(materialize(second, "pairs", short=True), rows, owners, n, called, num, den)
    star = stars(star.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(more))

    roots = owners.join(star.select(F.col("hi").alias("node"), F.col("lo").alias("root")), "node", "left").select("node", "owner", F.coalesce("root", "node").alias("root"))
    least = roots.groupBy("root").agg(F.min("owner").alias("component_id"))
    component = roots.join(least, "root").select("node", "component_id")
    return described.join(component, "node", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 4, 85, 100)
