"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a line. It hashes to a wide vector: four lanes of 32 bits from the whole line, and 128 lanes
that count the one-bits of two 64-bit hashes over the line's clauses (a run of text without punctuation, cut
after 64 characters, with the punctuation behind it). A document's fingerprint is the sum of its paragraphs'
vectors, lane by lane, modulo 2^32. So the order of paragraphs has no part in it, equal multisets
of paragraphs have equal fingerprints, and a paragraph's vector can be added or taken away later.

Each clause moves each of the 128 lanes up or down with equal chance, so the inner product of two
fingerprints estimates that of the two multisets of clauses; likeness is the cosine, cut off to 0 to 1,
with an error of about 0.09. Equal fingerprints have likeness 1; an empty text is like nothing else.

Everything is DataFrame functions. Written in hexadecimal: clause count (8 digits), 4 lanes (8 each),
128 lanes (8 each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import table, texts

#: Seeds of 64 lanes each; two of them keep the sums of a document few enough for generated code.
SEEDS = (11, 23)
#: Seeds of the lanes that tell unequal documents apart.
EQUAL = SEEDS
LANES = 64 * len(SEEDS)
#: A clause, or what stands before the first.
STOPS = r"\s.,;:!?|%&$#*"
CLAUSE = rf"[^{STOPS}][^\n.,;:!?|%&$#*]{{0,63}}[{STOPS}]*|[{STOPS}]+"
#: Most buckets: the driver sees one id of each. With more rows buckets grow; they are sorted and spilled, never held.
ROWS_PER_BUCKET, MAX_BUCKETS = 512, 1 << 17
LOW = 0xFFFFFFFF
PAIR = 0x0000000100000001


def _vector() -> list[Column]:
    """Sums over the hashes of clauses; two 32-bit counts share a long, so no sum can overflow."""
    sums = [F.sum(F.col("full").cast("long")).alias("n")]
    for k in range(len(EQUAL)):
        h = F.when(F.coalesce(F.col("nth"), F.lit(0)) == 0, F.col(f"line{k}")).otherwise(F.lit(0).cast("long"))
        sums += [F.sum(h.bitwiseAND(F.lit(LOW))).alias(f"e{k}_0"), F.sum(F.shiftrightunsigned(h, 32)).alias(f"e{k}_1")]
    for k in range(len(SEEDS)):
        h = F.when(F.col("full"), F.col(f"clause{k}")).otherwise(F.lit(0).cast("long"))
        sums += [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(PAIR))).alias(f"c{k}_{j}") for j in range(32)]
    return sums


def _packed() -> tuple[Column, Column, Column]:
    """Clause count, equality lanes and counting lanes out of the sums."""
    equality = F.array(*[F.col(f"e{s}_{k}").bitwiseAND(F.lit(LOW)) for s in range(len(EQUAL)) for k in (0, 1)])
    counts = F.array(*[x.bitwiseAND(F.lit(LOW)) for s in range(len(SEEDS)) for j in range(32) for x in (F.col(f"c{s}_{j}"), F.shiftrightunsigned(F.col(f"c{s}_{j}"), 32))])
    return F.col("n"), equality, counts


def _print(count: Column, equality: Column, counts: Column) -> Column:
    digits = lambda c, width: F.lpad(F.hex(c), width, "0")
    return F.concat(
        digits(count.bitwiseAND(F.lit(LOW)), 8),
        F.array_join(F.transform(equality, lambda x: digits(x, 8)), ""),
        F.array_join(F.transform(counts, lambda x: digits(x, 8)), ""),
    )


def _signed(count: Column, counts: Column) -> Column:
    """Lanes as ups minus downs; a lane counts as far as the clause count does."""
    return F.transform(counts, lambda x: (2 * x - count).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _likeness(same: Column, a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    cosine = _dot(a, b) / F.sqrt(norm_a * norm_b)
    return F.when(same, F.lit(1.0)).when(norm_a * norm_b > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine))).otherwise(F.lit(0.0))


def _lanes(fingerprint: Column) -> tuple[Column, Column, Column]:
    """Count, equality lanes and counting lanes of a written fingerprint."""
    number = lambda start, width: F.conv(F.substring(fingerprint, start, width), 16, 10).cast("long")
    return number(1, 8), F.array(*[number(9 + 8 * k, 8) for k in range(4)]), F.array(*[number(41 + 8 * k, 8) for k in range(LANES)])


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two written fingerprints."""
    (na, _, ca), (nb, _, cb) = _lanes(a), _lanes(b)
    x, y = _signed(na, ca), _signed(nb, cb)
    return _likeness(a == b, x, y, _dot(x, x), _dot(y, y))


def combined(a: Column, b: Column, remove: bool = False) -> Column:
    """Fingerprint of the multisets' sum, or of ``a`` with the paragraphs of ``b`` taken away."""
    (na, ea, ca), (nb, eb, cb) = _lanes(a), _lanes(b)
    sign = -1 if remove else 1
    at = lambda x, y, power: F.pmod(x + y * sign, F.lit(power))
    return _print(at(na, nb, 1 << 32), F.zip_with(ea, eb, lambda x, y: at(x, y, 1 << 32)), F.zip_with(ca, cb, lambda x, y: at(x, y, 1 << 32)))


def _summed(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A row per key with n, equality and counts; no exchange where ``rows`` are dealt out by a part of the keys.

    A line is hashed before its clauses are made rows, and a clause's row has its hashes only: memory does not
    grow with the product of a line's length and its clauses.
    """
    lines = rows.select(*keys, F.explode(F.split(text, "\n")).alias("line"))
    wholes = [F.xxhash64(F.lit(seed), "line").alias(f"line{k}") for k, seed in enumerate(EQUAL)]
    hashes = F.transform(F.regexp_extract_all("line", F.lit(CLAUSE), 0), lambda c: F.struct((F.length(c) > 0).alias("full"), *[F.xxhash64(F.lit(-seed), c).alias(f"clause{k}") for k, seed in enumerate(SEEDS)]))
    hashed = lines.select(*keys, *wholes, hashes.alias("found"))  # a step of its own: what stands beside a generator is computed behind it
    split = hashed.select(*keys, *[f"line{k}" for k in range(len(EQUAL))], F.posexplode_outer("found").alias("nth", "clause"))
    columns = [F.coalesce("clause.full", F.lit(False)).alias("full"), *[F.col(f"clause.clause{k}").alias(f"clause{k}") for k in range(len(SEEDS))]]
    clauses = split.select(*keys, *[f"line{k}" for k in range(len(EQUAL))], "nth", *columns)
    n, equality, counts = _packed()
    return clauses.groupBy(*keys).agg(*_vector()).select(*keys, "n", equality.alias("equality"), counts.alias("counts"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row (null text as empty); repeated rows stay apart."""
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    summed = _summed(rows, ["row", "doc_id"], "text")
    return summed.select("doc_id", _print(F.col("n"), F.col("equality"), F.col("counts")).alias("fingerprint"))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in buckets by descending id (null ids last, ties by text), each with the next row's text.

    The rows are dealt out once, by bucket. The first row of the next bucket joins each bucket as a guest, so
    the bucket's last row finds its successor; the very last row is followed by the first. Buckets are cut at
    quantiles of the ids; what the driver sees is one id a bucket, at most ``MAX_BUCKETS``.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    rows = texts(docs).withColumn("n_chars", F.length("text").cast("long"))
    total = docs.count()
    wanted = min(MAX_BUCKETS, -(-total // ROWS_PER_BUCKET))
    cuts = sorted({float(x) for x in rows.stat.approxQuantile("doc_id", [k / wanted for k in range(1, wanted)], 0.2 / wanted)}) if wanted > 1 else []
    if cuts:
        placed = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="as_double", outputCol="bucket", handleInvalid="keep").transform(rows.withColumn("as_double", F.col("doc_id").cast("double"))).drop("as_double")
        placed = placed.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(len(cuts) - F.col("bucket").cast("int")))
    else:
        placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    heads = sorted((r.bucket, r.head) for r in placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())
    hosts = [(b, head, heads[k - 1][0]) for k, (b, head) in enumerate(heads)]
    guests = F.broadcast(spark.createDataFrame(hosts, "own int, head long, host int"))
    both = placed.join(guests, (F.col("bucket") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest"))
    dealt = both.select("doc_id", "text", "n_chars", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, visit))).alias("at")).select("at.*", "doc_id", "text", "n_chars")
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    return dealt.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"))


def edited_fingerprints(docs: DataFrame, share: int = 3) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and their likeness to each other and to the next row's."""
    third = F.floor(F.col("n_chars") / share).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    rows = with_next(docs).withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["bucket", "place", "guest", "doc_id", "n_chars", "edited_sha256"]
    sides = rows.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))).alias("s")).select(*keys, "s.side", "s.body")
    summed = _summed(sides, [*keys, "side"], "body")
    summed = summed.withColumn("lanes", _signed(F.col("n"), F.col("counts"))).withColumn("fp", F.struct(_print(F.col("n"), F.col("equality"), F.col("counts")).alias("print"), F.col("lanes").alias("lanes"), _dot(F.col("lanes"), F.col("lanes")).alias("norm")))
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("fp")))
    whole = summed.groupBy(*keys).agg(side(0).alias("a"), side(1).alias("b"))
    follow = whole.withColumn("c", F.lead("a").over(Window.partitionBy("bucket").orderBy("place"))).filter(~F.col("guest"))
    like = lambda x, y: _likeness(F.col(f"{x}.print") == F.col(f"{y}.print"), F.col(f"{x}.lanes"), F.col(f"{y}.lanes"), F.col(f"{x}.norm"), F.col(f"{y}.norm"))
    return follow.select("doc_id", "n_chars", "edited_sha256", F.col("a.print").alias("fingerprint"), F.col("b.print").alias("edited_fingerprint"), like("a", "b").alias("near_edited"), like("a", "c").alias("near_next"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
