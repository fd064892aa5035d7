"""Exact top-k inner products over norm-sorted blocks with rotated partial sums.

Every component becomes floor(64 x). Candidates are dealt into shares of bounded size by descending length,
over all shares, and queries into groups. First every query meets the longest share, which gives a floor under
its k-th best score. A query then needs only the shares whose greatest length, times its own, can still reach
that floor (Cauchy-Schwarz): a prefix of the shares, found before anything is copied. Queries that need as many
shares are grouped together, and a task has one group and one share that some query of it needs.

Within a share candidates are taken in blocks by descending length. Both sides are turned by the right singular
vectors of all vectors' second-moment matrix, so the first rotated components carry most of a product. For a
block, a query goes on only if its length times the block's greatest length can still reach the query's k-th
best score so far; then partial sums over the first components plus the product of the residual lengths
(Cauchy-Schwarz) bound each score, and only pairs whose bound reaches the k-th best are multiplied out in
integers. Bounds carry a margin for rounding, so nothing that could count is pruned. Each task keeps k rows a
query; a last ranking joins shares.

Scores are exact: products are taken in doubles where every partial result is an integer below 2^53, in 64-bit
integers below 2^62, and for the few vectors beyond a length of 2^31 in integers of any size. A score beyond a
long is given as the nearest long and ranked by its exact value.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import materialize, table

SHARE_ROWS = 16384
GROUP_ROWS = 2048
BLOCK_ROWS = 512
LEAD_SHARE = 0.9
SCALE = 64
#: Up to this squared length products fit a long.
NARROW = 2.0**62
LONG = (-(2**63), 2**63 - 1)


def quantized(vectors: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, x (components before scaling), squared length after it, of every vector that takes part.

    Null vectors and ids, and null or non-finite components, take no part; shorter vectors count as filled with zeros.
    """
    x = F.col("embedding").cast("array<double>")
    whole = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    )
    # As doubles: floor() of a double beyond 2^53 is the double itself.
    v = lambda c: F.when(F.abs(c) < float(1 << 53), F.floor(c * SCALE).cast("double")).otherwise(c * SCALE)
    return whole.withColumn("squared", F.aggregate("x", F.lit(0.0), lambda s, c: s + v(c) * v(c)))


def _moments(batches, dim: int):
    total = np.zeros((dim, dim))
    for b in batches:
        m = np.floor(_matrix(b.column("x"), dim) * SCALE)
        total += m.T @ m
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of doubles, filled with zeros to ``dim``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _packed(batches, dim: int):
    """Each vector as the bytes of its doubles."""
    for b in batches:
        rows = pa.array([r.tobytes() for r in np.ascontiguousarray(_matrix(b.column("x"), dim))], pa.binary())
        yield pa.RecordBatch.from_arrays([rows if n == "x" else b.column(n) for n in b.schema.names], b.schema.names)


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all narrow vectors, by descending singular value; the driver sees ``dim`` x ``dim`` sums."""
    parts = vectors.filter(F.col("squared") <= NARROW).select("x").mapInArrow(functools.partial(_moments, dim=dim), "part binary")
    sums = parts.select(F.pmod(F.spark_partition_id(), F.lit(8)).alias("k"), "part").groupBy("k").applyInArrow(_added, "part binary")
    total = np.zeros((dim, dim))
    for r in sums.toLocalIterator():
        total += np.frombuffer(r.part).reshape(dim, dim)
    return np.linalg.svd(total)[2].T


def _added(t: pa.Table) -> pa.Table:
    parts = [np.frombuffer(p) for p in t.column("part").to_pylist()]
    return pa.table({"part": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary())})


FOUND = "query long, query_id long, vec_id long, score long, beyond binary"


def _found(queries: pd.DataFrame, r, ids, scores, beyond=None) -> pd.DataFrame:
    return pd.DataFrame({"query": queries["row"].to_numpy()[r], "query_id": queries["vec_id"].to_numpy()[r], "vec_id": np.asarray(ids, "i8"), "score": np.asarray(scores, "i8"), "beyond": [b""] * len(r) if beyond is None else beyond})


def _best(key, queries: pd.DataFrame, candidates: pd.DataFrame, k: int, turn: np.ndarray) -> pd.DataFrame:
    """The k best candidates of this share for each query of this group, where they reach the query's floor."""
    wide_q, wide_c = queries["squared"].to_numpy() > NARROW, candidates["squared"].to_numpy() > NARROW
    parts = [_narrow(queries[~wide_q], candidates[~wide_c], k, turn), _wide(queries[wide_q], candidates, k, len(turn)), _wide(queries[~wide_q], candidates[wide_c], k, len(turn))]
    return pd.concat(parts, ignore_index=True)


def _doubles(column: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), dim)


def _integers(x: np.ndarray) -> list[int]:
    return [int(a) * SCALE if abs(a) >= 1 << 53 else math.floor(a * SCALE) for a in x.tolist()]


def _sortable(n: int) -> bytes:
    """Bytes that sort as integers beyond a long do."""
    size = (n.bit_length() + 7) // 8
    led = size.to_bytes(2, "big") + abs(n).to_bytes(size, "big")
    return b"\1" + led if n > 0 else bytes([0, *(255 - b for b in led)]) + b"\xff"


def _wide(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, dim: int) -> pd.DataFrame:
    """Pairs in which a vector is too long for 64-bit integers: bounds in scaled doubles, then integers of any size."""
    rows, ids, scores, beyond = [], [], [], []
    if len(queries) and len(candidates):
        scaled = lambda x: np.frexp(np.maximum(np.abs(x).max(1), 1.0))[1]
        q, c = _doubles(queries["x"], dim), _doubles(candidates["x"], dim)
        q_power, c_power = scaled(q), scaled(c)
        q_unit, c_unit = np.ldexp(q, -q_power[:, None]), np.ldexp(c, -c_power[:, None])
        q_row, c_row, c_id = queries["row"].to_numpy(), candidates["row"].to_numpy(), candidates["vec_id"].to_numpy()
        for i in range(len(q)):
            others = np.flatnonzero(c_row != q_row[i])
            if not len(others):
                continue
            size = np.ldexp(np.ones(len(others), np.longdouble), c_power[others] + q_power[i] + 12)
            # floor() moves a component by less than one, which counts where a vector is short.
            error = size * (1e-12 + 1e-15 * dim * dim + dim * (np.ldexp(1.0, -c_power[others]) + np.ldexp(1.0, -int(q_power[i]))))
            guess = (c_unit[others] @ q_unit[i]) * size
            floor = np.partition(guess - error, -k)[-k] if len(others) > k else -np.inf
            near, own = others[guess + error >= floor], _integers(q[i])
            exact = sorted((-sum(a * b for a, b in zip(own, _integers(c[j]))), int(c_id[j])) for j in near)[:k]
            rows += [i] * len(exact)
            ids += [j for _, j in exact]
            scores += [min(max(-v, LONG[0]), LONG[1]) for v, _ in exact]
            beyond += [_sortable(-v) if -v >= LONG[1] or -v <= LONG[0] else b"" for v, _ in exact]
    return _found(queries, np.array(rows, "i8"), ids, scores, beyond)


def _narrow(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, turn: np.ndarray) -> pd.DataFrame:
    if not len(queries) or not len(candidates):
        return _found(queries, np.zeros(0, "i8"), [], [])
    dim = len(turn)
    candidates = candidates.sort_values(["squared", "vec_id"], ascending=[False, True], kind="stable")
    q, c = np.floor(_doubles(queries["x"], dim) * SCALE), np.floor(_doubles(candidates["x"], dim) * SCALE)
    q_row, c_row, c_id = queries["row"].to_numpy(), candidates["row"].to_numpy(), candidates["vec_id"].to_numpy()
    q_len, c_len = np.sqrt(queries["squared"].to_numpy()), np.sqrt(candidates["squared"].to_numpy())
    exact = float(q_len.max()) * float(c_len.max()) < 2.0**52
    kind = "f8" if exact else "i8"
    q_int, c_int = q.astype(kind), c.astype(kind)
    q_turned, c_turned = q @ turn, c @ turn
    energy = np.cumsum((q_turned**2).sum(0))
    lead = min(dim, int(np.searchsorted(energy, LEAD_SHARE * energy[-1])) + 1)
    rest = lambda t: np.sqrt(np.maximum((t[:, lead:] ** 2).sum(1), 0))
    q_rest, c_rest = rest(q_turned), rest(c_turned)
    q_lead, c_lead = np.ascontiguousarray(q_turned[:, :lead]), np.ascontiguousarray(c_turned[:, :lead])
    n = len(q)
    floor = queries["floor"].to_numpy().copy()  # under the k-th best score so far
    best_id, best_score, filled = np.zeros((n, k), "i8"), np.full((n, k), np.iinfo("i8").min), np.zeros((n, k), bool)
    active = np.arange(n)
    for at in range(0, len(c), BLOCK_ROWS):
        block = slice(at, min(at + BLOCK_ROWS, len(c)))
        margin = 1e-9 * q_len * c_len[at] + 1e-6
        active = active[(q_len * c_len[at] + margin >= floor)[active]]
        if not len(active):
            break
        for part in np.array_split(active, -(-len(active) // 512)):
            bound = q_lead[part] @ c_lead[block].T
            bound += q_rest[part][:, None] * c_rest[block]
            alive = bound + margin[part][:, None] >= floor[part][:, None]
            alive &= q_row[part][:, None] != c_row[block]
            rows = np.flatnonzero(alive.any(1))
            if not len(rows):
                continue
            if alive[rows].mean() > 0.05:
                cols = np.flatnonzero(alive.any(0))
                score = (q_int[part[rows]] @ c_int[block][cols].T).astype("i8")
                r, j = np.nonzero(alive[rows][:, cols])
                values, found, owner = score[r, j], c_id[block][cols[j]], part[rows[r]]
            else:
                r, j = np.nonzero(alive)
                values = np.einsum("ij,ij->i", q_int[part[r]], c_int[block][j]).astype("i8")
                found, owner = c_id[block][j], part[r]
            _merge(owner, found, values, best_id, best_score, filled, floor, k)
    r, j = np.nonzero(filled)
    return _found(queries, r, best_id[r, j], best_score[r, j])


def _merge(owner, found, values, best_id, best_score, filled, floor, k):
    """Put new scores in; a full row keeps its k best, ties to the smaller id."""
    good = values >= floor[owner]
    owner, found, values = owner[good], found[good], values[good]
    touched = np.unique(owner)
    if not len(touched):
        return
    r, j = np.nonzero(filled[touched])
    owner = np.concatenate([owner, touched[r]])
    values = np.concatenate([values, best_score[touched[r], j]])
    found = np.concatenate([found, best_id[touched[r], j]])
    order = np.lexsort((found, -values, owner))
    owner, values, found = owner[order], values[order], found[order]
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
    top = place < k
    filled[touched] = False
    best_id[owner[top], place[top]], best_score[owner[top], place[top]], filled[owner[top], place[top]] = found[top], values[top], True
    full = touched[filled[touched, k - 1]]
    floor[full] = best_score[full, k - 1]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(queries: DataFrame, candidates: DataFrame, k: int, dim: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest products of every query row, ties to the smaller vec_id.

    Both sides are rows of one written table of ``quantized``: a query passes over its own row, and no other,
    whatever its id. With fewer than k others all come. Rows that repeat an id are queries and candidates of
    their own. No rows on either side give no rows.
    """
    turn = rotation(candidates, dim)
    n_shares = -(-candidates.count() // SHARE_ROWS) or 1
    dealt = candidates.repartitionByRange(n_shares, F.desc("squared"), "row").mapInArrow(functools.partial(_packed, dim=dim), "row long, vec_id long, x binary, squared double")
    dealt = materialize(dealt.withColumn("share", F.spark_partition_id()), "shares")
    # A number a share, by descending length: what each share's longest vector is.
    tops = [(r.share, math.sqrt(r.top)) for r in dealt.groupBy("share").agg(F.max("squared").alias("top")).orderBy("share").collect()]
    asked = queries.select("row", "vec_id", "x", "squared").mapInArrow(functools.partial(_packed, dim=dim), "row long, vec_id long, x binary, squared double")
    groups = -(-queries.count() // GROUP_ROWS) or 1
    best = functools.partial(_best, k=k, turn=turn)

    def met(q: DataFrame, c: DataFrame) -> DataFrame:
        return q.groupBy("g", "s").cogroup(c.groupBy("to_g", "to_s")).applyInPandas(best, FOUND)

    all_groups = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    lead = tops[0][0] if tops else 0
    first = asked.withColumns({"floor": F.lit(float("-inf")), "g": F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"), "s": F.lit(lead)})
    found = materialize(_ranked(met(first, dealt.filter(F.col("share") == lead).withColumns({"to_g": all_groups, "to_s": F.col("share")})), k).drop("rank"), "found")
    floors = found.groupBy("query").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least")).filter(F.col("n") >= k).select(F.col("query").alias("row"), "least")
    length = F.sqrt("squared")
    reach = F.array(*[F.lit(t) for _, t in tops[1:]]).cast("array<double>")
    # Margins as in ``_narrow``; a vector too long for bounds in doubles needs every share.
    needs = F.when(F.col("squared") > NARROW, F.lit(len(tops) - 1)).otherwise(F.size(F.filter(reach, lambda t: t * length * (1 + 1e-9) + 1e-6 >= F.col("floor"))))
    lowered = F.col("least") - F.abs("least") * 1e-15  # a double may lie above the long that it stands for
    rest = asked.join(floors, "row", "left").withColumn("floor", F.coalesce(lowered, F.lit(float("-inf")))).drop("least", "n").withColumn("needs", needs).filter("needs > 0")
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2("needs")) - 3))  # few kinds of need, so that groups are full
    rest = rest.withColumn("needs", F.least(F.lit(len(tops) - 1), (F.ceil(F.col("needs") / step) * step).cast("int")))
    order = Window.partitionBy("needs", "part").orderBy("row")
    rest = rest.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(max(1, groups // 16))).cast("int"))
    rest = materialize(rest.withColumn("g", F.concat_ws("-", "needs", "part", F.floor((F.row_number().over(order) - 1) / GROUP_ROWS))), "needing")
    wanted = rest.select("g", "needs").distinct().select(F.col("g").alias("to_g"), F.explode(F.sequence(F.lit(1), F.col("needs"))).alias("to_s"))
    shares = dealt.withColumn("to_s", _position([n for n, _ in tops]))
    more = met(rest.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("needs")))), shares.join(wanted, "to_s"))
    return _ranked(found.unionByName(more), k).select("query_id", "rank", "vec_id", "score")


def _position(shares: list[int]) -> Column:
    """Place of a share among those that have rows."""
    return (F.array_position(F.array(*[F.lit(n) for n in shares]).cast("array<int>"), F.col("share")) - 1).cast("int")


def op2_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(quantized(table(spark, sf_dir, "embeddings")), "vectors")
    dim = vectors.agg(F.max(F.size("x"))).first()[0] or 1
    return top_products(vectors.filter(F.col("vec_id") % 20 == 0), vectors, 20, dim)


OP2_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.row <> c.row
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
