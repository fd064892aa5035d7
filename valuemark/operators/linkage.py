"""Linking two sets of names: exact, then blocked fuzzy, one to one, with protected human decisions."""

from __future__ import annotations

import bisect
import functools
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.functions import scalars as S
from valuemark.functions.matching import letter_counts, word_set_similarity
from valuemark.operators import ranking
from valuemark.operators.pricing import name_key
from valuemark.session import materialize

#: Names that a key is shown at a time beside one for each of its providers, and names in a block that is scored as one row.
DEPTH, BLOCK = 16, 128
#: A word of more names is frequent, and a list of more frames than these is not looked through: then all names go block by block.
RARE, FRAMES = 128, 512
SHOWN = "key string, facility_name string, exact boolean, score double"
LINK_COLUMNS = ("provider_id", "certificate", "provider_name", "facility_name", "match_method", "match_score", "reviewed", "review_source")


def named(names: DataFrame, column: str = "facility_name") -> DataFrame:
    """One row a normalised name, with its least spelling."""
    return names.select(column).filter(f"{column} IS NOT NULL").withColumn("norm", S.normalize_name(F.col(column))).filter("norm <> ''").groupBy("norm").agg(F.min(column).alias(column))


@functools.lru_cache(1 << 14)
def _rounded(score: float) -> float:
    return float(Decimal(repr(score)).quantize(Decimal("0.01"), ROUND_HALF_UP))


class Side:
    """A block of names as arrays: words, significant tokens below the block's own, letters, lengths."""

    def __init__(self, rows: list[dict], token: str, words: dict[str, int], tokens: dict[str, int]):
        self.rows = rows
        self.words = [frozenset(r["norm"].split()) for r in rows]
        self.letters = np.stack([letter_counts(r["norm"]) for r in rows])
        self.of = [[words.setdefault(w, len(words)) for w in ws] for ws in self.words]
        self.below = [[tokens.setdefault(t, len(tokens)) for t in r["tokens"] if t < token] for r in rows]
        self.n = np.array([len(ws) for ws in self.words])
        self.length = np.array([sum(map(len, ws)) + len(ws) - 1 for ws in self.words])

    @staticmethod
    def spread(of: list[list[int]], width: int) -> np.ndarray:
        out = np.zeros((len(of), max(width, 1)), "f4")
        for row, at in zip(out, of):
            row[at] = 1
        return out


def bounds(left: Side, right: Side, words: dict[str, int], tokens: dict[str, int]) -> np.ndarray:
    """The most that each pair's similarity can be, by lengths, shared words and letter counts; -1 where another token has the pair.

    The longest common subsequence of the words that two names do not share is at most what their letters have in
    common, and the shared words take the same letters from both, so the bound needs no look at the rests themselves.
    """
    x, y = Side.spread(left.of, len(words)), Side.spread(right.of, len(words))
    shared = x @ y.T
    base = (x * np.array([len(w) for w in words], "f4")) @ y.T + shared - 1
    common = np.minimum(left.letters[:, None, :], right.letters[None, :, :]).sum(-1, dtype="i8")
    n, m = left.n[:, None], right.n[None, :]
    a, b = left.length[:, None], right.length[None, :]
    most = np.maximum(200.0 * (common + np.minimum(n, m) - 1) / (a + b), 200.0 * base / (base + np.minimum(a, b)))
    most[(shared == n) | (shared == m)] = 100.0
    if tokens:
        most[(Side.spread(left.below, len(tokens)) @ Side.spread(right.below, len(tokens)).T) > 0] = -1.0
    return most


def _scored(batches, cutoff: float):
    """The best names of each key: at most its depth, none that a provider before it holds.

    Rows are pairs of blocks with a common token, those of a left block one after the other, so what it has found
    already rules out most of what comes: only pairs whose bound reaches a key's least place are compared in full.
    """
    at, best, left = None, [], []

    def told() -> pa.RecordBatch:
        found = [(r["norm"], name, False, -score) for r, heap in zip(left, best) for score, name in heap]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, (pa.string(), pa.string(), pa.bool_(), pa.float64()))], ["key", "facility_name", "exact", "score"])

    for batch in batches:
        for row in batch.to_pylist():
            if at != (row["token"], row["block"]):
                if best:
                    yield told()
                at, left = (row["token"], row["block"]), row["left"]
                best = [[] for _ in left]
            words, tokens = {}, {}
            a, b = (Side(row[side], row["token"], words, tokens) for side in ("left", "right"))
            most = bounds(a, b, words, tokens)
            for k, x in enumerate(a.rows):
                heap, line = best[k], most[k]
                for j in np.argsort(-line, kind="stable").tolist():
                    least = -heap[-1][0] if len(heap) >= x["depth"] else cutoff
                    if line[j] < 0 or line[j] + 0.0051 < least:
                        break
                    y = b.rows[j]
                    if y["norm"] == x["norm"] or (y["best"] is not None and x["rank"] is not None and y["best"] < x["rank"]):
                        continue
                    score = _rounded(word_set_similarity(a.words[k], b.words[j]))
                    if score >= cutoff and (len(heap) < x["depth"] or (-score, y["facility_name"]) < heap[-1]):
                        bisect.insort(heap, (-score, y["facility_name"]))
                        del heap[x["depth"] :]
    if best:
        yield told()


def _blocks(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    """token, block and the names of the block; common tokens have many blocks."""
    each = rows.withColumn("tokens", S.significant_tokens(F.col("norm"))).withColumn("token", F.explode("tokens"))
    common = each.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).filter("blocks > 1")
    block = F.pmod(F.xxhash64("norm"), F.coalesce("blocks", F.lit(1))).alias("block")
    return each.join(common, "token", "left").select("token", block, F.struct("norm", "tokens", *columns).alias("x")).groupBy("token", "block").agg(F.collect_list("x").alias(side)).select("token", "block", side)


def _framed(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """The rows with the frequent words (frame) and the other words (own) of each name, in order."""
    each = rows.select("norm", F.explode(F.array_distinct(F.split("norm", " "))).alias("word")).join(frequent, "word", "left")
    listed = lambda when: F.array_sort(F.collect_list(F.when(when, F.col("word"))))
    return rows.join(each.groupBy("norm").agg(listed(F.col("often").isNotNull()).alias("frame"), listed(F.col("often").isNull()).alias("own")), "norm")


def _signed(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    """sig and the names that have it: each own word, and all own words as one text, whole and without each of its characters."""
    own = F.array_join("own", " ")
    cut = F.transform(F.sequence(F.lit(0), F.length(own)), lambda i: F.concat(F.lit("~"), F.substring(own, F.lit(1), i), F.substring(own, i + 2, F.length(own))))
    sigs = F.array_union(F.transform("own", lambda w: F.concat(F.lit("="), w)), F.array_distinct(cut))
    each = rows.filter(F.size("own") > 0).select(F.explode(sigs).alias("sig"), F.struct("norm", *columns).alias("x"))
    return each.groupBy("sig").agg(F.collect_list("x").alias(side))


def _near(batches, cutoff: float):
    """The best names of each key among those that share a signature with it."""
    for batch in batches:
        for row in batch.to_pylist():
            found = []
            right = [(y["norm"], frozenset(y["norm"].split()), y["facility_name"], y["best"]) for y in row["right"]]
            for x in row["left"]:
                words, rank, best = frozenset(x["norm"].split()), x["rank"], []
                for norm, others, name, held in right:
                    if norm == x["norm"] or (held is not None and rank is not None and held < rank):
                        continue
                    if any(len(w) >= 4 and w not in S.STOP_TOKENS for w in words & others) and (score := _rounded(word_set_similarity(words, others))) >= cutoff:
                        best.append((-score, name))
                found += [(x["norm"], name, False, -score) for score, name in sorted(best)[: x["depth"]]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.string(), pa.bool_(), pa.float64()))], ["key", "facility_name", "exact", "score"])


@functools.lru_cache(1 << 16)
def _frames_met(mine: tuple[str, ...], frame: tuple[str, ...]) -> tuple[int, int, int, Counter, int, bool] | None:
    """Of two frames that share a significant word: length of the shared words, what is left of each, letters of the other's rest, its words, whether mine holds it."""
    both = set(mine) & set(frame)
    if not any(len(w) >= 4 and w not in S.STOP_TOKENS for w in both):
        return None
    left, right = [w for w in mine if w not in both], [w for w in frame if w not in both]
    return sum(map(len, both)) + len(both) - 1, sum(len(w) + 1 for w in left), sum(len(w) + 1 for w in right), Counter("".join(w + " " for w in right)), len(right), not right


def unseen(frame: list[str], own: list[str], frames: list[tuple[tuple[str, ...], int]]) -> float:
    """The most that the similarity to a name can be that shares no signature with this one; ``frames`` has the frames of names and the lengths of their other words.

    Such names share frequent words only, and of what is left at least two characters of the longer text are not in
    the common subsequence; what frames add to it is at most their rests' letters.
    """
    most, mine, text = 0.0, tuple(frame), " ".join(own)
    letters = Counter(" ".join([*frame, *own]))
    for other, m in frames:
        met = _frames_met(mine, other)
        if met is None:
            continue
        base, left, right, theirs, _, held = met
        if (held and not m) or (not left and not text):
            return 100.0
        n = len(text)
        a, b = n + left - (not n), m + right - (not m)
        common = min(n, m, max(n, m) - 2 if n and m else 0) + left + (sum((theirs & letters).values()) if right else 0)
        most = max(most, 200.0 * (base + 1 + min(common, a, b)) / (2 * base + 2 + a + b), 200.0 * base / (2 * base + 1 + min(a, b)))
    return most


def _open(batches, cutoff: float, frames: list):
    """Names whose list may lack a name that shares no signature with them."""
    for batch in batches:
        rows = batch.to_pylist()
        left = [unseen(r["frame"], r["own"], frames) + 0.0051 >= (r["least"] if (r["n"] or 0) >= r["depth"] else cutoff) for r in rows]
        yield batch.select(["norm", "depth", "rank"]).filter(pa.array(left, pa.bool_()))


def near_names(asks: DataFrame, targets: DataFrame, cutoff: float) -> tuple[DataFrame, DataFrame] | None:
    """What keys find by signatures, which few names share, and the keys for which that may not be all; nothing where names have too many frames.

    A name is its frequent words (frame) and its own words. Names that share an own word, or whose own words differ by one
    character in each, are compared; what any other name can reach follows from its frame and its length.
    """
    words = asks.select("norm").unionByName(targets.select("norm")).select(F.explode(F.array_distinct(F.split("norm", " "))).alias("word"))
    frequent = materialize(words.groupBy("word").agg(F.count("*").alias("often")).filter(F.col("often") > RARE), "frequent", short=True)
    right = materialize(_framed(targets, frequent), "framed", short=True)
    frames = [(tuple(r.frame), r.m) for r in right.select("frame", F.length(F.array_join("own", " ")).alias("m")).distinct().limit(FRAMES + 1).collect()]
    if len(frames) > FRAMES:
        return None
    left = materialize(_framed(asks, frequent), "framed", short=True)
    tasks = max(asks.sparkSession.sparkContext.defaultParallelism, int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = _signed(left, "left", "rank", "depth").join(_signed(right, "right", "facility_name", "best"), "sig").repartition(tasks)
    each = met.mapInArrow(functools.partial(_near, cutoff=cutoff), SHOWN).dropDuplicates(["key", "facility_name"])
    order = Window.partitionBy("key").orderBy(F.desc("score"), "facility_name")
    placed = each.withColumn("place", F.row_number().over(order)).join(left.select(F.col("norm").alias("key"), "depth"), "key").filter("place <= depth")
    found = materialize(placed.select("key", "facility_name", "exact", "score"), "near", short=True)
    least = found.groupBy(F.col("key").alias("norm")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    kinds = ", ".join(f"{c} {left.schema[c].dataType.simpleString()}" for c in ("norm", "depth", "rank"))
    rest = left.join(least, "norm", "left").mapInArrow(functools.partial(_open, cutoff=cutoff, frames=frames), kinds)
    return found, materialize(rest, "open-names", short=True)


def block_names(asks: DataFrame, targets: DataFrame, cutoff: float) -> DataFrame:
    """The best names of each key, every pair of names with a common significant token bounded, block by block."""
    left, right = _blocks(asks, "left", "rank", "depth"), _blocks(targets, "right", "facility_name", "best").select("token", "right")
    tasks = max(asks.sparkSession.sparkContext.defaultParallelism, int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = left.join(right, "token").repartition(tasks, "token", "block").sortWithinPartitions("token", "block")
    return pairs.mapInArrow(functools.partial(_scored, cutoff=cutoff), SHOWN)


def top_names(asks: DataFrame, targets: DataFrame, cutoff: float) -> DataFrame:
    """key, facility_name, exact, score, place: the first names of each key, exact ones, then by score, then by name.

    asks: norm (unique), depth (names to show) and rank (of the first provider who asks, or null); targets: norm,
    facility_name and best (rank of the provider that holds the name, or null). Names that a provider before the asking
    one holds are not shown. Fuzzy names share a significant token and reach the cutoff. Signatures find them for most
    keys; only keys that may have missed a name are compared with all.
    """
    fuzzy = asks.select("norm", "depth", "rank")
    near = near_names(fuzzy, targets, cutoff)
    if near is None:
        found = block_names(fuzzy, targets, cutoff)
    else:
        found, rest = near
        if not rest.isEmpty():
            found = found.join(rest.select(F.col("norm").alias("key")), "key", "left_anti").unionByName(block_names(rest, targets, cutoff))
    free = F.col("best").isNull() | F.col("rank").isNull() | (F.col("best") >= F.col("rank"))
    exact = targets.join(asks, "norm").filter(free).select(F.col("norm").alias("key"), "facility_name", F.lit(True).alias("exact"), F.lit(100.0).alias("score"))
    order = Window.partitionBy("key").orderBy(F.desc("exact"), F.desc("score"), "facility_name")
    both = exact.unionByName(found).withColumn("place", F.row_number().over(order))
    return both.join(asks.select(F.col("norm").alias("key"), "depth"), "key").filter("place <= depth").drop("depth")


WISHES = ("provider_id", "rank", "facility_name", "exact", "score", "place")


def settled(wishes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The wishes that still stand when nobody can do better, and the first of each provider, which is its own.

    Rounds of proposals: every provider proposes its first wish; a name will go to the first (by rank) that proposes
    it or to one before that, so wishes of all later ones for it fall. Names rank providers alike, so there is one
    stable matching, that of choosing in order of rank. A round is two aggregates and a join, on random wishes there are
    about as many as the logarithm of the providers.
    """
    alive, before = wishes, None
    while True:
        alive = materialize(alive.select(*WISHES), "wishes")
        n = alive.count()
        first = alive.groupBy("provider_id").agg(F.min_by(F.struct(*WISHES), "place").alias("w")).select("w.*")
        if n == before:
            return alive, first
        before = n
        best = first.groupBy("facility_name").agg(F.min("rank").alias("best"))
        alive = alive.join(best, "facility_name", "left").filter("best IS NULL OR rank <= best")


def one_to_one(preferences: DataFrame) -> DataFrame:
    """provider_id, facility_name, exact, score: providers choose in order of priority, each its first free name.

    ``preferences`` has provider_id, priority (unique, least first), facility_name, exact and score; a provider's order
    is exact names, then score, then name.
    """
    order = Window.partitionBy("provider_id").orderBy(F.desc("exact"), F.desc("score"), "facility_name")
    wishes = preferences.withColumn("place", F.row_number().over(order)).withColumn("rank", F.col("priority"))
    return settled(wishes)[1].select("provider_id", "facility_name", "exact", "score")


def best_names(providers: DataFrame, right: DataFrame, cutoff: float) -> DataFrame:
    """provider_id, facility_name, exact, score: the one-to-one matching of providers (provider_id, volume, norm) to names (norm, facility_name).

    Busier providers choose first (an unknown volume last), ties by id. Providers are shown their first names only. Who
    has lost all of a full list asks again and is shown names that nobody before it holds; a name may be taken from
    those behind it, who go on to their next, until nobody asks.
    """
    busy = providers.withColumn("_order", -F.coalesce(F.col("volume"), F.lit(-1)))
    left = materialize(ranking.global_positions(busy, "_order", "provider_id").select("provider_id", F.col("pos").alias("rank"), F.col("norm").alias("key")), "providers")
    right = materialize(right.select("norm", "facility_name"), "names")
    kind = left.schema["provider_id"].dataType.simpleString()
    asking, more = left, left.select("provider_id").limit(0)
    alive = providers.sparkSession.createDataFrame([], f"provider_id {kind}, rank long, facility_name string, exact boolean, score double, place int")
    first = alive
    while not asking.isEmpty():
        held = first.groupBy("facility_name").agg(F.min("rank").alias("best"))
        asks = materialize(asking.groupBy(F.col("key").alias("norm")).agg(F.min("rank").alias("rank"), (F.count("*") + DEPTH).alias("depth")), "asks")
        shown = materialize(top_names(asks, right.join(held, "facility_name", "left"), cutoff), "shown")
        full = shown.groupBy("key").agg(F.count("*").alias("n")).join(asks.select(F.col("norm").alias("key"), "depth"), "key").filter("n >= depth")
        more = materialize(more.join(asking, "provider_id", "left_anti").unionByName(asking.join(full, "key", "left_semi").select("provider_id")), "more")  # whose last list may not have been all
        wishes = asking.join(shown, "key").join(held, "facility_name", "left").filter("best IS NULL OR best >= rank")
        alive, first = settled(alive.unionByName(wishes.select(*WISHES)))
        asking = materialize(left.join(first, "provider_id", "left_anti").join(more, "provider_id", "left_semi"), "asking")
    return first.select("provider_id", "facility_name", "exact", "score")


def propose(providers: DataFrame, names: DataFrame, existing: DataFrame, s: Settings, cutoff: float | None = None) -> DataFrame:
    """Links for providers without a reviewed one. providers: provider_id, certificate, provider_name, volume.

    Reviewed rows are passed over and their targets are taken. Busier providers choose first, ties by id;
    a provider's order is exact names, then score, then name. Providers without a match come with nulls.
    """
    kept = existing.filter("reviewed")
    open_left = providers.join(kept.select("provider_id"), "provider_id", "left_anti").withColumn("norm", S.normalize_name(F.col("provider_name")))
    claimed = kept.filter("facility_name IS NOT NULL").select(S.normalize_name(F.col("facility_name")).alias("norm")).distinct()
    right = named(names).join(claimed, "norm", "left_anti")
    found = best_names(open_left.select("provider_id", "volume", "norm"), right, s.match_cutoff if cutoff is None else cutoff)
    auto = F.coalesce(F.col("exact") | (F.col("score") >= s.auto_accept), F.lit(False))
    return open_left.select("provider_id", "certificate", "provider_name").join(found, "provider_id", "left").select(
        "provider_id", "certificate", "provider_name", "facility_name", F.when(F.col("exact"), "exact").when(F.col("score").isNotNull(), "fuzzy").otherwise("unmatched").alias("match_method"),
        F.col("score").cast("decimal(5,2)").alias("match_score"), auto.alias("reviewed"), F.when(auto, "auto").alias("review_source"),
    )


def propose_measure_links(providers: DataFrame, measures: DataFrame, s: Settings) -> DataFrame:
    """Providers (provider_id, provider_name, volume) linked to the institutions that report measures (ccn, facility_name).

    Both sides use official names, so the cutoff is higher. An institution is taken once, by its number, however
    many names it has; a name that several have stands for the least number. Only links that are found come back.
    """
    rows = measures.filter("ccn <> ''").select("ccn", "facility_name", S.normalize_name(F.col("facility_name")).alias("norm")).filter("norm <> ''")
    named_once = rows.groupBy("norm").agg(F.min_by(F.struct("ccn", "facility_name"), F.struct("ccn", "facility_name")).alias("x")).select("norm", "x.*")
    left = providers.withColumn("norm", S.normalize_name(F.col("provider_name"))).filter("norm <> ''")
    found = best_names(left.select("provider_id", "volume", "norm"), named_once.select("norm", F.col("ccn").alias("facility_name")), s.measure_match_cutoff).withColumnRenamed("facility_name", "ccn")
    spelled = named_once.groupBy("ccn").agg(F.min("facility_name").alias("facility_name"))
    return left.select("provider_id", "provider_name").join(found, "provider_id").join(spelled, "ccn").select(
        "provider_id", "ccn", "provider_name", "facility_name", F.when(F.col("score") == 100, "exact").otherwise("fuzzy").alias("match_method"), F.col("score").cast("decimal(5,2)").alias("match_score"), F.lit(False).alias("reviewed"),
    )


def protected_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Insert, or update a row only where nobody has reviewed it."""
    keep = old.filter("reviewed")
    fresh = new.join(keep.select("provider_id"), "provider_id", "left_anti")
    untouched = old.filter("NOT coalesce(reviewed, false)").join(new.select("provider_id"), "provider_id", "left_anti")
    return keep.unionByName(fresh).unionByName(untouched)


def check_import(rows: DataFrame) -> None:
    """A target claimed twice, or an id that is no number, is an error that says which."""
    bad = rows.filter(~F.coalesce(S.strip(F.col("provider_id").cast("string")).rlike("^[0-9]+$"), F.lit(False))).select("provider_id").limit(5).collect()
    if bad:
        raise ValueError(f"provider ids that are no numbers: {[r.provider_id for r in bad]}")
    twice = rows.filter(F.trim("facility_name") != "").groupBy(name_key("facility_name").alias("name")).agg(F.count("*").alias("n"), F.min("provider_name").alias("one"), F.max("provider_name").alias("other")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0].name} is claimed by {twice[0].one} and {twice[0].other}")


def manual_import(old: DataFrame, rows: DataFrame) -> DataFrame:
    """Decisions from a reviewed file overwrite what stands; a score that stood stays."""
    check_import(rows)
    yes = F.lower(S.strip(F.col("n_reviewed").cast("string"))).isin("true", "t", "yes", "y", "1")
    new = rows.select(S.strip(F.col("provider_id").cast("string")).cast("int").alias("provider_id"), S.blank_to_null(F.col("facility_name")).alias("n_name"), F.col("provider_name").alias("n_provider"), F.col("reviewed").alias("n_reviewed"))
    both = old.join(new, "provider_id", "full_outer")
    given = F.col("n_provider").isNotNull()
    return both.select(
        "provider_id", "certificate", F.coalesce("provider_name", "n_provider").alias("provider_name"), F.when(given, F.col("n_name")).otherwise(F.col("facility_name")).alias("facility_name"),
        F.when(given, "manual").otherwise(F.col("match_method")).alias("match_method"), "match_score", F.when(given, F.coalesce(yes, F.lit(False))).otherwise(F.col("reviewed")).alias("reviewed"), F.when(given, "manual").otherwise(F.col("review_source")).alias("review_source"),
    )


def approve(old: DataFrame, provider_id: int, facility_name: str) -> DataFrame:
    """One pairing, approved by hand: score 100, reviewed."""
    hit = F.col("provider_id") == provider_id
    return old.withColumns({
        "facility_name": F.when(hit, F.lit(facility_name)).otherwise(F.col("facility_name")), "match_method": F.when(hit, "manual").otherwise(F.col("match_method")),
        "match_score": F.when(hit, F.lit(100).cast("decimal(5,2)")).otherwise(F.col("match_score")), "reviewed": F.when(hit, True).otherwise(F.col("reviewed")), "review_source": F.when(hit, "manual").otherwise(F.col("review_source")),
    })


def review_candidates(providers: DataFrame, names: DataFrame, links: DataFrame, most: int = 8) -> DataFrame:
    """The best names for each provider to review, by score then name; names that others hold are marked."""
    left = providers.select("provider_id", S.normalize_name(F.col("provider_name")).alias("key")).filter(F.size(S.significant_tokens(F.col("key"))) > 0)
    asks = materialize(left.select(F.col("key").alias("norm")).distinct().withColumns({"rank": F.lit(None).cast("long"), "depth": F.lit(most + 1)}), "asks")  # exact names come first there, by score here
    pairs = top_names(asks, named(names).withColumn("best", F.lit(None).cast("long")), 0.0)
    order = Window.partitionBy("key").orderBy(F.desc("score"), "facility_name")
    first = pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    held = links.filter("facility_name IS NOT NULL").select(name_key("facility_name").alias("held")).distinct()
    return left.join(first, "key").join(held, name_key("facility_name") == F.col("held"), "left").select("provider_id", "place", "facility_name", "score", F.col("held").isNotNull().alias("claimed"))


def match_summary(links: DataFrame, volumes: DataFrame) -> DataFrame:
    """Matched, approved, awaiting review, and the share of volume that is covered."""
    hit = F.col("facility_name").isNotNull()
    both = links.join(volumes.select("provider_id", "volume"), "provider_id", "left")
    return both.agg(
        F.count("*").alias("providers"), F.count_if(hit).alias("matched"), F.count_if(hit & F.col("reviewed")).alias("approved"), F.count_if(hit & ~F.col("reviewed")).alias("awaiting_review"),
        F.round(F.sum(F.when(hit, F.col("volume"))).cast("double") / F.nullif(F.sum("volume"), F.lit(0)).cast("double"), 4).alias("volume_share"),
    )


def write_review_queue(queue: DataFrame, path: str) -> str:
    """The queue as one CSV folder with a header, a row a provider, in the queue's order."""
    queue.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def review_queue(links: DataFrame, volumes: DataFrame, show: str = "all") -> DataFrame:
    rows = links.join(volumes.select("provider_id", "volume"), "provider_id", "left")
    rows = rows.filter("NOT reviewed") if show == "attention" else rows.filter("reviewed") if show == "approved" else rows
    return rows.orderBy("reviewed", F.desc("volume"), "provider_id")
