"""Chat formatting: roles recovered from transcripts by a hidden Markov model.

A conversation is a sequence of texts, each a turn or a stretch of transcript. A text is cut into parts at lines
that open with a speaker's name (``User:``, ``### Assistant``, ``<|system|>``), code blocks aside. Each part is
seen through marker and line features: the speaker named at its start, its length in characters and lines, how
its words end, and its shape (code, list lines). The hidden states are the roles. Start, transition and emission
probabilities are learned by counting from parts whose role is known, on top of a few set counts (for speakers'
names: that a name mostly means what it says). Viterbi gives the likeliest roles, and the parts are then rendered
in a canonical form.

Parts are numbered over ranges of (conversation, turn), so a conversation of any length spreads over tasks.
Viterbi runs over parts dealt out by conversation and sorted, many conversations a task; a long one is
cut at ``SEGMENT`` parts. Segments are bridged exactly: each yields the best score between every pair
of entering and leaving roles, a small matrix; the matrices of a conversation, one row a segment, settle the
roles at the cuts, and each segment is then decoded between its fixed ends.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import held_out, materialize, table

ROLES = ("system", "user", "assistant")
SEGMENT = 256
#: Set counts of a speaker's name with the role it names, with another role, and of no name.
NAMED, MISNAMED, UNNAMED = 20.0, 0.05, 1.0
#: Stands for a missing conversation id between the steps; turn numbers go through pandas as text, so none is rounded.
NO_ID = -(2**63) + 1

# Speaker names that mark a role.
NAMES = {
    "system": "system instruction instructions developer context",
    "user": "user human question customer student q me prompter",
    "assistant": "assistant ai bot answer model response gpt agent tutor a",
}
ROLE_OF = {name: k for k, role in enumerate(ROLES) for name in NAMES[role].split()}
#: Names that open a part within a text; the others are too common in prose.
OPENING = set("system user human customer student prompter assistant ai bot gpt agent tutor".split())
MARKER = re.compile(r"^\s*(?:<\|(?:im_start\|>)?\s*(\w+)\s*\|?>?|\[(\w+)\]|#{1,6}\s*(\w+)\s*:?\s*(?=\n)|\**(\w+)\**\s*:)[ \t]*\n?", re.IGNORECASE)
LENGTHS = (40, 80, 120, 160, 240, 320, 480, 700, 1000, 1500)
LINES = (1, 2, 3, 5, 8)
#: Sizes of the feature alphabets: length, lines, ending, shape.
ALPHABETS = (len(LENGTHS) + 1, len(LINES) + 1, 4, 3)


def parsed(text: str) -> tuple[int, str]:
    """Role that a speaker marker names (or -1), and the text behind the marker."""
    if m := MARKER.match(text):
        role = ROLE_OF.get(next(g for g in m.groups() if g).lower(), -1)
        if role >= 0:
            return role, text[m.end() :]
    return -1, text


def line_features(text: str) -> tuple[int, int, int, int]:
    end = text.rstrip()[-1:]
    ending = 1 if end == "?" else 2 if end in ".!" and end else 3 if end else 0
    shape = 2 if "```" in text else 1 if re.search(r"^\s*(?:[-*]|\d+\.)\s", text, re.MULTILINE) else 0
    return int(np.searchsorted(LENGTHS, len(text))), int(np.searchsorted(LINES, text.count("\n") + 1)), ending, shape


def parts(text: str) -> list[tuple[int, str]]:
    """The parts of a text: role that a speaker marker names (or -1), and the text behind the marker."""
    found, held, fenced = [], [], False
    for line in text.split("\n"):
        m = None if fenced else MARKER.match(line + "\n")
        if m and held and "".join(held).strip() and next(g for g in m.groups() if g).lower() in OPENING:
            found.append("\n".join(held))
            held = []
        fenced ^= line.lstrip().startswith("```")
        held.append(line)
    return [parsed(t) for t in [*found, "\n".join(held)]]


def _observed(batches):
    for b in batches:
        rows = []
        for i, text in enumerate(b.column("text").to_pylist()):
            cut = parts(text or "")
            rows += [(i, k, len(cut) == 1, body, marker, *line_features(body)) for k, (marker, body) in enumerate(cut)]
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.string(), *[pa.int32()] * 5)
        at, *cols = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
        keep = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[b.column(n).take(at) for n in keep], *cols], [*keep, "part", "alone", "body", "marker", "f0", "f1", "f2", "f3"])


def observed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, tie (hash of role and text), part (place in its text), alone (whether the text has no other), body (text behind a marker), marker and four line features of every part."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).withColumn("tie", F.xxhash64("role", "text"))
    return rows.mapInArrow(_observed, "conv_id long, turn long, role string, tie long, part int, alone boolean, body string, marker int, f0 int, f1 int, f2 int, f3 int")


#: What may stand before a part: the start of its conversation, a part of unknown role, or what another task has.
FIRST, UNKNOWN, ELSEWHERE = -1, -2, -3


def _numbered(batches):
    """Sorted rows with their place in their conversation, as far as this task sees it, and the role before them."""
    task, last, count, role = TaskContext.get().partitionId(), None, 0, ELSEWHERE
    for b in batches:
        if not b.num_rows:
            continue
        key, known = b.column("key").to_numpy(), b.column("known").to_numpy()
        fresh = np.r_[last is None or key[0] != last, key[1:] != key[:-1]]
        at = np.arange(len(key))
        begun = np.maximum.accumulate(np.where(fresh, at, -count))
        local, before = at - begun, np.where(fresh, FIRST, np.r_[role, known[:-1]])
        if last is None:
            before[0] = ELSEWHERE
        last, count, role = key[-1], int(local[-1]) + 1, known[-1]
        cols = [*b.columns, pa.array(np.full(len(key), task, "i8")), pa.array(local.astype("i8")), pa.array(before.astype("i4"))]
        yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, "task", "local", "before"])


SEEN = "key long, turn long, role string, part int, body string, marker int, f0 int, f1 int, f2 int, f3 int, known int"


def placed(turns: DataFrame) -> DataFrame:
    """The observed parts with nth (place in the conversation, from 0), known (index of a role to learn from) and before (that of the part before).

    Order is by turn, null first, then by a hash of the text, then by place in the text. Rows are dealt by ranges
    of that order and written; only conversations that go over the end of a task are put together, a row a task.
    """
    index = F.create_map(*[x for k, r in enumerate(ROLES) for x in (F.lit(r), F.lit(k))])
    seen = observed(turns)
    known = F.when(F.col("alone") & ~held_out(F.col("conv_id")), index[F.col("role")])
    seen = seen.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("key"), "turn", "role", "tie", "part", "body", "marker", "f0", "f1", "f2", "f3", F.coalesce(known, F.lit(UNKNOWN)).cast("int").alias("known"))
    order = ["key", "turn", "tie", "part"]
    dealt = seen.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = materialize(dealt.mapInArrow(_numbered, f"{SEEN}, task long, local long, before int"), "turns")
    ends = rows.groupBy("key", "task").agg(F.count("*").alias("n"), F.max_by("known", "local").alias("last"))
    so_far = Window.partitionBy("key").orderBy("task")
    ends = ends.select("key", "task", F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, -1)).alias("offset"), F.lag("last").over(so_far).alias("last")).filter("offset IS NOT NULL")
    joined = rows.join(F.broadcast(ends), ["key", "task"], "left")  # at most a row a task
    before = F.when(F.col("before") == ELSEWHERE, F.coalesce("last", F.lit(FIRST))).otherwise(F.col("before"))
    return joined.withColumn("nth", F.col("local") + F.coalesce("offset", F.lit(0))).withColumn("before", before).drop("task", "local", "offset", "last")


def learned(rows: DataFrame) -> dict[str, np.ndarray]:
    """Log probabilities of starts, transitions and emissions, from conversations that are not held out.

    The driver sees one row for each (role, feature, value) at most.
    """
    n = len(ROLES)
    start, move, emit = np.full(n, 0.5), np.full((n, n), 0.5), [np.full((n, a), 0.5) for a in ALPHABETS]
    names = np.full((n, n + 1), MISNAMED)
    names[:, 0], names[np.arange(n), np.arange(n) + 1] = UNNAMED, NAMED
    facts = F.explode(F.array(F.struct(F.lit(-1).alias("k"), F.col("before").alias("v")), F.struct(F.lit(-2).alias("k"), F.col("marker").alias("v")), *[F.struct(F.lit(i).alias("k"), F.col(f"f{i}").alias("v")) for i in range(4)]))
    for row in rows.filter("known >= 0").select(F.col("known").alias("r"), facts.alias("x")).groupBy("r", "x.k", "x.v").count().collect():
        if row.k >= 0:
            emit[row.k][row.r, row.v] += row["count"]
        elif row.k == -2:
            names[row.r, row.v + 1] += row["count"]
        elif row.v == FIRST:
            start[row.r] += row["count"]
        elif row.v >= 0:
            move[row.v, row.r] += row["count"]
    share = lambda m: np.log(m / m.sum(-1, keepdims=True))
    return {"start": share(start), "move": share(move), "names": share(names), **{f"emit{i}": share(e) for i, e in enumerate(emit)}}


def scores(pdf: pd.DataFrame, model: dict) -> np.ndarray:
    """Log emission of every part (row) by each role."""
    return sum(model[f"emit{i}"][:, pdf[f"f{i}"].to_numpy()].T for i in range(4)) + model["names"][:, pdf["marker"].to_numpy() + 1].T


def bridge(e: np.ndarray, first: bool, model: dict) -> np.ndarray:
    """Best score from each role of the turn before a segment to each role of its last turn."""
    at = (np.tile(model["start"], (len(ROLES), 1)) if first else model["move"]) + e[0]
    for row in e[1:]:
        at = (at[:, :, None] + model["move"][None]).max(1) + row
    return at


def ends(bridges: list[np.ndarray]) -> list[tuple[int, int]]:
    """Roles before and at the end of each segment on the best path of a conversation."""
    at, back = np.zeros(len(ROLES)), []
    for m in bridges:
        step = at[:, None] + m
        back.append(step.argmax(0))
        at = step.max(0)
    role, found = int(at.argmax()), []
    for b in reversed(back):
        found.append((int(b[role]), role))
        role = int(b[role])
    return found[::-1]


def viterbi(e: np.ndarray, first: bool, enter: int, leave: int, model: dict) -> list[int]:
    """Roles within a segment whose neighbours' roles are settled."""
    at, back = (model["start"] if first else model["move"][enter]) + e[0], []
    for row in e[1:]:
        step = at[:, None] + model["move"]
        back.append(step.argmax(0))
        at = step.max(0) + row
    path = [leave]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _runs(batches, keys: list[str]):
    """Frames of whole groups out of sorted batches; only the group at hand is held over."""
    held = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if len(pdf):
            last = (pdf[keys] != pdf[keys].iloc[-1]).any(axis=1).to_numpy()
            start = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            held = pdf.iloc[start:].reset_index(drop=True)
            if start:
                yield pdf.iloc[:start].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _slices(pdf: pd.DataFrame, keys: list[str]) -> list[tuple[int, int]]:
    change = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
    starts = np.flatnonzero(change)
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(pdf)]))


def _bridges(batches, model: dict):
    for pdf in _runs(batches, ["key", "segment"]):
        e, nth = scores(pdf, model), pdf["nth"].to_numpy()
        cut = _slices(pdf, ["key", "segment"])
        at = [a for a, _ in cut]
        yield pd.DataFrame({"key": pdf["key"].to_numpy()[at], "segment": pdf["segment"].to_numpy()[at], "best": [bridge(e[a:b], nth[a] == 0, model).ravel().tolist() for a, b in cut]})


def _settled(batches):
    for pdf in _runs(batches, ["key"]):
        found = []
        for a, b in _slices(pdf, ["key"]):
            found += ends([np.array(m).reshape(len(ROLES), -1) for m in pdf["best"].iloc[a:b]])
        yield pd.DataFrame({"key": pdf["key"], "segment": pdf["segment"], "enter": [x for x, _ in found], "leave": [y for _, y in found]})


def _decoded(batches, model: dict):
    for pdf in _runs(batches, ["key", "segment"]):
        e, nth, enter, leave = scores(pdf, model), pdf["nth"].to_numpy(), pdf["enter"].to_numpy(), pdf["leave"].to_numpy()
        path = [k for a, b in _slices(pdf, ["key", "segment"]) for k in viterbi(e[a:b], nth[a] == 0, enter[a], int(leave[a]), model)]
        yield pdf[["key", "turn", "part", "nth", "role", "body"]].rename(columns={"role": "given"}).assign(role=[ROLES[k] for k in path])[["key", "turn", "part", "nth", "given", "role", "body"]]


def recovered(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, turn, part (place in its text), nth (place in the conversation), given (the role as stored), role (as recovered) and body of every part.

    A text without inner speaker markers is one part. Texts follow their turn, ties a hash of role and text; null
    texts count as empty, null roles as unknown, null conversation ids as one conversation. No rows give no rows.
    The stored role is never looked at where a role is recovered; it only teaches, for texts of one part and
    outside the held-out fifth of the conversations.
    """
    rows = placed(turns)
    model = learned(rows)
    cut = rows.withColumn("segment", F.floor(F.col("nth") / segment).cast("long")).withColumn("turn", F.col("turn").cast("string"))
    dealt = lambda df, *keys, order: df.repartition(*keys).sortWithinPartitions(*keys, *order)
    bridges = dealt(cut.select("key", "segment", "nth", "marker", "f0", "f1", "f2", "f3"), "key", "segment", order=["nth"]).mapInPandas(functools.partial(_bridges, model=model), "key long, segment long, best array<double>")
    settled = dealt(bridges, "key", order=["segment"]).mapInPandas(_settled, "key long, segment long, enter int, leave int")
    fixed = cut.join(settled, ["key", "segment"])
    done = dealt(fixed, "key", "segment", order=["nth"]).mapInPandas(functools.partial(_decoded, model=model), "key long, turn string, part int, nth long, given string, role string, body string")
    return done.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("conv_id"), F.col("turn").cast("long").alias("turn"), "part", "nth", "given", "role", "body")


def rendered(turns: DataFrame) -> DataFrame:
    """``recovered`` with each turn in canonical form: a line that names the role, the trimmed text, an end mark."""
    body = F.regexp_replace(F.regexp_replace("body", r"\r\n?", "\n"), r"^\s+|\s+$", "")
    return turns.withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.replace(body, F.lit("<|"), F.lit("< |")), F.lit("\n<|end|>")))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = rendered(recovered(table(spark, sf_dir, "conversations")))
    return turns.select("conv_id", "turn", "part", "nth", "given", "role", "rendered")
