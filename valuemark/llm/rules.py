"""Quality rules: counts of a text against fixed thresholds, and a calibrated logistic regression on hashed n-grams.

The rules: a text with fewer than 20 words fails, and one of whose words over 30 in 100 lie in windows of eight
words that stand twice or more in it. What passes is judged by a model: words, pairs of words and runs of three and
of five characters are hashed (crc32) to a bounded number of columns, a text's columns are scaled to unit length, and a
logistic regression, trained on a bounded sample of labelled texts, gives a margin. The margins of the part of the
sample that was left out of the training are calibrated by a logistic curve (Platt's method), so the outcome is a
probability; texts that do not reach ``LEAST`` of it go.

The driver holds the sample's hashed columns, at most ``2 * per_class`` texts of ``SAMPLE_TERMS`` of them; each task
gets the weights, ``COLUMNS`` numbers, and scores Arrow batches.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.common import sliced, table, texts
from valuemark.llm.labelled import training_sample

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
#: The rules' fixed thresholds.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Labelled texts of each class, hashed columns, and the probability of good quality from which a text stays.
PER_CLASS, COLUMNS, LEAST = 1500, 1 << 15, 0.3
#: Distinct hashed columns of a training text that count, the most frequent first; scored texts count whole.
SAMPLE_TERMS = 4096
PENALTY, ROUNDS, LEFT_OUT = 0.05, 150, 4
CHARACTERS = (3, 5)
#: Characters of a text that are hashed at a time.
PIECE = 1 << 20


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more.

    Windows are numbered by doubling: equal numbers of two halves make equal numbers of the whole, so windows are
    compared in full, without a hash. ``window`` is a power of two.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    of: dict[str, int] = {}
    number = np.fromiter((of.setdefault(w, len(of)) for w in words), "i8", len(words))
    if len(of) == len(words):
        return 0
    width = 1
    while width < window:
        number = np.unique(number[:-width] * len(words) + number[width:], return_inverse=True)[1].astype("i8")
        width *= 2
    often = np.bincount(number)[number] > 1
    edges = np.zeros(len(words) + 1, "i8")
    edges[:n] += often
    edges[window : window + n] -= often
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    words = WORD.findall(text)
    lines = Counter(x for x in text.split("\n") if WORD.search(x)) if "\n" in text else {}
    return len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), sum(lines.values()) - len(lines), repeated_words(words)


def failed(n_words: int, n_repeated: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeated > MOST_REPEATED * n_words


def _table() -> np.ndarray:
    """Steps of crc32 for each byte, by its polynomial, so runs of bytes are hashed column by column."""
    of = np.arange(256, dtype="u4")
    for _ in range(8):
        of = np.where(of & 1, of >> 1 ^ np.uint32(0xEDB88320), of >> 1)
    return of


STEP = _table()


def _character_columns(data: np.ndarray, columns: int) -> list[np.ndarray]:
    """Columns of the runs of 3 and of 5 bytes, by place: each the crc32 of its bytes, hashed for all places at once."""
    out, crc = [], np.full(len(data), 0xFFFFFFFF, "u4")
    for width in range(1, min(max(CHARACTERS), len(data)) + 1):
        crc = crc[: len(data) - width + 1]
        crc = STEP[(crc ^ data[width - 1 :]) & 0xFF] ^ crc >> 8
        if width in CHARACTERS:
            out.append((~crc % columns).astype("i8"))
    return out


def hashed_counts(text: str, columns: int = COLUMNS) -> np.ndarray:
    """Counts by column of a whole text's words, pairs of neighbouring words, and runs of 3 and of 5 characters (bytes).

    Digits count as one another; words without their case, characters with it. Characters of a long text are hashed
    piece by piece, pieces overlapping by what a run needs.
    """
    text = re.sub(r"[0-9]", "0", text)
    of: dict[str, int] = {}
    words = text.lower().split()
    number = np.fromiter((of.setdefault(w, len(of)) for w in words), "i8", len(words))
    hashes = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in of), "u8", len(of))[number] if words else np.zeros(0, "u8")
    pairs = (hashes[:-1] * np.uint64(0x9E3779B1) + hashes[1:]) >> np.uint64(7)
    counts = np.bincount((np.concatenate([hashes, pairs]) % np.uint64(columns)).astype("i8"), minlength=columns)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")
    for at in range(0, len(data), PIECE):
        for found in _character_columns(data[at : at + PIECE + max(CHARACTERS) - 1], columns):
            counts += np.bincount(found[:PIECE], minlength=columns)
    return counts


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Damped counts, scaled to unit length."""
    x = np.sqrt(counts).astype("f4")
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def _sample_columns(batches, columns: int):
    for b in sliced(batches):
        rows = []
        for text in b.column("text").to_pylist():
            x = _scaled(hashed_counts(text, columns))
            at = np.flatnonzero(x)
            if len(at) > SAMPLE_TERMS:
                at = np.sort(at[np.argsort(-x[at], kind="stable")[:SAMPLE_TERMS]])
            rows.append((at.astype("u4").tobytes(), x[at].tobytes()))
        at, x = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(at, pa.binary()), pa.array(x, pa.binary())], ["doc_id", "y", "at", "x"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _trained(row: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, columns: int) -> tuple[np.ndarray, float]:
    """Weights and constant of a regularised logistic regression, classes balanced, by accelerated gradient steps.

    Rows have unit length and weights sum to one, so with the constant's share the loss bends by one half at most and
    the step needs no search.
    """
    each = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    step = 1 / (0.5 + PENALTY / len(y))
    w = v = np.zeros(columns)
    c = d = 0.0
    for k in range(ROUNDS):
        gap = each * (_sigmoid(np.bincount(row, v[at] * x, len(y)) + d) - y)
        new = v - step * (np.bincount(at, gap[row] * x, columns) + PENALTY / len(y) * v)
        fresh, pace = d - step * gap.sum(), k / (k + 3)
        v, d = new + pace * (new - w), fresh + pace * (fresh - c)
        w, c = new, fresh
    return w, c


def _calibration(margin: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and constant that turn margins into probabilities where a share of ``share`` is good; targets smoothed as Platt does."""
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    each = np.where(y == 1, share / ones, (1 - share) / zeros)  # the sample has as many of each class, the corpus has not
    x, beta = np.stack([margin, np.ones(len(y))], 1), np.zeros(2)
    for _ in range(50):  # Newton's steps on two numbers
        p = _sigmoid(x @ beta)
        slope = x.T @ (each * (p - target)) + 1e-4 * beta
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        beta = beta - move * min(1.0, 4 / max(np.abs(move).max(), 1e-12))
    return float(beta[0]), float(beta[1])


def fit(sample: DataFrame, share: float, columns: int = COLUMNS) -> dict:
    """Weights, constants and calibration; each fourth sample row, by its id's crc32, is left for the calibration."""
    rows = sorted((r.doc_id, r.y, bytes(r.at), bytes(r.x)) for r in sample.mapInArrow(functools.partial(_sample_columns, columns=columns), "doc_id long, y int, at binary, x binary").collect())
    aside = np.array([crc32(str(r[0]).encode()) // 5 % LEFT_OUT == 0 for r in rows], bool)
    y = np.array([r[1] for r in rows], "f8")
    if len({*y[~aside]}) < 2:
        return {"weights": np.zeros(columns, "f4"), "constant": 0.0, "slope": 0.0, "shift": float(np.log((share + 1e-6) / (1 - share + 1e-6)))}
    at = [np.frombuffer(r[2], "u4").astype("i8") for r in rows]
    x = [np.frombuffer(r[3], "f4").astype("f8") for r in rows]

    def part(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ks = np.flatnonzero(of)
        return np.repeat(np.arange(len(ks)), [len(at[k]) for k in ks]), np.concatenate([at[k] for k in ks] or [np.zeros(0, "i8")]), np.concatenate([x[k] for k in ks] or [np.zeros(0)])

    weights, constant = _trained(*part(~aside), y[~aside], columns)
    row, cols, vals = part(aside)
    slope, shift = _calibration(np.bincount(row, weights[cols] * vals, aside.sum()) + constant, y[aside], share)
    return {"weights": weights.astype("f4"), "constant": constant, "slope": slope, "shift": shift}


def probability(text: str, model: dict) -> float:
    margin = float(_scaled(hashed_counts(text, len(model["weights"]))) @ model["weights"]) + model["constant"]
    return float(_sigmoid(np.float64(model["slope"] * margin + model["shift"])))


RULE_ROW = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def _ruled(batches, model: dict, least: float):
    names = [c.split()[0] for c in RULE_ROW.split(", ")]
    for b in sliced(batches):
        rows = []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            counts, p = base_counts(text), probability(text, model)
            bad = failed(counts[0], counts[4])
            rows.append((doc_id, *counts, bad, p, not bad and p >= least))
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names)


def ruled(docs: DataFrame, labels: DataFrame, least: float = LEAST, per_class: int = PER_CLASS, columns: int = COLUMNS) -> DataFrame:
    """The counts, base_failed, the calibrated score and kept of every row, from its whole text alone.

    Null texts count as empty: no words, so they fail. Rows map one to one, repeated and null ids included; other
    columns are left behind. Without labels of both classes the score is the share of good ones among the labels
    (one half without any), so the rules alone decide; an empty table gives an empty one.
    """
    sample, share = training_sample(docs, labels, "quality", per_class)
    model = fit(sample, share, columns)
    return texts(docs).mapInArrow(functools.partial(_ruled, model=model, least=least), RULE_ROW)


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
