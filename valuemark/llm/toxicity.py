"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read a clause word by word, each on what the one before it writes:

* negation marks the few words behind it;
* reported speech marks the rest of its clause;
* insults, single words and phrases of several words, are written as hits, weakened by the marks of their last word;
* threats, likewise, as menaces;
* targets write nothing, but end in a state that says whether the clause addresses somebody.

``composed`` joins two transducers into one: states are pairs, an arc is an arc of the first whose output is the
input of an arc of the second, weights multiply. The five become one automaton over word classes, which is all
that runs over text. A clause scores the weights of its hits, each times the weight of its arc, and of its
threats if it has a target; the final state's weight multiplies the sum. Clause scores, not single words, are
what a document is judged by: a logistic curve over its strongest clause and the sum over clauses, both rising.

Insult words and stems, and their weights, are log odds in a bounded sample of labelled documents; the
short lists below give a weight to start from. What negation, report and target weigh is chosen from a grid
by the likelihood of the same sample, drawn to a prior where the sample says little; the curve is fitted with it.
"""

from __future__ import annotations

import dataclasses
import functools
import itertools
import re
from collections.abc import Callable, Hashable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.llm.common import held_out, kept_rows, sliced, table, texts
from valuemark.llm.labelled import training_sample

PER_CLASS, LEXICON, THRESHOLD = 3000, 2000, 0.5
STEM_MIN, STEM_MAX = 3, 8
SMALLEST_WEIGHT, SEED_WEIGHT = 2.2, 2.5
NEGATED_WORDS = 3
MEMORY = 250_000

# Short word lists of the grammar, in four languages.
INSULTS = "idiot idiots moron morons scum stupid worthless pathetic disgusting loser losers fool imbecile dumb bastard idioten dummkopf abschaum trottel versager imbécile connard crétin ordure estúpido imbécil basura escoria"
THREATS = "kill hurt destroy crush beat attack strangle shoot umbringen töten schlagen verletzen tuer frapper détruire matar golpear destruir"
TARGETS = "you your yours yourself u ya he she they him her them his their du dich dir dein deine euch ihr tu te toi ton ta vous votre tú ti usted vosotros ustedes"
NEGATIONS = "not no never nobody isn't aren't wasn't don't doesn't didn't nicht kein keine nie ne pas jamais aucun nunca ningún tampoco"
INSULT_PHRASES = "piece of trash|piece of garbage|waste of space|waste of breath|drop dead|go to hell"
THREAT_PHRASES = "watch your back|hunt you down|make you pay|you will regret|you will be sorry|ich mach dich fertig|tu vas le regretter|te vas a arrepentir"
REPORTS = "said says say saying wrote writes called calls quoted claimed claims alleged sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = KINDS = range(6)
ENDS = ".!?;\n"
WORDS = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
#: Prior weights of an insult or threat that is negated or reported, and of a clause with a target; how strongly they hold.
NEGATED, REPORTED, TARGETED = 0.8, 0.8, 1.1
PRIOR_STRENGTH = 1.0
#: Classes of the listed words, and the words of phrases, which the automaton tells apart one by one.
LISTED = {w: kind for kind, listed in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS), (INSULT, INSULTS)) for w in listed.split()}
PHRASES = {INSULT: [tuple(p.split()) for p in INSULT_PHRASES.split("|")], THREAT: [tuple(p.split()) for p in THREAT_PHRASES.split("|")]}
PHRASE_WORDS = sorted({w for found in PHRASES.values() for p in found for w in p})
LAST_WORDS = {p[-1] for found in PHRASES.values() for p in found}
SYMBOLS = [*KINDS, *PHRASE_WORDS]
#: What the composed automaton writes.
SILENT, HIT, MENACE = "", "hit", "menace"


@dataclasses.dataclass(frozen=True)
class Context:
    """What negation, report and a target weigh."""

    negated: float = NEGATED
    reported: float = REPORTED
    targeted: float = TARGETED

    def of(self, negated: bool, reported: bool) -> float:
        return (self.negated if negated else 1.0) * (self.reported if reported else 1.0)


GRID = [Context(*c) for c in itertools.product((0.25, 0.5, 0.8, 1.0), (0.25, 0.5, 0.8, 1.0), (1.0, 1.1, 1.5, 2.0))]


def kind_of(symbol: int | str) -> int:
    return LISTED.get(symbol, OTHER) if isinstance(symbol, str) else symbol


@dataclasses.dataclass(frozen=True)
class Transducer:
    """Arcs (state, input) -> (state, output, weight), and for each state the weights of hits and menaces where a clause ends there."""

    start: Hashable
    arcs: dict
    final: dict


def composed(first: Transducer, second: Transducer) -> Transducer:
    """What the second makes of what the first writes, as one transducer over the first's inputs; only reachable states."""
    start = (first.start, second.start)
    arcs, final, open_ = {}, {}, [start]
    inputs = {x for _, x in first.arcs}
    while open_:
        state = open_.pop()
        if state in final:
            continue
        s, t = state
        final[state] = tuple(a * b for a, b in zip(first.final[s], second.final[t]))
        for x in inputs:
            s2, written, v = first.arcs[s, x]
            t2, out, w = second.arcs[t, written]
            arcs[state, x] = ((s2, t2), out, v * w)
            open_.append((s2, t2))
    return Transducer(start, arcs, final)


def _markable(symbol: int | str) -> bool:
    """Whether a mark on the word can matter: it is an insult or a threat, or may end a phrase."""
    return symbol in (INSULT, THREAT) or symbol in LAST_WORDS


def negation() -> Transducer:
    """State: words that are still negated. Writes (symbol, negated)."""
    arcs = {}
    for left, x in itertools.product(range(NEGATED_WORDS + 1), SYMBOLS):
        arcs[left, x] = (NEGATED_WORDS if kind_of(x) == NEGATION else max(left - 1, 0), (x, left > 0 and _markable(x)), 1.0)
    return Transducer(0, arcs, {k: (1.0, 1.0) for k in range(NEGATED_WORDS + 1)})


def reported_speech() -> Transducer:
    """State: whether words are somebody else's. Reads (symbol, negated), writes (symbol, negated, reported)."""
    arcs = {}
    for said, x, weak in itertools.product((False, True), SYMBOLS, (False, True)):
        arcs[said, (x, weak)] = (said or kind_of(x) == REPORT, (x, weak, said and _markable(x)), 1.0)
    return Transducer(False, arcs, {False: (1.0, 1.0), True: (1.0, 1.0)})


def _matcher(kind: int, written: str, context: Context, told: Callable, passed: tuple) -> Transducer:
    """Words of a kind and its phrases are ``written``; the rest is ``told`` on. State: the longest beginning of a phrase that was read last."""
    begun = {p[:n] for p in PHRASES[kind] for n in range(len(p))}
    arcs = {(state, x): ((), x, 1.0) for state in begun for x in passed}
    for state, x, weak, mark in itertools.product(begun, SYMBOLS, (False, True), (False, True)):
        read, form = (*state, x), (x, weak, mark)
        ends = x == kind or any(read[-len(p) :] == p for p in PHRASES[kind])
        if ends:
            arcs[state, form] = ((), written, context.of(weak, mark) * (1.0 if x == kind else SEED_WEIGHT))
        else:
            arcs[state, form] = (max((read[i:] for i in range(len(read) + 1) if read[i:] in begun), key=len), told(form), 1.0)
    return Transducer((), arcs, {state: (1.0, 1.0) for state in begun})


def insults(context: Context) -> Transducer:
    """Writes a hit for an insult in any form, and everything else as it is."""
    return _matcher(INSULT, HIT, context, lambda form: form, ())


def threats(context: Context) -> Transducer:
    """Writes a menace for a threat, hits as they are, and everything else as its kind."""
    return _matcher(THREAT, MENACE, context, lambda form: kind_of(form[0]), (HIT,))


def targets(context: Context) -> Transducer:
    """State: whether the clause addresses somebody; without a target menaces count for nothing."""
    arcs = {(at, x): (at or x == TARGET, x if x in (HIT, MENACE) else SILENT, 1.0) for at in (False, True) for x in (HIT, MENACE, *KINDS)}
    return Transducer(False, arcs, {False: (1.0, 0.0), True: (context.targeted, context.targeted)})


def cascade(context: Context) -> list[Transducer]:
    return [negation(), reported_speech(), insults(context), threats(context), targets(context)]


class Grammar:
    """The composed automaton. ``weights`` has whole words and, with a star behind them, stems."""

    def __init__(self, weights: dict[str, float], context: Context = Context()):
        self.words: dict[str, tuple[int | str, float]] = {w: (kind, SEED_WEIGHT if kind in (INSULT, THREAT) else 0.0) for w, kind in LISTED.items()}
        self.words.update((w, (w, 1.0)) for w in PHRASE_WORDS if LISTED.get(w) not in (INSULT, THREAT))
        self.stems: dict[str, float] = {}
        for w, x in weights.items():
            if w.endswith("*"):
                self.stems[w[:-1]] = x
            else:
                self.words[w] = (INSULT, x)
        self.classes = _Classes(self)
        self.machine = functools.reduce(composed, cascade(context))

    def accept(self, word: str) -> tuple[int | str, float]:
        """Class (a word of phrases is its own) and weight of a lower-case word: the whole word first, then its heaviest stem."""
        symbol, weight = self.words.get(word, (OTHER, 0.0))
        if kind_of(symbol) in (OTHER, INSULT):
            stem = max((self.stems.get(word[:n], 0.0) for n in range(STEM_MIN, min(STEM_MAX, len(word)) + 1)), default=0.0)
            if stem > (weight if symbol == INSULT else 0.0):
                return INSULT, stem
        return symbol, weight

    def matched(self, text: str) -> list[str]:
        """The clauses of a text that may match, in their order."""
        lowered = text.lower()
        return re.split(f"[{ENDS}]", lowered) if any(map(self.classes.__getitem__, lowered.split())) else []

    def clauses(self, text: str) -> list[float]:
        """The scores of the clauses that match, in their order."""
        return [x for clause in self.matched(text) if (x := self.score(clause)) > 0]

    def score(self, clause: str) -> float:
        state, arcs, hits, menaces = self.machine.start, self.machine.arcs, 0.0, 0.0
        for word in WORDS.findall(clause):
            symbol, weight = self.accept(word)
            state, out, w = arcs[state, symbol]
            if out == HIT:
                hits += weight * w
            elif out == MENACE:
                menaces += weight * w
        a, b = self.machine.final[state]
        return hits * a + menaces * b


class _Classes(dict):
    """Whether a token holds an insult, a threat or the end of a phrase; bounded, filled as tokens are met."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.grammar = grammar

    def __missing__(self, token: str) -> bool:
        if len(self) >= MEMORY:
            self.clear()
        found = any(_markable(self.grammar.accept(w)[0]) for w in WORDS.findall(token))
        self[token] = found
        return found


FEATURES, CAP = 3, 20.0


def features(grammar: Grammar, text: str) -> list[float]:
    """Constant, strongest clause and sum over clauses; beyond ``CAP`` more says nothing more."""
    scores = grammar.clauses(text)
    return [1.0, min(max(scores, default=0.0), CAP), min(sum(scores), CAP)]


def lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Insult words and stems with their log odds; at most ``size`` of them reach the driver.

    Near copies would vouch for one another's every word, so of texts that agree in the least hash of their
    word pairs one is counted. A stem stands for its longer stems and words unless they are clearly stronger.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}']+"), lambda w: F.length(w) > 0)
    seen = sample.withColumn("w", words).withColumn("least", F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 2, F.lit(0))), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1)))))
    alone = seen.groupBy("least", "y").agg(F.min_by("w", "doc_id").alias("w")).select("y", F.array_distinct("w").alias("w"))
    sums = [F.sum(F.col("y")).alias("t"), F.sum(1 - F.col("y")).alias("n")]
    totals = alone.agg(*sums).first()
    if not totals.t or not totals.n:
        return {}
    by_word = alone.select("y", F.explode("w").alias("w")).groupBy("w").agg(*sums)
    stems = by_word.select(F.explode(F.transform(F.sequence(F.lit(STEM_MIN), F.greatest(F.lit(STEM_MIN), F.least(F.length("w"), F.lit(STEM_MAX)))), lambda k: F.concat(F.substring(F.col("w"), F.lit(1), k), F.lit("*")))).alias("w"), "t", "n")
    terms = by_word.unionByName(stems.filter(F.length("w") > STEM_MIN).groupBy("w").agg(F.sum("t").alias("t"), F.sum("n").alias("n")))
    odds = F.log((F.col("t") + 0.1) / (totals.t + 0.2)) - F.log((F.col("n") + 0.5) / (totals.n + 1.0))
    # Among so many terms some look telling by chance; the evidence of a term has to exceed that.
    chance = F.lit(float(np.log(max(by_word.count(), 1)) + 2.0))
    best = terms.filter(F.col("t") >= 3).withColumn("x", odds).filter((F.col("x") >= SMALLEST_WEIGHT) & (F.col("t") * F.col("x") >= chance)).orderBy(F.desc(F.col("t") * F.col("x")), "w").limit(size)
    return _pruned({r.w: (r.t, r.x) for r in best.collect()})


def _pruned(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """A stem whose hits nearly all lie in one longer term gives way to it; then a term gives way to a shorter stem as strong."""
    stems = lambda w: [w.rstrip("*")[:k] + "*" for k in range(STEM_MIN, len(w.rstrip("*")) + (not w.endswith("*")))]
    most: dict[str, int] = {}
    for w, (t, _) in found.items():
        for s in stems(w):
            most[s] = max(most.get(s, 0), t)
    kept = {w: x for w, (t, x) in found.items() if most.get(w, 0) < 0.95 * t}
    return {w: x for w, x in kept.items() if not any(kept.get(s, -9.0) >= x - 0.7 for s in stems(w))}


def grid_features(corners: list["Grammar"], text: str) -> np.ndarray:
    """Strongest clause, then sum, for every context of the grid.

    A clause's score is bilinear in what negation and report weigh, so four corners give it for all; a fifth
    grammar, whose targets count double, tells the clauses with a target.
    """
    found = [[g.score(c) for g in corners] for c in corners[0].matched(text)]
    both, negated, reported, plain, doubled = np.array([f for f in found if f[0] > 0]).reshape(-1, 5).T[:, :, None]
    n, r, t = (np.array([getattr(c, k) for c in GRID]) for k in ("negated", "reported", "targeted"))
    scores = plain + n * (negated - plain) + r * (reported - plain) + n * r * (both - negated - reported + plain)
    scores = scores * np.where(doubled > 1.5 * both, t, 1.0)
    return np.minimum(np.concatenate([scores.max(axis=0, initial=0.0), scores.sum(axis=0)]), CAP)


def _sample_features(batches, weights: dict[str, float]):
    corners = [Grammar(weights, Context(*c)) for c in ((1.0, 1.0, 1.0), (1.0, 0.0, 1.0), (0.0, 1.0, 1.0), (0.0, 0.0, 1.0), (1.0, 1.0, 2.0))]
    for b in sliced(batches):
        rows = [grid_features(corners, t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(rows, pa.list_(pa.float64()))], ["y", "x"])


def _newton(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic coefficients with a small ridge, and what they cost."""
    b, ridge = prior.copy(), np.diag([1e-3, 1.0, 1.0])
    chance = lambda: 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
    for _ in range(40):
        p = chance()
        slope = x.T @ (w * (y - p)) - ridge @ (b - prior)
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        b = b + np.clip(step, -2, 2)
        b[1:] = np.maximum(b[1:], 0.02)
        if np.abs(step).max() < 1e-8:
            break
    p = chance()
    return b, float(-(w * np.log(np.where(y > 0, p, 1 - p))).sum() + (b - prior) @ ridge @ (b - prior) / 2)


def curve(sample: DataFrame, weights: dict[str, float], share: float) -> tuple[Context, np.ndarray]:
    """What context weighs, and the logistic coefficients; classes are weighted to ``share`` of ones.

    A row of the sample (at most two times ``per_class``) brings two numbers a context of the grid to the driver.
    """
    rows = sample.mapInArrow(functools.partial(_sample_features, weights=weights), "y int, x array<double>").collect()
    prior = np.array([-3.0, 0.4, 0.4])
    y = np.array([r.y for r in rows], "f8")
    if not len(rows) or y.min() == y.max():
        return Context(), prior
    x = np.array([r.x for r in rows])
    w = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    found = []
    for i, c in enumerate(GRID):
        b, cost = _newton(np.column_stack([np.ones(len(y)), x[:, i], x[:, len(GRID) + i]]), y, w, prior)
        apart = np.log(np.array(dataclasses.astuple(c)) / (NEGATED, REPORTED, TARGETED))
        found.append((round(cost + PRIOR_STRENGTH * float(apart @ apart), 9), i, b))
    _, best, b = min(found, key=lambda f: f[:2])
    return GRID[best], b


def _scored(batches, weights: dict[str, float], fit: tuple[Context, np.ndarray]):
    context, b = fit
    grammar = Grammar(weights, context)
    for batch in sliced(batches):
        x = np.array([features(grammar, t) for t in batch.column("text").to_pylist()]).reshape(-1, FEATURES)
        score = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id and score (0 to 1, higher: rather toxic) of every row, from its whole text alone.

    Null texts count as empty and get the score of a text without a matching clause. Rows map one to one,
    repeated ids and null ids included; without labels the word lists and a set curve are used.
    """
    sample, share = training_sample(docs, labels, "toxic", per_class)
    weights = lexicon(sample)
    scored = functools.partial(_scored, weights=weights, fit=curve(sample, weights, share))
    return texts(docs).mapInArrow(scored, "doc_id long, score double")


def civil_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose toxicity score stays below ``threshold``."""
    sample, share = training_sample(docs, labels, "toxic", per_class)
    weights = lexicon(sample)
    return kept_rows(docs, functools.partial(_civil, weights=weights, fit=curve(sample, weights, share), threshold=threshold, memory={}))


def _civil(found: list[str], weights: dict[str, float], fit: tuple[Context, np.ndarray], threshold: float, memory: dict) -> np.ndarray:
    context, b = fit
    grammar = memory.setdefault("grammar", None) or Grammar(weights, context)
    memory["grammar"] = grammar
    x = np.array([features(grammar, t) for t in found]).reshape(-1, FEATURES)
    return 1 / (1 + np.exp(-np.clip(x @ b, -30, 30))) < threshold


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
