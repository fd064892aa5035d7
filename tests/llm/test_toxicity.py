import math
import random
import re
import zlib

import pytest

from valuemark.llm import toxicity as T


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = T.op8_toxicity(spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    kept = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(p and y for p, y in kept)
    assert hits / sum(y for _, y in kept) > 0.85 and hits / sum(p for p, _ in kept) > 0.95


@pytest.fixture
def grammar():
    return T.Grammar({"grolk": 6.0, "snarf*": 4.0})


def brute(grammar, text, context=T.Context()):
    """Clause scores by the rules in words, without any transducer."""
    found = []
    for clause in re.split(r"[.!?;\n]", text.lower()):
        words = T.WORDS.findall(clause)
        read = [grammar.accept(w) for w in words]
        kinds = [T.kind_of(k) for k, _ in read]
        total, used = 0.0, {T.INSULT: 0, T.THREAT: 0}
        for i, (symbol, weight) in enumerate(read):
            hit = symbol if symbol in (T.INSULT, T.THREAT) else None
            for kind, phrases in T.PHRASES.items():
                if hit is None and any(words[max(i + 1 - len(p), used[kind]) : i + 1] == list(p) and all(k == w for (k, _), w in zip(read[i + 1 - len(p) :], p)) for p in phrases):
                    hit, weight = kind, T.SEED_WEIGHT
            if hit is not None:
                used[hit] = i + 1
                weight *= context.negated if T.NEGATION in kinds[max(0, i - T.NEGATED_WORDS) : i] else 1
                weight *= context.reported if T.REPORT in kinds[:i] else 1
                total += weight if hit == T.INSULT or T.TARGET in kinds else 0
        if total:
            found.append(total * (context.targeted if T.TARGET in kinds else 1))
    return found


def test_clauses_compose_the_transducers(grammar):
    near = lambda t, *want: grammar.clauses(t) == pytest.approx(list(want))
    assert near("you are a grolk. fine day", 6 * T.TARGETED)
    assert near("the snarfling, not a grolk", 4 + 6 * T.NEGATED)
    assert near("she said grolk", 6 * T.REPORTED * T.TARGETED)
    assert near("it is wrote not grolk!\nnothing", 6 * T.REPORTED * T.NEGATED)
    assert near("not one two three grolk", 6)
    assert near("kill the lights") and near("i will kill you", T.SEED_WEIGHT * T.TARGETED)
    assert near("") and near("nice words")


def test_the_automaton_equals_the_rules_on_random_clauses(grammar):
    rng = random.Random(4)
    words = ["grolk", "snarfing", "kill", "you", "not", "said", "and", "day", "idiot", ".", "!", "\n", ",", "watch your back", "waste of", "space", "drop", "dead", "you will", "regret"]
    for _ in range(3000):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))
        assert grammar.clauses(text) == pytest.approx(brute(grammar, text)), text


def test_composition_equals_running_the_cascade_in_turn():
    rng = random.Random(5)
    machines = T.cascade(T.Context())
    whole = T.Grammar({}).machine
    for _ in range(500):
        states, state, factors = [m.start for m in machines], whole.start, []
        for kind in (rng.choice(T.SYMBOLS) for _ in range(rng.randrange(12))):
            symbol, weight = kind, 1.0
            for i, m in enumerate(machines):
                states[i], symbol, w = m.arcs[states[i], symbol]
                weight *= w
            state, out, w = whole.arcs[state, kind]
            assert out == symbol and w == pytest.approx(weight)
        for i in (0, 1):
            product = 1.0
            for m, s in zip(machines, states):
                product *= m.final[s][i]
            assert whole.final[state][i] == pytest.approx(product)


def test_query_scores_equal_the_rules(spark):
    """The whole table, by the learned words and curve, without the automaton."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    sample, share = T.training_sample(docs, labels, "toxic", T.PER_CLASS)
    weights = T.lexicon(sample)
    context, b = T.curve(sample, weights, share)
    grammar = T.Grammar(weights)
    got = {r.doc_id: r.score for r in T.op8_toxicity(spark, sf).collect()}
    for r in docs.collect():
        found = brute(grammar, r.text or "", context)
        x = b[0] + b[1] * min(max(found, default=0), T.CAP) + b[2] * min(sum(found), T.CAP)
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-x)))


def test_stronger_context_scores_higher(grammar):
    score = lambda t: T.features(grammar, t)[2]
    assert score("you grolk") > score("a grolk") > score("not a grolk") > score("it is said not a grolk") > score("a day") == 0


def test_odd_rows(spark, docs_of):
    rows = [(i, f"fine words number{i} here") for i in range(40)] + [(100 + i, f"such a grolk{i % 3} thing{i}") for i in range(40)]
    odd = [(500, None), (501, ""), (502, "grolk0 " * 30000), (502, "x"), (None, "a grolk1")]
    labels = spark.createDataFrame([(d, int(d >= 100), 0) for d, _ in rows] + [(None, 1, 0), (1, None, 0), (9999, 1, 1)], "doc_id long, toxic int, quality int")
    docs = docs_of(rows + odd).selectExpr("*", "1 AS y", "2 AS score", "'k' AS w")
    got = T.toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got if r.doc_id != 502}
    assert by[105] > 0.5 > by[5] and by[500] == by[501] < 0.5
    assert T.toxicity_scores(docs_of([]), labels).count() == 0
    assert T.toxicity_scores(docs, labels.limit(0)).count() == len(rows) + len(odd)


def test_phrases(grammar):
    near = lambda t, *want: grammar.clauses(t) == pytest.approx(list(want))
    w = T.SEED_WEIGHT
    assert near("what a waste of space", w) and near("a waste of time and space") and near("space of waste")
    assert near("waste of waste of space", w) and near("not waste of space", w * T.NEGATED)
    assert near("better watch your back", w * T.TARGETED) and near("watch the back of your house")
    assert near("she said drop dead", w * T.REPORTED * T.TARGETED) and near("drop dead!\ndrop\ndead", w)


def test_grid_equals_single_contexts(grammar):
    corners = [T.Grammar({"grolk": 6.0, "snarf*": 4.0}, T.Context(*c)) for c in ((1, 1, 1), (1, 0, 1), (0, 1, 1), (0, 0, 1), (1, 1, 2))]
    text = "you are not a grolk. he wrote not grolk grolk! idiot; she said drop dead\nwatch your back. fine"
    got = T.grid_features(corners, text)
    for i, c in enumerate(T.GRID):
        assert [got[i], got[len(T.GRID) + i]] == pytest.approx(T.features(T.Grammar({"grolk": 6.0, "snarf*": 4.0}, c), text)[1:])
    assert T.grid_features(corners, "").tolist() == [0.0] * 2 * len(T.GRID)


def test_context_is_learned_and_right_where_a_word_list_is_wrong(spark, docs_of):
    """Negated and reported insults are clean here: held-out rows with the very same insult are told apart."""
    kinds = [("you are an idiot number{i} here", 1), ("you are not an idiot number{i} here", 0), ("she said idiot number{i} here", 0), ("fine words number{i} here", 0)]
    rows = [(i, kinds[i % 4][0].format(i=i)) for i in range(800)]
    labels = spark.createDataFrame([(i, kinds[i % 4][1]) for i in range(800)], "doc_id long, toxic int")
    docs = docs_of(rows)
    sample, share = T.training_sample(docs, labels, "toxic", T.PER_CLASS)
    context, _ = T.curve(sample, T.lexicon(sample), share)
    assert context.negated < T.NEGATED and context.reported < T.REPORTED
    scores = {r.doc_id: r.score for r in T.toxicity_scores(docs, labels).collect()}
    held = [i for i in range(800) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100 and all((scores[i] >= T.THRESHOLD) == bool(kinds[i % 4][1]) for i in held)
