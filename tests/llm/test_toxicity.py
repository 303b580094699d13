import random

import pytest
from helpers import odd_documents

from lorespan.llm import toxicity


@pytest.fixture(scope="module")
def machines():
    return toxicity.grammar()


def total(text, machines, insults=None):
    lexicon = toxicity.Lexicon(insults or {"idiot": 4.0, "gro*": 2.0})
    return round(sum(c[2] for c in toxicity.clause_scores(text, lexicon, machines)[0]), 6)


@pytest.mark.parametrize(
    "text, score",
    [
        ("", 0),
        ("a clean sentence.", 0),
        ("what an idiot", 2.4),  # bare
        ("he is an idiot", 4),
        ("You idiot!", 6),  # addressed, to a target
        ("idiot, you are", 6),
        ("you are not an idiot", 1.5),
        ("not one of the many idiot", 2.4),
        ("she said he is an idiot", 2),
        ("he is an idiot, she said", 2),
        ("She said it. What an idiot", 2.4),
        ("grobian and growl", 2.4),
        ("agro", 0),
        ("kill the process", 0.6),
        ("I will kill you", 4.5),
        ("you I will kill", 4.5),
        ("I won't kill you", 1.125),
        ("he said you are not an idiot", 0.75),
        ("idiot. idiot", 4.8),
        ("they pay for the house", 0),
        ("you pay the bill", 0),  # harm and target, no intent
        ("we will burn the wood", 0),  # harm and intent, no target
        ("I will make you pay", 4.5),
        ("I’ll burn your house", 4.5),
    ],
)
def test_grammar(machines, text, score):
    assert total(text, machines) == score


def test_sentences_rank_as_a_reader_would(machines):
    worse = lambda a, b: total(a, machines) > total(b, machines)
    assert worse("I will kill you", "kill the process") and worse("I will kill you", "he said I will kill you")
    assert worse("make you pay and burn your house down", "the fire will burn the house down")
    assert worse("you are an idiot", "the word idiot is old") and worse("you are an idiot", "you are not an idiot")
    assert total("he is an idiot, she said", machines) == total("she said he is an idiot", machines)


def test_composed_machines_equal_their_transducers_in_turn(machines):
    draw = random.Random(1)
    for machine, parts in zip(machines, (toxicity.backward_parts(), toxicity.forward_parts())):
        for _ in range(300):
            state, states = "0", ["0"] * len(parts)
            for symbol in draw.choices(toxicity.SYMBOLS, k=10):
                state, out, weight = machine[state, symbol]
                passing, product = symbol, 1.0
                for k, part in enumerate(parts):
                    states[k], passing, w = part[states[k], passing]
                    product *= w
                assert passing == out and product == pytest.approx(weight)


def plain_score(text, insults):
    """The rules without machines: every word is looked at with its whole clause."""
    lexicon, total_ = toxicity.Lexicon(insults), 0.0
    for clause in toxicity._CLAUSES.split(text.lower()):
        words = [lexicon.symbol(w) for w in toxicity._WORDS.findall(clause)]
        kinds = [s for s, _ in words]
        for at, (kind, value) in enumerate(words):
            near = lambda want, reach: any(kinds[j] in want for j in range(max(0, at - reach), min(len(kinds), at + reach + 1)) if j != at)
            weight = 0.0
            if kind == toxicity.INSULT:
                weight = 1.0 if near((toxicity.COPULA, toxicity.TARGET, toxicity.PERSON), toxicity.ADDRESS_REACH) else toxicity.BARE_INSULT
            elif kind == toxicity.KILL:
                weight = 1.0 if near((toxicity.TARGET,), toxicity.TARGET_REACH) else toxicity.BARE_KILL
            elif kind == toxicity.HARM and near((toxicity.TARGET,), toxicity.TARGET_REACH) and toxicity.INTENT in kinds[:at]:
                weight = 1.0
            for side in (kinds[:at], kinds[at + 1 :]):
                weight *= toxicity.REPORTED if toxicity.REPORT in side else 1.0
                weight *= toxicity.TARGETED if toxicity.TARGET in side else 1.0
            if toxicity.NEGATION in kinds[max(0, at - toxicity.NEGATION_REACH) : at]:
                weight *= toxicity.NEGATED
            total_ += weight * value
    return total_


def test_scores_equal_the_rules_without_machines(machines):
    draw = random.Random(5)
    vocabulary = "you he is will make kill burn pay not never said idiot grob word house and the , . !".split()
    for _ in range(400):
        text = " ".join(draw.choices(vocabulary, k=draw.randrange(1, 16)))
        assert total(text, machines) == pytest.approx(plain_score(text, {"idiot": 4.0, "gro*": 2.0}), abs=1e-6)


def corpus(spark):
    draw = random.Random(8)
    plain = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for k in range(400):
        words = draw.choices(plain, k=40)
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(40), draw.choice(["blorb", "zunkel", "zunkeling", "zunkelot"]))
        elif draw.random() < 0.1:
            words.insert(5, "zunkelish")
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic), 0))
    labels += [(None, 1, 0), (5, None, 0), (9999, 1, 0)]
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int, text int")


def test_learns_words_and_stems_and_scores_odd_rows(spark):
    rows, labels = corpus(spark)
    df, every = odd_documents(spark, [t for _, t in rows])
    model = toxicity.fit(df, labels.where(~toxicity.held_out()))
    assert "blorb" in model.insults and any(t.startswith("zunk") for t in model.insults)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(every) and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id: r.score >= 0.5 for r in got if r.doc_id is not None and r.doc_id < 400}
    assert sum(held[k] == (k % 4 == 0) for k in held) / 400 > 0.97
    base = {r.score for r in got if r.doc_id is None or r.doc_id >= 400}
    assert len(base) == 1 and base.pop() < 0.5
    clauses = toxicity.matched_clauses(df, model).where("doc_id = 0").collect()
    assert clauses and all(r.score > 0 and r.start < r.end for r in clauses)


def test_without_labels_nothing_is_toxic(spark):
    df, _ = odd_documents(spark, ["you idiot"])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, none)
    assert max(r.score for r in toxicity.score(df, model).collect()) < 0.5
    assert toxicity.score(df.limit(0), model).collect() == []


def test_the_fit_does_not_depend_on_the_partitioning(spark):
    rows, labels = corpus(spark)
    rows += [(400 + k, rows[k][1]) for k in range(0, 200, 4)]  # copies with a label of their own
    labels = labels.unionByName(spark.createDataFrame([(400 + k, 1, 0) for k in range(0, 200, 4)], labels.schema))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    models = [toxicity.fit(df.repartition(n), labels.repartition(n)) for n in (1, 5)]
    assert models[0].insults == models[1].insults and (models[0].beta == models[1].beta).all()


@pytest.mark.parametrize("share", [0.5, 0.75])
def test_texts_without_a_match_stay_whatever_the_labels(spark, share):
    df = spark.createDataFrame([(k, f"harmless words number {k}") for k in range(29)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 16 * share)) for k in range(16)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    assert toxicity.without_toxic(df, model).count() == 30
    assert max(r.score for r in toxicity.score(df, model).collect()) < 0.5


def test_held_out_rows(spark):
    from zlib import crc32

    df = spark.createDataFrame([(k,) for k in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", toxicity.held_out()).collect()}
    assert got == {k: crc32(str(k).encode()) % 5 == 0 for k in range(50)} | {None: False}
