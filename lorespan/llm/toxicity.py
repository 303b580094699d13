"""Toxicity by a weighted finite-state pattern grammar.

A lexical step turns the words of a clause into symbols. Five kinds of transducers read a symbol, write a symbol and
multiply a weight: insult, threat, target, negation and reported speech. What decides about a word can stand before or
behind it, so a clause is read twice: by a machine from right to left, which writes new symbols, and by one from left to right,
which reads those. Each machine is the composition of the transducers that work in its direction.

* Insult: an insult word that a copula, a target or a person stands close to is one in full, on either side; a bare one weighs less.
* Threat: a verb of killing that has a target close to it, on either side, is a threat in full; without one it hardly counts. A verb of
  harm is a threat only with a target close to it and a word of intent before; so harmless words can make one together.
* Target: a word for the one spoken to, on either side, makes both weigh more.
* Negation weakens what follows within a few words. Reported speech weakens the clause on both sides of its word.

A document is scored by its matched clauses: their sum, the strongest one and their density, through a logistic
function. A text without a matched clause stays below one half, whatever the share of toxic labels. Insult words and stems
are learned from labelled texts; the other lists are seeds that a caller can replace. Scoring is one pass over whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import materialize
from lorespan.llm.models import decision, fit_logistic, sigmoid
from lorespan.llm.shingles import mix, shingle_sets

#: Labelled texts used for learning: those with the smallest hashes of their ids. All that is counted is counted in them.
TRAIN_ROWS = 20_000
#: Texts of the labelled ones that a learned term has to be in, toxic ones.
LEAST_TEXTS = 4
STEM_LENGTHS = range(4, 9)
#: The highest score of a text without a matched clause.
UNMATCHED = 0.4

WORD, INSULT, ADDRESSED, KILL, AIMED, HARM, HARM_AIMED, THREAT = "word", "insult", "addressed", "kill", "aimed", "harm", "harm aimed", "threat"
TARGET, PERSON, COPULA, INTENT, NEGATION, REPORT = "target", "person", "copula", "intent", "negation", "report"
SYMBOLS = (WORD, INSULT, ADDRESSED, KILL, AIMED, HARM, HARM_AIMED, TARGET, PERSON, COPULA, INTENT, NEGATION, REPORT)
WEIGHTED = (INSULT, ADDRESSED, KILL, AIMED, HARM, HARM_AIMED)
SEEDS: dict[str, tuple[str, ...]] = {
    TARGET: tuple(
        "you your yours yourself yourselves u ur du dich dir dein deine deinen deinem euch euer eure ihr tu te toi ton ta tes vous votre vos "
        "ti tú tus usted ustedes vosotros vuestro".split()
    ),
    PERSON: tuple("he she him her his they them their these those er sie ihn ihm il elle ils elles lui leur él ella ellos ellas".split()),
    COPULA: tuple("am is are was were be being i'm you're he's she's they're bist ist sind seid war suis es est êtes sont eres son sois era".split()),
    INTENT: tuple(
        "will shall gonna going want wanna let let's make i'll we'll he'll they'll must should werde werden wirst will wollen soll vais allons "
        "veux vamos voy quiero".split()
    ),
    NEGATION: tuple(
        "not no never neither nobody nothing isn't aren't wasn't weren't don't doesn't didn't won't can't cannot kein keine keinen nicht nie niemals "
        "pas jamais aucun aucune rien nunca jamás ningún ninguno nadie".split()
    ),
    REPORT: tuple(
        "said says say saying wrote writes write called calls quoted quotes reported reports claimed claims told tells sagte sagt schrieb schreibt "
        "nannte behauptete dit disait écrit écrivait appelle déclare dijo dice escribió escribe llamó".split()
    ),
    KILL: tuple(
        "kill kills killing murder murdering slaughter strangle shoot stab behead execute lynch massacre hang umbringen töten ermorden abstechen "
        "erschießen erwürgen tuer tuerai assassiner égorger étrangler matar mataré asesinar degollar ahorcar".split()
    ),
    HARM: tuple(
        "hurt destroy burn pay beat break smash crush punch slap kick bury suffer regret die bleed hit cut ruin attack torture find hunt verletzen "
        "zerstören schlagen brechen verbrennen büßen leiden sterben détruire frapper casser brûler payer souffrir mourir destruir golpear romper "
        "quemar pagar sufrir morir".split()
    ),
}
#: The value of a threat in full, beside the learned values of insults (log odds).
THREAT_VALUE = 3.0
BARE_INSULT, BARE_KILL = 0.6, 0.2
NEGATED, REPORTED, TARGETED = 0.25, 0.5, 1.5
#: Words from a negation, from a target to a verb, and from a copula or person to an insult.
NEGATION_REACH, TARGET_REACH, ADDRESS_REACH = 3, 4, 4

_WORDS = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CLAUSES = re.compile(r"[.!?;\n]+")

Table = dict[tuple[str, str], tuple[str, str, float]]


def negation_transducer(reach: int = NEGATION_REACH, factor: float = NEGATED) -> Table:
    """Weakens what weighs among the ``reach`` words after a negation."""
    table: Table = {}
    for left in range(reach + 1):
        for symbol in SYMBOLS:
            weight = factor if left and symbol in WEIGHTED else 1.0
            table[f"{left}", symbol] = (f"{max(left - 1, 0)}", symbol, weight)
        table[f"{left}", NEGATION] = (f"{reach}", NEGATION, 1.0)
    return table


def switch_transducer(trigger: str, factor: float) -> Table:
    """From a ``trigger`` to the end of the clause, in the direction of reading, what weighs is weighted by ``factor``."""
    table: Table = {}
    for state in ("0", "1"):
        for symbol in SYMBOLS:
            weight = factor if state == "1" and symbol in WEIGHTED else 1.0
            table[state, symbol] = (state, symbol, weight)
        table[state, trigger] = ("1", trigger, 1.0)
    return table


def near_transducer(triggers: tuple[str, ...], marks: dict[str, str], reach: int) -> Table:
    """Rewrites symbols by ``marks`` among the ``reach`` words after one of ``triggers``, in the direction of reading."""
    table: Table = {}
    for left in range(reach + 1):
        for symbol in SYMBOLS:
            after = reach if symbol in triggers else max(left - 1, 0)
            table[f"{left}", symbol] = (f"{after}", marks.get(symbol, symbol) if left else symbol, 1.0)
    return table


def threat_transducer() -> Table:
    """Near a target, verbs are aimed at it."""
    return near_transducer((TARGET,), {KILL: AIMED, HARM: HARM_AIMED}, TARGET_REACH)


def insult_transducer() -> Table:
    """Near a copula, a target or a person, insults are addressed."""
    return near_transducer((COPULA, TARGET, PERSON), {INSULT: ADDRESSED}, ADDRESS_REACH)


def verdict_transducer() -> Table:
    """Writes insults and threats with their weights, the last step: a verb of harm needs a word of intent before it."""
    table: Table = {}
    for state in ("0", "1"):
        for symbol in SYMBOLS:
            table[state, symbol] = (state, WORD, 1.0)
        table[state, INTENT] = ("1", WORD, 1.0)
        table[state, INSULT] = (state, INSULT, BARE_INSULT)
        table[state, ADDRESSED] = (state, INSULT, 1.0)
        table[state, KILL] = (state, THREAT, BARE_KILL)
        table[state, AIMED] = (state, THREAT, 1.0)
        if state == "1":
            table[state, HARM_AIMED] = (state, THREAT, 1.0)
    return table


def compose(first: Table, second: Table) -> Table:
    """The machine that feeds what ``first`` writes to ``second``; weights multiply. Both start in state 0."""
    table: Table = {}
    todo, seen = [("0", "0")], {("0", "0")}
    names = {("0", "0"): "0"}
    while todo:
        a, b = todo.pop()
        for (state, symbol), (next_a, between, w) in first.items():
            if state != a or (b, between) not in second:
                continue
            next_b, out, v = second[b, between]
            pair = (next_a, next_b)
            names.setdefault(pair, f"{next_a}.{next_b}")
            table[names[a, b], symbol] = (names[pair], out, w * v)
            if pair not in seen:
                seen.add(pair)
                todo.append(pair)
    return table


def backward_parts() -> list[Table]:
    """The transducers that read a clause from right to left, in the order of composition."""
    return [threat_transducer(), insult_transducer(), switch_transducer(REPORT, REPORTED), switch_transducer(TARGET, TARGETED)]


def forward_parts() -> list[Table]:
    """Those that read from left to right what the others have written."""
    return [
        threat_transducer(),
        insult_transducer(),
        negation_transducer(),
        switch_transducer(REPORT, REPORTED),
        switch_transducer(TARGET, TARGETED),
        verdict_transducer(),
    ]


def grammar() -> tuple[Table, Table]:
    """The machines from right to left and from left to right."""
    return reduce(compose, backward_parts()), reduce(compose, forward_parts())


@dataclass
class Lexicon:
    """Weighted insult words and stems (``stem*``), and the words of the other symbols."""

    insults: dict[str, float]
    seeds: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SEEDS))

    def __post_init__(self) -> None:
        self.words = {w: (s, THREAT_VALUE if s in (KILL, HARM) else 0.0) for s, ws in self.seeds.items() for w in ws}
        self.words |= {w: (INSULT, v) for w, v in self.insults.items() if not w.endswith("*")}
        self.stems = {w[:-1]: v for w, v in self.insults.items() if w.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)

    def symbol(self, word: str) -> tuple[str, float]:
        found = self.words.get(word)
        if found is None:
            for n in self.lengths:
                if (value := self.stems.get(word[:n])) is not None:
                    return INSULT, value
            return WORD, 0.0
        return found

    def triggers(self) -> list[str]:
        """What a text has to hold, as a word or the beginning of one, to have a matched clause."""
        return [w for w, (s, _) in self.words.items() if s in (INSULT, KILL, HARM)] + list(self.stems)


def clause_scores(text: str, lexicon: Lexicon, machines: tuple[Table, Table]) -> tuple[list[tuple[int, int, float]], int]:
    """(start, end, score) of the clauses that score, and the number of words of the text."""
    backward, forward = machines
    found, n_words, begin = [], 0, 0
    lowered = text.lower().replace("’", "'")
    for end, after in [*((m.start(), m.end()) for m in _CLAUSES.finditer(lowered)), (len(lowered), len(lowered))]:
        symbols = [lexicon.symbol(m.group()) for m in _WORDS.finditer(lowered, begin, end)]
        n_words += len(symbols)
        if any(symbol in WEIGHTED for symbol, _ in symbols):
            state, marked = "0", []
            for symbol, value in reversed(symbols):
                state, out, weight = backward[state, symbol]
                marked.append((out, weight * value))
            state, score = "0", 0.0
            for symbol, value in reversed(marked):
                state, out, weight = forward[state, symbol]
                if out in (INSULT, THREAT):
                    score += weight * value
            if score > 0:
                found.append((begin, end, score))
        begin = after
    return found, n_words


def _features(scores: list[float], n_words: int) -> list[float]:
    total = sum(scores)
    return [np.log1p(total), max(scores, default=0.0), np.log1p(100 * total / max(n_words, 1)), np.log1p(len(scores)), float(total > 0)]


class Scorer:
    """Features of whole texts; texts without any trigger are not read word by word."""

    def __init__(self, lexicon: Lexicon) -> None:
        import ahocorasick

        self.lexicon, self.machines = lexicon, grammar()
        self.automaton = ahocorasick.Automaton()
        for term in lexicon.triggers():
            self.automaton.add_word(term, term)
        if lexicon.triggers():
            self.automaton.make_automaton()

    def _holds_trigger(self, lowered: str) -> bool:
        """Whether a trigger stands at the beginning of a word."""
        return any(end < len(term) or not lowered[end - len(term)].isalnum() for end, term in self.automaton.iter(lowered))

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), 5))
        if not len(self.automaton):
            return out
        for row, text in enumerate(texts):
            if text and self._holds_trigger(text.lower()):
                found, n_words = clause_scores(text, self.lexicon, self.machines)
                if found:
                    out[row] = _features([f[2] for f in found], n_words)
        return out


@dataclass
class Model:
    insults: dict[str, float]
    beta: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        """From 0 to 1; rows without a matched clause stay below one half."""
        scores = sigmoid(decision(features, self.beta))
        return np.where(features[:, -1] > 0, scores, np.minimum(scores, UNMATCHED))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn the lexicon and the weights from labelled documents (``labels``: ``doc_id, toxic``).

    Uses at most ``train_rows`` labelled rows; rows with null ids, labels or texts are left out, and of near copies
    (equal smallest shingles in two orders) with one label that with the smallest id counts. The same table gives the same
    model in any partitioning. Without a row of both labels nothing is toxic.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    # At most train_rows narrow rows are sent to every task.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [f"{s[0]:x} {mix(s).min():x}" if len(s) else "" for _, s in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.string())], ["doc_id", "toxic", "text", "low"])

    sketched = rows.mapInArrow(firsts, "doc_id long, toxic int, text string, low string")
    first = sketched.groupBy("low", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("row"))
    rows = materialize(first.select("row.doc_id", "toxic", "row.text"), "train")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model({}, np.array([0.0] * 5 + [-5.0]))
    known = _term_counts(rows.where("toxic = 1"), None).where(F.col("n") >= LEAST_TEXTS)  # no more than the labelled texts hold
    positive = {r["term"]: r["n"] for r in known.collect()}
    negative = {r["term"]: r["n"] for r in _term_counts(rows.where("toxic = 0"), frozenset(positive)).collect()}
    insults = choose_terms(positive, negative, totals[1], totals[0])
    scorer = _scorer_features(insults)
    sample = rows.mapInArrow(scorer, "doc_id long, toxic int, f array<double>").toPandas().sort_values("doc_id")
    x, y = np.stack(sample["f"].to_numpy()), sample["toxic"].to_numpy(dtype=float)
    return Model(insults, fit_logistic(x, y, ridge=1.0))


def _terms(text: str) -> set[str]:
    words = set(_WORDS.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEM_LENGTHS if len(w) >= n}


def _term_counts(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """``term, n``: texts that hold a word or a stem, counted within the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                terms = _terms(text)
                counts.update(terms if only is None else terms & only)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def choose_terms(positive: dict[str, int], negative: dict[str, int], n_pos: int, n_neg: int) -> dict[str, float]:
    """Terms far more common in toxic texts, without terms that contain one another; weights are log odds."""
    ranked = []
    for term, p in positive.items():
        n = negative.get(term, 0)
        rate_p, rate_n = p / n_pos, n / n_neg
        both = (p + n) / (n_pos + n_neg)
        z = (rate_p - rate_n) / np.sqrt(max(both * (1 - both), 1e-9) * (1 / n_pos + 1 / n_neg))
        odds = np.log((p + 0.5) / (n_pos + 1)) - np.log((n + 0.5) / (n_neg + 1))
        if z >= 6 and odds >= 1.5:
            whole = not term.endswith("*")
            ranked.append((round(float(z), 6), len(term) + whole, term, float(odds)))
    chosen: dict[str, float] = {}
    roots: list[str] = []
    for _, _, term, odds in sorted(ranked, key=lambda r: (-r[0], -r[1], r[2])):
        root = term.rstrip("*")
        if not any(root.startswith(r) or r.startswith(root) for r in roots):
            chosen[term] = odds
            roots.append(root)
    return chosen


def _scorer_features(insults: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(insults))
        for batch in batches:
            x = scorer.features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "toxic", "f"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row of ``docs`` (``doc_id long, text``).

    Null and empty texts, and texts without a matched clause, get the score of a text without matches, below one half. Repeated
    rows are scored alike; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(model.insults))
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for a in range(0, batch.num_rows, 500):
                part = batch.column("text").slice(a, 500).to_pylist()
                scores[a : a + len(part)] = model.score(scorer.features(part))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, in all their columns. Rows are decided where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(model.insults))
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                rows = batch.slice(a, 500)
                scores = model.score(scorer.features(rows.column("text").cast(pa.string()).to_pylist()))
                yield rows.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)


def matched_clauses(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, start, end, score`` of every matched clause, in code points of the lower-cased text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(model.insults))
        for batch in batches:
            rows = [
                (i, *clause)
                for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                if text
                for clause in clause_scores(text, scorer.lexicon, scorer.machines)[0]
            ]
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["doc_id", "start", "end", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, start int, end int, score double")


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves no rest when divided by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
