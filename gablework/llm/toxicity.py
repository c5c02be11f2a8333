"""Toxicity by a weighted grammar of finite-state transducers over clauses."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gablework.llm.common import settled, text_or_empty
from gablework.llm.training import fit_logistic, fold, labelled_sample, logistic
from gablework.session import stage

#: Labelled documents to learn from, at most.
SAMPLE = 6000
#: A stem counts from so many words of toxic documents and so much surely exceeded log odds on.
LEAST_WORDS, LEAST_ODDS = 4, 1.6
#: Letters of a stem; whole words are kept apart by a leading "=".
STEM = (3, 8)
#: Words added to a text's own, so that a single match in a short one says little.
EVEN = 20
#: Words a task remembers.
REMEMBERED = 300_000

TOKEN = re.compile(r"[^\W_]+|[.,;:!?\n]")

# Word lists of the small transducers, in four languages; verbs by their infinitives,
# under the ending that inflected forms replace.
THREATS = {
    "": "kill hurt destroy murder attack stab shoot".split(),
    "er": "tuer frapper".split(),
    "en": "töten umbringen schlagen".split(),
    "ar": "matar golpear".split(),
}
INFLECTIONS = {
    "er": "er e es ons ez ent é ée és erai eras era erons erez eront ais ait aient ant".split(),
    "en": "en e st est t et te test ten tet ete etest eten etet end".split(),
    "ar": "ar o as a amos áis an é ó aste aron aré arás ará aremos arán aría ando ado".split(),
    "": " s es ed ing".split(" "),
}
TARGETS = "you your yours he she they them tu toi vous du dich ihr euch tú usted ustedes vosotros".split()
NEGATIONS = "not never neither nor without cannot jamais nicht kein keine niemals nunca jamás tampoco".split()
REPORTS = "said says wrote quoted claimed reported dit écrit sagte schrieb behauptete dijo escribió".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BOUNDARY = range(7)

#: Words a negation reaches; what negation, report and target do to a clause; weight of a threat at a target.
SCOPE, NEGATED, REPORTED, TARGETED, THREATENED = 3, 0.5, 0.6, 1.25, 4.0


def inflected(verb: str, ending: str) -> set[str]:
    """The forms of a regular verb; without an ending to replace, also those that double its last letter."""
    stem = verb.removesuffix(ending)
    forms = {stem + e for e in INFLECTIONS[ending]}
    return forms if ending else forms | {stem + stem[-1] + e for e in ("ed", "ing")}


@dataclass(frozen=True)
class Transducer:
    """States 0 to n - 1, from 0.

    ``step``: next state, factor of what the word read weighs, and a weight that the
    composition adds at that word, before the factors.  ``final``: factor of the clause.
    """

    states: int
    step: dict[tuple[int, int], tuple[int, float, float]]
    final: dict[int, float]

    def move(self, state: int, symbol: int) -> tuple[int, float, float]:
        return self.step.get((state, symbol), (state, 1.0, 0.0))

    def end(self, state: int) -> float:
        return self.final.get(state, 1.0)


def negation() -> Transducer:
    """Insults, and threats completed, within a few words after a negation count less."""
    step = {}
    for left in range(SCOPE + 1):
        for symbol in (OTHER, INSULT, THREAT, TARGET, REPORT):
            step[left, symbol] = (max(0, left - 1), NEGATED if left else 1.0, 0.0)
        step[left, NEGATION] = (SCOPE, 1.0, 0.0)
    return Transducer(SCOPE + 1, step, {})


def report() -> Transducer:
    """A clause with a verb of speech counts less."""
    return Transducer(2, {(0, REPORT): (1, 1.0, 0.0)}, {1: REPORTED})


def target() -> Transducer:
    """A clause that addresses someone counts more."""
    return Transducer(2, {(0, TARGET): (1, 1.0, 0.0)}, {1: TARGETED})


def threat() -> Transducer:
    """The word that completes a threat and its target, in either order, adds a weight: once in a clause."""
    step = {(0, THREAT): (1, 1.0, 0.0), (0, TARGET): (2, 1.0, 0.0), (1, TARGET): (3, 1.0, THREATENED), (2, THREAT): (3, 1.0, THREATENED)}
    return Transducer(4, step, {})


def insult() -> Transducer:
    """A second insult in a row counts as one phrase: a little more than a single one."""
    step = {(0, INSULT): (1, 1.0, 0.0), (1, INSULT): (1, 1.2, 0.0)}
    step |= {(1, symbol): (0, 1.0, 0.0) for symbol in (OTHER, THREAT, TARGET, NEGATION, REPORT)}
    return Transducer(2, step, {})


class Grammar:
    """The composition of transducers as tables: one state for each tuple of states reached."""

    def __init__(self, parts: tuple[Transducer, ...]):
        tuples = list(product(*[range(p.states) for p in parts]))
        number = {t: i for i, t in enumerate(tuples)}
        self.next = np.zeros((len(tuples), BOUNDARY), dtype=int)
        self.factor, self.added = np.ones((len(tuples), BOUNDARY)), np.zeros((len(tuples), BOUNDARY))
        self.final = []
        for t, i in number.items():
            for symbol in range(BOUNDARY):
                moves = [p.move(s, symbol) for p, s in zip(parts, t)]
                self.next[i, symbol] = number[tuple(m[0] for m in moves)]
                self.factor[i, symbol] = np.prod([m[1] for m in moves])
                self.added[i, symbol] = sum(m[2] for m in moves)
            self.final.append(float(np.prod([p.end(s) for p, s in zip(parts, t)])))
        self.next, self.factor, self.added = self.next.tolist(), self.factor.tolist(), self.added.tolist()

    def clause(self, symbols: list[int], weights: list[float]) -> float:
        """The weight that the grammar gives a clause."""
        state, total = 0, 0.0
        for symbol, weight in zip(symbols, weights):
            total += (weight + self.added[state][symbol]) * self.factor[state][symbol]
            state = self.next[state][symbol]
        return total * self.final[state]


class Scorer:
    """Features of a text from the weights of its matched clauses."""

    NAMES = ("per_word", "per_clause", "most", "matched_share", "log_total", "log_matched", "log_words")

    def __init__(self, lexicon: dict[str, float], remembered: int = REMEMBERED):
        self.lexicon, self.remembered = lexicon, remembered
        self.grammar = Grammar((negation(), report(), target(), threat(), insult()))
        self.fixed = {w: (s, 0.0) for s, words in ((THREAT, [f for e, verbs in THREATS.items() for v in verbs for f in inflected(v, e)]), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
        self.fixed |= {c: (BOUNDARY, 0.0) for c in ".,;:!?\n"}
        self.known: dict[str, tuple[int, float]] = dict(self.fixed)

    def _class_of(self, word: str) -> tuple[int, float]:
        low, high = STEM
        stems = ["=" + word, *(word[:k] for k in range(low, min(high, len(word) - 1) + 1))]
        weight = max((self.lexicon.get(s, 0.0) for s in stems), default=0.0)
        return (INSULT, weight) if weight > 0 else (OTHER, 0.0)

    def features(self, text: str) -> list[float]:
        tokens = TOKEN.findall(text.lower())
        if len(self.known) > self.remembered:
            self.known = dict(self.fixed)
        known = self.known
        for word in set(tokens).difference(known):
            known[word] = self._class_of(word)
        classes = list(map(known.__getitem__, tokens))
        symbols = [c[0] for c in classes]
        n_words = len(symbols) - symbols.count(BOUNDARY)
        found: list[float] = []
        clauses = 1
        if INSULT in symbols or THREAT in symbols:
            start = 0
            for i, symbol in enumerate([*symbols, BOUNDARY]):
                if symbol != BOUNDARY:
                    continue
                part = symbols[start:i]
                clauses += bool(part)
                if INSULT in part or THREAT in part:
                    found.append(self.grammar.clause(part, [c[1] for c in classes[start:i]]))
                start = i + 1
        total = sum(found)
        matched = sum(1 for x in found if x > 0)
        words = max(1, n_words)
        return [
            min(2.0, 10 * total / (words + EVEN)),
            min(10.0, total / clauses),
            min(10.0, max(found, default=0.0)),
            matched / clauses,
            float(np.log1p(total)),
            float(np.log1p(matched)),
            float(np.log1p(words)),
        ]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]

    def score(self, features: np.ndarray) -> np.ndarray:
        return logistic(features @ np.array(self.weights[:-1]) + self.weights[-1])


def _stem_counts(sample: DataFrame):
    """For each stem and half the words in toxic documents, and in all, that have it.

    A word counts once for each word that it follows, so that copies of a
    document, and repeated words or lines, are no more evidence than a single
    one.  The stem "" counts all words.
    """
    words = F.filter(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    rows = settled(sample.select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"), "__label", "text"), words=words)
    follows = F.transform("words", lambda w, i: F.struct(F.get("words", i - 1).alias("before"), w.alias("word")))
    places = rows.select("half", "__label", F.inline(follows)).distinct()
    counts = places.groupBy("half", "__label", "word").agg(F.count(F.lit(1)).alias("n"))
    low, high = STEM
    stems = F.concat(
        F.array(F.lit(""), F.concat(F.lit("="), "word")),
        F.transform(
            F.filter(F.array(*[F.lit(k) for k in range(low, high + 1)]), lambda k: k < F.length("word")), lambda k: F.substring("word", F.lit(1), k)
        ),
    )
    rows = counts.select("half", "__label", "n", F.explode(stems).alias("stem"))
    toxic = [F.sum(F.when(F.col("half") == h, F.col("__label") * F.col("n")).otherwise(0)).alias(f"t{h}") for h in (0, 1)]
    every = [F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)]
    counted = stage(rows.groupBy("stem").agg(*toxic, *every).where(F.col("t0") + F.col("t1") >= LEAST_WORDS), "stems")
    every_word = counted.where("stem = ''").first()
    if every_word is None:
        return counted.limit(0).toPandas()
    # Only stems that some choice of halves could take leave the cluster: _lexicon passes over all others.
    could = F.col("stem") == ""
    for halves in ((0,), (1,), (0, 1)):
        t, n = (sum((F.col(f"{x}{h}") for h in halves), F.lit(0)) for x in "tn")
        all_t, all_n = (sum(every_word[f"{x}{h}"] for h in halves) for x in "tn")
        ratio = F.log((t + 0.5) / (n - t + 0.5)) - float(np.log((all_t + 1) / (all_n - all_t + 1)))
        surely = ratio - 2 * F.sqrt(1 / (t + 0.5) + 1 / (n - t + 0.5))
        could = could | ((t >= LEAST_WORDS) & (surely >= LEAST_ODDS - 1e-9))
    return counted.where(could).toPandas()


def _lexicon(stems, halves: tuple[int, ...]) -> dict[str, float]:
    """Stems by the log ratio of their rates among words of toxic and of other documents.

    The ratio must be high by two standard errors too.  Longer stems are taken
    first, and a shorter one must also hold without their words: neither
    a chance word nor the short beginning it shares with an insult counts.
    """
    t = sum(stems[f"t{h}"] for h in halves).to_numpy(dtype=float)
    n = sum(stems[f"n{h}"] for h in halves).to_numpy(dtype=float)
    counts = {s: (toxic, every) for s, toxic, every in zip(stems["stem"], t, n)}
    if "" not in counts:
        return {}
    all_toxic, all_words = counts.pop("")
    base = np.log((all_toxic + 1) / (all_words - all_toxic + 1))

    def odds(toxic: float, every: float) -> tuple[float, float]:
        clean = every - toxic
        ratio = float(np.log((toxic + 0.5) / (clean + 0.5)) - base)
        return ratio, ratio - 2 * float(np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)))

    left, found = dict(counts), {}
    for stem in sorted(counts, key=lambda s: (not s.startswith("="), -len(s), s)):
        ratio, surely = odds(*counts[stem])
        toxic, every = left[stem]
        if counts[stem][0] < LEAST_WORDS or surely < LEAST_ODDS or (every >= LEAST_WORDS and odds(toxic, every)[0] < LEAST_ODDS):
            continue
        found[stem] = ratio
        word = stem.removeprefix("=")
        for k in range(STEM[0], min(STEM[1] + 1, len(word))):
            if word[:k] in left:
                left[word[:k]] = (left[word[:k]][0] - toxic, left[word[:k]][1] - every)
    return found


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", bound: int = SAMPLE) -> Model:
    """Learn the lexicon of insults and the weights of the features.

    At most ``bound`` labelled documents outside the held-out third are used.
    Features for the fit come from a lexicon learned on the other half of them.
    Without both labels the score is the share of toxic ones.
    """
    sample = labelled_sample(docs, labels, "toxic", fold(3) != 1, bound, text)
    rows = sample.select("doc_id", "__label", "text", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"))
    size = {(r["half"], r["__label"]): r["n"] for r in rows.groupBy("half", "__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = [size.get((h, 1), 0) for h in (0, 1)]
    clean = [size.get((h, 0), 0) for h in (0, 1)]
    if not sum(toxic) or not sum(clean):
        share = sum(toxic) / max(1, sum(toxic) + sum(clean))
        bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return Model({}, (0.0,) * len(Scorer.NAMES) + (bias,))
    stems = _stem_counts(sample)
    lexicons = [_lexicon(stems, (1 - h,)) for h in (0, 1)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(x) for x in lexicons]
        for batch in batches:
            found = [scorers[h].features(t) for h, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["label", "x"])

    seen = rows.select("__label", "half", "text").mapInArrow(task, "label int, x array<double>").toPandas()
    weights = fit_logistic(np.stack(seen["x"].to_numpy()), seen["label"].to_numpy(dtype=float), ridge=0.3)
    return Model(_lexicon(stems, (0, 1)), tuple(weights.tolist()))


def scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``__toxicity`` from 0 to 1 for every whole text.

    A null or empty text has no clauses; its score is that of a text without
    matches.  Rows are scored one by one, so ties and repeated rows score
    alike; an empty table gives an empty result.  A very long text is one row
    of work: its words are held once, its clauses one at a time.
    """
    lexicon, weights = model.lexicon, model

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            x = np.array([scorer.features(t or "") for t in batch.column(at).to_pylist()]).reshape(-1, len(Scorer.NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights.score(x), pa.float64())], names=[*batch.schema.names, "__toxicity"])

    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("__toxicity", T.DoubleType())])
    return docs.mapInArrow(task, schema)


#: Score from which a text counts as toxic.
THRESHOLD = 0.7


def keep_clean(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows below the threshold; all columns as they were."""
    model = fit(docs, labels, text)
    return scores(docs, model, text).where(F.col("__toxicity") < THRESHOLD).select(*docs.columns)


def report_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    scored = scores(docs.select("doc_id", text_or_empty().alias("text")), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
        F.col("__toxicity").alias("score"),
        (F.col("__toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
