"""Quality score by a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gablework.llm.common import settled, text_or_empty, trimmed, words_of
from gablework.llm.training import fold, labelled_sample, logistic

#: Labelled documents to learn from, at most; buckets of words; factors of an interaction.
SAMPLE, BUCKETS, FACTORS = 6000, 1 << 14, 8
#: Passes, documents per step, step size, decay, spread of the first factors.
PASSES, STEP, RATE, DECAY, SPREAD, SEED = 12, 64, 0.02, 1e-4, 0.05, 7
#: Score from which a text counts as good.
THRESHOLD = 0.3

#: Measures computed by Spark; three more come from the words' hashes.
MEASURES = ("log_chars", "log_words", "word_chars", "symbols", "marks", "upper", "digits", "line_words", "dup_lines", "stored_chars")
COUNTED = ("distinct", "commonest", "doubled")


def _share(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom)


def _count(name: str, characters: str) -> Column:
    """How often any of the given characters occurs."""
    left = F.col(name)
    for c in characters:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.length(name) - F.length(left)


def _inputs(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, words, measures): hashes of the words, and structure and metadata of every whole text."""
    stored = F.coalesce(F.col("n_chars").cast("double"), F.length("__body")) if "n_chars" in docs.columns else F.length("__body")
    lines = F.filter(F.split("__body", "\n"), lambda x: trimmed(x) != "")
    rows = docs.withColumn("__body", text_or_empty(text))
    # Arrays that several measures read are split once; single characters are counted by plain replacement.
    rows = settled(
        rows.select("doc_id", "__body", stored.cast("double").alias("stored")),
        words=F.transform(words_of(F.col("__body")), lambda w: F.xxhash64(F.lower(w))),
        lines=lines,
        chars=F.length("__body") - _count("__body", " \t\n\x0b\f\r"),
    )
    n, n_lines, chars = F.size("words"), F.size("lines"), F.col("chars")
    upper = F.length(F.regexp_replace("__body", r"[^\p{Lu}]+", ""))
    measures = [
        F.log1p(F.length("__body")),
        F.log1p(n),
        F.least(_share(chars, n), F.lit(30.0)),
        F.least(_share(_count("__body", "#*$%&|<>"), n), F.lit(3.0)),
        F.least(_share(_count("__body", "!?"), n), F.lit(3.0)),
        _share(upper, chars),
        _share(_count("__body", "0123456789"), chars),
        F.log1p(_share(n, n_lines)),
        _share(n_lines - F.size(F.array_distinct("lines")), n_lines),
        F.log1p("stored"),
    ]
    return rows.select("doc_id", "words", F.array(*[m.cast("double") for m in measures]).alias("measures"))


def _counted(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, times) of the distinct word buckets of each row, and per row the measures of the hashes."""
    n = len(lists)
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    words = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
    bucket = words % np.uint64(BUCKETS)
    twin = np.flatnonzero((words[1:] == words[:-1]) & (row[1:] == row[:-1]))
    doubled = np.bincount(row[twin], minlength=n)
    code, times = np.unique(row * BUCKETS + bucket.astype(np.int64), return_counts=True)
    row, bucket = code // BUCKETS, code % BUCKETS
    most = np.zeros(n)
    np.maximum.at(most, row, times)
    whole = np.maximum(sizes, 1)
    return row, bucket, times, np.stack([np.bincount(row, minlength=n) / np.sqrt(whole), most / whole, doubled / whole], axis=1)


@dataclass
class Entries:
    """Sparse inputs of some rows: each row has all the dense measures and its words, in row order."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(lists: pa.ListArray, measures: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> "Entries":
        row, bucket, times, counted = _counted(lists)
        dense = np.clip((np.hstack([measures, counted]) - centre) / scale, -4, 4) / 2
        n, k = dense.shape
        # Words have unit length together, so that a long text weighs as much as a short one.
        value = np.sqrt(times)
        norm = np.sqrt(np.bincount(row, weights=times.astype(float), minlength=n))
        rows = np.concatenate([np.repeat(np.arange(n), k), row])
        order = np.argsort(rows, kind="stable")
        index = np.concatenate([np.tile(BUCKETS + np.arange(k), n), bucket])[order]
        values = np.concatenate([dense.ravel(), value / np.maximum(norm[row], 1)])[order]
        counts = np.bincount(rows, minlength=n)
        return Entries(np.cumsum(counts) - counts, index, values)

    def rows(self, chosen: np.ndarray) -> "Entries":
        ends = np.append(self.start[1:], len(self.index))[chosen]
        counts = ends - self.start[chosen]
        start = np.cumsum(counts) - counts
        at = np.repeat(self.start[chosen] - start, counts) + np.arange(counts.sum())
        return Entries(start, self.index[at], self.value[at])


@dataclass
class Machine:
    """bias + w.x + half the sum over factors of (v.x)^2 - (v^2).(x^2): linear in the inputs present."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def raw(self, x: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = self.v[x.index] * x.value[:, None]
        sums = np.add.reduceat(parts, x.start, axis=0)
        squares = np.add.reduceat(parts * parts, x.start, axis=0)
        linear = np.add.reduceat(self.w[x.index] * x.value, x.start)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, parts

    def score(self, lists: pa.ListArray, measures: np.ndarray) -> np.ndarray:
        if not len(measures):
            return np.zeros(0)
        return logistic(self.raw(Entries.of(lists, measures, self.centre, self.scale))[0])


def fit_machine(lists: pa.ListArray, measures: np.ndarray, labels: np.ndarray) -> Machine:
    """Adagrad on the logistic loss, in a fixed order."""
    counted = _counted(lists)[3]
    dense = np.hstack([measures, counted])
    centre, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-6
    x = Entries.of(lists, measures, centre, scale)
    rng = np.random.default_rng(SEED)
    size = BUCKETS + dense.shape[1]
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, SPREAD, (size, FACTORS)), centre, scale)
    seen_w, seen_v, seen_bias = np.full(size, 1e-4), np.full((size, FACTORS), 1e-4), 1e-4
    for _ in range(PASSES):
        shuffled = rng.permutation(len(labels))
        for i in range(0, len(labels), STEP):
            chosen = shuffled[i : i + STEP]
            part = x.rows(chosen)
            raw, sums, parts = machine.raw(part)
            slope = (logistic(raw) - labels[chosen]) / len(chosen)
            row = np.repeat(np.arange(len(chosen)), np.diff(np.append(part.start, len(part.index))))
            each = slope[row] * part.value
            touched, where = np.unique(part.index, return_inverse=True)
            dw = np.bincount(where, weights=each, minlength=len(touched)) + DECAY * machine.w[touched]
            pull = each[:, None] * (sums[row] - parts)
            dv = np.zeros((len(touched), FACTORS))
            np.add.at(dv, where, pull)
            dv += DECAY * machine.v[touched]
            seen_w[touched] += dw * dw
            seen_v[touched] += dv * dv
            seen_bias += slope.sum() ** 2
            machine.w[touched] -= 5 * RATE * dw / np.sqrt(seen_w[touched])
            machine.v[touched] -= RATE * dv / np.sqrt(seen_v[touched])
            machine.bias -= RATE * slope.sum() / np.sqrt(seen_bias)
    return machine


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", bound: int = SAMPLE) -> Machine:
    """Learn from at most ``bound`` labelled documents outside the held-out fifth.

    Their inputs, not their texts, are fetched.  Without both labels the score is
    the share of label 1; without any label it is one half.
    """
    more = ["n_chars"] if "n_chars" in docs.columns else []
    sample = labelled_sample(docs, labels, "quality", fold(5) != 0, bound, text, *more)
    rows = _inputs(sample, "text").join(sample.select("doc_id", "__label"), "doc_id").orderBy("doc_id")
    fetched = rows.select("words", "measures", "__label").toArrow().combine_chunks()
    size = BUCKETS + len(MEASURES) + len(COUNTED)
    y = fetched.column("__label").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        dense = len(MEASURES) + len(COUNTED)
        return Machine(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, FACTORS)), np.zeros(dense), np.ones(dense))
    words = fetched.column("words").combine_chunks()
    words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
    measures = np.stack(fetched.column("measures").to_pandas().to_numpy())
    return fit_machine(words, measures, y)


def scores(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text, from 0 to 1.

    A null or empty text is scored from its measures alone, all zero.  Rows are
    scored one by one: ties and repeated rows score alike, other columns than
    the text and n_chars are ignored, no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            measures = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(MEASURES))
            found = machine.score(batch.column(1), measures)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return _inputs(docs, text).mapInArrow(task, f"doc_id {kind}, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = scores(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
