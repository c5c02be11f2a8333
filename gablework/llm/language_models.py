"""Language identification by interpolated Kneser-Ney models of characters.

A text is its lower-case letters with one space between runs.  Runs of four
characters are counted exactly, over all texts to learn from; lower orders count
in how many ways a run continues to the left, which the table of runs of four gives.
The models reach the workers as arrays of sorted hashes.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from gablework.llm.chunks import before_and_total, gathered, spans
from gablework.llm.common import held, text_or_empty
from gablework.llm.training import fold
from gablework.session import stage

#: Characters in a run; four of 16 bits fill a 64-bit number.
ORDER = 4
#: Bits of a hash: at most so many cells for each order of all languages' runs, and of their contexts.
BITS = 22
#: One of so many texts to learn from is kept for calibration, of languages with four times that many
#: texts at least; its runs are counted in the final models all the same.
KEPT = 16
#: Relative accuracy of the quantiles of calibration is one part in so many.
ACCURACY = 100_000
#: Share of a language's own texts that may be rejected.
REJECTED = 0.002
#: Runs whose scores a worker remembers.
REMEMBERED = 1 << 19
SPACE, UNKNOWN = 0x20, "und"


@cache
def _inner() -> np.ndarray:
    """For each 16-bit character whether it belongs to a word: letters and the marks on them."""
    return np.array([chr(i).isalpha() or unicodedata.category(chr(i))[0] == "M" for i in range(1 << 16)])


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): a run of four for every character after the opening spaces of each text, and
    where each text's runs start.

    A text without a letter has none.
    """
    padded = pc.binary_join_element_wise("   ", pc.utf8_lower(texts), " ", "")
    lengths = pc.utf8_length(padded).to_numpy().astype(np.int64)
    _, offsets, data = padded.buffers()
    ends = np.frombuffer(offsets, dtype="<i4")[padded.offset : padded.offset + len(padded) + 1]
    raw = bytes(data.slice(int(ends[0]), int(ends[-1] - ends[0]))) if len(padded) else b""
    points = np.frombuffer(raw.decode().encode("utf-32-le"), dtype="<u4")
    first = before_and_total(lengths)
    chars = np.minimum(points, 0xFFFF).astype(np.uint16)
    inner = _inner()[chars]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        inner[far] = [chr(p).isalpha() for p in points[far].tolist()]
        # Letters of the far planes share the private cells.
        chars[far] = 0xE000 + points[far] % 0x1900
    chars[~inner] = SPACE
    kept = inner.copy()
    kept[1:] |= inner[:-1]
    opening = spans(first[:-1], np.minimum(lengths, ORDER - 1))
    kept[opening] = True
    place = before_and_total(kept)
    starts = place[first]
    chars = chars[kept].astype(np.uint64)
    if len(chars) < ORDER:
        return np.zeros(0, dtype=np.int64), np.zeros(len(lengths) + 1, dtype=np.int64)
    keys = chars[3:] | chars[2:-1] << np.uint64(16) | chars[1:-2] << np.uint64(32) | chars[:-3] << np.uint64(48)
    # Runs that would reach into the next text begin at its opening; they end in its first three characters.
    counts = np.diff(starts) - (ORDER - 1)
    marks = np.add.reduceat(inner, first[:-1]) > 0 if len(lengths) else np.zeros(0, dtype=bool)
    counts = np.where(marks, counts, 0)
    return keys[spans(starts[:-1], counts)].view(np.int64), before_and_total(counts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


def counted(rows: DataFrame) -> DataFrame:
    """(lang, key, n): how often each language has each run of four, over all rows of (lang, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}

        def out(lang: str) -> pa.RecordBatch:
            keys, n = _merged(waiting.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], names=["lang", "key", "n"])

        for batch in gathered(batches, 1):
            names = batch.column(0).dictionary_encode()
            which = names.indices.to_numpy()
            for i, lang in enumerate(names.dictionary.to_pylist()):
                keys, _ = runs(batch.column(1).filter(pa.array(which == i)))
                waiting.setdefault(lang, []).append(np.unique(keys, return_counts=True))
                if len(waiting[lang]) == 16:
                    yield out(lang)
        for lang in list(waiting):
            yield out(lang)

    return rows.select("lang", "text").mapInArrow(task, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def estimates(counts: DataFrame) -> DataFrame:
    """(code, lang, key, v): per order 1 to 4 the discounted share of each run after its context
    (code: the order) and the weight of the next lower order in each context (code: the order and 4).
    """
    grams = [counts.select(F.lit(ORDER).alias("order"), "lang", "key", F.col("n").alias("c"))]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1))
        grams.append(
            grams[-1].groupBy("lang", shorter.alias("key")).agg(F.count(F.lit(1)).alias("c")).select(F.lit(order).alias("order"), "lang", "key", "c")
        )
    table = grams[0]
    for other in grams[1:]:
        table = table.unionByName(other)
    table = stage(table.withColumn("context", F.shiftrightunsigned("key", 16)), "runs")
    ones, twos = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    # One row per language and order.
    discounts = table.groupBy("order", "lang").agg(F.when(ones > 0, ones / (ones + 2 * twos)).otherwise(F.lit(0.5)).alias("d"))
    within = Window.partitionBy("order", "lang", "context")
    shares = table.join(F.broadcast(discounts), ["order", "lang"]).withColumns(
        {"total": F.sum("c").over(within), "kinds": F.count(F.lit(1)).over(within), "at": F.row_number().over(within.orderBy("key"))}
    )
    # The discount of a lone run is at most its count, so no share is negative.
    share = F.struct(F.col("order").alias("code"), F.col("key").alias("key"), ((F.col("c") - F.col("d")) / F.col("total")).alias("v"))
    weight = F.struct(
        (F.col("order") + ORDER).alias("code"), F.col("context").alias("key"), (F.col("d") * F.col("kinds") / F.col("total")).alias("v")
    )
    both = F.when(F.col("at") == 1, F.array(share, weight)).otherwise(F.array(share))
    return shares.select("lang", F.inline(both))


def cells(code: np.ndarray | int, lang: int | np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """The hash of a run (or a context) of a language in its table."""
    salt = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + (np.uint64(8) * np.asarray(lang, dtype=np.uint64) + np.asarray(code, dtype=np.uint64)) * salt
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
        return (x ^ x >> np.uint64(31)) >> np.uint64(64 - bits)


@dataclass
class Models:
    """Languages in order of name; for each code the sorted hashes and their values."""

    languages: list[str]
    uniform: float
    bits: int
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    values: dict[int, np.ndarray] = field(default_factory=dict)
    temperature: float = 1.0
    #: Per language: usual bits a character, their spread, and the limit in units of it.
    usual: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _found(self, code: int, lang: int, keys: np.ndarray, otherwise: float) -> np.ndarray:
        hashes = self.hashes.get(code)
        if hashes is None or not len(hashes):
            return np.full(len(keys), otherwise)
        wanted = cells(code, lang, keys, self.bits)
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        return np.where(hashes[at] == wanted, self.values[code][at], otherwise)

    def bits_of(self, keys: np.ndarray) -> np.ndarray:
        """Bits of each run's last character after the others: a row per run, a column per language."""
        out = np.empty((len(keys), len(self.languages)))
        unsigned = keys.view(np.uint64)
        for lang in range(len(self.languages)):
            p = np.full(len(keys), self.uniform)
            for order in range(1, ORDER + 1):
                run = unsigned & np.uint64((1 << 16 * order) - 1)
                # A context never met leaves all to the lower order.
                p = self._found(order, lang, run, 0.0) + self._found(ORDER + order, lang, run >> np.uint64(16), 1.0) * p
            out[:, lang] = -np.log2(np.minimum(p, 1.0))
        return out


class Scorer:
    """Cross-entropies of texts; the bits of a run are worked out once while remembered."""

    def __init__(self, models: Models, remembered: int = REMEMBERED):
        self.models, self.remembered = models, remembered
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.int64)
        self.bits = np.zeros((0, len(self.models.languages)))

    def _bits(self, keys: np.ndarray) -> np.ndarray:
        """Bits of distinct runs in rising order."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        if known.all() and len(keys):
            return self.bits[at]
        new = keys[~known]
        found = self.models.bits_of(new)
        out = np.empty((len(keys), found.shape[1]))
        out[known], out[~known] = self.bits[at[known]], found
        if len(self.keys) + len(new) > self.remembered:
            self._forget()
            if len(keys) <= self.remembered:
                self.keys, self.bits = keys, out
        else:
            self.keys, self.bits = np.insert(self.keys, at[~known], new), np.insert(self.bits, at[~known], found, axis=0)
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Characters scored in each text, and bits a character under each language (0 without any)."""
        keys, first = runs(texts)
        coded = pa.array(keys).dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        order = np.argsort(distinct)
        bits = np.empty((len(distinct), len(self.models.languages)))
        bits[order] = self._bits(distinct[order])
        n = np.diff(first)
        some = n > 0
        sums = np.zeros((len(n), bits.shape[1]))
        if some.any():
            for lang in range(bits.shape[1]):
                sums[some, lang] = np.add.reduceat(bits[:, lang].copy()[which], first[:-1][some])
        return n, sums / np.maximum(n, 1)[:, None]


def _calibrated(models: Models, seen: DataFrame) -> None:
    """Set temperature and limits from all kept texts' (lang, n, entropy) under models that did not see them."""
    size = len(models.languages)
    models.usual, models.spread, models.limit = np.zeros(size), np.ones(size), np.full(size, np.inf)
    names = F.array(*[F.lit(x) for x in models.languages])
    texts = seen.where((F.col("n") > 0) & F.array_contains(names, F.col("lang"))).select(
        "n", "entropy", F.array_position(names, F.col("lang")).cast("int").alias("own")
    )
    texts = texts.withColumn("bits", F.element_at("entropy", F.col("own")))
    steps = [2.0**-k for k in range(15)]

    def loss(t: float) -> Column:
        shared = F.aggregate("entropy", F.lit(0.0), lambda total, e: total + F.exp((F.col("bits") - e) * F.col("n") * (t * math.log(2))))
        # The true language's chance is one part of this sum; an endless sum is a chance of nothing.
        return F.avg(F.least(F.log(shared), F.lit(-math.log(1e-12)))).alias(f"loss_{t}")

    losses = texts.agg(*[loss(t) for t in steps]).first()
    if losses[0] is None:
        return
    models.temperature = steps[min(range(len(steps)), key=lambda k: losses[k])]
    # One row per language, from here on.
    usual = texts.groupBy("own").agg(F.percentile_approx("bits", 0.5, ACCURACY).alias("usual"))
    away = texts.join(F.broadcast(usual), "own").withColumn("away", (F.col("bits") - F.col("usual")) * F.sqrt("n"))
    shares = [F.percentile_approx(F.abs("away"), 0.5, ACCURACY).alias("spread"), F.percentile_approx("away", 1 - REJECTED, ACCURACY).alias("far")]
    for row in away.groupBy("own", "usual").agg(*shares).collect():
        lang = row["own"] - 1
        models.usual[lang], models.spread[lang] = row["usual"], max(1e-6, row["spread"] * 1.4826)
        models.limit[lang] = max(6.0, row["far"] / models.spread[lang])


def _models(counts: DataFrame, bits: int) -> Models | None:
    """Models, not calibrated, of the languages in staged (lang, key, n); None without any run."""
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    index = {lang: i for i, lang in enumerate(languages)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            numbers = np.array([index[x] for x in names.dictionary.to_pylist()], dtype=np.uint64)
            code = batch.column(1).to_numpy()
            found = cells(code, numbers[names.indices.to_numpy()], batch.column(2).to_numpy().copy(), bits)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found.astype(np.int64)), batch.column(3)], names=["code", "cell", "v"])

    spelled = estimates(counts).select("lang", "code", "key", "v").mapInArrow(task, "code int, cell bigint, v double")
    # At most 2^bits cells per code, whatever the corpus; two runs that meet in one share the greater value.
    table = spelled.groupBy("code", "cell").agg(F.max("v").cast("float").alias("v")).toArrow().combine_chunks()
    code, cell, value = (table.column(c).to_numpy() for c in ("code", "cell", "v"))
    characters = counts.select(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("char")).distinct().count()
    models = Models(languages, 1.0 / (characters + 1), bits)
    for c in np.unique(code).tolist():
        own = np.flatnonzero(code == c)
        own = own[np.argsort(cell[own])]
        models.hashes[c], models.values[c] = cell[own].astype(np.uint64), value[own]
    return models


def fit(docs: DataFrame, usable: Column, text: str = "text", bits: int = BITS) -> Models | None:
    """Models of every language named in usable rows, from all their texts; None without any run.

    Runs and statistics come from every usable row.  A sixteenth part of each larger language is
    first kept aside: models without it are calibrated on all of its texts, then its runs are added.
    """
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col(text).isNotNull()).select("doc_id", "lang", F.col(text).alias("text"))
    # One row per language.
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    large = [lang for lang, size in sizes.items() if size >= 4 * KEPT]
    kept = F.col("lang").isin(large) & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(KEPT)) == 0)
    counts = stage(counted(rows.where(~kept)), "run-counts")
    first = _models(counts, bits)
    if not large:
        if first is not None:
            _calibrated(first, rows.sparkSession.createDataFrame([], "lang string, n bigint, entropy array<double>"))
        return first
    held = stage(rows.where(kept), "calibration")
    if first is not None:
        _calibrated(first, stage(entropies(held, first, "lang"), "entropies"))
    both = counts.unionByName(counted(held)).groupBy("lang", "key").agg(F.sum("n").alias("n"))
    models = _models(stage(both, "run-counts"), bits)
    if models is not None:
        # A language whose texts were all kept aside is learned without limits.
        old = [first.languages.index(x) if first is not None and x in first.languages else None for x in models.languages]
        models.temperature = first.temperature if first is not None else 1.0
        for name, otherwise in (("usual", 0.0), ("spread", 1.0), ("limit", np.inf)):
            setattr(models, name, np.array([otherwise if i is None else getattr(first, name)[i] for i in old]))
    return models


def entropies(rows: DataFrame, models: Models, keep: str, text: str = "text") -> DataFrame:
    """(keep, n, entropy): characters and bits a character under each language, of whole texts."""
    kind = rows.schema[keep].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in gathered(batches, 1):
            scorer = scorer or Scorer(models)
            n, entropy = scorer(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.FixedSizeListArray.from_arrays(pa.array(entropy.ravel()), entropy.shape[1]).cast(pa.list_(pa.float64()))],
                names=[keep, "n", "entropy"],
            )

    return rows.select(keep, text_or_empty(text).alias("text")).mapInArrow(task, f"{keep} {kind}, n bigint, entropy array<double>")


def identify(docs: DataFrame, models: Models | None, text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every whole text.

    ``lang_pred`` has the lowest cross-entropy a character, of equal ones the first
    by name; ``score`` is its calibrated probability among the languages learned.
    ``accepted`` is false where the text costs more than the language's own texts do.
    Texts that are null, empty or without a letter are ``und`` with score 0,
    as all are without a model.  Rows are judged one by one, so ties and repeated
    rows agree; other columns are ignored; no rows give none.  A worker holds some
    4 MB of text, or one text, with its runs.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if models is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    names = np.array([*models.languages, UNKNOWN], dtype=object)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in gathered(batches, 1):
            scorer = scorer or Scorer(models)
            n, entropy = scorer(batch.column(1))
            some = n > 0
            best = entropy.argmin(axis=1)
            least = entropy[np.arange(len(n)), best]
            chance = np.exp(-models.temperature * np.log(2) * (entropy - least[:, None]) * n[:, None])
            score = np.where(some, 1 / chance.sum(axis=1), 0.0)
            away = (least - models.usual[best]) * np.sqrt(n) / models.spread[best]
            accepted = some & (away <= models.limit[best])
            lang = names[np.where(some, best, len(names) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    rows = docs.select("doc_id", text_or_empty(text).alias("text"))
    return rows.mapInArrow(task, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def report(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those outside the held-out quarter."""
    usable = fold(4) != 2
    return identify(docs, fit(docs, usable)).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted"
    )
