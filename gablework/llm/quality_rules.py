"""Quality rules: one table of limits, compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gablework.llm.common import settled, text_or_empty, trimmed, words_of

# Frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is it that was for on are as with be by at this have from or not but an they which you "
    "le la les de des du et un une en que qui dans pour pas sur est au par plus avec il elle ne ce "
    "der die das und zu den von mit ist des im dem nicht ein eine auf für sich es als auch er sie "
    "el los las y del se por con no para su lo como más o pero sus"
).split()

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limit:
    """A measure must lie within [low, high]; None is open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The limits of the method, besides the base rules.
LIMITS = (
    Limit("mean_word_chars", 2.0, 14.0),
    Limit("symbols_per_word", None, 0.1),
    Limit("marks_per_word", None, 0.5),
    Limit("upper_share", None, 0.4),
    Limit("stop_share", 0.02, None),
    Limit("dup_line_share", None, 0.4),
)


def _ratio(top: Column, bottom: Column) -> Column:
    """A ratio that is 0 for an empty text."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and ratios of every whole text, as ``__q`` fields; a null text is empty.

    Everything is computed within the row from arrays, so no row moves.  The
    repeated three-word windows are found by sorting the window hashes of a
    text together with their places, only where some hash occurs twice.
    """
    body = text_or_empty(text)
    first = settled(
        docs,
        __words=words_of(body),
        __lines=F.filter(F.split(body, "\n"), lambda x: trimmed(x) != ""),
        __length=F.length(body),
        __spaceless=F.length(_without(body, " \t\n\x0b\f\r")),
        __symbols=F.length(body) - F.length(_without(body, SYMBOLS)),
        __marks=F.length(body) - F.length(_without(body, "!?")),
        __upper=F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
    )
    second = settled(
        first,
        __n=F.size("__words").cast("long"),
        __hashes=F.transform("__words", lambda w: F.xxhash64(w)),
        __stops=F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
    )
    windows = F.greatest(F.size("__hashes") - 2, F.lit(0))
    pairs = F.zip_with(
        F.slice("__hashes", F.lit(1), windows), F.slice("__hashes", F.lit(2), windows), lambda a, b: F.xxhash64(a, b)
    )
    third = settled(
        second,
        __triples=F.zip_with(pairs, F.slice("__hashes", F.lit(3), windows), lambda ab, c: F.xxhash64(ab, c)),
    ).drop("__hashes")
    places = F.sequence(F.lit(1), F.size("__triples"))
    fourth = settled(
        third,
        __sorted=F.when(
            F.size(F.array_distinct("__triples")) < F.size("__triples"),
            F.sort_array(F.zip_with("__triples", places, lambda h, p: F.struct(h.alias("h"), p.alias("p")))),
        ),
    ).drop("__triples")
    size = F.size("__sorted") - 1
    twins = F.zip_with(
        F.slice("__sorted", F.lit(1), size),
        F.slice("__sorted", F.lit(2), size),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], y["p"])).otherwise(F.array().cast("array<int>")),
    )
    covered = F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(twins)), lambda p: F.array(p, p + 1, p + 2))))
    repeats = F.when(F.col("__sorted").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")
    lines = F.size("__lines")
    duplicates = lines - F.size(F.array_distinct("__lines"))
    n, chars = F.col("__n"), F.col("__spaceless")
    summary = F.struct(
        n.alias("n_words"),
        chars.cast("long").alias("word_chars"),
        F.col("__symbols").cast("long").alias("n_symbols"),
        duplicates.cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        _ratio(chars, n).alias("mean_word_chars"),
        _ratio(F.col("__symbols"), n).alias("symbols_per_word"),
        _ratio(F.col("__marks"), n).alias("marks_per_word"),
        _ratio(F.col("__upper"), chars).alias("upper_share"),
        _ratio(F.col("__stops"), n).alias("stop_share"),
        _ratio(duplicates, lines).alias("dup_line_share"),
    )
    return settled(fourth, __q=summary).select(*[docs[c] for c in docs.columns], "__q")


def verdict(q: str = "__q", limits: tuple[Limit, ...] = LIMITS) -> Column:
    """The table of limits as one condition."""
    kept = F.lit(True)
    for limit in limits:
        value = F.col(q)[limit.measure]
        if limit.low is not None:
            kept = kept & (value >= limit.low)
        if limit.high is not None:
            kept = kept & (value <= limit.high)
    return kept


def base_failed(q: str = "__q") -> Column:
    n, repeats = F.col(q)["n_words"], F.col(q)["n_repeat_words"]
    return (n < 50) | (100 * repeats > 50 * n)


def with_rules(docs: DataFrame, text: str = "text", limits: tuple[Limit, ...] = LIMITS) -> DataFrame:
    """``docs`` with a struct ``__q`` of measures, and booleans ``__base_failed`` and ``__kept``.

    A null or empty text has no words and fails the base rules.  Rows are
    judged one by one: ties, repeated rows and other columns have no influence,
    and an empty table gives an empty result.
    """
    rated = measured(docs, text)
    return rated.withColumns({"__base_failed": base_failed(), "__kept": ~base_failed() & verdict(limits=limits)})


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass; all columns as they were."""
    return with_rules(docs, text).where("__kept").select(*docs.columns)


def report(docs: DataFrame, text: str = "text") -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rated = with_rules(docs.select("doc_id", text), text)
    return rated.select(
        "doc_id",
        *[F.col("__q")[n].alias(n) for n in names],
        F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def report_sql(limits: tuple[Limit, ...] = LIMITS) -> str:
    """The same for DuckDB."""
    rules = []
    for limit in limits:
        rules += [f"{limit.measure} >= {limit.low!r}"] if limit.low is not None else []
        rules += [f"{limit.measure} <= {limit.high!r}"] if limit.high is not None else []
    stops = ", ".join("'" + w + "'" for w in sorted(set(STOP_WORDS)))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words,
        len(ls) AS n_lines, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
        length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_upper,
        len(list_filter(ws, lambda x: list_contains([{stops}], lower(x)))) AS n_stops
      FROM w LEFT JOIN p ON w.doc_id = p.doc_id),
q AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
        coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word, coalesce(n_marks / nullif(n_words, 0), 0) AS marks_per_word,
        coalesce(n_upper / nullif(word_chars, 0), 0) AS upper_share, coalesce(n_stops / nullif(n_words, 0), 0) AS stop_share,
        coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(rules)} AS kept FROM q"""
