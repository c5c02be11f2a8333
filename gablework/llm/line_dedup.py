"""Line dedup: later copies of three consecutive lines go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gablework.llm.common import settled, text_or_empty, trimmed
from gablework.session import stage

#: Lines in a window.
WINDOW = 3


def _key(text: Column) -> Column:
    """Identity of a document row: rows that share id and text count as one document."""
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64(text), F.xxhash64(F.lit(7), text))


def _windows(docs: DataFrame, text: str) -> DataFrame:
    """A row per window: document, first and last line, and 128 bits of the lines' hash."""
    body = text_or_empty(text)
    base = docs.select("doc_id", body.alias("__text"))
    split = settled(base, __lines=F.transform(F.split("__text", "\n"), lambda x: trimmed(x)), __key=_key(F.col("__text")))
    numbered = F.transform(
        F.col("__lines"),
        lambda x, i: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), i.alias("at"), (x != "").alias("full")),
    )
    listed = settled(split.drop("__text"), __full=F.filter(numbered, lambda x: x["full"])).drop("__lines")
    size = F.greatest(F.size("__full") - (WINDOW - 1), F.lit(0))
    shifted = [F.slice("__full", F.lit(i + 1), size) for i in range(WINDOW)]
    joined = F.arrays_zip(*[s.alias(f"x{i}") for i, s in enumerate(shifted)])
    packed = F.transform(
        joined,
        lambda z: F.struct(
            F.xxhash64(*[z[f"x{i}"]["a"] for i in range(WINDOW)]).alias("h1"),
            F.xxhash64(F.lit(11), *[z[f"x{i}"]["b"] for i in range(WINDOW)]).alias("h2"),
            z["x0"]["at"].alias("from"),
            z[f"x{WINDOW - 1}"]["at"].alias("to"),
        ),
    )
    return listed.select("__key", F.struct("doc_id", "__key").alias("__doc"), F.inline(packed))


def covered_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, spans) of the documents that hold a later copy of some window.

    The first occurrence, by (doc_id, place), is found by an aggregation that
    combines before the shuffle; windows that occur once go there.  The few
    repeated windows are written, so that joining them back can be broadcast when
    small, and split by adaptive execution when one of them is hot.
    """
    windows = _windows(docs, text)
    repeated = stage(
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("__doc", "from")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "windows",
    )
    later = windows.join(repeated, ["h1", "h2"]).where(F.struct("__doc", "from") > F.col("first"))
    return later.groupBy("__key").agg(F.collect_set(F.struct("from", "to")).alias("__spans"))


def drop_repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with later copies of three-line windows removed from the text.

    Lines are compared without outer white space; blank lines are skipped when
    windows are formed, and go where they lie inside a removed span.  The first
    occurrence in order of doc_id (nulls first) and place stays.  Adds
    ``__n_lines`` and ``__n_removed``; ``n_chars`` follows the text if present.

    Null texts stay null and have no lines.  Texts of fewer than three lines
    are never changed, and repeats of fewer than three consecutive lines remain,
    whatever the lines' length.  Rows that repeat both doc_id and text are one document
    and are treated alike.  An empty table gives an empty result.
    """
    spans = covered_lines(docs, text)
    body = text_or_empty(text)
    keyed = docs.withColumn("__key", _key(body))
    joined = settled(keyed.join(spans, "__key", "left"), __lines=F.split(body, "\n"))
    covered = F.flatten(F.transform("__spans", lambda s: F.sequence(s["from"], s["to"])))
    every = F.sequence(F.lit(0), F.size("__lines") - 1)
    left = F.when(F.col("__spans").isNull(), every).otherwise(F.array_except(every, covered))
    # Arrays of a changed text only; others keep their text as it is.
    chosen = settled(joined, __left=F.when(F.col("__spans").isNotNull(), left))
    lines = F.col("__lines")
    rebuilt = F.array_join(F.transform("__left", lambda i: F.element_at(lines, i + 1)), "\n")
    new = F.when(F.col("__left").isNull(), F.col(text)).otherwise(rebuilt)
    counted = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size("__lines")).cast("long")
    removed = F.when(F.col("__left").isNull(), F.lit(0)).otherwise(F.size("__lines") - F.size("__left")).cast("long")
    done = settled(chosen, __new=new, __n_lines=counted, __n_removed=removed)
    out = {c: F.col(c) for c in docs.columns} | {text: F.col("__new")}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("__left").isNull(), F.col("n_chars")).otherwise(
            F.length("__new").cast(docs.schema["n_chars"].dataType)
        )
    return done.select(*[v.alias(c) for c, v in out.items()], "__n_lines", "__n_removed")


def report(docs: DataFrame, text: str = "text") -> DataFrame:
    done = drop_repeated(docs.select("doc_id", text), text)
    return done.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        F.md5(text_or_empty(text)).alias("text_md5"),
    )


REPORT_SQL = """
WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i - 1 AS pos, trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x, ls[i] AS line
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM s)),
f AS (SELECT doc_id, pos, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z, lead(pos, 2) OVER o AS upto
      FROM l WHERE x <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, upto, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, pos) AS n FROM f WHERE z IS NOT NULL),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, upto + 1)) AS pos FROM r WHERE n > 1),
k AS (SELECT l.doc_id, count(c.pos) AS n_removed, count(*) AS n_lines,
        coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
      FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id)
SELECT s.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  md5(coalesce(k.text, '')) AS text_md5 FROM s LEFT JOIN k ON s.doc_id = k.doc_id"""
