"""Chat formatting: snapshots that a longer logged conversation contains are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Turns whose numbers share a block are ordered together; turns in one rendered row.
BLOCK, PART = 256, 256

#: Text before a role, between role and text, and after the text.
MARKS = ("<|", "|>\n", "<|end|>\n")

_STATE = ["pos", "s1", "s2", "s3", "s4"]


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with a key, a block and a place within the conversation."""
    rows = turns.select(
        F.col("conv_id"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("long").alias("block"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("key", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.withColumn("rank", F.row_number().over(order).cast("long"))
    return _with_offsets(numbered, {"pos": ("rank", F.count(F.lit(1)))})


def _with_offsets(rows: DataFrame, sums: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add to block-local values the totals of the conversation's earlier blocks."""
    totals = rows.groupBy("key", "block").agg(*[total.alias(f"t_{new}") for new, (_, total) in sums.items()])
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "key", "block", *[F.coalesce(F.sum(f"t_{new}").over(before), F.lit(0)).alias(f"o_{new}") for new in sums]
    )
    joined = rows.join(offsets, ["key", "block"])
    added = {new: F.col(local) + F.col(f"o_{new}") for new, (local, _) in sums.items()}
    return joined.withColumns(added).drop(*[f"o_{new}" for new in sums])


def _states(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each turn the rolling hash of the conversation up to it; and the hashes summed.

    The hash is a running sum over place-dependent hashes of the turns, kept in
    four sums of 32 bits each.  Sums can be taken per block and put together,
    so a conversation that holds much of the table is no single task.
    """
    one = F.xxhash64("pos", "role", "text")
    two = F.xxhash64(F.lit(7), "text", "role", "pos")
    low = F.lit(0xFFFFFFFF).cast("long")
    parts = {
        "p1": one.bitwiseAND(low),
        "p2": F.shiftrightunsigned(one, 32),
        "p3": two.bitwiseAND(low),
        "p4": F.shiftrightunsigned(two, 32),
    }
    hashed = placed.select("conv_id", "key", "block", "pos", *[c.alias(n) for n, c in parts.items()])
    upto = Window.partitionBy("key", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = hashed.withColumns({f"l{i}": F.sum(f"p{i}").over(upto) for i in range(1, 5)})
    return _with_offsets(local, {f"s{i}": (f"l{i}", F.sum(f"p{i}")) for i in range(1, 5)}), hashed


def maximal(turns: DataFrame) -> DataFrame:
    """(key, conv_id, n_turns) of conversations that are no prefix of another one.

    Of equal conversations the one with the smallest conv_id stays.
    """
    placed = _placed(turns)
    states, hashed = _states(placed)
    finals = hashed.groupBy("key").agg(
        F.max("pos").alias("pos"), *[F.sum(f"p{i}").alias(f"s{i}") for i in range(1, 5)], F.first("conv_id").alias("conv_id")
    )
    seen = states.select(*_STATE, F.lit(1).alias("prefix"), F.lit(0).alias("end"))
    ended = finals.select(*_STATE, F.lit(0).alias("prefix"), F.lit(1).alias("end"))
    # A state that more conversations pass than end in is a proper prefix of some.
    inner = (
        seen.unionByName(ended)
        .groupBy(*_STATE)
        .agg(F.sum("prefix").alias("passed"), F.sum("end").alias("ended"))
        .where("ended > 0 AND passed > ended")
        .select(*_STATE)
    )
    whole = finals.groupBy(*_STATE).agg(F.min(F.struct("conv_id", "key")).alias("best"))
    kept = whole.join(inner, _STATE, "left_anti")
    return kept.select(F.col("best.key").alias("key"), F.col("best.conv_id").alias("conv_id"), F.col("pos").alias("n_turns"))


def render(turns: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Maximal conversations as text: (conv_id, n_turns, part, text).

    A part holds up to 256 turns, so an endless conversation is many rows of
    bounded size; common ones have the single part 0.  Turns are ordered by
    turn (nulls first), role and text; a null role or text is empty.  Rows
    without conv_id form one conversation with a null id.  A repeated turn row
    is a turn of its own.  Other columns are ignored; an empty table gives an
    empty result.
    """
    placed = _placed(turns)
    before, between, after = marks
    piece = F.concat(F.lit(before), "role", F.lit(between), "text", F.lit(after))
    rows = placed.select(
        "key", F.floor((F.col("pos") - 1) / PART).cast("long").alias("part"), F.struct("pos", piece.alias("piece")).alias("turn")
    )
    parts = rows.groupBy("key", "part").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    texts = parts.select("key", "part", F.array_join(F.col("turns.piece"), "").alias("text"))
    return texts.join(maximal(turns), "key").select("conv_id", "n_turns", "part", "text")


RENDER_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
      FROM conversations),
h AS (SELECT conv_id, pos, md5(string_agg(md5(role || chr(1) || text), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS state,
        count(*) OVER (PARTITION BY conv_id) AS n FROM t),
p AS (SELECT DISTINCT state FROM h WHERE pos < n),
k AS (SELECT min(conv_id) AS conv_id, n AS n_turns FROM h WHERE pos = n AND state NOT IN (SELECT state FROM p) GROUP BY state, n)
SELECT k.conv_id, k.n_turns, ((t.pos - 1) // 256)::BIGINT AS part,
  string_agg('<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10), '' ORDER BY t.pos) AS text
FROM k JOIN t ON k.conv_id = t.conv_id GROUP BY k.conv_id, k.n_turns, part"""
