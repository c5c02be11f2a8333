"""Hierarchical packing into windows of several context sizes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gablework.llm import tokens
from gablework.llm.common import partitions, running_sums, staged_small

#: Context sizes, long to short: powers of two, each half of the one before.
TIERS = (2048, 1024, 512, 256)
#: Tokens of a training step.
STEP_TOKENS = 1 << 16
#: Documents of one length are set apart for filling by so many hash cells.
CELLS = 64
#: Lengths and arrival ranks share one number: the rank has so many bits.
RANK_BITS = 44


@dataclass
class Filled:
    """Windows of whole documents.

    A block (length, first rank, tier, first window, windows, copies, offset): from that window on,
    each window holds ``copies`` documents of the length side by side.  A
    stretch (tier, first window, windows, filled): windows alike.
    """

    blocks: list[tuple[int, int, int, int, int, int, int]]
    stretches: list[tuple[int, int, int, int]]

    def gap(self) -> int:
        return sum(windows * (tier - filled) for tier, _, windows, filled in self.stretches)


def fill_windows(counts: np.ndarray, tiers: Sequence[int]) -> Filled:
    """Pack documents, given by their number per length, into windows of their tier.

    A document opens a window of the smallest tier that holds it, long ones first; what
    it leaves open takes the longest documents that fit, all of shorter tiers
    (in the last tier, of its own too).  Windows alike are handled together, so
    the work depends on the number of lengths, not of documents.
    """
    left, used = counts.tolist(), [0] * len(counts)
    present = [n for n in range(1, len(left)) if left[n]]
    out = Filled([], [])

    def take(length: int, tier: int, first: int, windows: int, copies: int, at: int) -> None:
        out.blocks.append((length, used[length], tier, first, windows, copies, at))
        used[length] += windows * copies
        left[length] -= windows * copies
        if not left[length]:
            present.remove(length)

    for i, tier in enumerate(tiers):
        least = tiers[i + 1] if i + 1 < len(tiers) else 0
        made = 0
        while present and present[-1] > least:
            length = present[-1]
            # As many windows full of this length as there are, or one with what is left of it.
            copies = min(tier // length, left[length])
            windows = left[length] // copies
            take(length, tier, made, windows, copies, 0)
            alike = [(made, windows, copies * length)]
            made += windows
            while alike:
                first, windows, at = alike.pop()
                fits = bisect_right(present, tier - at)
                if not fits:
                    out.stretches.append((tier, first, windows, at))
                    continue
                length = present[fits - 1]
                some = min(windows, left[length])
                copies = min((tier - at) // length, left[length] // some)
                take(length, tier, first, some, copies, at)
                alike.append((first, some, at + copies * length))
                if some < windows:
                    alike.append((first + some, windows - some, at))
    return out


def choose_loose(cells: np.ndarray, tiers: Sequence[int]) -> tuple[np.ndarray, Filled]:
    """Which documents (by length and hash cell) may be cut to fill gaps, and the windows of all others.

    The worst filled windows are given up, as few as let their documents fill the gaps
    of the rest; ``cells`` has the number of documents per length and cell.
    """
    loose = np.zeros(cells.shape, dtype=bool)
    lengths = np.arange(len(cells))
    while True:
        filled = fill_windows(np.where(loose, 0, cells).sum(axis=1), tiers)
        spare = int((np.where(loose, cells, 0).sum(axis=1) * lengths).sum())
        missing = filled.gap() - spare
        if missing <= 0:
            return loose, filled
        given: dict[int, list[tuple[int, int]]] = {}
        for tier, first, windows, at in sorted(filled.stretches, key=lambda s: (s[3] / s[0], s)):
            if missing <= 0:
                break
            # A window given up is a gap less, and tokens more to fill others.
            some = min(windows, -(-missing // tier))
            given.setdefault(tier, []).append((first, first + some))
            missing -= some * tier
        wanted = np.zeros(len(cells), dtype=np.int64)
        for length, _, tier, first, windows, copies, _ in filled.blocks:
            for begin, end in given.get(tier, ()):
                wanted[length] += copies * max(0, min(first + windows, end) - max(first, begin))
        for length in np.flatnonzero(wanted):
            free = [c for c in range(cells.shape[1]) if cells[length, c] and not loose[length, c]]
            free.sort(key=lambda c: (int(cells[length, c]), c))
            for c in free:
                if wanted[length] <= 0:
                    break
                loose[length, c] = True
                wanted[length] -= cells[length, c]


def count_cells(encoded: DataFrame, top: int) -> np.ndarray:
    """Documents per length beyond full windows and hash cell: a table of bounded size."""
    counted = encoded.select(F.expr(f"cast(n % {top} as int)").alias("rest"), _cell()).groupBy("rest", "cell").agg(F.count(F.lit(1)).alias("k")).toPandas()
    cells = np.zeros((top, CELLS), dtype=np.int64)
    cells[counted["rest"].to_numpy(dtype=int), counted["cell"].to_numpy(dtype=int)] = counted["k"].to_numpy()
    cells[0] = 0
    return cells


def _cell():
    return F.pmod(F.xxhash64("came", F.lit("cell")), F.lit(CELLS)).cast("int").alias("cell")


FULL, WHOLE, LOOSE = "full", "whole", "loose"


def cut(encoded: DataFrame, top: int, loose: np.ndarray) -> DataFrame:
    """Pieces of every document: its full windows, and the rest as a whole or, to be cut, with its ids."""
    spark = encoded.sparkSession
    chosen = [(int(n), int(c)) for n, c in np.argwhere(loose)]
    # Bounded by the number of lengths and cells.
    set_apart = F.broadcast(spark.createDataFrame(chosen, "rest int, cell int").withColumn("loose", F.lit(True)))
    rows = encoded.withColumns({"rest": F.expr(f"cast(n % {top} as int)"), "cell": _cell()}).join(set_apart, ["rest", "cell"], "left")
    starts = F.expr(f"sequence(0L, n - 1, {top}L)")
    pieces = rows.withColumn("start", F.explode(starts)).withColumn("length", F.least(F.lit(top).cast("long"), F.col("n") - F.col("start")))
    ids = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    kind = F.when(F.col("length") == top, FULL).when(F.col("loose"), LOOSE).otherwise(WHOLE)
    return pieces.select(
        "came", "doc_id", F.col("n").alias("doc_tokens"), "start", "length", kind.alias("kind"), F.crc32(ids).alias("ids_crc32"), F.when(kind == LOOSE, ids).alias("tail_ids")
    )


def ranked(pieces: DataFrame) -> DataFrame:
    """``rank``: number of pieces of the same length that come before, in one fixed order.

    Each length is numbered in hash groups of arrivals, so a length that many
    documents have, or copies of one, spread over all tasks.
    """
    groups = 4 * partitions(pieces.sparkSession)
    keyed = pieces.withColumn("group", F.pmod(F.xxhash64("came"), F.lit(groups)))
    within = Window.partitionBy("length", "group").orderBy("came")
    local = keyed.withColumn("rank", F.row_number().over(within) - 1)
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("length", "group").agg(F.count(F.lit(1)).alias("k"))
    offsets = totals.select("length", "group", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("ahead"))
    joined = local.join(offsets, ["length", "group"])
    return joined.withColumn("rank", F.col("rank") + F.col("ahead")).drop("group", "ahead")


def placed(whole: DataFrame, filled: Filled) -> DataFrame:
    """Ranked pieces with the tier, ``index`` of their window in it, and offset; by a look-up in the blocks."""
    table = np.array(sorted(filled.blocks), dtype=np.int64).reshape(-1, 7)
    keys = (table[:, 0] << RANK_BITS) + table[:, 1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (at_length, at_rank))
            _, since, tier, first, _, copies, at = table[np.searchsorted(keys, (length << RANK_BITS) + rank, "right") - 1].T
            own = [pa.array(tier), pa.array(first + (rank - since) // copies), pa.array(at + (rank - since) % copies * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "tier", "index", "offset"])

    rows = whole.withColumns({c: F.col(c).cast("long") for c in ("length", "rank")})
    at_length, at_rank = rows.columns.index("length"), rows.columns.index("rank")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(task, ", ".join([*fields, "tier long, index long, offset long"])).drop("rank")


def open_windows(whole_like: DataFrame, filled: Filled) -> DataFrame:
    """Windows with a gap, laid on one line: (at, upto, filled, tier, index)."""
    spark = whole_like.sparkSession
    table = np.array([s for s in filled.stretches if s[3] < s[0]], dtype=np.int64).reshape(-1, 4)
    tier, first, windows, at = table.T
    upto, line = np.cumsum(windows), np.cumsum(windows * (tier - at))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.column(0).to_numpy()
            k = np.searchsorted(upto, i, "right")
            nth, gap = i - (upto[k] - windows[k]), tier[k] - at[k]
            begin = line[k] - windows[k] * gap + nth * gap
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (begin, begin + gap, at[k], tier[k], first[k] + nth)], names=["at", "upto", "filled", "tier", "index"]
            )

    total = int(windows.sum())
    return spark.range(0, total, 1, partitions(spark)).mapInArrow(task, "at long, upto long, filled long, tier long, index long")


def pack(
    docs: DataFrame,
    vocab_path: str,
    end_id: int = 1,
    tiers: Sequence[int] = TIERS,
    step_tokens: int = STEP_TOKENS,
    text: str = "text",
) -> DataFrame:
    """All token ids of ``docs`` in sequences, a row per piece.

    A document longer than the longest tier gives full windows of it and a rest; rests
    and shorter documents are routed whole to the smallest tier that holds
    them.  Each tier is packed, and gaps of its windows are filled with whole
    documents of shorter tiers, by counts per length.  Only the documents of
    the worst filled windows are cut: as few as fill what gaps remain.  Gaps
    and these documents are laid end to end on two lines of one length scale; where a
    document lies over a gap it fills it, and beyond the last gap they fill
    windows of the longest tier.  So only the last window is padded.  Steps
    take the same number of tokens from one tier each; ``step_order`` in 0 to
    1 mixes the tiers evenly.

    Rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier, step_group, step_order.  A null or empty text is its end id alone.
    Repeated rows are packed as often as they come; null ids too; each row has an arrival
    number, by which ties and copies are told apart and spread.  Other
    columns are ignored; an empty table gives an empty result.  Longest work of
    one task: a document, or one cell of the two lines.
    """
    spark = docs.sparkSession
    top = tiers[0]
    arrived = tokens.encode(docs, vocab_path, end_id, text).withColumn("came", F.monotonically_increasing_id())
    encoded = staged_small(arrived, "ids")
    loose, filled = choose_loose(count_cells(encoded, top), tiers)
    pieces = staged_small(cut(encoded, top, loose), "pieces")

    sums = {r["kind"]: (int(r["k"]), int(r["n"])) for r in pieces.groupBy("kind").agg(F.count(F.lit(1)).alias("k"), F.sum("length").alias("n")).collect()}
    gaps, tails = filled.gap(), sums.get(LOOSE, (0, 0))[1]
    extra = -(-max(0, tails - gaps) // top)
    planned = {t: sum(s[2] for s in filled.stretches if s[0] == t) for t in tiers}
    # Sequence ids: tiers one after the other; of the longest, planned windows, full ones of long documents, those of tails.
    full = planned[top] + sums.get(FULL, (0, 0))[0]
    in_tier = planned | {top: full + extra}
    first, base = 0, {}
    for t in tiers:
        base[t] = first
        first += in_tier[t]

    def of_tier(values: dict[int, int | float]):
        out = F.lit(None)
        for t, v in values.items():
            out = F.when(F.col("tier") == t, F.lit(v)).otherwise(out)
        return out

    per_step = {t: max(1, step_tokens // t) for t in tiers}
    steps = {t: max(1, -(-in_tier[t] // per_step[t])) for t in tiers}

    def stepped(df: DataFrame) -> DataFrame:
        group = F.floor(F.col("index") / of_tier(per_step)).cast("long")
        return df.withColumn("step_group", group).withColumns(
            {
                "sequence_id": (F.col("index") + of_tier(base)).cast("long"),
                "step_order": (F.col("step_group") + 0.5) / of_tier(steps),
            }
        )

    order = ["came", "start"]
    narrow = pieces.drop("tail_ids")
    numbered = running_sums(narrow.where(F.col("kind") == FULL).withColumn("one", F.lit(1)), order, index="one")
    windows = numbered.withColumns(
        {"index": F.col("index") + planned[top], "tier": F.lit(top).cast("long"), "offset": F.lit(0).cast("long")}
    )
    wholes = placed(ranked(narrow.where(F.col("kind") == WHOLE)), filled)
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "step_order"]
    heads = stepped(windows.select(*wholes.columns).unionByName(wholes)).select(*result)

    spare = spark.range(extra).select(
        (F.lit(gaps) + F.col("id") * top).alias("at"),
        (F.lit(gaps) + (F.col("id") + 1) * top).alias("upto"),
        F.lit(0).cast("long").alias("filled"),
        F.lit(top).cast("long").alias("tier"),
        (F.col("id") + full).alias("index"),
    )
    room = stepped(open_windows(pieces, filled).unionByName(spare)).select(
        "at", "upto", F.struct("at", "filled", "tier", "step_group", "sequence_id", "step_order").alias("room")
    )
    line = running_sums(pieces.where(F.col("kind") == LOOSE), order, at="length")
    fill = line.select(
        "at", (F.col("at") + F.col("length")).alias("upto"), F.struct("at", "doc_id", "start", "doc_tokens", "tail_ids").alias("tail")
    )
    filled = _overlaps(room, fill, top, tails)
    skip = F.col("pos") - F.col("tail.at")
    part = F.substring(F.col("tail.tail_ids"), (4 * skip + 1).cast("int"), (4 * F.col("length")).cast("int"))
    fillers = filled.select(
        "tail.doc_id",
        (F.col("tail.start") + skip).alias("start"),
        "length",
        F.crc32(part).alias("ids_crc32"),
        "tail.doc_tokens",
        "room.sequence_id",
        (F.col("room.filled") + F.col("pos") - F.col("room.at")).alias("offset"),
        "room.tier",
        "room.step_group",
        "room.step_order",
    )
    return heads.unionByName(fillers)


def _overlaps(room: DataFrame, fill: DataFrame, cell: int, end: int) -> DataFrame:
    """Where intervals of two gapless lines that start at 0 overlap, up to ``end``: (pos, length, room, tail).

    Both are cut at multiples of ``cell``.  In a cell the starts of both lines
    are put in order; between two of them one interval of each line lies.
    """

    def in_cells(df: DataFrame, name: str) -> DataFrame:
        cells = F.sequence(F.floor(F.col("at") / cell), F.floor((F.col("upto") - 1) / cell))
        return df.withColumn("cell", F.explode(cells)).select(
            "cell", F.greatest("at", F.col("cell") * cell).alias("pos"), F.col(name)
        )

    points = in_cells(room, "room").unionByName(in_cells(fill, "tail"), allowMissingColumns=True)
    order = Window.partitionBy("cell").orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.select(
        "pos",
        F.least(F.coalesce(F.lead("pos").over(order), (F.col("cell") + 1) * cell), F.lit(end)).alias("next"),
        F.last("room", ignorenulls=True).over(upto).alias("room"),
        F.last("tail", ignorenulls=True).over(upto).alias("tail"),
    )
    return swept.withColumn("length", F.col("next") - F.col("pos")).where("length > 0")


def report(docs: DataFrame, vocab_path: str) -> DataFrame:
    return pack(docs, vocab_path)
