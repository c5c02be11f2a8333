"""Token files: ids as frequency ranks in bytes, with separate control bytes.

A file set is a folder with two tables: ``vocabulary`` (rank, id), and
``sequences`` (shard, doc_id, n, control, data), sorted by doc_id within shards and
shards in ascending order.  Each control byte gives the widths, 1 to 4 bytes, of
four numbers whose little-endian bytes stand in ``data``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gablework.llm import tokens
from gablework.llm.common import staged_small
from gablework.session import scratch_path

#: Ids a vocabulary may have: the rank table is held by the driver and each task.
MOST_IDS = 1 << 20


def frequency_ranks(encoded: DataFrame) -> np.ndarray:
    """Ids in order of falling count over all rows, ties by id; ids that never occur are left out.

    ``counts`` of ``encoded`` holds them for each group of texts, so the ids themselves are not read.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for pairs in batch.column(0).to_pylist():
                ids, found = np.frombuffer(pairs, dtype="<i8").reshape(-1, 2).T
                if int(ids[-1]) >= len(counts):
                    counts = np.pad(counts, (0, int(ids[-1]) + 1 - len(counts)))
                counts[ids] += found
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts[ids], pa.int64())], names=["id", "n"])

    groups = encoded.select("counts").where("counts IS NOT NULL")
    counted = groups.mapInArrow(task, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counted.limit(MOST_IDS + 1).toPandas()
    if len(rows) > MOST_IDS:
        raise ValueError(f"more than {MOST_IDS} distinct ids")
    return rows.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(dtype=np.uint32)


def pack(sequences: list[bytes], rank_of: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of each sequence of packed ids; its last four are filled up with rank 0."""
    counts = np.array([len(x) // 4 for x in sequences], dtype=np.int64)
    padded = -(-counts // 4) * 4
    first = np.cumsum(padded) - padded
    ranks = np.zeros(int(padded.sum()), dtype="<u4")
    place = np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)
    ranks[place] = rank_of[np.frombuffer(b"".join(sequences), dtype="<u4")]
    widths = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    codes = (widths - 1).reshape(-1, 4)
    control = (codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6).tobytes()
    used = np.arange(4, dtype=np.uint8) < widths[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()
    ends = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    cuts = np.append(first, len(ranks))
    controls = [control[i // 4 : j // 4] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    bounds = ends[cuts].tolist()
    return controls, [data[i:j] for i, j in zip(bounds[:-1], bounds[1:])]


#: Widths of the four numbers of each control byte, and where each of them starts.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
STARTS = np.cumsum(WIDTHS, axis=1) - WIDTHS
TOTALS = WIDTHS.sum(axis=1)
KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def unpack(controls: list[bytes], data: list[bytes], counts: list[int], id_of: np.ndarray) -> list[bytes]:
    """The packed ids of each sequence, by looking up every control byte's widths and starts."""
    codes = np.frombuffer(b"".join(controls), dtype=np.uint8)
    totals = TOTALS[codes]
    at = ((np.cumsum(totals) - totals)[:, None] + STARTS[codes]).ravel()
    raw = np.frombuffer(b"".join(data) + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    number = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24
    found = id_of[number & KEEP[WIDTHS[codes].ravel()]].astype("<u4").tobytes() if len(at) else b""
    starts = 16 * (np.cumsum([0, *map(len, controls)]))[:-1]
    return [found[i : i + 4 * n] for i, n in zip(starts.tolist(), counts)]


def write(docs: DataFrame, path: str, vocab_path: str, end_id: int, text: str = "text") -> None:
    """Tokenize all texts and write the file set at ``path`` in ascending doc_id order.

    Token ids are written once to the shared folder, counted, coded row by row and
    only then moved, as the coded form is the smallest.  Nulls in doc_id come
    first; rows with one doc_id are ordered by checksum, then arrival, which also
    spreads an id that holds many rows over several shards.  Null texts are empty.
    An empty table gives a file set without rows.
    """
    spark = docs.sparkSession
    encoded = staged_small(tokens.encode(docs, vocab_path, end_id, text, counts=True), "ids")
    id_of = frequency_ranks(encoded)
    spark.createDataFrame(
        [(i, int(x)) for i, x in enumerate(id_of)], "rank bigint, id bigint"
    ).coalesce(1).write.parquet(f"{path}/vocabulary")
    rank_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, dtype=np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            controls, data = (pa.array(x, pa.binary()) for x in pack(batch.column(4).to_pylist(), rank_of))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], controls, data], names=["doc_id", "n", "crc", "came", "control", "data"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = encoded.select("doc_id", "n", tokens.with_crc().alias("crc"), F.monotonically_increasing_id().alias("came"), "ids")
    coded = rows.mapInArrow(task, f"doc_id {kind}, n bigint, crc bigint, came bigint, control binary, data binary")
    order = [F.col("doc_id").asc_nulls_first(), F.col("crc"), F.col("came")]
    # The ranges are found by a pass over the rows of their own: they are coded once, before it.
    sorted_rows = staged_small(coded, "coded").repartitionByRange(*order).sortWithinPartitions(*order)
    shards = sorted_rows.select(F.spark_partition_id().alias("shard"), "doc_id", "n", "came", "control", "data")
    shards.write.option("compression", "zstd").parquet(f"{path}/sequences")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n, ids) read back; ``start`` counts all ids of earlier documents."""
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").limit(MOST_IDS + 1).toPandas()
    if len(vocabulary) > MOST_IDS:
        raise ValueError(f"more than {MOST_IDS} distinct ids")
    id_of = vocabulary["id"].to_numpy(dtype=np.uint32)
    files = spark.read.parquet(f"{path}/sequences")
    kind = files.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, control, data = (batch.column(i).to_pylist() for i in (3, 4, 5))
            ids = pa.array(unpack(control, data, n, id_of), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], ids], names=["shard", "doc_id", "came", "n", "ids"])

    ordered = files.select("shard", "doc_id", "came", "n", "control", "data")
    return ordered.mapInArrow(task, f"shard int, doc_id {kind}, came bigint, n bigint, ids binary")


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Replace ``shard`` and ``came`` by ``start``: running sums within shards, and one of the shard totals.

    The totals come from the files' own counts, without decoding anything.
    """
    crc = [c for c in rows.columns if c == "ids_crc32"]
    within = (
        Window.partitionBy("shard")
        .orderBy(F.col("doc_id").asc_nulls_first(), *crc, "came")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumn("start", F.coalesce(F.sum("n").over(within), F.lit(0)))
    # One row per shard: as many as there are shuffle partitions.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("shard").agg(F.sum("n").alias("total"))
    offsets = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return local.join(F.broadcast(offsets), "shard").withColumn("start", F.col("start") + F.col("offset")).drop("offset", "shard", "came")


def report(docs: DataFrame, vocab_path: str, end_id: int = 2) -> DataFrame:
    """Write all documents, read the files back and give start, length and checksum of each."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs.select("doc_id", "text"), path, vocab_path, end_id)
    rows = read(docs.sparkSession, path)
    summed = rows.select("shard", "doc_id", "came", "n", tokens.with_crc().alias("ids_crc32"))
    files = docs.sparkSession.read.parquet(f"{path}/sequences").select("shard", "n")
    return with_starts(summed, files).select("doc_id", "start", F.col("n").alias("n_tokens"), "ids_crc32")
