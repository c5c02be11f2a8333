"""Encoding and decoding with a piece model, by a table of distinct marked chunks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gablework.llm.common import held, text_or_empty

SPACE_MARK = "▁"
#: A run of marks with what follows it; text after a line break; a line break.
CHUNK = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}\n]*|[^{SPACE_MARK}\n]+|\n")
#: Chunks the table of a worker process may hold, some 200 MB; beyond it the table starts anew.
TABLE = 1_000_000


def check_model(processor) -> None:
    """The table is exact only if no piece holds a mark after another character, or a line break."""
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if SPACE_MARK in piece.lstrip(SPACE_MARK) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses a chunk")


class ChunkTable:
    """Ids of texts; each distinct chunk is segmented once while the table holds it."""

    def __init__(self, model_path: str, size: int = TABLE):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=model_path)
        check_model(self.processor)
        self.size = size
        self.ids: dict[str, bytes] = {}
        # A text starts with a mark of its own; that and a line break come before a chunk to be segmented.
        self.lead = len(self.processor.encode("\n"))

    def _segment(self, chunks: list[str]) -> None:
        for chunk, ids in zip(chunks, self.processor.encode([f"\n{c}" for c in chunks], num_threads=1)):
            self.ids[chunk] = np.array(ids[self.lead :], dtype="<u4").tobytes()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Segment the distinct chunks of some texts, then join their ids by place."""
        for i in range(0, len(texts), 100):
            listed = [CHUNK.findall(SPACE_MARK + t.replace(" ", SPACE_MARK)) if t else [] for t in texts[i : i + 100]]
            distinct = set().union(*listed)
            new = [c for c in distinct if c not in self.ids]
            if len(self.ids) + len(new) > self.size:
                self.ids, new = {}, list(distinct)
            self._segment(new)
            for chunks in listed:
                yield b"".join(map(self.ids.__getitem__, chunks))


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): ids of every whole text as little-endian unsigned 32-bit numbers.

    Equal to encoding each text at once, without begin or end ids.  A null or
    empty text has no ids.  One row per input row; ties and repeated rows are
    encoded alike, other columns are ignored, an empty table gives no rows.

    The distinct-chunk table belongs to a worker process.  One table for all would
    have to be joined to every word, and so move every text; see the README.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = held(f"chunks {model_path}", lambda: ChunkTable(model_path))
            ids = pa.array(table(batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    rows = docs.select("doc_id", text_or_empty(text).alias("text"))
    return rows.mapInArrow(task, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, text): the model's own text of the ids."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            texts = [processor.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, f"doc_id {kind}, ids binary, text string")


def report(docs: DataFrame, model_path: str) -> DataFrame:
    """Number and digest of the ids of each text, and digest of the decoded text."""
    decoded = decode(encode(docs, model_path), model_path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal: dict[int, str] = {}
        for batch in batches:
            n, by_ids, by_text = [], [], []
            for packed, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = np.frombuffer(packed, dtype="<u4").tolist()
                for i in set(ids).difference(decimal):
                    decimal[i] = str(i)
                n.append(len(ids))
                by_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                by_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(by_ids), pa.array(by_text)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return decoded.mapInArrow(digest, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
