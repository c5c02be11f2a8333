"""Word-level BPE ids of whole texts."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gablework.llm.chunks import Found, Segments, before_and_total, binaries, gathered
from gablework.llm.common import held, text_or_empty

#: Words encoded by one call, with a mark in between.
BUNDLE = 256
MARK = "\x01"

#: Characters whose lower case and whose split are the same here and in the tokenizer; others make a text uncommon.
UNCOMMON = r"[^\t\n\r\x{20}-\x{7e}\x{a1}-\x{12f}\x{131}-\x{24f}]"
#: A comma or full stop at a word's end that belongs to a run of signs.
RUN = r"[^\pL\pN\s][.,][ \n]"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of the texts whose ids, one after the other, are the texts', and where each text's parts start.

    White space ends a token in any case.  In common text a final comma or full
    stop after a letter or digit is a token of its own, and case does not matter, so
    both are taken off: fewer distinct words are left to encode.
    """
    low = pc.if_else(pc.match_substring_regex(texts, UNCOMMON), texts, pc.utf8_lower(texts))
    whole = pc.or_(pc.match_substring_regex(texts, UNCOMMON), pc.match_substring_regex(low, RUN))
    parted = low
    for sign, apart in ((", ", " , "), (". ", " . "), (".\n", " .\n")):
        parted = pc.replace_substring(parted, sign, apart)
    lines = pc.replace_substring(pc.if_else(whole, low, parted), "\n", " ")
    split = pc.split_pattern(lines, " ")
    offsets = split.offsets.to_numpy()
    return split.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


class WordEncoder:
    """Ids of texts, each distinct word encoded once as long as it is remembered.

    The tokenizer drops white space and splits on it, so the ids of a text are
    those of its words in order.  New words are encoded in bundles with a mark
    between them, whose id shows where a word ends.
    """

    def __init__(self, vocab_path: str, **memory: int):
        # One thread a task: the cores are Spark's to share out.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocab_path)
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.words = Segments(self._segment, **memory)

    def _segment(self, words: list[str]) -> Found:
        """Ids of new words; one that holds the mark itself is encoded alone."""
        marked = [i for i, w in enumerate(words) if MARK in w]
        alone = {i: self.tokenizer.encode(words[i], add_special_tokens=False).ids for i in marked}
        plain = ["" if i in alone else w for i, w in enumerate(words)] if alone else words
        between = f" {MARK} "
        bundles = [between.join(plain[i : i + BUNDLE]) + between for i in range(0, len(plain), BUNDLE)]
        found = self.tokenizer.encode_batch_fast(bundles, add_special_tokens=False)
        ids = np.concatenate([np.array(f.ids, dtype=np.uint32) for f in found]) if found else np.zeros(0, dtype=np.uint32)
        ends = np.flatnonzero(ids == self.mark)
        counts = np.diff(ends, prepend=-1) - 1
        ids = ids[ids != self.mark]
        if alone:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, own in alone.items():
                parts[i], counts[i] = np.array(own, dtype=np.uint32), len(own)
            ids = np.concatenate(parts)
        return ids, counts, np.ones(len(words), dtype=bool)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the number of ids of each."""
        words, first = words_of(texts)
        ((ids, counts, _),) = self.words.of(words.dictionary_encode())
        return ids, np.diff(before_and_total(counts)[first])


def encode(docs: DataFrame, vocab_path: str, end_id: int, text: str = "text", counts: bool = False) -> DataFrame:
    """(doc_id, n, ids): ids as little-endian unsigned 32-bit numbers, ``end_id`` last.

    With ``counts`` a fourth column: in one row of each group of texts that were encoded
    together how often each id occurs in them (an id and its count, as 64-bit numbers), else null.

    One row per input row, in no special order.  A null or empty text has the
    end id alone.  Rows never move; a worker holds some 4 MB of text, or one
    longer text, with its ids, and a bounded memory of words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 1):
            encoder = held(f"words {vocab_path}", lambda: WordEncoder(vocab_path))
            found, lengths = encoder(batch.column(1))
            ids = np.full(len(found) + len(lengths), end_id, dtype="<u4")
            ids[np.arange(len(found)) + np.repeat(np.arange(len(lengths)), lengths)] = found
            n = lengths + 1
            columns = {"doc_id": batch.column(0), "n": pa.array(n), "ids": binaries(ids, before_and_total(n))}
            if counts and len(n):
                often = np.bincount(ids)
                met = np.flatnonzero(often)
                columns["counts"] = pa.array([np.stack([met, often[met]], axis=1).astype("<i8").tobytes(), *[None] * (len(n) - 1)], pa.binary())
            elif counts:
                columns["counts"] = pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select("doc_id", text_or_empty(text).alias("text"))
    return rows.mapInArrow(task, f"doc_id {kind}, n bigint, ids binary" + (", counts binary" if counts else ""))


def with_crc(ids: str = "ids"):
    """Unsigned crc32 of packed ids."""
    return F.crc32(F.col(ids))
