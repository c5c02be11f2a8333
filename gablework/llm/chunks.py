"""Ids of texts by way of their distinct parts, in Arrow and numpy.

A text is split where no token can cross, equal parts are found by Arrow's
dictionary encoding, each distinct part is segmented once while a worker
remembers it, and the ids are joined back by place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts a worker remembers, and their characters; beyond either it keeps those of the texts at hand.
REMEMBERED, REMEMBERED_CHARS = 300_000, 8_000_000
#: Bytes of text that are worked on together.
TOGETHER = 4 << 20


def gathered(batches: Iterable[pa.RecordBatch], column: int, size: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Batches joined until a text column holds ``size`` bytes, and cut into rows of about that size."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_numpy().astype(np.int64)
        # Rows that start within the same stretch of ``size`` bytes stay together.
        stretch = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            waiting.append(batch.slice(start, end - start))
            held += int(lengths[start:end].sum())
            if held >= size:
                yield pa.concat_batches(waiting)
                waiting, held = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def before_and_total(counts: np.ndarray) -> np.ndarray:
    """0 and the running totals: where each of some parts starts, and where the last one ends."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


#: Of some strings: all ids in order, the number of ids of each string, whether each string's ids are sound.
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


class Segments:
    """Ids of strings by one or more tokenizers, each distinct string segmented once while it is remembered."""

    def __init__(
        self,
        *tokenizers: Callable[[list[str]], Found],
        remembered: int = REMEMBERED,
        remembered_chars: int = REMEMBERED_CHARS,
    ):
        self.tokenizers = tokenizers
        self.remembered, self.remembered_chars = remembered, remembered_chars
        self.known: dict[str, int] = {}
        self.chars = 0
        self.shelves = [_Shelf() for _ in self.tokenizers]

    def _keep(self, names: list[str], place: np.ndarray) -> np.ndarray:
        """Forget all parts but those of ``names`` that are known; their new places."""
        known = np.flatnonzero(place >= 0)
        shelves = [_Shelf() for _ in self.tokenizers]
        for new, old in zip(shelves, self.shelves):
            new.add(0, *old.of(place[known]))
        self.shelves = shelves
        self.known = {names[i]: k for k, i in enumerate(known.tolist())}
        self.chars = sum(map(len, self.known))
        moved = np.full(len(names), -1, dtype=np.int64)
        moved[known] = np.arange(len(known))
        return moved

    def _learn(self, new: list[str]) -> None:
        first = len(self.known)
        for shelf, tokenizer in zip(self.shelves, self.tokenizers):
            shelf.add(first, *tokenizer(new))
        self.known.update(zip(new, range(first, first + len(new))))
        self.chars += sum(map(len, new))

    def of(self, words: pa.DictionaryArray) -> list[Found]:
        """What each tokenizer finds for some dictionary-encoded strings."""
        names = words.dictionary.to_pylist()
        get = self.known.get
        place = np.fromiter([get(w, -1) for w in names], dtype=np.int64, count=len(names))
        new = np.flatnonzero(place < 0)
        if len(self.known) + len(new) > self.remembered or self.chars > self.remembered_chars:
            place = self._keep(names, place)
        if len(new):
            place[new] = len(self.known) + np.arange(len(new))
            self._learn([names[i] for i in new.tolist()])
        each = place[words.indices.to_numpy()]
        return [shelf.of(each) for shelf in self.shelves]


class _Shelf:
    """The ids of one tokenizer, string after string, in arrays that grow."""

    def __init__(self):
        self.ids, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.lengths = np.zeros(1 << 14, dtype=np.int32)
        self.sound = np.ones(1 << 14, dtype=bool)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])

    def add(self, first: int, ids: np.ndarray, counts: np.ndarray, sound: np.ndarray) -> None:
        last, upto = first + len(counts), self.used + len(ids)
        self.ids = self._room(self.ids, upto)
        self.starts, self.lengths, self.sound = (self._room(a, last) for a in (self.starts, self.lengths, self.sound))
        self.ids[self.used : upto] = ids
        self.starts[first:last] = self.used + np.cumsum(counts) - counts
        self.lengths[first:last] = counts
        self.sound[first:last] = sound
        self.used = upto

    def of(self, each: np.ndarray) -> Found:
        counts = self.lengths[each].astype(np.int64)
        return self.ids[spans(self.starts[each], counts)], counts, self.sound[each]


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column that cuts the bytes of ``data`` at ``ends`` (0 first, counted in its entries)."""
    offsets = (ends * data.itemsize).astype(np.int64)
    if offsets[-1] >= 1 << 31:
        raise ValueError("ids of one batch take 2 GB or more")
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(np.ascontiguousarray(data))]
    )
