"""Alignment of two tokenizers' tokens by the bytes they cover.

Both token sequences of a text cover the same bytes.  Where tokens of both end at one
byte, the text can be cut; between two cuts lies a group.  Cuts are found by
halving: bisection looks for a common end near the middle of an interval, and
both halves are treated alike until no cut is left.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gablework.llm.chunks import Segments, before_and_total, gathered, spans
from gablework.llm.common import held, staged_small, text_or_empty

SPACE_MARK = "▁"
#: White space other than the space, as Unicode has it (a fixed set).
OTHER_SPACE = (
    r"[\x{09}-\x{0D}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
#: Texts in which parting at spaces could part a token: runs of spaces, a last one,
#: a space between other white space, a literal mark.
IRREGULAR = rf"  | $|{OTHER_SPACE} {OTHER_SPACE}|\x{{2581}}"
#: Parts that are encoded alone: empty ones, and those with white space or a mark.
SPACED = rf"^$|[ \x{{2581}}]|{OTHER_SPACE}"
#: Ends on each side of the middle that the first bisection tries; each further one tries four times as many.
NEAR = 1
#: Words encoded together, and bytes of text in a block of documents.
BUNDLE, BLOCK = 256, 1 << 20


@cache
def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones are
    themselves, the rest follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: byte-level BPE of a text with a space before it."""

    def __init__(self, path: str):
        # One thread a task: the cores are Spark's to share out.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        special = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (1 + max(special.values()))
        symbols = byte_of_symbol()
        for entry, i in vocabulary.items():
            if all(s in symbols for s in entry):
                self.bytes[i] = bytes(symbols[s] for s in entry)

    def segment(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a piece model, which puts a space before the text by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            if self.processor.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                if SPACE_MARK in piece.lstrip(SPACE_MARK):
                    raise ValueError(f"piece {piece!r} crosses a space")
                self.bytes.append(piece.replace(SPACE_MARK, " ").encode())

    def segment(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


class Side:
    """One tokenizer, and the bytes of its ids."""

    def __init__(self, tokenizer):
        self.tokenizer, self.table = tokenizer, tokenizer.bytes
        self.widths = np.array([len(b) for b in self.table], dtype=np.int64)

    def _apart(self, texts: list[str]) -> tuple[list[np.ndarray], list[int], list[bool]]:
        """Ids, their number and their soundness of texts that are encoded one by one."""
        found = self.tokenizer.segment(texts)
        sound = [b"".join([self.table[i] for i in ids]) == b" " + t.encode() for t, ids in zip(texts, found)]
        return [np.array(ids, dtype=np.uint32) for ids in found], [len(ids) for ids in found], sound

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words without white space are encoded some together, with spaces between, and told apart by their bytes."""
        plain = pc.invert(pc.match_substring_regex(pa.array(words, pa.string()), SPACED)).to_numpy(zero_copy_only=False)
        order, ids, counts, sound = [], [], [], []
        together = np.flatnonzero(plain).tolist()
        bundles = [together[i : i + BUNDLE] for i in range(0, len(together), BUNDLE)]
        joined = [" ".join([words[i] for i in b]) for b in bundles]
        for bundle, text, found in zip(bundles, joined, self.tokenizer.segment(joined)):
            found = np.array(found, dtype=np.uint32)
            widths = np.cumsum([1 + len(words[i].encode()) for i in bundle])
            reached = np.cumsum(self.widths[found])
            ends = np.searchsorted(reached, widths) + 1
            whole = len(found) == ends[-1] and (reached[ends - 1] == widths).all()
            order += bundle
            if whole and b"".join(map(self.table.__getitem__, found.tolist())) == b" " + text.encode():
                ids.append(found)
                counts += np.diff(ends, prepend=0).tolist()
                sound += [True] * len(bundle)
            else:
                for own, more in zip((ids, counts, sound), self._apart([words[i] for i in bundle])):
                    own += more
        alone = np.flatnonzero(~plain).tolist()
        order += alone
        for own, more in zip((ids, counts, sound), self._apart([words[i] for i in alone])):
            own += more
        # Back into the order of the words.
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
        counts = np.array(counts, dtype=np.int64)
        back = np.argsort(order)
        starts = np.cumsum(counts) - counts
        return flat[spans(starts[back], counts[back])], counts[back], np.array(sound, dtype=bool)[back]


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A end, by bisection, the B token that reaches it, and whether that ends there too."""
    if not len(a_ends):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    at = np.searchsorted(b_ends, a_ends)
    return at, b_ends[at] == a_ends


def halved(at: np.ndarray, common: np.ndarray, a_parts: np.ndarray, b_parts: np.ndarray) -> np.ndarray:
    """The leaf groups of many texts as rows (first A, end A, first B, end B), in order.

    ``at`` and ``common`` come from :func:`shared_ends`; ``a_parts`` and ``b_parts`` give where each
    text's tokens start (and the last one's end).  All open intervals take a
    step together: one with a common end near its middle is cut there and both
    halves stay open, one that has none at all becomes a leaf, and others look further
    from their middle.
    """
    some = np.diff(a_parts) > 0
    a0, a1, b0, b1 = a_parts[:-1][some], a_parts[1:][some], b_parts[:-1][some], b_parts[1:][some]
    reach = np.full(len(a0), NEAR, dtype=np.int64)
    leaves: list[list[np.ndarray]] = [[a0[:0], a1[:0], b0[:0], b1[:0]]]
    none = np.iinfo(np.int64).max
    while len(a0):
        single = (a1 - a0 == 1) | (b1 - b0 == 1)
        leaves.append([x[single] for x in (a0, a1, b0, b1)])
        a0, a1, b0, b1, reach = (x[~single] for x in (a0, a1, b0, b1, reach))
        if not len(a0):
            break
        # The last end of an interval is common but no cut; the others are tried.
        middle = (a0 + a1 - 2) >> 1
        low, high = np.maximum(a0, middle - reach), np.minimum(a1 - 2, middle + reach)
        counts = high - low + 1
        first = np.cumsum(counts) - counts
        tried = spans(low, counts)
        away = 2 * (tried - np.repeat(middle, counts))
        away = np.where(common[tried], np.where(away < 0, 1 - away, away), none)
        nearest = np.minimum.reduceat(away, first)
        found = nearest != none
        tried_out = ~found & (low == a0) & (high == a1 - 2)
        leaves.append([x[tried_out] for x in (a0, a1, b0, b1)])
        near = nearest[found]
        cut = middle[found] + np.where(near & 1, -(near >> 1), near >> 1)
        cut, cut_b = cut + 1, at[cut] + 1
        wider = ~found & ~tried_out
        reach = np.concatenate([np.full(2 * len(cut), NEAR, dtype=np.int64), 4 * reach[wider]])
        a0, a1, b0, b1 = (
            np.concatenate([a0[found], cut, a0[wider]]),
            np.concatenate([cut, a1[found], a1[wider]]),
            np.concatenate([b0[found], cut_b, b0[wider]]),
            np.concatenate([cut_b, b1[found], b1[wider]]),
        )
    groups = [np.concatenate(x) for x in zip(*leaves)]
    order = np.argsort(groups[0], kind="stable")
    return np.stack([x[order] for x in groups], axis=1)


def overlaps(at: np.ndarray, common: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The A and the B token of every overlap, in order: one lies before each end of either side."""
    n_a = len(at)
    shared = np.cumsum(common)
    place = np.arange(n_a) + at - (shared - common)
    total = n_a + n_b - (int(shared[-1]) if n_a else 0)
    is_a = np.zeros(total, dtype=bool)
    is_a[place] = True
    is_b = ~is_a
    is_b[place[common]] = True
    return np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b


class Aligner:
    """Groups and links of texts; each distinct part is encoded once while remembered."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Side(ByteLevel(a_path)), Side(Pieces(b_path))
        self.parts = Segments(self.a.segment, self.b.segment)
        ids = range(max(len(self.a.table), len(self.b.table)))
        self.signed = pa.array([f"{i}{sign}" for i in ids for sign in ",|;"], pa.large_string())

    def _parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """What is encoded at once, and where each text's parts start: parted at spaces, or whole."""
        padded = pc.binary_join_element_wise("", texts, " ")  # a text with a space before it
        odd = pc.match_substring_regex(padded, IRREGULAR).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy()
        flat = split.values.slice(offsets[0], offsets[-1] - offsets[0])
        starts = offsets - offsets[0]
        if not odd.any():
            return flat, starts
        lengths = np.where(odd, 1, np.diff(starts))
        first = before_and_total(lengths)
        # Odd texts stand behind the parts of all texts.
        behind = np.full(len(odd), len(flat), dtype=np.int64) + np.cumsum(odd) - odd
        take = np.repeat(np.where(odd, behind, starts[:-1]) - first[:-1], lengths) + np.arange(first[-1])
        return pa.concat_arrays([flat, texts.filter(pa.array(odd))]).take(pa.array(take)), first

    def __call__(self, texts: pa.Array) -> dict[str, np.ndarray | list]:
        """Figures of each text, and the id pairs linked in it (``pairs``, by index, with how often).

        ``texts`` has no nulls; texts that are empty or whose bytes do not come out have no tokens.
        """
        n = len(texts)
        words, first = self._parts(texts)
        (a_ids, a_counts, a_sound), (b_ids, b_counts, b_sound) = self.parts.of(words.dictionary_encode())
        faults = np.diff(before_and_total(~(a_sound & b_sound))[first])
        a_counts, b_counts = (np.diff(before_and_total(c)[first]) for c in (a_counts, b_counts))
        fine = (faults == 0) & (pc.binary_length(texts).to_numpy() > 0)
        if not fine.all():
            a_ids, b_ids = a_ids[np.repeat(fine, a_counts)], b_ids[np.repeat(fine, b_counts)]
            a_counts, b_counts = a_counts * fine, b_counts * fine
        a_parts, b_parts = before_and_total(a_counts), before_and_total(b_counts)
        at, common = shared_ends(np.cumsum(self.a.widths[a_ids]), np.cumsum(self.b.widths[b_ids]))
        groups = halved(at, common, a_parts, b_parts)
        at_a, at_b = overlaps(at, common, len(b_ids))
        coded = pa.array(a_ids[at_a].astype(np.int64) << 32 | b_ids[at_b]).dictionary_encode()
        pairs, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        n_links = a_counts + b_counts - np.diff(before_and_total(common)[a_parts])
        text_of = np.repeat(np.arange(n), n_links)
        cells, times = np.unique(text_of * max(1, len(pairs)) + which, return_counts=True)
        cell_text, cell_pair = np.divmod(cells, max(1, len(pairs)))
        return {
            "n_a": a_counts,
            "n_b": b_counts,
            "n_groups": np.diff(np.searchsorted(groups[:, 0], a_parts)),
            "n_links": n_links,
            "groups_sha256": self._digests(a_ids, b_ids, a_parts, b_parts, groups),
            "pairs": pairs,
            "holding": np.bincount(cell_pair, minlength=len(pairs)),
            "per_text": np.bincount(cell_text, minlength=n),
            "cell_pair": cell_pair,
            "times": times,
        }

    def written(self, a_ids, b_ids, groups: np.ndarray) -> pa.LargeStringArray:
        """``a1,a2|b1;`` in parts: each id with the sign after it, A before B in each group."""
        a0, a1, b0, b1 = groups.T
        a_sign, b_sign = np.zeros(len(a_ids), dtype=np.int64), np.zeros(len(b_ids), dtype=np.int64)
        a_sign[a1 - 1], b_sign[b1 - 1] = 1, 2
        place_a = np.arange(len(a_ids)) + np.repeat(b0, a1 - a0)
        place_b = np.arange(len(b_ids)) + np.repeat(a1, b1 - b0)
        keys = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        keys[place_a], keys[place_b] = 3 * a_ids.astype(np.int64) + a_sign, 3 * b_ids.astype(np.int64) + b_sign
        return self.signed.take(pa.array(keys))

    def _digests(self, a_ids, b_ids, a_parts, b_parts, groups) -> list[str]:
        if not len(groups):
            return [""] * (len(a_parts) - 1)
        parts = self.written(a_ids, b_ids, groups)
        _, offsets, data = parts.buffers()
        bounds = np.frombuffer(offsets, dtype="<i8")[a_parts + b_parts].tolist()
        whole = memoryview(data)
        # The last sign of a text is not part of it.
        return [hashlib.sha256(whole[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(bounds[:-1], bounds[1:])]


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Blocks of aligned documents: figures per document, and the block's distinct linked id pairs.

    A block holds documents of 1 to 2 MB of text, or one longer document.  For
    each of its id pairs (A id in the upper, B id in the lower 32 bits) it says how many
    of its documents hold it linked; for each document which pairs, and how often.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    figures = ("n_a", "n_b", "n_groups", "n_links")
    fields = ", ".join(f"{f} array<bigint>" for f in figures)
    schema = (
        f"block string, doc_id array<{kind}>, {fields}, groups_sha256 array<string>, "
        "pairs array<bigint>, holding array<bigint>, per_text array<bigint>, steps binary, times binary"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(gathered(batches, 1, BLOCK)):
            aligner = held(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))
            found = aligner(batch.column(1))
            # Places of pairs rise within a document: their steps are small and pack well.
            steps = np.diff(found["cell_pair"], prepend=0).astype("<i4")
            row = {
                "block": f"{part}-{number}",
                "doc_id": batch.column(0),
                **{f: found[f] for f in figures},
                "groups_sha256": found["groups_sha256"],
                "pairs": found["pairs"],
                "holding": found["holding"],
                "per_text": found["per_text"],
                "steps": steps.tobytes(),
                "times": found["times"].astype("<u4").tobytes(),
            }
            columns = []
            for name, value in row.items():
                if isinstance(value, np.ndarray):
                    value = pa.array(value.astype(np.int64))
                elif isinstance(value, list):
                    value = pa.array(value, pa.string())
                if isinstance(value, pa.Array):
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value))
                else:
                    columns.append(pa.array([value], pa.binary() if isinstance(value, bytes) else pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=list(row))

    return docs.select("doc_id", text_or_empty(text).alias("text")).mapInArrow(task, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold an id pair linked, and whether no pair of its A id has more.

    Blocks have added up their documents before anything moves.
    """
    counted = blocks.select(F.explode(F.arrays_zip("pairs", "holding")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holding").alias("n"))
    counted = counted.withColumn("a", F.shiftright("pair", 32))
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Tokens, groups and links of every whole text, weighed by the corpus-wide counts of linked id pairs.

    Null and empty texts, and texts whose tokens do not give their bytes back, have zeros
    and an empty digest.  Rows count one by one: repeated rows and rows with
    a null or shared doc_id are documents of their own.  Equal counts are all best.  Other columns are
    ignored, an empty table gives no rows.  A worker holds 1 to 2 MB of text or one
    document, with its tokens.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = staged_small(align(docs, a_path, b_path), "aligned")
    counts = pair_counts(blocks.select("pairs", "holding"))
    # A pair stands once in a block: common pairs are no hot keys here.
    wanted = blocks.select(F.col("block").alias("owner"), F.posexplode("pairs").alias("at", "pair"))
    known = wanted.join(counts, "pair").select("owner", "at", "n", "best")
    figures = ["n_a", "n_b", "n_groups", "n_links"]
    names = ["doc_id", *figures, "n_best", "count_sum", "groups_sha256"]

    def weigh(found: pa.Table, block: pa.Table) -> pa.Table:
        parts = []
        for i in range(block.num_rows):
            row = {c: block.column(c).combine_chunks()[i] for c in block.column_names}
            steps = np.frombuffer(row["steps"].as_buffer(), dtype="<i4").astype(np.int64)
            times = np.frombuffer(row["times"].as_buffer(), dtype="<u4").astype(np.int64)
            at = found.column("at").to_numpy()
            n, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
            n[at], best[at] = found.column("n").to_numpy(), found.column("best").to_numpy()
            place = np.cumsum(steps)
            ends = before_and_total(row["per_text"].values.to_numpy())
            sums = [np.diff(before_and_total(v[place] * times)[ends]) for v in (best, n)]
            columns = [row["doc_id"].values, *[row[f].values for f in figures], *map(pa.array, sums), row["groups_sha256"].values]
            parts.append(pa.Table.from_arrays(columns, names=names))
        return pa.concat_tables(parts)

    schema = f"doc_id {kind}, " + ", ".join(f"{f} bigint" for f in [*figures, "n_best", "count_sum"]) + ", groups_sha256 string"
    done = known.groupBy("owner").cogroup(blocks.drop("pairs", "holding").groupBy("block")).applyInArrow(weigh, schema)
    return done.select("doc_id", *figures, "n_best", "count_sum", "groups_sha256")
