"""Best-fit packing of tokenized documents into sequences of one size.

The plan is made over a histogram of piece lengths, so the driver handles as many numbers as a
sequence has tokens, however many documents there are. Pieces then take the planned slots by their
rank within their length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import Store, chunks
from tablewright.session import ship_with_tasks

# Tokens of a sequence, and the id that ends a document.
SIZE, END = 2048, 0
# Bytes of text that are tokenized at once, and bytes of different words whose ids a task remembers.
CHUNK, REMEMBERED = 2 << 20, 32 << 20
# Words that the tokenizer gets at once; it keeps about a kilobyte for each until they are read.
AT_ONCE = 2000
# Words of these letters alone are one token of the tokenizer's pattern, and stay so when it
# normalises them; so many go to it in one text, which costs less than as many texts.
_PLAIN, JOINED = "^[a-zß-öø-ÿ]+$", 50
# A letter before one of these marks ends a token of the tokenizer's pattern, in every context.
_CUT = r"(\pL)([,.;:!?])"
# How tokens begin that are found in a text before letters are lower-cased.
_SPECIAL = "<|"


class Words:
    """Token ids of texts, where equal words are tokenized once.

    White space, and the place between a letter and a mark like a full stop, always part tokens of
    a vocabulary of word ends, so the ids of a text are those of its words one after another.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.ends = self._word_ends()
        self._forget()

    def _word_ends(self) -> np.ndarray | None:
        """By id: whether the token ends a word. None if the vocabulary does not tell."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return ends

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.pool = np.empty(0, np.uint32)
        self.begin, self.bytes = np.zeros(1, np.int64), 0

    def _ids(self, texts: list[str], at_once: int) -> Iterator[list[int]]:
        for i in range(0, len(texts), at_once):
            yield from (e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + at_once], add_special_tokens=False))

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        ids = [np.array(i, np.uint32) for i in self._ids(words, AT_ONCE)]
        return np.concatenate([self.pool[:0], *ids]), np.array([len(i) for i in ids], np.int64)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """:meth:`_apart` of plain words, many in a text; None if they do not have one end each."""
        if self.ends is None or not words:
            return None
        texts = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids = np.concatenate([np.array(i, np.uint32) for i in self._ids(texts, AT_ONCE // JOINED)])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or last[-1] != len(ids) - 1:
            return None
        return ids, np.diff(last, prepend=-1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the first of each; null is empty."""
        texts = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), _CUT, r"\1 \2")
        if not pc.any(pc.match_substring(texts, _SPECIAL)).as_py():
            texts = pc.ascii_lower(texts)  # as the tokenizer does, and fewer words differ
        lists = pc.ascii_split_whitespace(texts)
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        if self.bytes > REMEMBERED:
            self._forget()
        known = words.dictionary.to_numpy(zero_copy_only=False)
        slot = np.fromiter(map(self.slot.get, known, repeat(-1)), np.int64, len(known))
        new = np.flatnonzero(slot < 0)
        if len(new):
            plain = pc.match_substring_regex(words.dictionary.take(pa.array(new)), _PLAIN).to_numpy(zero_copy_only=False)
            for at, encode in ((new[plain], self._joined), (new[~plain], self._apart)):
                some = known[at].tolist()
                ids, count = encode(some) or self._apart(some)
                slot[at] = np.arange(len(self.slot), len(self.slot) + len(some))
                self.slot.update(zip(some, slot[at].tolist()))
                self.pool = np.concatenate([self.pool, ids])
                self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(count, dtype=np.int64)])
                self.bytes += sum(map(len, some))
        slots = slot[words.indices.to_numpy(zero_copy_only=False)]
        count = np.diff(self.begin)[slots]
        total = np.concatenate([[0], np.cumsum(count)])
        out = self.pool[np.repeat(self.begin[slots] - total[:-1], count) + np.arange(total[-1])]
        return out, total[first]


def pieces(documents: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", size: int = SIZE, ids: bool = True) -> DataFrame:
    """Token pieces of every document: the id column, ``piece``, ``start``, ``length``, ``ids``, ``ids_crc32``.

    ``tokenizer`` is the content of a tokenizer file. A document is the ids of its whole text, then
    ``END``; a null or empty text is ``END`` alone. Only documents longer than ``size`` are cut, into
    pieces of ``size`` and a last one that may be shorter. ``ids_crc32`` is that of the ids as
    little-endian 32-bit numbers. Other columns are left out; repeated ids and null ids stay. With
    ``ids=False`` the ids themselves are left out. Nothing is shuffled.
    """
    key = documents.select(F.col(id)).schema[0].dataType.simpleString()
    schema = f"`{id}` {key}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(tokenizer)
        for batch in chunks(batches, 1, CHUNK):
            tokens, rows = words.encode(batch.column(1))
            tokens = np.insert(tokens, rows[1:], END).astype("<u4")
            rows = rows + np.arange(len(rows))
            length = np.diff(rows)
            cuts = -(-length // size)
            row = np.repeat(np.arange(len(cuts)), cuts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * size
            part = np.minimum(size, length[row] - start)
            at = np.append(rows[row] + start, len(tokens))
            crc = [zlib.crc32(tokens[a:b]) for a, b in zip(at, at[1:])]
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(part), pa.array(crc, pa.int64())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=[id, "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])])

    return documents.select(id, text).mapInArrow(run, schema)


class Plan(NamedTuple):
    """Slots: ``n`` pieces of ``length`` from rank ``rank`` on, ``each`` a sequence, in the
    sequences from ``first`` on, from ``offset`` on. Sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    n: np.ndarray
    each: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these ranks within their lengths."""
        at = np.searchsorted(self.length << 40 | self.rank, length << 40 | rank, side="right") - 1
        number = rank - self.rank[at]
        return self.first[at] + number // self.each[at], self.offset[at] + number % self.each[at] * length


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Best fit, longest first, over the counts of lengths.

    Every piece goes to the fullest sequence that still has room. Sequences filled alike are
    handled together: of those with the least sufficient room r, each takes r // length pieces.
    The steps depend on the lengths that occur, not on how many pieces have them.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    steps: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 1 <= length <= size:
            raise ValueError(f"a piece of {length} tokens does not fit into {size}")
        for r in range(length, size + 1):
            if not left:
                break
            each = r // length
            if r == size:
                room[size].append((sequences, -(-left // each)))
                sequences += -(-left // each)
            groups, room[r] = room[r], []
            for first, n in groups:
                full = min(n, left // each)
                if full:
                    steps.append((length, rank, full * each, each, first, size - r))
                    room[r - each * length].append((first, full))
                    left, rank, first, n = left - full * each, rank + full * each, first + full, n - full
                if n and left:
                    steps.append((length, rank, left, left, first, size - r))
                    room[r - left * length].append((first, 1))
                    left, rank, first, n = 0, rank + left, first + 1, n - 1
                if n:
                    room[r].append((first, n))
    steps.sort()
    return Plan(*np.array(steps, np.int64).reshape(-1, 6).T, sequences)


def pack(pieces: DataFrame, size: int = SIZE, store: Store | None = None) -> DataFrame:
    """Give every row a ``sequence_id`` and its ``offset`` there; ``length`` (1 to ``size``) is its need.

    Sequences are filled without gaps from offset 0 on. All rows stay, repeated ones too, and so do
    other columns, but columns of the two new names are replaced. A null length, or one out of
    range, is an error. An empty table gives an empty one. Rows move once, by task and length, to
    learn their rank; pass narrow rows.
    """
    spark = pieces.sparkSession
    store = store or Store(spark)
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    task, place = (next(n for n in (f"__{base}{i}" for i in range(len(names) + 1)) if n not in names) for base in ("task", "place"))
    at = names.index("length")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        before = np.zeros(size + 1, np.int64)
        for batch in batches:
            if batch.column(at).null_count:
                raise ValueError("a piece without a length")
            length = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(length) and not (1 <= length.min() and length.max() <= size):
                raise ValueError(f"a piece of less than 1 or more than {size} tokens")
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=size + 1)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts)
            rank += before[length]
            before += counts
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), me, np.int32)), pa.array(rank)], names=[*names, task, place])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema), f"{task} int", f"{place} bigint"])
    rows = store.put(pieces.mapInArrow(number, schema), "pieces")
    counts = store.put(rows.groupBy(task, F.col("length").cast("bigint").alias("length")).agg(F.count("*").alias("n")), "lengths")
    slots = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)
    # A length has as many rows here as there were tasks.
    earlier = Window.partitionBy("length").orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col(task).alias("t"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("b"))
    ranked = rows.join(base, (F.col(task) == F.col("t")) & (F.col("length") == F.col("l"))).select(*names, (F.col(place) + F.col("b")).alias(place))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            where, offset = slots.place(length, batch.column(len(names)).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(where), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema), "sequence_id bigint", "offset bigint"])
    return ranked.mapInArrow(settle, schema)


ship_with_tasks(__name__)
