"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes decides where a chunk ends: at block size 2^k, where its
low k bits are zero, so the boundaries of a coarse block size are some of those of a finer one. A
fingerprint holds the chunk signatures at two neighbouring block sizes; fingerprints are compared
by edit distance at a block size that both have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import Powers, Store, mix
from tablewright.session import ship_with_tasks

WINDOW = 7
# The block size is the largest one for which so many chunks are expected, so that an edit which
# keeps the length keeps the block size; the finest has chunks of two bytes.
CHUNKS, FINEST = 32, 1
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def fingerprint(data: bytes, powers: Powers) -> str:
    """``k:signature:signature at k + 1``; every chunk is two letters.

    Equal bytes have equal fingerprints. Every chunk is kept: a text of one repeated word or line can
    have many more than ``CHUNKS``, at most one a byte. Empty bytes give ``1::``.
    """
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    padded = np.zeros(n + WINDOW - 1, np.uint64)
    padded[WINDOW - 1 :] = raw.astype(np.uint64) + np.uint64(1)
    rolling = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        rolling += padded[i : i + n] * np.uint64(pow(0x100000001B3, i + 1, 1 << 64))
    rolling = mix(rolling)
    low = rolling & (~rolling + np.uint64(1))
    levels = np.bitwise_count(low - np.uint64(1))
    k = max(FINEST, (n // CHUNKS).bit_length() - 1)
    prefix = powers.prefix(raw)
    return f"{k}:{_signature(levels >= k, prefix, powers)}:{_signature(levels > k, prefix, powers)}"


def _signature(boundary: np.ndarray, prefix: np.ndarray, powers: Powers) -> str:
    ends = np.flatnonzero(boundary) + 1
    if not len(ends) or ends[-1] < len(boundary):
        ends = np.append(ends, len(boundary))
    starts = np.concatenate([[0], ends[:-1]])
    keep = ends > starts
    symbols = powers.between(prefix, starts[keep], ends[keep]) >> np.uint64(52)
    return ALPHABET[np.stack([symbols >> np.uint64(6), symbols & np.uint64(63)], axis=1)].tobytes().decode()


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a machine word of rows at a time.

    Symbols of one side only are in no common subsequence, and an equal beginning or end is in a
    longest one: without them, long repetitive signatures are mostly short.
    """
    both = set(a) & set(b)
    a, b = sorted(([x for x in side if x in both] for side in (a, b)), key=len)
    least = len(a)
    head = next((i for i in range(least) if a[i] != b[i]), least)
    tail = next((i for i in range(least - head) if a[-1 - i] != b[-1 - i]), least - head)
    a, b = a[head : least - tail], b[head : len(b) - tail]
    places: dict[str, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    free = full
    for x in a:
        hit = free & places.get(x, 0)
        free = (free + hit | free - hit) & full
    return head + tail + len(b) - free.bit_count()


def likeness(first: str, second: str) -> float:
    """1 minus the edit distance (insert, delete) over the length of both signatures.

    The better of the block sizes that both have; 0 without one, 1 for equal fingerprints.
    """
    if first == second:
        return 1.0
    sides = []
    for text in (first, second):
        k, fine, coarse = text.split(":")
        sides.append({int(k): fine, int(k) + 1: coarse})
    best = 0.0
    for k in sides[0].keys() & sides[1].keys():
        a, b = ([s[k][i : i + 2] for i in range(0, len(s[k]), 2)] for s in sides)
        if a or b:
            best = max(best, 2 * _common(a, b) / (len(a) + len(b)))
    return best


def edited(text: str, following: str) -> str:
    """``text`` with its last third of code points replaced by as many first ones of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _row(doc, text: str, own: str, following: str, next_print: str, powers: Powers) -> tuple:
    changed = edited(text, following).encode()
    other = fingerprint(changed, powers)
    return doc, len(text), hashlib.sha256(changed).hexdigest(), own, other, likeness(own, other), likeness(own, next_print)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows), kinds)], names=names)


_NAMES = [x.split()[0] for x in _RESULT.split(", ")]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint the sorted rows of a task, each with the row after it.

    The first row is marked with its text, and so is the last, whose next row is in another task.
    """
    names, kinds = [*_NAMES, "part", "head", "open"], [*_KINDS, pa.int32(), pa.string(), pa.string()]
    powers, part, held, first, rows = Powers(), TaskContext.get().partitionId(), None, None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                text = text or ""
                own = fingerprint(text.encode(), powers)
                if held is not None:
                    rows.append((*_row(held[0], held[1], held[2], text, own, powers), part, first, None))
                    first = None
                else:
                    first = text
                held = doc, text, own
            if rows:
                yield _batch(rows, names, kinds)
                rows = []
    if held is not None:
        yield _batch([(held[0], None, None, held[2], None, None, None, part, first, held[1])], names, kinds)


def _at_seam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for i in range(batch.num_rows):
            doc, text, own, following = (batch.column(c)[i].as_py() for c in range(4))
            yield _batch([_row(doc, text, own, following, fingerprint(following.encode(), powers), powers)], _NAMES, _KINDS)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprint every document and its edited text, and compare it with both and its successor.

    ``documents`` has ``doc_id`` and ``text``; other columns are ignored. The order is descending
    ``doc_id``, nulls last, equal ids by the hash of their text; the last row's successor is the
    first. A null text is empty; an empty table gives no rows; a single row follows itself.

    Texts are shuffled once, into ranges of ids; only a task's first and last text travel again.
    """
    store = Store(documents.sparkSession)
    ranged = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(F.col("doc_id").desc_nulls_last(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "tie")
        .select("doc_id", "text")
    )
    done = store.put(ranged.mapInArrow(_in_order, f"{_RESULT}, part int, head string, open string"), "prints")
    # One row a task from here on.
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = done.where("head IS NOT NULL").select("part", "head")
    following = heads.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(whole)).alias("after"))
    seams = (
        done.where("open IS NOT NULL").join(following, "part")
        .join(heads.select(F.col("part").alias("after"), "head").alias("h"), "after")
        .select("doc_id", "open", "fingerprint", F.col("h.head"))
        .mapInArrow(_at_seam, _RESULT)
    )
    return done.where("open IS NULL").select(*_NAMES).unionByName(seams)


ship_with_tasks(__name__)
