"""Suffix-array dedup: remove every byte of a long string that also starts earlier.

A string of ``LENGTH`` bytes that occurs twice holds the same anchor at the same place both times:
the 32 bytes with the smallest hash in it. Anchors that occur once in the whole corpus rule out all
strings around them. The stretches around the other anchors go, by anchor, to shards. A shard sorts
its suffixes by Larsson-Sadakane refinement (ranks double their depth, only unsorted groups are
sorted again), takes common prefixes by Kasai's rule, and keeps the earliest of each equal string.
An anchor with very many occurrences is dealt to several shards, whose earliest strings are merged
by binary search. All of it is exact: hashes only route, except for the merge, which compares
128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Powers, Store, chunks, free_name, mix, text_bytes
from tablewright.session import ship_with_tasks

LENGTH, GRAM = 100, 32
# Strings of LENGTH bytes have so many places for a gram.
PLACES = LENGTH - GRAM + 1
# Occurrences of an anchor in one shard, and bytes that a shard sorts at once.
SPREAD, SHARD_BYTES = 4096, 1 << 19
# Bytes of text whose grams are hashed at once, so few that they stay in the cache.
CHUNK = 1 << 17
LAST = (1 << 63) - 1


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with the same anchor: (first start, last start, anchor, anchor's hash)."""
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n + 1, 8), (1, 1))
    words = np.ascontiguousarray(words).view("<u8").ravel()
    grams = n - GRAM + 1
    value = np.zeros(grams, np.uint64)
    for i in range(0, GRAM, 8):
        value ^= mix(words[i : i + grams] + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64)))
        value *= np.uint64(0xFF51AFD7ED558CCD)
    value = mix(value)
    # Leftmost smallest of PLACES neighbours, by doubling.
    least, where = value, np.arange(grams, dtype=np.int32)
    span = 1
    while span < PLACES:
        step = min(span, PLACES - span)
        left, right = least[:-step], least[step:]
        first = left <= right
        where = np.where(first, where[:-step], where[step:])
        least = np.where(first, left, right)
        span += step
    starts = np.arange(n - LENGTH + 1)
    row_end = np.repeat(offsets[1:], np.diff(offsets))[: len(starts)]
    valid = starts + LENGTH <= row_end
    change = np.ones(len(starts), bool)
    change[1:] = (where[1:] != where[:-1]) | ~valid[:-1]
    change &= valid
    begin = np.flatnonzero(change)
    if not len(begin):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    stop = np.ones(len(starts), bool)
    stop[:-1] = change[1:] | ~valid[1:]
    end = np.flatnonzero(stop & valid)
    at = where[begin].astype(np.int64)
    return begin, end, at, value[at]


def suffix_ranks(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of the first ``LENGTH`` bytes at every position, by Larsson-Sadakane refinement.

    ``ends`` is the end of the stretch of each position. Equal strings have equal ranks; a position
    with fewer bytes left has a rank that is good for shorter comparisons only.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))).view(">u8").ravel().astype(np.uint64)
    left = ends - np.arange(n)
    tail = np.flatnonzero(left < 8)
    key[tail] &= ~((np.uint64(1) << ((8 - left[tail]) * 8).astype(np.uint64)) - np.uint64(1))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[order] = group
    depth = 8
    while depth < LENGTH:
        step = min(depth, LENGTH - depth)
        # Only groups of several positions go on, and only positions with enough bytes left.
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        open_ = np.repeat(size > 1, size)
        order, group = order[open_], group[open_]
        inside = left[order] >= depth + step
        order, group = order[inside], group[inside]
        if not len(order):
            break
        second = rank[order + step]
        by = np.lexsort((second, group))
        order, group, second = order[by], group[by], second[by]
        new = np.ones(len(order), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        base = np.repeat(head, np.diff(np.append(head, len(order))))
        group = group + (np.flatnonzero(new)[np.cumsum(new) - 1] - base)
        rank[order] = group
        depth += step
    return rank


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of every suffix in ``order`` with the one before it, by Kasai's rule.

    Going through the text, a suffix shares one byte less with its predecessor than the suffix one
    position earlier did with its own, if both predecessors are neighbours, too. Only where such a
    chain begins are bytes compared, all of them at once.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    chained = np.zeros(n, bool)
    chained[1:] = (before[1:] >= 0) & (before[:-1] >= 0) & (before[1:] == before[:-1] + 1) & (ends[1:] == ends[:-1])
    first = np.flatnonzero((before >= 0) & ~chained)
    shared = np.zeros(n, np.int64)
    room = np.minimum(ends[first] - first, ends[before[first]] - before[first])
    for a in range(0, len(first), 1 << 14):
        part, limit = first[a : a + (1 << 14)], room[a : a + (1 << 14)]
        width = int(limit.max(initial=0))
        step = np.arange(width)
        mine = np.minimum(part[:, None] + step, n - 1)
        theirs = np.minimum(before[part][:, None] + step, n - 1)
        equal = (data[mine] == data[theirs]) & (step < limit[:, None])
        shared[part] = np.where(equal.all(1), width, np.argmin(equal, 1)) if width else 0
        shared[part] = np.minimum(shared[part], limit)
    link = np.maximum.accumulate(np.where(chained, 0, np.arange(n)))
    chain = np.flatnonzero(chained)
    shared[chain] = np.maximum(shared[link[chain]] - (chain - link[chain]), 0)
    return shared[order]


_KEYS = "id long, tie long"
_COUNTED = f"h long, {_KEYS}, pos long"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, 2, CHUNK):
        data, offsets = text_bytes(batch.column(2))
        _, _, at, value = anchors(data, offsets)
        row = np.searchsorted(offsets, at, side="right") - 1
        rows = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(value.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at - offsets[row])],
            names=["h", "id", "tie", "pos"],
        )


def _stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each repeated anchor, of a task's texts."""
    unpack = zstandard.ZstdDecompressor()

    def cut(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        raw = b"".join(texts)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        lists = part.column(3)
        wanted = lists.flatten()
        whose = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
        places = wanted.field("pos").to_numpy() + offsets[whose]
        parts = wanted.field("parts").to_numpy()
        by = np.argsort(places, kind="stable")
        places, parts = places[by], parts[by]
        begin, end, at, value = anchors(np.frombuffer(raw, np.uint8), offsets)
        near = np.minimum(np.searchsorted(places, at), len(places) - 1)
        hit = np.flatnonzero(places[near] == at)
        parts, begin, end, value = parts[near[hit]], begin[hit], end[hit] + LENGTH, value[hit]
        row = np.searchsorted(offsets, begin, side="right") - 1
        rows = pa.array(row)
        keys = (part.column(0).to_numpy() ^ part.column(1).to_numpy()) & 0x7FFFFFFF
        return pa.RecordBatch.from_arrays(
            [
                pa.array(value.view(np.int64)), pa.array((keys[row] % np.maximum(parts, 1)).astype(np.int32)), pa.array(parts > 1),
                part.column(0).take(rows), part.column(1).take(rows), pa.array(begin - offsets[row]),
                pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
            ],
            names=["h", "part", "shared", "id", "tie", "start", "bytes"],
        )

    for batch in batches:
        texts, size, first = [], 0, 0
        for i, z in enumerate(batch.column(2).to_pylist()):
            texts.append(unpack.decompress(z))
            size += len(texts[-1])
            if size >= CHUNK:
                yield cut(batch.slice(first, i + 1 - first), texts)
                texts, size, first = [], 0, i + 1
        if texts:
            yield cut(batch.slice(first), texts)


_MARK = f"{_KEYS}, first long, last long, d1 long, d2 long"


def _resolve(table: pa.Table, powers: Powers) -> pa.RecordBatch:
    """Within a shard: windows that start earlier elsewhere, as runs; and what others must know."""
    table = table.combine_chunks()
    shared, ids, ties, start = (table.column(c).to_numpy() for c in ("shared", "id", "tie", "start"))
    # Stretches by (document, place): equal ones, of a repeated row, count as one.
    by = np.lexsort((start, ties, ids))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (ids[by][1:] != ids[by][:-1]) | (ties[by][1:] != ties[by][:-1]) | (start[by][1:] != start[by][:-1])
    place = np.empty(len(by), np.int64)
    place[by] = np.cumsum(fresh)
    # Of stretches with equal bytes only the earliest is sorted; the others go whole.
    codes = table.column("bytes").combine_chunks().dictionary_encode()
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    code = codes.indices.to_numpy()
    eldest = np.full(len(codes.dictionary), -1, np.int64)
    eldest[code[by][::-1]] = by[::-1]
    copies = np.flatnonzero(place > place[eldest[code]])
    size = np.diff(text_bytes(codes.dictionary)[1])[code[copies]]
    copied = (ids[copies], ties[copies], start[copies], start[copies] + size - LENGTH)
    # Equal strings have the same anchor: a stretch that is alone with its anchor holds none.
    _, which, number = np.unique(table.column("h").to_numpy()[eldest], return_inverse=True, return_counts=True)
    several = np.flatnonzero((number[which] > 1) | shared[eldest])
    eldest = eldest[several]
    data, at = text_bytes(codes.dictionary.take(pa.array(several)))
    shared, ids, ties, start, place = (x[eldest] for x in (shared, ids, ties, start, place))
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    ends = at[1:][row]
    rank = suffix_ranks(data, ends)
    windows = np.flatnonzero(ends - np.arange(len(data)) >= LENGTH)
    age = (place[row[windows]] << 32) + (windows - at[:-1][row[windows]])
    order = windows[np.lexsort((age, rank[windows]))]
    age_of = np.zeros(len(data), np.int64)
    age_of[windows] = age
    same = common_prefixes(data, ends, order) >= LENGTH
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    later = age_of[order] > age_of[order[lead]]
    gone = np.sort(order[later])
    cut = np.ones(len(gone), bool)
    cut[1:] = (gone[1:] != gone[:-1] + 1) | (row[gone[1:]] != row[gone[:-1]])
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(gone)) - 1
    tail = tail[: len(head)]
    first, last = gone[head], gone[tail]
    r = row[first]
    base = start[r] - at[:-1][r]
    # The earliest string of each group, where other shards hold the same anchor.
    tell = order[~same]
    tell = tell[shared[row[tell]]]
    q = row[tell]
    prefix = powers.prefix(data)
    backward = powers.prefix(mix(data.astype(np.uint64) + np.uint64(7)))
    d1 = powers.between(prefix, tell, tell + LENGTH).view(np.int64)
    d2 = powers.between(backward, tell, tell + LENGTH).view(np.int64)
    far = start[q] + tell - at[:-1][q]
    none = len(first) + len(copies)
    mask = np.concatenate([np.ones(none, bool), np.zeros(len(tell), bool)])
    blank = np.zeros(none, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([ids[r], copied[0], ids[q]])), pa.array(np.concatenate([ties[r], copied[1], ties[q]])),
            pa.array(np.concatenate([first + base, copied[2], far])), pa.array(np.concatenate([last + base, copied[3], far])),
            pa.array(np.concatenate([blank, d1]), mask=mask), pa.array(np.concatenate([blank, d2]), mask=mask),
        ],
        names=["id", "tie", "first", "last", "d1", "d2"],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the rows, sorted by (h, part), into shards that hold whole groups."""
    powers = Powers()
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for piece in chunks([batch], 6, SHARD_BYTES):
            held.append(piece)
            size += piece.column(6).nbytes
            if size < SHARD_BYTES:
                continue
            table = pa.Table.from_batches(held)
            h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
            change = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1])) + 1
            if len(change):
                yield _resolve(table.slice(0, change[-1]), powers)
                held = table.slice(change[-1]).to_batches()
                size = sum(b.column(6).nbytes for b in held)
    if size:
        yield _resolve(pa.Table.from_batches(held), powers)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of several shards: all but the earliest of equal ones, found by binary search."""
    runs = [b for b in batches if b.num_rows]
    if not runs:
        return
    table = pa.Table.from_batches(runs)
    ids, ties, first, d1, d2 = (table.column(c).to_numpy() for c in ("id", "tie", "first", "d1", "d2"))
    order = np.lexsort((first, ties, ids, d2, d1))
    lead = np.ones(len(order), bool)
    lead[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
    heads = order[lead]
    at = np.searchsorted(d1[heads], d1)
    while True:  # several second hashes below one first hash are next to each other
        wrong = np.flatnonzero(d2[heads[at]] != d2)
        if not len(wrong):
            break
        at[wrong] += 1
    own = heads[at]
    gone = np.flatnonzero((ids != ids[own]) | (ties != ties[own]) | (first != first[own]))
    yield pa.RecordBatch.from_arrays([pa.array(x[gone]) for x in (ids, ties, first, first)], names=["id", "tie", "first", "last"])


def _cut(data: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``data`` without its runs, the bytes removed, and the number of gaps."""
    kept, at, spans, removed = [], 0, 0, 0
    covered = -1
    for first, last in sorted(runs):
        stop = last + LENGTH
        if first > covered:
            kept.append(data[max(at, 0) : first])
            spans += 1
            removed += stop - first
        elif stop > covered:
            removed += stop - covered
        covered = max(covered, stop)
        at = covered
    kept.append(data[at:])
    return b"".join(kept), removed, spans


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(3)
    for batch in batches:
        rows = []
        for key, tie, z, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = unpack.decompress(z)
            left, removed, spans = _cut(data, [(r["first"], r["last"]) for r in runs])
            rows.append((key, tie, removed, spans, hashlib.sha256(left).hexdigest(), pack.compress(left)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["id", "tie", "n_removed", "n_spans", "kept_sha256", "left"]) if rows else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=["id", "tie", "n_removed", "n_spans", "kept_sha256", "left"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(3)
    for batch in batches:
        texts = [pack.compress(t.encode()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["id", "tie", "z"])


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")
    )


def repeats(documents: DataFrame, store: Store) -> DataFrame:
    """What changes: ``(id, tie, n_removed, n_spans, kept_sha256, left)``, one row for each document
    of which bytes go; ``left`` is the rest, compressed. Equal rows count once."""
    texts = _keyed(documents).where(F.octet_length("text") >= LENGTH)
    found = store.put(texts.mapInArrow(_find, _COUNTED), "anchors")
    count = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    hits = (
        found.join(count, "h")
        .groupBy("id", "tie")
        .agg(F.collect_set(F.struct("pos", F.ceil(F.col("n") / SPREAD).alias("parts"))).alias("hits"))
    )
    hits = store.put(hits, "hits")
    store.drop(found)
    packed = texts.mapInArrow(_packed, f"{_KEYS}, z binary").join(hits, ["id", "tie"]).dropDuplicates(["id", "tie"])
    packed = store.put(packed, "repeated")
    stretches = packed.mapInArrow(_stretch, f"h long, part int, shared boolean, {_KEYS}, start long, bytes binary")
    marks = store.put(
        stretches.repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(_shards, _MARK), "marks"
    )
    merged = marks.where("d1 IS NOT NULL").repartition("d1").mapInArrow(_merge, f"{_KEYS}, first long, last long")
    runs = marks.where("d1 IS NULL").select("id", "tie", "first", "last").unionByName(merged)
    gaps = runs.groupBy("id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    return store.put(
        packed.select("id", "tie", "z").join(gaps, ["id", "tie"])
        .mapInArrow(_apply, f"{_KEYS}, n_removed long, n_spans long, kept_sha256 string, left binary"), "changes",
    )


def removals(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``: one for every document.

    ``documents`` has ``doc_id`` and ``text``; other columns are ignored. A byte goes if a string of
    ``LENGTH`` bytes over it also starts earlier: in a document with a smaller ``doc_id``, or earlier
    in its own. Documents with equal ids are ordered by a hash of their text, those without an id
    come last, and rows equal in both count as one and get equal results. A null text is empty.
    """
    store = Store(documents.sparkSession)
    changes = repeats(documents, store).drop("left")
    base = _keyed(documents).select("id", "tie", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return base.join(changes, ["id", "tie"], "left").select(
        F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = [unpack.decompress(z).decode(errors="ignore") for z in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "tie", "left"])


def deduplicate(documents: DataFrame) -> DataFrame:
    """The documents without their repeated bytes; a row of which nothing else is left has an empty text.

    Bytes of a character that was cut through are dropped. Other columns stay as they are, but
    ``n_chars``, if it is there, follows the text. A text without repeats stays as it is, null too.
    """
    store = Store(documents.sparkSession)
    changes = repeats(documents, store).select("id", "tie", "left").mapInArrow(_text, f"{_KEYS}, left string")
    names = documents.columns
    own, tie, left = (free_name(documents, name) for name in ("__id", "__tie", "__left"))
    keyed = documents.select(
        "*", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias(own),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias(tie),
    )
    changes = changes.select(F.col("id").alias(own), F.col("tie").alias(tie), F.col("left").alias(left))
    joined = keyed.join(changes, [own, tie], "left").withColumn("text", F.coalesce(left, "text"))
    if "n_chars" in names:
        joined = joined.withColumn("n_chars", F.when(F.col(left).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return joined.select(*names)


ship_with_tasks(__name__)
