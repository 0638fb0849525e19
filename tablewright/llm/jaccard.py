"""N-gram Jaccard join with PartEnum signatures, and the groups that its links make.

Two documents link when 100 * intersection >= 75 * union of their word-shingle sets. Sizes are cut
into bands so that similar sets lie in the same or in neighbouring bands. Within a band, similar
sets differ in at most k elements. The feature domain is cut by a hash into more than k partitions, and
each one's content is a signature (the subsets of one partition): of more than k partitions, at
least one holds no differing element. Partitions with very few elements do not sign, since unlike
documents would meet there; numbers are chosen by band so that the chance that a similar pair has
no signing partition without a difference is below 1e-9. Sets of up to nine elements are cut into
single elements, and all subsets after the allowed deletions are signatures.

Boilerplate would give unlike documents equal signatures. Sets of which at most a third are very
frequent shingles therefore also sign without them, and those of which under a tenth are frequent
sign only so: similar sets still have one way of signing in common, and leaving elements out never
makes sets differ more. Which shingles count as frequent changes the cost, not the links.

Links are found without pairing a whole bucket: members are first checked against the bucket's
smallest member, by parity sketches that never rule out a similar pair and then by the sets; only
buckets that still span several groups are looked at pair by pair, in blocks of bounded size, by
small sketches first and for the pairs that are left as before. A block with more candidates than members gives a forest of the nearest ones. Blocks of
which a pair of the forest does not link are looked at again by whole sketches, in the same way, and those of which one still does not link
by the sets themselves. No step makes more pairs than a block has members.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Powers, Store, chunks, components, mix, shingles, text_bytes, word_hashes
from tablewright.session import ship_with_tasks

WIDTH = 5
# A link: NEED * intersection >= SHARE * union.
SHARE, NEED = 75, 100
# Logarithm of the chance that a similar pair has no signature in common.
LOST = -9
# Bands up to this size enumerate deletions.
TINY = 9
# Signatures that a task sorts at once, and those that meet in one bucket of the exchange.
FLUSH, BUCKET = 1_500_000, 1_000_000
# Shingles that a share of all documents has are frequent; so many of them at most, the most
# frequent ones first, which bounds what is sent to the tasks.
FREQUENT, MOST_FREQUENT = 0.001, 100_000
# Shares of frequent shingles up to which a set signs without them, and from which with them.
WITHOUT, WITH = 1 / 3, 0.1
# Members of a signature in one block of pairwise comparison.
BLOCK = 2048
# Compressed texts in a block that compares sets, and the bytes of sets that it keeps.
BLOCK_BYTES = 1 << 24
# Cells of a block's sketch for each element of the largest set of the band, at least.
FEW = 1
# Pairs of members, and words of their sketches, that a block looks at in one step.
AT_ONCE = 1 << 20


def _chance_of_none(parts: int, k: int, common: int, least: int) -> float:
    """Logarithm (base 10) of the chance that no partition is free of k differing elements and has
    ``least`` of the common ones."""
    mean = common / parts
    few = sum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(least))
    return parts * math.log10(max(1e-300, 1 - (1 - 1 / parts) ** k * max(0.0, 1 - few)))


def _partitions(k: int, common: int) -> tuple[int, int]:
    """How many partitions, and how many elements one must have to sign."""
    for least in range(6, 1, -1):
        for parts in range(k + 1, 2 * k + 2, max(1, k // 20)):
            if _chance_of_none(parts, k, common, least) < LOST:
                return parts, least
    return max(k + 1, math.ceil(k * 10 ** min(-LOST / common, 6))), 1


def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low, high, parts = [1], [], []
    for _ in range(64):
        high.append(low[-1] * NEED // SHARE)
        low.append(high[-1] + 1)
    for a, b in zip(low, high):
        k = (NEED - SHARE) * 2 * b // (NEED + SHARE)
        # Common elements of a pair at least, all of them or those that are not frequent.
        common = (math.ceil((SHARE / NEED - WITHOUT) * a), math.ceil(SHARE * a / NEED))
        # Very large sets keep the figures of large ones: those only become safer with size.
        parts.append([_partitions(k, c) if k < 20_000 else (k + 1, 6) for c in common])
    both = np.array(parts, np.int64)
    return np.array(low[:64]), np.array(high), both[:, :, 0], both[:, :, 1]


LOW, HIGH, PARTS, LEAST = _bands()


def shingle_sets(column: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of every row, and the first of each row."""
    words, first = word_hashes(*text_bytes(column), powers)
    values, at = shingles(words, first, WIDTH)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, row))
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], np.searchsorted(row[new], np.arange(len(at)))


def digest(values: np.ndarray) -> bytes:
    """Identity of a set: sixteen bytes, the first eight as its short key."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def short(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def signatures(values: np.ndarray, at: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures and the row of each; the low six bits are the band of the larger set.

    Every set signs for its own band and for the next one, where it may be the smaller set.
    ``frequent`` is sorted.
    """
    sizes = np.diff(at)
    element = mix(values)
    all_rows = np.repeat(np.arange(len(sizes)), sizes)
    near = np.searchsorted(frequent, values)
    common = np.zeros(len(values), bool)
    common[near < len(frequent)] = frequent[near[near < len(frequent)]] == values[near < len(frequent)]
    share = np.bincount(all_rows, common, minlength=len(sizes)) / np.maximum(sizes, 1)
    out, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for step in (0, 1):
        band = np.searchsorted(LOW, sizes, side="right") - 1 + step
        wide = (sizes > 0) & (band >= 0) & (HIGH[np.clip(band, 0, 63)] > TINY)
        for mode, signs in enumerate((share <= WITHOUT, share >= WITH)):
            parts = np.where(wide & signs, PARTS[np.clip(band, 0, 63), mode], 0)
            base = np.concatenate([[0], np.cumsum(parts)])
            of = parts[all_rows] > 0 if mode else (parts[all_rows] > 0) & ~common
            row, item = all_rows[of], element[of]
            seed = seed_of(2 * band + mode)
            part = ((mix(item ^ seed[row]) >> np.uint64(32)) * parts[row].astype(np.uint64)) >> np.uint64(32)
            cell = base[row] + part.astype(np.int64)
            # Sums of 64-bit values per cell, exact in two halves.
            low = np.bincount(cell, (item & np.uint64(0xFFFFFFFF)).astype(float), minlength=base[-1])
            high = np.bincount(cell, (item >> np.uint64(32)).astype(float), minlength=base[-1])
            inside = np.bincount(cell, minlength=base[-1])
            whose = np.repeat(np.arange(len(sizes)), parts)
            full = np.flatnonzero(inside >= LEAST[np.clip(band, 0, 63), mode][whose])
            whose = whose[full]
            content = low[full].astype(np.uint64) + (high[full].astype(np.uint64) << np.uint64(32))
            value = mix(content + mix((full - base[whose]).astype(np.uint64) ^ seed[whose]))
            out.append((value & ~np.uint64(63)) | band[whose].astype(np.uint64))
            rows.append(whose)
        for r in np.flatnonzero((sizes > 0) & ~wide).tolist():
            own = [int(x) for x in element[at[r] : at[r + 1]]]
            total, b = sum(own), int(band[r])
            found = {total - sum(gone) for d in range(len(own) * (NEED - SHARE) // NEED + 1) for gone in itertools.combinations(own, d)}
            tokens = mix(np.array([x & (1 << 64) - 1 for x in sorted(found)], np.uint64) + np.uint64(b))
            out.append((tokens & ~np.uint64(63)) | np.uint64(b))
            rows.append(np.full(len(tokens), r))
    return np.concatenate(out), np.concatenate(rows)


def seed_of(band: np.ndarray) -> np.ndarray:
    return mix(band.astype(np.uint64) + np.uint64(1_000_003))


_CLASS = "doc_id long, n_shingles long, c binary, k long, frequent binary"


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class of every document; and, once a flush, the shingles that many of its documents have."""
    names = ["doc_id", "n_shingles", "c", "k", "frequent"]
    powers, held, size, documents = Powers(), [], 0, 0

    def flush() -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(held), return_counts=True)
        many = count >= max(4, documents * FREQUENT)
        pack = np.stack([value[many].view(np.int64), count[many]], 1).tobytes()
        return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([pack], pa.binary())], names=names)

    for batch in chunks(batches, 1):
        values, at = shingle_sets(batch.column(1), powers)
        keys = [digest(values[a:b]) if b > a else None for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at)), pa.array(keys, pa.binary()), pa.array([None if k is None else short(k) for k in keys], pa.int64()), pa.nulls(batch.num_rows, pa.binary())],
            names=names,
        )
        held.append(values)
        size, documents = size + len(values), documents + batch.num_rows
        if size >= FLUSH:
            yield flush()
            held, size, documents = [], 0, 0
    if held:
        yield flush()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pack in batch.column(0).to_pylist():
            rows = np.frombuffer(pack, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["h", "n"])


_ROW = "bucket int, sig long, k long, pack binary"


def _pack(sig: np.ndarray, key: np.ndarray) -> bytes:
    """Sorted signatures by byte planes, of which the leading ones are nearly constant."""
    planes = np.ascontiguousarray(sig.view(np.uint8).reshape(-1, 8).T)
    classes, which = np.unique(key, return_inverse=True)
    body = planes.tobytes() + which.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() + classes.tobytes()
    return len(sig).to_bytes(8, "little") + zstandard.ZstdCompressor(1).compress(body)


def _unpack(pack: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(pack[:8], "little")
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(pack[8:]), np.uint8)
    sig = np.ascontiguousarray(body[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    which = np.ascontiguousarray(body[8 * n : 12 * n].reshape(4, n).T).view(np.uint32).ravel()
    return sig, body[12 * n :].view(np.int64)[which]


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def _members(sig: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    n = len(sig)
    return pa.RecordBatch.from_arrays(
        [pa.array((key % 100_003).astype(np.int32)), pa.array(sig.view(np.int64)), pa.array(key), pa.nulls(n, pa.binary())],
        names=["bucket", "sig", "k", "pack"],
    )


def _distinct(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs by signature, and how many keys each one's signature has."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    sig, key = sig[new], key[new]
    return sig, key, np.repeat(np.diff(_runs(sig)), np.diff(_runs(sig)))


def _sign(batches: Iterator[pa.RecordBatch], buckets: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Signatures of a task, packed by bucket.

    Members of a signature that several sets of the task share leave as rows at once; only one of
    them goes into the pack, so a frequent signature reaches the exchange once per flush.
    """
    powers, held, size = Powers(), [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        sig, key, number = _distinct(np.concatenate([s for s, _ in held]), np.concatenate([k for _, k in held]))
        shared = number > 1
        if shared.any():
            yield _members(sig[shared], key[shared])
        lead = _runs(sig)[:-1]
        sig, key = sig[lead], key[lead]
        bucket = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = _runs(bucket)
        packs = [_pack(sig[a:b], key[a:b]) for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.nulls(len(packs), pa.int64()), pa.nulls(len(packs), pa.int64()), pa.array(packs, pa.binary())],
            names=["bucket", "sig", "k", "pack"],
        )

    for batch in chunks(batches, 0):
        values, at = shingle_sets(batch.column(0), powers)
        sig, row = signatures(values, at, frequent)
        keys = np.array([short(digest(values[a:b])) if b > a else 0 for a, b in zip(at, at[1:])], np.int64)
        held.append((sig, keys[row]))
        size += len(sig)
        if size >= FLUSH:
            yield from flush()
            held, size = [], 0
    if size:
        yield from flush()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, k) of all signatures that several sets have; buckets come one after the other."""
    names = ["sig", "k"]
    held: list[bytes] = []
    current = None

    def resolve() -> Iterator[pa.RecordBatch]:
        parts = [_unpack(p) for p in held]
        sig, key, number = _distinct(np.concatenate([s for s, _ in parts]), np.concatenate([k for _, k in parts]))
        shared = number > 1
        yield pa.RecordBatch.from_arrays([pa.array(sig[shared].view(np.int64)), pa.array(key[shared])], names=names)

    for batch in batches:
        direct = batch.filter(batch.column(3).is_null())
        if direct.num_rows:
            yield pa.RecordBatch.from_arrays([direct.column(1), direct.column(2)], names=names)
        packs = batch.filter(batch.column(3).is_valid())
        for bucket, pack in zip(packs.column(0).to_pylist(), packs.column(3).to_pylist()):
            if bucket != current and held:
                yield from resolve()
                held = []
            current = bucket
            held.append(pack)
    if held:
        yield from resolve()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(3)
    for batch in batches:
        packs = [packer.compress(t.encode()) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packs, pa.binary())], names=["doc_id", "z"])


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the wanted classes; a row of another class with the same id goes."""
    powers = Powers()
    for batch in batches:
        keep = [digest(_set_of(z, powers)) == c for z, c in zip(*(batch.column(i).to_pylist() for i in (0, 1)))]
        part = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([part.column(1), part.column(0)], names=["c", "z"])


def _set_of(pack: bytes, powers: Powers) -> np.ndarray:
    return shingle_sets(pa.array([zstandard.ZstdDecompressor().decompress(pack)], pa.binary()), powers)[0]


def _link(one: np.ndarray, other: np.ndarray) -> bool:
    common = len(np.intersect1d(one, other, assume_unique=True))
    return NEED * common >= SHARE * (len(one) + len(other) - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    last, own = None, None
    for batch in batches:
        keep = []
        for i, (za, zb) in enumerate(zip(batch.column(2), batch.column(3))):
            if za != last:
                last, own = za, _set_of(za.as_py(), powers)
            keep.append(_link(own, _set_of(zb.as_py(), powers)))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"])


def _folded(parity: np.ndarray, width: int) -> np.ndarray:
    """The sketch with only ``width`` cells, a power of two: cells that become one add up."""
    return parity.reshape(-1, min(width, len(parity))).sum(0) & 1


def _parity(values: np.ndarray, band: int) -> np.ndarray:
    """Whether the hashes in every cell of the band's sketch are odd in number."""
    width = int(min(8192, max(256, 1 << int(10 * HIGH[band]).bit_length())))
    cell = mix(values ^ np.uint64(0x5BD1E995)) & np.uint64(width - 1)
    return np.bincount(cell.astype(np.int64), minlength=width) & 1


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity of the hashes in every cell: two sketches differ in at most as many bits as the sets.

    ``few`` is the same with about a tenth of the cells, for blocks, where a set is sent with each
    of its signatures.
    """
    powers = Powers()
    for batch in batches:
        keys, bands, sizes, bits, few = [], [], [], [], []
        for c, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = _set_of(z, powers)
            band = int(np.searchsorted(LOW, len(values), side="right")) - 1
            for b in (band, band + 1):
                parity = _parity(values, b)
                keys.append(c)
                bands.append(b)
                sizes.append(len(values))
                bits.append(np.packbits(parity.astype(bool)).tobytes())
                few.append(np.packbits(_folded(parity, max(64, 1 << int(FEW * HIGH[b]).bit_length())).astype(bool)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(bands, pa.int32()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()), pa.array(few, pa.binary())],
            names=["c", "band", "n", "bits", "few"],
        )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of rows (a, b, sizes, sketches) that may be similar."""
    for batch in batches:
        n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
        one, at = text_bytes(batch.column(4))
        total = np.concatenate([[0], np.cumsum(np.bitwise_count(one ^ text_bytes(batch.column(5))[0]), dtype=np.int64)])
        apart = total[at[1:]] - total[at[:-1]]
        keep = pa.array((NEED * np.minimum(n, m) >= SHARE * np.maximum(n, m)) & ((NEED + SHARE) * apart <= (NEED - SHARE) * (n + m)))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])


_PAIR = "sig long, i int, j int, a binary, b binary, forest boolean"


class _Block:
    """Members of a block of a signature: sizes, groups, sketches, and sides where it has two."""

    def __init__(self, n: np.ndarray, group: np.ndarray, words: np.ndarray, side: np.ndarray | None) -> None:
        self.n, self.group, self.words, self.side = n, group, words, side

    def near(self, x: int, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``other`` that may be similar to ``x``, and in how many bits their sketches differ."""
        if self.side is not None:
            other = other[self.side[other] != self.side[x]]
        n = self.n
        other = other[(self.group[other] != self.group[x]) & (NEED * np.minimum(n[other], n[x]) >= SHARE * np.maximum(n[other], n[x]))]
        if not len(other):
            return other, other
        apart = np.bitwise_count(self.words[other] ^ self.words[x]).sum(1, dtype=np.int64)
        ok = (NEED + SHARE) * apart <= (NEED - SHARE) * (n[other] + n[x])
        return other[ok], apart[ok]

    def pairs(self, most: int | None) -> list[tuple[int, int]] | None:
        """All pairs that may be similar; None if there are more than ``most``."""
        found: list[tuple[int, int]] = []
        n, every = self.n, np.arange(len(self.n))
        step, some = max(1, AT_ONCE // max(1, len(n))), max(1, AT_ONCE // max(1, self.words.shape[1]))
        for first in range(0, len(n), step):
            of = every[first : first + step, None]
            may = (every > of) & (self.group != self.group[of]) & (NEED * np.minimum(n, n[of]) >= SHARE * np.maximum(n, n[of]))
            if self.side is not None:
                may &= self.side != self.side[of]
            x, y = np.nonzero(may)
            x += first
            for at in range(0, len(x), some):
                a, b = x[at : at + some], y[at : at + some]
                apart = np.bitwise_count(self.words[a] ^ self.words[b]).sum(1, dtype=np.int64)
                ok = (NEED + SHARE) * apart <= (NEED - SHARE) * (n[a] + n[b])
                found += zip(a[ok].tolist(), b[ok].tolist())
                if most is not None and len(found) > most:
                    return None
        return found

    def forest(self) -> list[tuple[int, int]]:
        """Of those pairs the nearest ones that join the same members, at most one less than members."""
        far = np.iinfo(np.int64).max
        best, parent = np.full(len(self.n), far), np.zeros(len(self.n), np.int64)
        todo = np.ones(len(self.n), bool)
        out, x = [], 0
        for _ in range(len(self.n) - 1):
            todo[x] = False
            rest = np.flatnonzero(todo)
            other, apart = self.near(x, rest)
            closer = apart < best[other]
            best[other[closer]], parent[other[closer]] = apart[closer], x
            best[rest[self.group[rest] == self.group[x]]] = -1  # joined already
            y = int(rest[np.argmin(best[rest])])
            if 0 <= best[y] < far:
                out.append((int(parent[y]), y))
            x = y
        return out


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Table]]:
    """Rows sorted by (sig, i, j) as tables of whole blocks: the three keys, the bounds of the blocks, the table."""
    pending: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        table = pending if batch is None else pa.Table.from_batches([batch]) if pending is None else pa.concat_tables([pending, pa.Table.from_batches([batch])])
        if table is None or not table.num_rows:
            continue
        key = np.stack([table.column(i).to_numpy() for i in range(3)])
        bounds = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, [table.num_rows]])
        done = len(bounds) - 1 if batch is None else len(bounds) - 2
        pending = None if batch is None else table.slice(bounds[done])
        if done:
            yield key, bounds[: done + 1], table.slice(0, bounds[done])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different groups in a block of a signature that may be similar.

    Rows come sorted by (sig, i, j); a block has ``BLOCK`` members of each side at most, on average.
    A block with more pairs than members gives a forest of them.
    """
    for key, bounds, table in _whole(batches):
        # Columns become arrays once, since most blocks have few members.
        side, c, group, n, bits = (column.combine_chunks() for column in table.columns[3:])
        side, n = side.to_numpy(), n.to_numpy().astype(np.int64)
        group = group.dictionary_encode().indices.to_numpy()
        data, at = text_bytes(bits)
        whose, pairs, forests = [], [], []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            words = data[at[a] : at[b]].view(np.uint64).reshape(b - a, -1)
            block = _Block(n[a:b], group[a:b], words, None if key[1, a] == key[2, a] else side[a:b])
            found = block.pairs(b - a - 1)
            forest = found is None
            if forest:
                found = block.forest()
            if found:
                names = c.slice(a, b - a).to_pylist()
                whose += [a] * len(found)
                pairs += [sorted((names[x], names[y])) for x, y in found]
                forests += [forest] * len(found)
        sig, i, j = (pa.array(k[whose], t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32())))
        yield pa.RecordBatch.from_arrays(
            [sig, i, j, *(pa.array([p[e] for p in pairs], pa.binary()) for e in (0, 1)), pa.array(forests, pa.bool_())],
            names=["sig", "i", "j", "a", "b", "forest"],
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``(a, b)`` that join the groups of a block as all its links do, at most one less than members.

    Rows are those of :func:`_across` with the compressed text for size and sketch. Pairs of one group,
    or that links have joined, are not compared again.
    """
    powers = Powers()
    for key, bounds, table in _whole(batches):
        side, c, group, z = (column.combine_chunks() for column in table.columns[3:])
        side, every = side.to_numpy(), group.dictionary_encode().indices.to_numpy()
        links: list[tuple[bytes, bytes]] = []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            n, words = np.zeros(b - a, np.int64), []
            for x in range(b - a):
                values = _set_of(z[a + x].as_py(), powers)
                n[x] = len(values)
                words.append(np.packbits(_parity(values, int(key[0, a]) & 63).astype(bool)).view(np.uint64))
            group = every[a:b].copy()
            block = _Block(n, group, np.array(words), None if key[1, a] == key[2, a] else side[a:b])
            held: dict[int, np.ndarray] = {}
            size = 0
            for x in range(b - a - 1):
                for y in [x, *block.near(x, np.arange(x + 1, b - a))[0].tolist()]:
                    if y != x and group[x] == group[y]:
                        continue
                    if y not in held:
                        if size > BLOCK_BYTES:
                            held, size = {m: s for m, s in held.items() if m == x}, 0
                        held[y] = _set_of(z[a + y].as_py(), powers)
                        size += held[y].nbytes
                    if y != x and _link(held[x], held[y]):
                        group[group == group[y]] = group[x]
                        links.append((c[a + x].as_py(), c[a + y].as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([pair[e] for pair in links], pa.binary()) for e in (0, 1)], names=["a", "b"])


def _check(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that link, by their exact sets."""
    joined = (
        pairs.join(texts.select(F.col("c").alias("a"), F.col("z").alias("za")), "a")
        .join(texts.select(F.col("c").alias("b"), F.col("z").alias("zb")), "b")
        .select("a", "b", "za", "zb")
    )
    return joined.mapInArrow(_verify, "a binary, b binary")


def join(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id)``: one for every document.

    ``documents`` has ``doc_id`` and ``text``; other columns are ignored. ``component_id`` is the
    smallest ``doc_id`` that links reach, the document's own included. A document without words has
    no shingles, links with nothing and is its own component; equal sets always link. A row without
    an id has no component and gives none its own. Rows that share an id are linked each by its text.
    An empty table gives no rows.
    """
    store = Store(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    everything = store.put(texts.mapInArrow(_classify, _CLASS), "classes")
    classes = everything.where("frequent IS NULL").drop("frequent")
    total, number = (x or 0 for x in classes.agg(F.sum("n_shingles"), F.count("*")).first())
    buckets = max(1, -(-total // BUCKET))
    counts = everything.where("frequent IS NOT NULL").select("frequent").mapInArrow(_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= max(8, FREQUENT * number)).orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").toArrow()
    frequent = np.sort(top.column("h").to_numpy().astype(np.int64).view(np.uint64))
    representative = classes.where("c IS NOT NULL AND doc_id IS NOT NULL").groupBy("c", "k").agg(F.min("doc_id").alias("doc_id"))

    signed = texts.where("doc_id IS NOT NULL").select("text").mapInArrow(lambda batches: _sign(batches, buckets, frequent), _ROW)
    members = store.put(
        signed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet, "sig long, k long").distinct(), "members"
    )
    wanted = store.put(representative.join(members.select("k").distinct(), "k", "left_semi"), "wanted")
    chosen = store.put(
        texts.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_packed, "doc_id long, z binary")
        .join(wanted.select("doc_id", "c"), "doc_id").select("z", "c").mapInArrow(_pick, "c binary, z binary").dropDuplicates(["c"]), "texts",
    )
    sketches = store.put(chosen.mapInArrow(_sketch, "c binary, band int, n int, bits binary, few binary"), "sketches")
    band = F.col("sig").bitwiseAND(F.lit(63)).cast("int").alias("band")
    met, members = members, members.join(wanted.select("k", "c"), "k").select("sig", "c")

    # Every member against the smallest of its signature, by sketches and then by the sets.
    center = members.groupBy("sig").agg(F.min("c").alias("a"))
    star = members.join(center, "sig").where("c <> a").select("a", F.col("c").alias("b"), band)

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs ``(a, b, band)`` those that link, by their whole sketches and then by the sets."""
        near = (
            pairs.groupBy("a", "b").agg(F.min("band").alias("band"))
            .join(sketches.select(F.col("c").alias("a"), "band", F.col("n").alias("na"), F.col("bits").alias("ba")), ["a", "band"])
            .join(sketches.select(F.col("c").alias("b"), "band", F.col("n").alias("nb"), F.col("bits").alias("bb")), ["b", "band"])
            .select("a", "b", "na", "nb", "ba", "bb").mapInArrow(_near, "a binary, b binary")
        )
        return store.put(_check(near, chosen), "links")

    links = linked(star)
    groups = components(links, store)

    # Signatures that still span several groups, in blocks.
    now = members.join(groups.withColumnRenamed("node", "c"), "c", "left").select("sig", "c", F.coalesce("component", "c").alias("g"))
    now = store.put(now, "groups")
    store.drop(met)
    open_ = now.groupBy("sig").agg(F.count("*").alias("m"), F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high")
    rest = store.put(now.join(open_.select("sig", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "sig"), "open")
    store.drop(now)
    side = F.pmod(F.xxhash64("c"), "blocks").cast("int")

    block = ["sig", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")]

    def in_blocks(rows: DataFrame, *held: str) -> DataFrame:
        """Rows ``(sig, side, other, c, g)`` with what a block compares, block by block."""
        return rows.select(*block, "side", "c", "g", *held).repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")

    def sketched(rows: DataFrame, sketch: str) -> DataFrame:
        rows = rows.withColumn("band", band).join(sketches.select("c", "band", "n", sketch), ["c", "band"])
        return store.put(in_blocks(rows, "n", sketch).mapInArrow(_across, _PAIR), "pairs")

    def regrouped(more: DataFrame) -> bool:
        """Put links between groups to them; False if there are none."""
        nonlocal edges, groups
        if more.isEmpty():
            return False
        edges = edges.unionByName(more.select("a", "b"))
        groups = components(edges, store)
        return True

    def cut_off(pairs: DataFrame) -> DataFrame:
        """Rows ``(sig, i, j, side)`` of the blocks of which a pair of the forest did not link.

        It may have cut off members that others of its block link.
        """
        group_of = lambda name: groups.select(F.col("node").alias(name), F.col("component").alias(f"g{name}"))
        apart = pairs.where("forest").join(group_of("a"), "a", "left").join(group_of("b"), "b", "left")
        apart = apart.where(F.coalesce("ga", "a") != F.coalesce("gb", "b")).select("sig", "i", "j").distinct()
        return store.put(apart.withColumn("side", F.explode(F.array_distinct(F.array("i", "j")))), "cut")

    def again(cut: DataFrame) -> DataFrame:
        """Members of these blocks and the groups that they have now."""
        rows = rest.drop("g").withColumn("side", side).join(cut, ["sig", "side"]).join(groups.withColumnRenamed("node", "c"), "c", "left")
        rows = rows.withColumn("other", F.col("i") + F.col("j") - F.col("side"))
        return rows.select("sig", "side", "other", "c", F.coalesce("component", "c").alias("g"), "blocks")

    edges = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    every = rest.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    pairs = sketched(every, "few")
    regrouped(linked(pairs.select("a", "b", band)))
    cut = cut_off(pairs)
    if not cut.isEmpty():
        sharp = sketched(again(cut), "bits")
        regrouped(store.put(_check(sharp.select("a", "b").distinct(), chosen), "links"))
        if not sharp.where("forest").isEmpty() and not (cut := cut_off(sharp)).isEmpty():
            # Blocks whose texts are too large are cut finer: each side into parts.
            rows = store.put(again(cut), "again")
            sizes = rows.join(chosen.select("c", F.octet_length("z").alias("size")), "c")
            parts = sizes.groupBy(*block).agg(F.ceil(F.sum("size") / BLOCK_BYTES).cast("int").alias("parts"))
            rows = rows.select("*", *block[1:]).join(parts, ["sig", "i", "j"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            own = F.floor(F.pmod(F.xxhash64("c"), F.col("blocks") * F.col("parts")) / F.col("blocks")).cast("int")
            mine, other = F.col("side") + F.col("blocks") * own, F.col("other") + F.col("blocks") * F.col("part")
            rows = store.put(rows.select("sig", mine.alias("side"), other.alias("other"), "c", "g"), "again")
            regrouped(store.put(in_blocks(rows.join(chosen, "c"), "z").mapInArrow(_joined, "a binary, b binary"), "links"))
    for table in (sketches, rest, pairs):
        store.drop(table)

    named = representative.join(groups.withColumnRenamed("node", "c"), "c", "left").select("c", "doc_id", F.coalesce("component", "c").alias("g"))
    least = named.groupBy("g").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(least, "g").select("c", "component_id")
    return classes.join(of_class, "c", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


ship_with_tasks(__name__)
