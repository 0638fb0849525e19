"""SentencePiece encoding and decoding by streaming Viterbi.

The segmentation is the one of the greatest total piece score (ties: the longer last piece), with
the pieces and scores of a given vocabulary file. It is found position by position in a window of
the longest piece; ids are committed as soon as all surviving paths meet at one boundary. Decoding
gives back the exact text.

Of a vocabulary whose scores are merge ranks, this is the best-scored segmentation, which need not
be the one that greedy merging finds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.llm.common import Powers, chunks, text_bytes
from tablewright.session import ship_with_tasks

# The mark that stands for a space in pieces, and what stands for that mark itself in a text.
MARK, LITERAL = 0x2581, 0x110000
# A character without a piece becomes its bytes, at this much below the lowest score.
BYTE_PENALTY = 10.0
# Longer words go through the stream one by one; shorter ones side by side, with the same ids.
SIDE_BY_SIDE = 256
# Bytes of text at once: words that are new in them are segmented together. What a task holds for
# them is many times as large.
CHUNK = 1 << 19
# Words whose ids a task remembers between chunks; beyond that it starts anew.
REMEMBERED = 1_000_000


class Vocabulary:
    """Pieces, scores and byte ids; small (one entry a piece), so it travels with the tasks."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], normal: list[bool]) -> None:
        self.pieces = pieces
        self.byte_ids = np.array(byte_ids, np.int32)
        self.known = {p: i for i, p in enumerate(pieces) if normal[i]}
        if any(chr(MARK) in p.lstrip(chr(MARK)) for p in self.known):
            raise ValueError("a piece with a space after another character is not supported")
        self.longest = max(map(len, self.known))
        self.scores = np.array(scores, np.float64)
        self.fallback = min(scores[i] for i in self.known.values()) - BYTE_PENALTY
        raw = [b"" for _ in pieces]
        for piece, i in self.known.items():
            raw[i] = piece.replace(chr(MARK), " ").encode()
        for byte, i in enumerate(byte_ids):
            raw[i] = bytes([byte])
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a SentencePiece model file, on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        normal = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
        return cls(pieces, [model.get_score(i) for i in range(size)], [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], normal)

    def expand(self, char: int) -> list[int]:
        text = chr(MARK if char == LITERAL else char)
        return [int(self.byte_ids[b]) for b in text.encode()]


class Stream:
    """Viterbi over characters that arrive one after the other, with bounded memory.

    ``feed`` returns the ids that became certain, ``finish`` the rest. Scores are kept for the last
    ``longest`` positions and back pointers from the last commit on; a commit happens when the
    paths of all positions in the window share a boundary.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.text: list[int] = []  # since the last commit
        self.best, self.back = [0.0], [(0, -1)]  # by position since the last commit
        self.waiting = 2 * vocabulary.longest

    def feed(self, chars) -> list[int]:
        out: list[int] = []
        for char in chars:
            self.text.append(char)
            end = len(self.text)
            if char == MARK and end > 1 and self.text[-2] != MARK:
                # No piece reaches over this boundary: every path meets here.
                self.text.pop()
                out += self._commit(end - 1)
                self.text.append(char)
                end = 1
            best, back = -np.inf, (0, -1)
            window = "".join(map(_char, self.text[max(0, end - self.v.longest) : end]))
            for length in range(min(end, self.v.longest), 0, -1):
                piece = self.v.known.get(window[len(window) - length :], -1)
                if piece < 0 and length > 1:
                    continue
                score = self.best[end - length] + (self.v.scores[piece] if piece >= 0 else self.v.fallback)
                if score > best:
                    best, back = score, (length, piece)
            self.best.append(best)
            self.back.append(back)
            if end >= self.waiting:
                out += self._meet()
        return out

    def finish(self) -> list[int]:
        return self._commit(len(self.text))

    def _meet(self) -> list[int]:
        """Commit up to the last boundary that all paths into the window share."""
        end = len(self.text)
        ends = set(range(max(0, end - self.v.longest + 1), end + 1))
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - self.back[last][0])
        at = ends.pop()
        out = self._commit(at) if at > 0 else []
        self.waiting = len(self.text) + 2 * self.v.longest
        return out

    def _commit(self, at: int) -> list[int]:
        ids: list[list[int]] = []
        end = at
        while end > 0:
            length, piece = self.back[end]
            ids.append([piece] if piece >= 0 else self.v.expand(self.text[end - 1]))
            end -= length
        low = self.best[at]
        self.text = self.text[at:]
        self.best = [x - low for x in self.best[at:]]
        self.back = self.back[at:]
        self.waiting = 2 * self.v.longest
        return [i for group in reversed(ids) for i in group]


def _char(c: int) -> str:
    return "\0" if c == LITERAL else chr(c)


class Encoder:
    """Encode and decode whole columns: equal words once, all of them one position at a time."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v, self.powers = vocabulary, Powers()
        # Every beginning of a piece: with its id if it is one itself, else -1.
        nodes = {p[:n]: -1 for p in self.v.known for n in range(1, len(p))} | self.v.known
        text = np.array([ord(c) for p in nodes for c in p], np.uint32)
        ends = np.cumsum([len(p) for p in nodes])
        keys = self.powers.between(self.powers.prefix(text), np.concatenate([[0], ends[:-1]]), ends)
        ids = np.array(list(nodes.values()), np.int32)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]
        # The first key of every possible leading 20 bits; then few steps are left.
        self.slots = np.zeros(1 << 20, np.int32)
        lead = (self.keys >> np.uint64(44)).astype(np.int64)
        self.slots[:] = np.searchsorted(lead, np.arange(1 << 20))
        self.steps = int(np.bincount(lead).max())
        self._forget()

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 for a mere beginning and -2 for neither."""
        at = self.slots[(keys >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(keys), -2, np.int32)
        for step in range(self.steps):
            near = np.minimum(at + step, len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[near] == keys)
            out[hit] = self.ids[near[hit]]
        return out

    def _matches(self, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The piece of every length at every start: only starts that can still go on are looked up."""
        prefix = self.powers.prefix(text)
        found = np.full((self.v.longest + 1, len(text)), -1, np.int32)
        for length in range(1, self.v.longest + 1):
            room = start + length <= stop
            start, stop = start[room], stop[room]
            ids = self._lookup(self.powers.between(prefix, start, start + length))
            found[length, start] = np.maximum(ids, -1)
            start, stop = start[ids > -2], stop[ids > -2]
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the first of each row; a null or empty text has none."""
        data, offsets = text_bytes(column)
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        at = lead[offsets]
        full = np.flatnonzero(np.diff(at))
        chars = np.where(chars == MARK, np.uint32(LITERAL), np.where(chars == 32, np.uint32(MARK), chars))
        chars = np.insert(chars, at[full], MARK)
        rows = at + np.concatenate([[0], np.cumsum(np.diff(at) > 0)])
        n = len(chars)
        if not n:
            return np.empty(0, np.int32), np.zeros(len(at), np.int64)
        begins = chars == MARK
        begins[1:] &= chars[:-1] != MARK
        begins[rows[full]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], n)
        hashes = self.powers.between(self.powers.prefix(chars), starts, ends)
        keys, some, which = np.unique(hashes, return_index=True, return_inverse=True)
        begin, counts = self._known(keys, chars, starts[some], ends[some])
        counts = counts[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        out = self.pool[np.repeat(begin[which] - total[:-1], counts) + np.arange(total[-1])]
        return out, total[np.searchsorted(starts, rows)]

    def _forget(self) -> None:
        # Sorted hashes of words, where their ids are in the pool and how many; a run has at most
        # half the words of the one before.
        self.seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pool, self.used = np.empty(0, np.int32), 0

    def _remember(self, keys: np.ndarray, begin: np.ndarray, count: np.ndarray) -> None:
        """Another run of words; runs that it outgrows become one with it, so a word is moved few times."""
        while self.seen and len(self.seen[-1][0]) < 2 * len(keys):
            old = self.seen.pop()
            place = np.searchsorted(old[0], keys)
            keys, begin, count = (np.insert(a, place, b) for a, b in zip(old, (keys, begin, count)))
        self.seen.append((keys, begin, count))

    def _keep(self, ids: np.ndarray) -> int:
        """Put ids into the pool, which has room to grow; where they begin there."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            pool = np.empty(self.used + (self.used >> 2), np.int32)
            pool[:at] = self.pool[:at]
            self.pool = pool
        self.pool[at : self.used] = ids
        return at

    def _known(self, keys: np.ndarray, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct words are in the pool; words not seen before are segmented."""
        if sum(len(run[0]) for run in self.seen) > REMEMBERED:
            self._forget()
        begin, count, new = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64), np.ones(len(keys), bool)
        for seen, at, number in self.seen:
            near = np.minimum(np.searchsorted(seen, keys), len(seen) - 1)
            old = np.flatnonzero(seen[near] == keys)
            begin[old], count[old], new[old] = at[near[old]], number[near[old]], False
        if new.any():
            ids, at = self._words(chars, starts[new], ends[new])
            begin[new], count[new] = at[:-1] + self._keep(ids), np.diff(at)
            self._remember(keys[new], begin[new], count[new])
        return begin, count

    def _words(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and the first of each."""
        lengths = ends - starts
        short = np.flatnonzero(lengths <= SIDE_BY_SIDE)
        ids, begin = self._lanes(chars, starts[short], lengths[short])
        if len(short) == len(starts):
            return ids, begin
        parts: list[np.ndarray] = [np.empty(0, np.int32)] * len(starts)
        for i, word in enumerate(short):
            parts[word] = ids[begin[i] : begin[i + 1]]
        for word in np.flatnonzero(lengths > SIDE_BY_SIDE):
            stream = Stream(self.v)
            out = stream.feed(chars[starts[word] : ends[word]].tolist())
            parts[word] = np.array(out + stream.finish(), np.int32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _lanes(self, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words side by side: step t extends the paths of every word that is as long."""
        order = np.argsort(-lengths, kind="stable")
        size = lengths[order]
        base = np.concatenate([[0], np.cumsum(size + 1)])  # one more position than characters
        text = np.zeros(base[-1], np.uint32)
        inside = np.repeat(base[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        text[inside] = chars[np.repeat(starts[order] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
        matches = self._matches(text, inside, np.repeat(base[:-1] + size, size))
        best = np.full(base[-1], -np.inf)
        best[base[:-1]] = 0.0
        back = np.zeros(base[-1], np.int8)
        piece = np.full(base[-1], -1, np.int32)
        active = np.searchsorted(-size, -np.arange(1, size.max(initial=0) + 1), side="right")
        for t, lanes in enumerate(active.tolist(), 1):
            end = base[:lanes] + t
            top, took, what = np.full(lanes, -np.inf), np.zeros(lanes, np.int8), np.full(lanes, -1, np.int32)
            for length in range(min(t, self.v.longest), 0, -1):
                found = matches[length, end - length]
                if length > 1:
                    hit = np.flatnonzero(found >= 0)
                    score = best[end[hit] - length] + self.v.scores[found[hit]]
                else:
                    hit = np.arange(lanes)
                    score = best[end - 1] + np.where(found >= 0, self.v.scores[found], self.v.fallback)
                better = score > top[hit]
                hit = hit[better]
                top[hit], took[hit], what[hit] = score[better], length, found[hit]
            best[end], back[end], piece[end] = top, took, what
        # All paths meet at the end of a word: walk back from there, all words at once.
        chosen = np.zeros(base[-1], bool)
        at, floor = base[:-1] + size, base[:-1]
        while True:
            alive = at > floor
            at, floor = at[alive], floor[alive]
            if not len(at):
                break
            chosen[at] = True
            at = at - back[at]
        where = np.flatnonzero(chosen)
        ids = piece[where]
        counts = np.ones(len(where), np.int64)
        odd = np.flatnonzero(ids < 0)
        raw = [self.v.expand(int(c)) for c in text[where[odd] - 1]]
        counts[odd] = [len(r) for r in raw]
        first = np.concatenate([[0], np.cumsum(counts)])
        out = np.repeat(ids, counts)
        if len(odd):
            out[out < 0] = np.concatenate(raw)
        begin = first[np.searchsorted(where, base)]
        # Back to the order in which the words came.
        back_order = np.empty(len(order), np.int64)
        back_order[order] = np.arange(len(order))
        count = np.diff(begin)[back_order]
        total = np.concatenate([[0], np.cumsum(count)])
        return out[np.repeat(begin[:-1][back_order] - total[:-1], count) + np.arange(total[-1])], total

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all rows and the first of each; the leading space of a row goes."""
        counts = np.diff(self.v.bytes_at)[ids]
        total = np.concatenate([[0], np.cumsum(counts)])
        data = self.v.bytes[np.repeat(self.v.bytes_at[:-1][ids] - total[:-1], counts) + np.arange(total[-1])]
        at = total[rows]
        full = np.flatnonzero(np.diff(at))
        full = full[data[at[full]] == 32]
        shift = np.zeros(len(at), np.int64)
        shift[full + 1] = 1
        return np.delete(data, at[full]), at - np.cumsum(shift)


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Replace ``text`` by ``ids`` (array), ``n_tokens`` and ``exact`` (decoding gave the same bytes).

    Other columns stay, but columns of those names are replaced. A null text has null ids, no
    tokens and is exact; an empty text has no ids. Nothing is shuffled.
    """
    names = [c for c in documents.columns if c not in (text, "ids", "n_tokens", "exact")]
    kept = documents.select(*names)
    schema = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "ids array<int>", "n_tokens int", "exact boolean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        at = len(names)
        for batch in chunks(batches, at, CHUNK):
            ids, rows = encoder.encode(batch.column(at))
            data, offsets = text_bytes(batch.column(at))
            again, places = encoder.decode(ids, rows)
            # Compare row by row only where the whole differs.
            if np.array_equal(places, offsets) and np.array_equal(again, data):
                exact = np.ones(batch.num_rows, bool)
            else:
                exact = np.array([np.array_equal(data[a:b], again[c:d]) for a, b, c, d in zip(offsets, offsets[1:], places, places[1:])], bool)
            gone = batch.column(at).is_null()
            lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32), mask=np.append(gone.to_numpy(zero_copy_only=False), False)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], lists, pa.array(np.diff(rows).astype(np.int32)), pa.array(exact)],
                names=[*names, "ids", "n_tokens", "exact"],
            )

    return documents.select(*names, text).mapInArrow(run, ", ".join(schema))


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Replace the column of ids by ``text``; null ids give a null text. Other columns stay."""
    names = [c for c in tokens.columns if c not in (ids, "text")]
    schema = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*names).schema), "text string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            lists = batch.column(len(names))
            rows = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            data, at = encoder.decode(lists.flatten().to_numpy(zero_copy_only=False), rows)
            text = [None if not ok else data[a:b].tobytes().decode(errors="replace") for a, b, ok in zip(at, at[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(text, pa.string())], names=[*names, "text"])

    return tokens.select(*names, ids).mapInArrow(run, ", ".join(schema))


ship_with_tasks(__name__)
