"""Repair of damaged conversations by the lightest derivation.

A conversation is in order if its roles are none, or ``user`` and ``assistant`` in turns to an
assistant's end, after at most one ``system`` row. Repairs are deductions over a weighted
hypergraph: an item (i, q) says that the first i rows can be repaired so that state q is reached;
it follows from an earlier item and the axiom of a row (keep, rerole, delete), or from an earlier
item alone (insert). Its weight is (cost, audit), the audit being the initials of the edits. A
deduction adds a cost and appends an initial, which never makes a weight smaller and keeps the
order of two weights; so items popped from an agenda in order of weight are final.

Rows are dealt over the tasks by conversation *and* turn, so a conversation of any size is cut.
Blocks of a cut conversation are solved apart, from every state to every state, and then chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from os.path import commonprefix
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.common import Store
from tablewright.session import ship_with_tasks

WHITE = " \t\n\x0b\f\r"
# States: nothing yet, after a system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
DONE = (EMPTY, ASSISTANT)
# Where a kept row leads, by its initial; an empty role has none and leads nowhere else.
KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "": (EMPTY, SYSTEM, USER, ASSISTANT)}
# Where an inserted or reroled row leads; the role it gets.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
RECAST, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
# A conversation beyond one of these, in one task, is cut into blocks.
BLOCK_ROWS, BLOCK_CHARS = 1024, 4 << 20

_ROWS = "array<struct<role: string, text: string, fault: string>>"
_MESSAGES = "array<struct<role: string, text: string, edit: string>>"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SPAN = "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, low bigint, high bigint, head string, tail string"


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` and ``dropped``, damaged by a hash of conversation and turn.

    Of 20 hash values, 0 drops the row (it stays, marked), 1 empties its text, 2 removes its end
    marks, 3 repeats it, 4 makes it a user's. A null role or text, and in the hash a null
    conversation or turn, is one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def fault(text: Column) -> Column:
    """The fault that a text shows by itself: b(lank), t(runcated) or none."""
    rest = F.rtrim(text, F.lit(WHITE))
    return F.when(rest == "", "b").when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")


def derive(rows: list[tuple[str, str]], start: int, goals: Iterable[int]) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) from state ``start`` before the rows to each reachable goal after them.

    ``rows`` has (initial of the role, fault). The agenda ends when every goal is final or nothing
    is left to deduce.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    wanted, out = set(goals), {}
    while agenda and wanted:
        cost, edits, i, state = heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(rows) and state in wanted:
            out[state] = cost, edits
            wanted.remove(state)
        heappush(agenda, (cost + INSERT, edits + "I", i, NEXT[state]))
        if i == len(rows):
            continue
        initial, wrong = rows[i]
        heappush(agenda, (cost + DELETE, edits + "D", i + 1, state))
        if wrong not in ("b", "d"):
            extra = CUT_OFF if wrong == "t" else 0
            to = KEEP[initial][state] if initial in KEEP else None
            if to is not None:
                heappush(agenda, (cost + extra, edits + "K", i + 1, to))
            heappush(agenda, (cost + RECAST + extra, edits + "R", i + 1, NEXT[state]))
    return out


def apply(rows: list[dict], state: int, edits: str) -> list[dict]:
    """The messages that the edits make of the rows, from a state on."""
    out, left = [], iter(rows)
    for edit in edits:
        row = None if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = KEEP[row["role"][:1]][state]
            out.append({"role": row["role"], "text": row["text"], "edit": edit})
        else:
            state = NEXT[state]
            out.append({"role": ROLE[state], "text": row["text"] if row else "", "edit": edit})
    return out


class Span(NamedTuple):
    """What is counted of rows in a row; two spans join into the one of both."""

    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    head: str = ""
    tail: str = ""

    @classmethod
    def of(cls, rows: list[dict], turns: list[int | None]) -> Span:
        if not rows:
            return cls()
        initials, faults = [r["role"][:1] for r in rows], [r["fault"] for r in rows]
        known = {t for t in turns if t is not None}
        return cls(
            len(rows), *(faults.count(f) for f in "bdt"), sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            len(known), min(known, default=None), max(known, default=None), initials[0], initials[-1])

    def join(self, other: Span) -> Span:
        if not self.n or not other.n:
            return other if other.n else self
        return Span(
            self.n + other.n, self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.illegal + other.illegal + (self.tail + other.head not in LEGAL),
            self.turns + other.turns - (self.high is not None and self.high == other.low),
            other.low if self.low is None else self.low, self.high if other.high is None else other.high, self.head, other.tail)

    def counts(self, cost: int) -> dict[str, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(zip(_COUNTS, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)))


class _Out:
    """Rows of a task, given out as record batches."""

    def __init__(self, schema: T.StructType, rows: int = 2000, chars: int = 8 << 20) -> None:
        self.schema, self.most, self.room = to_arrow_schema(schema), rows, chars
        self.rows: list[dict] = []
        self.chars = 0

    def add(self, row: dict, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= self.most or self.chars >= self.room:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
            self.rows, self.chars = [], 0


def _rows(batches: Iterator[pa.RecordBatch], step: int = 1000) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(i, step).columns))


def _schema(key: str, rest: str) -> T.StructType:
    return T.StructType.fromDDL(f"conv_id {key}, {rest}")


class Repairs(NamedTuple):
    """``conversations``: one row each, with ``gaps, blank, duplicate, truncated, illegal, cost, audit``.
    ``blocks``: repaired ``messages`` (role, text, edit) of a conversation, ordered by ``task`` and
    ``block``; ``alone`` if it is the only one."""

    conversations: DataFrame
    blocks: DataFrame

    def messages(self) -> DataFrame:
        """Repaired messages: ``conv_id, task, block, position, role, text, edit``."""
        return self.blocks.select("conv_id", "task", "block", F.posexplode("messages").alias("position", "m")).select(
            "conv_id", "task", "block", "position", "m.role", "m.text", "m.edit")

    def digests(self) -> DataFrame:
        """``conv_id, repaired_sha256``: of ``role:text`` of all messages, joined by line ends.

        A cut conversation is hashed block by block in one task, since SHA-256 has one order; the
        task holds one block at a time.
        """
        line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
        joined = self.blocks.select("conv_id", "task", "block", "alone", F.size("messages").alias("n"), F.array_join(line, "\n").alias("body"))
        kind = self.blocks.schema["conv_id"].dataType.simpleString()
        schema = _schema(kind, "repaired_sha256 string")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, now, state, begun = _Out(schema), None, None, False
            for conv, _, _, _, n, body in _rows(batches, 16):
                if state is None or conv != now:
                    if state is not None:
                        yield from out.add({"conv_id": now, "repaired_sha256": state.hexdigest()})
                    now, state, begun = conv, hashlib.sha256(), False
                if n:
                    state.update((("\n" if begun else "") + body).encode())
                    begun = True
            if state is not None:
                yield from out.add({"conv_id": now, "repaired_sha256": state.hexdigest()})
            yield from out.flush()

        cut = joined.where("NOT alone").repartition("conv_id").sortWithinPartitions("conv_id", "task", "block")
        return joined.where("alone").select("conv_id", F.sha2("body", 256).alias("repaired_sha256")).unionByName(cut.mapInArrow(run, schema))


def _first_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Blocks of rows that come sorted; a conversation whole in one task is repaired at once."""
    schema = _schema(key, f"task int, block int, alone boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                          f"cost bigint, audit string, messages {_MESSAGES}, rows {_ROWS}, turns array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, me, block = _Out(schema), TaskContext.get().partitionId(), 0
        held: list[dict] = []
        turns: list[int | None] = []
        seen: set[tuple[str, str]] = set()
        now, chars, loose, begun = None, 0, True, False  # the first conversation may have begun in another task

        def close(alone: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block, chars, held, turns
            row: dict[str, Any] = {"conv_id": now, "task": me, "block": block, "alone": alone}
            if alone:
                seen.clear()
                for r in held:
                    if (r["role"], r["text"]) in seen and r["fault"] != "b":
                        r["fault"] = "d"
                    seen.add((r["role"], r["text"]))
                found = derive([(r["role"][:1], r["fault"]) for r in held], EMPTY, DONE)
                cost, audit = min(found.values())
                row |= Span.of(held, turns).counts(cost) | {"audit": audit, "messages": apply(held, EMPTY, audit)}
            else:
                row |= {"rows": held, "turns": turns}
            yield from out.add(row, chars)
            block, chars, held, turns = block + 1, 0, [], []

        for conv, turn, role, text, wrong, dropped in _rows(batches):
            if begun and conv != now:
                yield from close(not loose)
                loose = False
            now, begun = conv, True
            if dropped:
                continue
            held.append({"role": role, "text": text, "fault": wrong})
            turns.append(turn)
            chars += len(text)
            if len(held) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                loose = True
                yield from close(False)
        if begun:
            yield from close(False)  # the last one may go on in another task
        yield from out.flush()

    return rows.mapInArrow(run, schema)


def _solved(loose: DataFrame, key: str) -> DataFrame:
    """Loose blocks with every row's fault, and the lightest derivations between all states."""
    at = F.posexplode("rows").alias("place", "r")
    narrow = loose.select("conv_id", "task", "block", at).select(
        "conv_id", "r.role", F.unhex(F.sha2("r.text", 256)).alias("h"), F.struct("task", "block", "place").alias("at"))
    first = narrow.groupBy("conv_id", "role", "h").agg(F.min("at").alias("at"))
    news = first.groupBy(F.col("at.task").alias("task"), F.col("at.block").alias("block")).agg(F.collect_list("at.place").alias("news"))
    schema = _schema(key, f"task int, block int, rows {_ROWS}, costs array<int>, audits array<string>, {_SPAN}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for conv, task, block, rows, turns, news in _rows(batches, 4):
            fresh = set(news or ())
            for i, r in enumerate(rows):
                if i not in fresh and r["fault"] != "b":
                    r["fault"] = "d"
            short = [(r["role"][:1], r["fault"]) for r in rows]
            found = [derive(short, start, range(4)) for start in range(4)]
            row = {"conv_id": conv, "task": task, "block": block, "rows": rows}
            row |= {"costs": [f.get(to, (None,))[0] for f in found for to in range(4)], "audits": [f.get(to, (None, None))[1] for f in found for to in range(4)]}
            yield from out.add(row | Span.of(rows, turns)._asdict(), sum(len(r["text"]) for r in rows))
        yield from out.flush()

    return loose.select("conv_id", "task", "block", "rows", "turns").join(news, ["task", "block"], "left").select(
        "conv_id", "task", "block", "rows", "turns", "news").mapInArrow(run, schema)


def _chain(solved: DataFrame, key: str) -> DataFrame:
    """The states of every block on the lightest derivation of its conversation; the last row has its counts.

    Blocks come in order; only what the four live derivations do not share is held of their audits.
    """
    names = ["conv_id", "task", "block", "costs", "audits", *Span._fields]
    schema = _schema(key, "task int, block int, start int, audit_part string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        now, begun = None, False

        def close() -> Iterator[pa.RecordBatch]:
            cost, rest, path = min((live[q] for q in DONE if q in live), key=lambda d: d[:2])
            audit, place, steps = "".join(sure) + rest, 0, []
            while path is not None:
                path, *step = path
                steps.append(step)
            for number, ((task, block), (start, length)) in enumerate(zip(places, reversed(steps)), 1):
                row = {"conv_id": now, "task": task, "block": block, "start": start, "audit_part": audit[place : place + length]}
                place += length
                if number == len(places):
                    row |= span.counts(cost) | {"audit": audit}
                yield from out.add(row, length)

        for conv, task, block, costs, audits, *fields in _rows(batches, 16):
            if begun and conv != now:
                yield from close()
                begun = False
            if not begun:
                now, begun = conv, True
                live: dict[int, tuple] = {EMPTY: (0, "", None)}
                span, sure, places = Span(), [], []
            places.append((task, block))
            span = span.join(Span(*fields))
            after: dict[int, tuple] = {}
            for start, (cost, rest, path) in live.items():
                for to in range(4):
                    more, edits = costs[4 * start + to], audits[4 * start + to]
                    if more is not None and (to not in after or (cost + more, rest + edits) < after[to][:2]):
                        after[to] = cost + more, rest + edits, (path, start, len(edits))
            shared = commonprefix([d[1] for d in after.values()])
            sure.append(shared)
            live = {q: (cost, rest[len(shared):], path) for q, (cost, rest, path) in after.items()}
        if begun:
            yield from close()
        yield from out.flush()

    return solved.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "task", "block").mapInArrow(run, schema)


def repair(conversations: DataFrame, store: Store | None = None) -> Repairs:
    """Find the cheapest edits that put every conversation in order.

    Columns: ``conv_id``, ``turn``, ``role``, ``text`` and, if there, ``dropped`` (such a row only
    says that the conversation exists). Others are ignored. Rows count by turn, nulls first, then
    role and text. A null role or text is one space. Faults, the first one counts: ``blank`` (white
    space only), ``duplicate`` (role and text as in an earlier row), ``truncated`` (does not end in
    one of ``.!?``). Edits: keep 0, rerole 2, delete 3 (a must for blank and duplicate), insert an
    empty message 2; a truncated row that stays adds 1. Of equal costs, the audit least in ASCII
    wins. ``illegal`` counts neighbours that no order allows; ``gaps`` the turns missing between
    the least and the greatest. An empty role has no initial, so keeping its row changes nothing.
    A null ``conv_id`` is a conversation of its own; without rows, all counts are 0 and the audit
    is empty. An empty table gives empty ones.
    """
    store = store or Store(conversations.sparkSession)
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), word("role"), word("text"), dropped.alias("dropped"))
    key = rows.schema["conv_id"].dataType.simpleString()
    # The last column parts equal rows, which may be many.
    dealt = rows.withColumn("same", F.monotonically_increasing_id()).repartitionByRange("conv_id", "turn", "role", "text", "same").sortWithinPartitions(
        "conv_id", "turn", "role", "text").select("conv_id", "turn", "role", "text", fault(F.col("text")).alias("fault"), "dropped")
    first = store.put(_first_blocks(dealt, key), "blocks")
    solved = store.put(_solved(first.where("NOT alone"), key), "solved")
    chain = store.put(_chain(solved, key), "chain")
    schema = _schema(key, f"task int, block int, alone boolean, messages {_MESSAGES}")

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for conv, task, block, rows, start, edits in _rows(batches, 4):
            messages = apply(rows, start, edits)
            yield from out.add({"conv_id": conv, "task": task, "block": block, "alone": False, "messages": messages}, sum(len(m["text"]) for m in messages))
        yield from out.flush()

    cut = solved.select("conv_id", "task", "block", "rows").join(chain.select("task", "block", "start", "audit_part"), ["task", "block"]).select(
        "conv_id", "task", "block", "rows", "start", "audit_part").mapInArrow(mend, schema)
    columns = ["conv_id", *_COUNTS, "audit"]
    return Repairs(
        first.where("alone").select(*columns).unionByName(chain.where("audit IS NOT NULL").select(*columns)),
        first.where("alone").select("conv_id", "task", "block", "alone", "messages").unionByName(cut),
    )


ship_with_tasks(__name__)
