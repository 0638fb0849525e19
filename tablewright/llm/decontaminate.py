"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

The index holds, for every term, its postings in blocks of items with the greatest impact in each
block (block-max). A passage is a window of words; windows overlap so far that any item lies whole
in one. The weakest terms, which even together do not lift any item to the threshold, propose no
block; the blocks of the other terms in a passage are bounded by their block maxima, and only blocks
that can still reach the threshold are scored. Impacts are divided by the item's own score, so 1 is the item itself. No passage and no
match above the threshold is left out. Matches are then verified by the overlap of the item's
question and of its answer with the passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Powers, Store, chunks, folded, free_name, numbered, shingles, text_bytes, word_hashes
from tablewright.session import ship_with_tasks

# BM25: saturation of repeated terms and length normalisation.
K1, B = 1.2, 0.75
# Share of an item's own score that a passage must reach to be retrieved.
THRESHOLD = 0.5
# Share of the question's and of the answer's shingles that a passage must hold.
OVERLAP = 0.5
SHINGLE = 3
ANSWER_WORDS = 5
BLOCK = 64
# Items in one index; more items make several indexes, each queried by all passages.
SHARD_ITEMS = 20_000


class Index(NamedTuple):
    """Sorted terms; per term the postings (item, impact) and the blocks (block, greatest impact)."""

    items: np.ndarray
    terms: np.ndarray
    post_at: np.ndarray
    post_item: np.ndarray
    post_impact: np.ndarray
    block_key: np.ndarray  # term * blocks + block, sorted
    block_max: np.ndarray
    block_at: np.ndarray
    essential: np.ndarray
    blocks: int
    window: int
    question: list[tuple[int, np.ndarray]]  # shingle width and shingles
    answer: list[tuple[int, np.ndarray]]


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item given as one text: the last sentence answers.

    With a single sentence, or a last one of under ``ANSWER_WORDS`` words, the last third of the
    words is the answer.
    """
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
    if len(parts) > 1 and len(parts[-1].split()) >= ANSWER_WORDS:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


def build_index(items: list[tuple[int, str, str]]) -> Index:
    """Index ``(item_id, question, answer)``; items without words are left out."""
    powers = Powers()

    def hashed(texts: list[str]) -> list[np.ndarray]:
        data, offsets = text_bytes(folded(pa.array(texts, pa.string())))
        words, first = word_hashes(data, offsets, powers)
        return [words[a:b] for a, b in zip(first, first[1:])]

    def grams(words: np.ndarray) -> tuple[int, np.ndarray]:
        width = min(SHINGLE, max(1, len(words)))
        return width, np.unique(shingles(words, np.array([0, len(words)]), width)[0])

    rows = [(i, q, a) for (i, q, a), w in zip(items, hashed([f"{q} {a}" for _, q, a in items])) if len(w)]
    whole = hashed([f"{q} {a}" for _, q, a in rows])
    lengths = np.array([len(w) for w in whole], float)
    term, item, count = [], [], []
    for i, words in enumerate(whole):
        values, counts = np.unique(words, return_counts=True)
        term.append(values)
        item.append(np.full(len(values), i))
        count.append(counts)
    terms, which = np.unique(np.concatenate(term or [np.empty(0, np.uint64)]), return_inverse=True)
    item = np.concatenate(item or [np.empty(0, np.int64)]).astype(np.int64)
    count = np.concatenate(count or [np.empty(0)]).astype(float)
    present = np.bincount(which, minlength=len(terms))
    idf = np.log(1 + (len(rows) - present + 0.5) / (present + 0.5))
    scale = K1 * (1 - B + B * lengths[item] / max(lengths.mean() if len(rows) else 1, 1))
    impact = idf[which] * count * (K1 + 1) / (count + scale)
    impact = impact / np.bincount(item, impact, minlength=len(rows))[item]
    order = np.lexsort((item, which))
    which, item, impact = which[order], item[order], impact[order]
    blocks = max(1, -(-len(rows) // BLOCK))
    keys, start = np.unique(which * blocks + item // BLOCK, return_index=True)
    block_max = np.maximum.reduceat(impact, start) if len(start) else np.empty(0)
    at = np.searchsorted(which, np.arange(len(terms) + 1))
    questions, answers = hashed([q for _, q, _ in rows]), hashed([a for _, _, a in rows])
    return Index(
        np.array([i for i, _, _ in rows], np.int64), terms, at, item, impact, keys, block_max,
        np.searchsorted(keys // blocks, np.arange(len(terms) + 1)),
        _essential(len(rows), at, item, impact),
        blocks, int(2 * lengths.max(initial=1)), [grams(w) for w in questions], [grams(w) for w in answers],
    )


def _essential(items: int, at: np.ndarray, item: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """Terms of which an item at the threshold holds at least one; those with small impacts are not."""
    terms = len(at) - 1
    essential = np.ones(terms, bool)
    if terms:
        reached = np.zeros(items)
        for term in np.argsort(np.maximum.reduceat(impact, at[:-1]), kind="stable"):
            span = slice(at[term], at[term + 1])
            reached[item[span]] += impact[span]
            if reached[item[span]].max() >= THRESHOLD - 1e-9:
                break
            essential[term] = False
    return essential


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions from each start to its end, and whose they are."""
    counts = ends - starts
    total = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    return starts[owner] + np.arange(total[-1]) - total[:-1][owner], owner


def retrieve(index: Index, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All (first word, end, row, item, score) of passages that reach the threshold."""
    step = index.window // 2
    counts = np.diff(first)
    # Windows of 2 * step words every step words; the last ones may be shorter.
    number = np.where(counts > 0, np.maximum(1, -(-counts // step) - 1), 0)
    k, row = _spread(np.zeros(len(counts), np.int64), number)
    begin = first[:-1][row] + k * step
    end = np.minimum(begin + 2 * step, first[1:][row])
    near = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = index.terms[near] == words
    strong = np.concatenate([[0], np.cumsum(known & index.essential[near])])
    some = strong[end] > strong[begin]
    begin, end, row = begin[some], end[some], row[some]
    place = np.flatnonzero(known)
    at, window = _spread(np.searchsorted(place, begin), np.searchsorted(place, end))
    pair = np.unique(window * len(index.terms) + near[place[at]])
    window, term = np.divmod(pair, len(index.terms))
    edge = np.searchsorted(window, np.arange(len(begin) + 1))
    essential = index.essential[term]
    at, owner = _spread(index.block_at[term[essential]], index.block_at[term[essential] + 1])
    candidate = np.unique(window[essential][owner] * index.blocks + index.block_key[at] % index.blocks)
    # Bound every proposed block by all terms of its passage.
    passage, block = np.divmod(candidate, index.blocks)
    at, owner = _spread(edge[passage], edge[passage + 1])
    key = term[at] * index.blocks + block[owner]
    spot = np.minimum(np.searchsorted(index.block_key, key), len(index.block_key) - 1)
    bound = np.bincount(owner, np.where(index.block_key[spot] == key, index.block_max[spot], 0.0), minlength=len(candidate))
    kept = bound >= THRESHOLD - 1e-9
    passage, block = passage[kept], block[kept]
    # Score what is left.
    at, owner = _spread(edge[passage], edge[passage + 1])
    post, source = _spread(index.post_at[term[at]], index.post_at[term[at] + 1])
    inside = index.post_item[post] // BLOCK == block[owner[source]]
    post, source = post[inside], owner[source[inside]]
    scores = np.bincount(source * BLOCK + index.post_item[post] % BLOCK, index.post_impact[post], minlength=len(passage) * BLOCK)
    hit = np.flatnonzero(scores >= THRESHOLD - 1e-9)
    passage, item = passage[hit // BLOCK], block[hit // BLOCK] * BLOCK + hit % BLOCK
    return begin[passage], end[passage], row[passage], item, scores[hit]


_SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _share(part: np.ndarray, of: np.ndarray) -> float:
    return float(np.isin(of, part).mean()) if len(of) else 1.0


def _search(index: Index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in chunks(batches, 1):
        data, offsets = text_bytes(folded(batch.column(1)))
        words, first = word_hashes(data, offsets, powers)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for begin, end, row, item, score in zip(*(x.tolist() for x in retrieve(index, words, first))):
            part = words[begin:end]
            shares = []
            for (width, wanted) in (index.question[item], index.answer[item]):
                shares.append(_share(shingles(part, np.array([0, len(part)]), width)[0], wanted))
            found = (score, *shares)
            if min(shares) >= OVERLAP:
                best[row, item] = max(found, best.get((row, item), found))
        if best:
            docs = batch.column(0).take(pa.array([r for r, _ in best]))
            figures = [pa.array([v[i] for v in best.values()], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([docs, pa.array(index.items[[i for _, i in best]]), *figures], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for every document and test item that it contains, with the best passage's figures.

    ``documents`` has ``doc_id`` and ``text``; ``benchmark`` has ``item_id`` and ``text``, or
    ``question`` and ``answer`` in place of ``text``. Words are compared in lower case, with
    white space ignored. Null or empty texts match nothing, an empty benchmark gives no rows, items
    without an id are left out, equal items match separately, and further columns are ignored. Rows with equal ``doc_id`` are
    matched separately.

    The benchmark is read in shards of ``SHARD_ITEMS`` items, each of which becomes an index that
    is sent to the tasks; documents are not shuffled and not collected.
    """
    if "question" in benchmark.columns:
        items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("question", F.lit("")).alias("q"), F.coalesce("answer", F.lit("")).alias("a"))
    else:
        items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("q"), F.lit(None).cast("string").alias("a"))
    items = items.where("item_id IS NOT NULL")
    shards = -(-items.count() // SHARD_ITEMS)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = documents.sparkSession.createDataFrame([], _SCHEMA)
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard)
        rows = [(r.item_id, r.q, r.a) if r.a is not None else (r.item_id, *split_item(r.q)) for r in part.orderBy("item_id", "q").collect()]
        index = build_index(rows)
        if len(index.items):
            out = out.unionByName(texts.mapInArrow(lambda batches, index=index: _search(index, batches), _SCHEMA))
    return out


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows that contain no test item, those that share an id with a hit or have no id included."""
    row = free_name(documents, "__row")
    rows = numbered(documents, Store(documents.sparkSession), row)
    hit = matches(rows.select(F.col(row).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(hit, row, "left_anti").select(*documents.columns)


ship_with_tasks(__name__)
