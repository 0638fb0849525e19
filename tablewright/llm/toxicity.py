"""Toxicity by a linear-chain conditional random field over tokens.

Labels of documents become labels of tokens: features (a word or a beginning of words) that toxic
documents of the training sample have far more often than others mark the tokens of toxic
documents. A two-tag chain (toxic or not) with hashed word, beginning and neighbour features is fit
to these tokens. Forward-backward gives every token of a text its marginal; runs of toxic tokens are
the offending spans, and a logistic model of summaries of the marginals (how many tokens are toxic, and
how surely the most toxic ones are) gives the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Powers, chunks, lowered, mix, sampled_labels, text_bytes, word_spans
from tablewright.session import ship_with_tasks

# Labelled documents from which features are counted and the document model is fit, and those of
# which tokens are sent to the driver, with so many tokens each at most. They bound the fit only.
SAMPLE, TAGGED, TOKENS = 8_000, 3_000, 120
# A feature marks toxic tokens from this likelihood ratio on, and this much evidence in all.
RATIO, EVIDENCE = 5.0, 15.0
MARKS = 20_000
BEGINNINGS = (3, 4, 5, 6, 7, 8)
BITS = 20
LANES = 512

_GAP = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


class Model(NamedTuple):
    """Weights by hashed feature, transition scores [from, to], start scores, and the document model."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    document: np.ndarray


def tokens(column: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of every token (own ones, by column), first token of each row, starts and ends."""
    data, offsets = text_bytes(lowered(column))
    starts, ends, first = word_spans(data, offsets, _GAP)
    prefix = powers.prefix(data)
    own = [powers.between(prefix, starts, ends)]
    for size in BEGINNINGS:
        own.append(mix(powers.between(prefix, starts, np.minimum(starts + size, ends)) + np.uint64(size)))
    return np.stack(own, 1) if len(starts) else np.empty((0, 1 + len(BEGINNINGS)), np.uint64), first, starts, ends


def emissions(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Buckets of all features of every token: own ones, and the words before and after."""
    n = len(own)
    before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    before[1:], after[:-1] = own[:-1, 0], own[1:, 0]
    heads = first[:-1][np.diff(first) > 0]
    before[heads] = 0
    after[heads[1:] - 1] = 0
    out = np.empty((n, own.shape[1] + 2), np.int32)
    shift = np.uint64(64 - BITS)
    for i in range(own.shape[1]):
        out[:, i] = own[:, i] >> shift
    out[:, -2] = mix(before + np.uint64(101)) >> shift
    out[:, -1] = mix(after + np.uint64(202)) >> shift
    return out


def marginals(score: np.ndarray, heads: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the toxic tag at every token, and of each move [from, to] into it.

    All texts are one chain: at a head the step does not depend on the tag before. The chain is cut
    into lanes that advance together; lane products join them exactly.
    """
    n = len(score)
    if not n:
        return np.empty(0), np.empty((0, 2, 2))
    step = np.empty((n, 2, 2))
    gain = np.stack([np.zeros(n), np.clip(score, -30, 30)], 1)
    step[:] = np.exp(moves[None] + gain[:, None, :] - np.maximum(gain.max(1), 0)[:, None, None])
    step[heads] = np.exp(start + gain[heads] - np.maximum(gain[heads].max(1), 0)[:, None])[:, None, :]
    lanes = min(LANES, n)
    length = -(-n // lanes)
    padded = np.broadcast_to(np.eye(2), (lanes * length, 2, 2)).copy()
    padded[:n] = step
    padded = padded.reshape(lanes, length, 2, 2)
    product = padded[:, 0].copy()
    for t in range(1, length):
        product = product @ padded[:, t]
        product /= product.sum((1, 2), keepdims=True)
    enter, leave = np.empty((lanes, 2)), np.empty((lanes, 2))
    a = np.array([0.5, 0.5])
    for k in range(lanes):
        enter[k] = a
        a = a @ product[k]
        a = a / a.sum()
    b = np.ones(2)
    for k in range(lanes - 1, -1, -1):
        leave[k] = b
        b = product[k] @ b
        b = b / b.sum()
    forward, backward = np.empty((lanes, length, 2)), np.empty((lanes, length, 2))
    a, b = enter, leave
    for t in range(length):
        a = (a[:, None, :] @ padded[:, t])[:, 0]
        a = a / a.sum(1, keepdims=True)
        forward[:, t] = a
    for t in range(length - 1, -1, -1):
        backward[:, t] = b
        b = (padded[:, t] @ b[:, :, None])[:, :, 0]
        b = b / b.sum(1, keepdims=True)
    forward, backward = forward.reshape(-1, 2)[:n], backward.reshape(-1, 2)[:n]
    both = forward * backward
    toxic = both[:, 1] / both.sum(1)
    last = np.concatenate([[[0.5, 0.5]], forward[:-1]])
    move = last[:, :, None] * step * backward[:, None, :]
    return toxic, move / move.sum((1, 2), keepdims=True)


def fit_chain(buckets: np.ndarray, tags: np.ndarray, heads: np.ndarray, rounds: int = 60, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximise the likelihood of the tags by adaptive gradient steps over all tokens."""
    weights = np.zeros(1 << BITS)
    moves, start = np.array([[0.0, -1.0], [0.0, -1.0]]), np.array([0.0, -1.0])
    if not len(tags):
        return weights, moves, start
    used = np.unique(buckets)
    compact = np.searchsorted(used, buckets)
    w, past = np.zeros(len(used)), np.full(len(used), 1e-6)
    past_moves, past_start = np.full((2, 2), 1e-6), np.full(2, 1e-6)
    inner = np.ones(len(tags), bool)
    inner[heads] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[:-1][inner[1:]], tags[1:][inner[1:]]), 1)
    began = np.bincount(tags[heads], minlength=2)
    n = len(tags)
    for _ in range(rounds):
        toxic, move = marginals(w[compact].sum(1), heads, moves, start)
        miss = tags - toxic
        gradient = np.zeros(len(w))
        for i in range(compact.shape[1]):
            gradient += np.bincount(compact[:, i], miss, minlength=len(w))
        gradient = gradient / n * 1000 - l2 * w * 1000
        past += gradient**2
        w += 0.3 * gradient / np.sqrt(past)
        g = (seen - move[inner].sum(0)) / n * 1000
        past_moves += g**2
        moves = moves + 0.1 * g / np.sqrt(past_moves)
        g = (began - np.array([(1 - toxic[heads]).sum(), toxic[heads].sum()])) / n * 1000
        past_start += g**2
        start = start + 0.1 * g / np.sqrt(past_start)
    weights[used] = w
    return weights, moves, start


# The document model looks at the marginals of these places, counted from the most toxic token.
PLACES = (1, 2, 4)
FEATURES = 3 + len(PLACES)


def summaries(toxic: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row: log-odds that some token is toxic, log of the expected number, log of its share, and
    the log-odds of the most toxic tokens (the least possible where a text has fewer)."""
    counts = np.diff(first)
    toxic = np.clip(toxic, 1e-9, 1 - 1e-9)
    total = np.concatenate([[0], np.cumsum(toxic)])
    none = np.concatenate([[0], np.cumsum(np.log1p(-toxic))])
    expected = total[first[1:]] - total[first[:-1]]
    clean = np.minimum(none[first[1:]] - none[first[:-1]], -1e-9)
    odds = np.clip(np.log(-np.expm1(clean)) - clean, -12, 12)
    most = np.full((len(counts), max(PLACES)), 1e-6)
    for i, (a, b) in enumerate(zip(first, first[1:])):
        n = min(b - a, max(PLACES))
        if n:
            most[i, :n] = np.sort(np.partition(toxic[a:b], b - a - n)[b - a - n :])[::-1]
    most = np.clip(most[:, np.array(PLACES) - 1], 1e-6, 1 - 1e-6)
    return np.concatenate([
        np.stack([odds / 4, np.log(expected + 1e-2), np.log(expected / np.maximum(counts, 1) + 1e-4)], 1), np.log(most / (1 - most)),
    ], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.01) -> np.ndarray:
    """Weights and intercept by Newton steps over scaled columns; the intercept has no penalty."""
    if not len(x):
        return np.zeros(x.shape[1] + 1)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w = w + np.linalg.solve(curve, x.T @ (y - p) - penalty * w)
    w[:-1] /= scale
    w[-1] -= mean @ w[:-1]
    return w


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in chunks(batches, 1):
        own, first, _, _ = tokens(batch.column(1), powers)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        y = batch.column(0).to_numpy()
        found, toxic = [], []
        for i in range(own.shape[1]):
            order = np.lexsort((own[:, i], row))
            f, r = own[order, i], row[order]
            new = np.ones(len(f), bool)
            new[1:] = (f[1:] != f[:-1]) | (r[1:] != r[:-1])
            found.append(f[new])
            toxic.append(y[r[new]])
        values, which = np.unique(np.concatenate(found), return_inverse=True)
        hits = np.bincount(which, np.concatenate(toxic), minlength=len(values)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(hits), pa.array(np.bincount(which, minlength=len(values)) - hits)], names=["f", "toxic", "clean"])


def _tagged(batches: Iterator[pa.RecordBatch], marks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Feature buckets and tags of the training tokens: around marked ones, else from the hash of the id on."""
    powers = Powers()
    for batch in chunks(batches, 2):
        own, first, _, _ = tokens(batch.column(2), powers)
        buckets = emissions(own, first)
        marked = np.isin(own, marks).any(1)
        rows = []
        for i, (a, b, y) in enumerate(zip(first, first[1:], batch.column(1).to_pylist())):
            hit = a + np.flatnonzero(marked[a:b]) if y else np.empty(0, np.int64)
            if y and not len(hit):
                continue  # nothing says which of its tokens are toxic
            at = int(hit[0]) - TOKENS // 3 if len(hit) else a + hash(batch.column(0)[i].as_py()) % max(1, b - a - TOKENS)
            at = max(a, min(at, b - TOKENS))
            part = slice(at, min(b, at + TOKENS))
            if part.stop > part.start:
                rows.append((buckets[part].astype("<i4").tobytes(), (marked[part] & bool(y)).astype(np.uint8).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], names=["buckets", "tags"])


def _measure(batches: Iterator[pa.RecordBatch], model: Model, score: bool) -> Iterator[pa.RecordBatch]:
    """Score of every row with its toxic spans, or the summaries for the document model."""
    powers = Powers()
    weights = model.weights.astype(np.float32)
    for batch in chunks(batches, 1):
        own, first, starts, ends = tokens(batch.column(1), powers)
        buckets = emissions(own, first)
        total = np.zeros(len(own))
        for i in range(buckets.shape[1]):
            total += weights[buckets[:, i]]
        toxic, _ = marginals(total, first[:-1][np.diff(first) > 0], model.moves, model.start)
        x = summaries(toxic, first)
        if not score:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])
            continue
        value = 1 / (1 + np.exp(-np.clip(x @ model.document[:-1] + model.document[-1], -30, 30)))
        data, offsets = text_bytes(lowered(batch.column(1)))
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        hit = np.flatnonzero(toxic >= 0.5)
        row = np.searchsorted(first, hit, side="right") - 1
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (row[1:] != row[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(hit))[: len(head)] - 1
        base = chars[offsets[:-1]][row[head]]
        at = np.searchsorted(row[head], np.arange(batch.num_rows + 1)).astype(np.int32)
        spans = pa.StructArray.from_arrays(
            [pa.array((chars[starts[hit[head]]] - base).astype(np.int32)), pa.array((chars[ends[hit[tail]]] - base).astype(np.int32))], names=["first", "stop"]
        )
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.ListArray.from_arrays(pa.array(at), spans)], names=["doc_id", "score", "spans"])


def mark(documents: DataFrame, model: Model, name: str) -> DataFrame:
    """``documents`` with the score of ``text`` as column ``name``, a new one; nothing is shuffled."""
    names = documents.columns
    if name.lower() in (c.lower() for c in names):
        raise ValueError(f"the documents have a column {name}")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, names.index("text")):
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(names.index("text"))], names=["doc_id", "text"])
            for part in _measure([rows], model, True):
                done = batch.slice(part.column(0)[0].as_py(), part.num_rows)
                yield pa.RecordBatch.from_arrays([*done.columns, part.column(1)], names=[*names, name])

    return documents.mapInArrow(run, f"{kinds}, `{name}` double")


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit to ``labels`` (``doc_id`` and ``label`` 0 or 1), of which ``SAMPLE`` rows are used at most.

    Without labels of both kinds the model gives every text the same score.
    """
    sample = sampled_labels(labels, label, SAMPLE)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", F.col("y").cast("long").alias("y"), "text")
    sizes = {r.y: r.n for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = texts.select("y", "text").mapInArrow(_count, "f long, toxic long, clean long").groupBy("f").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    ratio = (F.col("t") + 0.5) / max(toxic, 1) / ((F.col("c") + 0.5) / max(clean, 1))
    marked = counts.where((F.col("t") >= 3) & (ratio >= RATIO)).select("f", (F.col("t") * F.log(ratio)).alias("evidence")).where(F.col("evidence") >= EVIDENCE)
    marks = np.array([r.f for r in marked.orderBy(F.desc("evidence"), "f").limit(MARKS).collect()], np.int64).view(np.uint64)
    share = min(1.0, TAGGED / max(1, toxic + clean))
    few = texts.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = few.mapInArrow(lambda batches: _tagged(batches, marks), "buckets binary, tags binary").collect()
    rows.sort(key=lambda r: bytes(r.buckets))  # the order of arrival must not show
    buckets = np.concatenate([np.empty((0, 3 + len(BEGINNINGS)), np.int32), *(np.frombuffer(r.buckets, "<i4").reshape(-1, 3 + len(BEGINNINGS)) for r in rows)])
    tags = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(r.tags, np.uint8) for r in rows)]).astype(np.int64)
    heads = np.cumsum([0, *(len(r.tags) for r in rows)])[:-1].astype(np.int64)
    model = Model(*fit_chain(buckets, tags, heads), np.zeros(FEATURES + 1))
    parts = texts.select("y", "text").mapInArrow(lambda batches: _measure(batches, model, False), "y long, x array<double>").orderBy("y", "x").collect()
    x = np.array([r.x for r in parts], float).reshape(-1, FEATURES)
    return model._replace(document=fit_logistic(x, np.array([r.y for r in parts], float)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Rows ``(doc_id, score, spans)``: one for every document, null and empty texts included.

    ``spans`` has the toxic runs of tokens as code point offsets ``[first, stop)``. Texts are taken
    whole; other columns are ignored; nothing is shuffled.
    """
    return documents.select("doc_id", "text").mapInArrow(
        lambda batches: _measure(batches, model, True), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, score double, spans array<struct<first:int,stop:int>>"
    )


ship_with_tasks(__name__)
