"""Quality by a generalised additive model with pairwise interactions.

Features of form are binned; boosting visits one feature after the other, in cycles, and adds a
shallow tree over its bins to the feature's lookup table. Pairs that explain most of what is left
get two-way tables in the same way. A score is the sum of table entries, by vectorised lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import LOWER, SPACE, Powers, chunks, sampled_labels, shingles, text_bytes, word_spans
from tablewright.session import ship_with_tasks

# Labelled documents that the model is fit to at most; they bound the fit only.
SAMPLE = 20_000
BINS, COARSE, PAIRS = 32, 8, 8
CYCLES, RATE, LEAVES = 120, 0.1, 4

NAMES = (
    "chars", "words", "word_length", "upper", "digits", "symbols", "marks", "bars", "lines", "beyond_ascii",
    "distinct_words", "most_frequent_word", "distinct_runs", "short_words", "capital_words", "words_a_stop", "repeated_neighbours", "distinct_lines",
)


class Model(NamedTuple):
    """Bin edges and table of each feature, coarse edges, pairs with their tables, and the intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    intercept: float


def _class(test) -> np.ndarray:
    return np.array([bool(test(chr(b))) and b < 128 for b in range(256)])


_UPPER, _DIGIT = _class(str.isupper), _class(str.isdigit)
_SYMBOL, _MARK, _BAR, _LINE, _STOP = (_class(lambda c, s=s: c in s) for s in ("#$%&*@^~<>{}[]\\_=+", "!?", "|", "\n", ".!?"))


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many values differ, and how often the most frequent one occurs."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    most = np.zeros(rows, np.int64)
    head = np.flatnonzero(new)
    np.maximum.at(most, r[head], np.diff(np.append(head, len(v))))
    return np.bincount(r[new], minlength=rows), most


def features(column: pa.Array, powers: Powers) -> np.ndarray:
    """The ``NAMES`` of every text; shares of an empty text are 0."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    size = np.diff(offsets)

    def total(flags: np.ndarray) -> np.ndarray:
        summed = np.concatenate([[0], np.cumsum(flags)])
        return summed[offsets[1:]] - summed[offsets[:-1]]

    starts, ends, first = word_spans(data, offsets)
    counts = np.diff(first)
    row = np.repeat(np.arange(rows), counts)
    prefix = powers.prefix(LOWER[data])
    words = powers.between(prefix, starts, ends)
    distinct, most = _distinct(words, row, rows)
    runs, at = shingles(words, first, 3)
    distinct_runs, _ = _distinct(runs, np.repeat(np.arange(rows), np.diff(at)), rows)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    gap = np.zeros(256, bool)
    gap[10] = True
    line_start, line_end, line_first = word_spans(data, offsets, gap)
    lines = np.diff(line_first)
    distinct_lines, _ = _distinct(powers.between(prefix, line_start, line_end), np.repeat(np.arange(rows), lines), rows)
    per_byte, per_word = np.maximum(size, 1), np.maximum(counts, 1)
    chars = total((data & 0xC0) != 0x80)
    of_words = lambda flags: np.bincount(row, flags, minlength=rows) / per_word
    return np.stack([
        np.log1p(chars), np.log1p(counts), total(~SPACE[data]) / per_word, total(_UPPER[data]) / per_byte, total(_DIGIT[data]) / per_byte,
        total(_SYMBOL[data]) / per_byte, total(_MARK[data]) / per_word, total(_BAR[data]) / per_word, total(_LINE[data]) / per_word,
        total(data >= 128) / per_byte, distinct / per_word, most / per_word, distinct_runs / np.maximum(np.diff(at), 1),
        of_words(ends - starts <= 3), of_words(_UPPER[data[starts]] if len(starts) else np.empty(0)), counts / (1 + total(_STOP[data])),
        of_words(again), distinct_lines / np.maximum(lines, 1),
    ], 1)


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """Step function over ordered bins with the best splits, one after the other."""
    cuts = [0, len(gradient)]
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])

    def gain(a: int, b: int) -> float:
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves - 1):
        best = max(((gain(a, c) + gain(c, b) - gain(a, b), c) for a, b in zip(cuts, cuts[1:]) for c in range(a + 1, b)), default=(0.0, 0))
        if best[0] <= 1e-9:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.empty(0)


def _place(model_edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model_edges)], 1)


def fit_tables(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the feature tables, then of the best pairs' tables."""
    d = x.shape[1]
    edges, coarse = [_edges(x[:, i], BINS) for i in range(d)], [_edges(x[:, i], COARSE) for i in range(d)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    rate = (y.sum() + 0.5) / (len(y) + 1)
    margin = np.full(len(y), np.log(rate / (1 - rate)))
    intercept = float(np.log(rate / (1 - rate)))
    place, rough = _place(edges, x), _place(coarse, x)
    for _ in range(CYCLES if len(y) else 0):
        for i in range(d):
            p = 1 / (1 + np.exp(-margin))
            size = len(tables[i])
            step = RATE * _tree(np.bincount(place[:, i], y - p, minlength=size), np.bincount(place[:, i], p * (1 - p), minlength=size), LEAVES)
            tables[i] += step
            margin += step[place[:, i]]
    p = 1 / (1 + np.exp(-margin))
    strength = []
    for i in range(d):
        for j in range(i):
            cell = rough[:, i] * COARSE + rough[:, j]
            g, h = np.bincount(cell, y - p, minlength=COARSE**2), np.bincount(cell, p * (1 - p), minlength=COARSE**2)
            strength.append((float((g**2 / (h + 5.0)).sum()), i, j))
    pairs = [(i, j) for _, i, j in sorted(strength, reverse=True)[:PAIRS]] if len(y) else []
    pair_tables = [np.zeros(COARSE**2) for _ in pairs]
    for _ in range(CYCLES // 2):
        for k, (i, j) in enumerate(pairs):
            p = 1 / (1 + np.exp(-margin))
            cell = rough[:, i] * COARSE + rough[:, j]
            g = np.bincount(cell, y - p, minlength=COARSE**2).reshape(COARSE, COARSE)
            h = np.bincount(cell, p * (1 - p), minlength=COARSE**2).reshape(COARSE, COARSE)
            # A tree of depth two: one cut of the first feature, then a tree over the second on each side.
            side = _tree(g.sum(1), h.sum(1), 2)
            step = np.empty((COARSE, COARSE))
            for value in np.unique(side):
                part = side == value
                step[part] = _tree(g[part].sum(0), h[part].sum(0), 2)
            step = RATE * step.ravel()
            pair_tables[k] += step
            margin += step[cell]
    return Model(edges, tables, coarse, pairs, pair_tables, intercept)


def predict(model: Model, x: np.ndarray) -> np.ndarray:
    place, rough = _place(model.edges, x), _place(model.coarse, x)
    margin = np.full(len(x), model.intercept)
    for i, table in enumerate(model.tables):
        margin += table[place[:, i]]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        margin += table[rough[:, i] * COARSE + rough[:, j]]
    return 1 / (1 + np.exp(-margin))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in chunks(batches, 1):
        x = features(batch.column(1), powers)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=["y", *NAMES])


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit to ``labels`` (``doc_id`` and ``label`` 0 or 1), of which ``SAMPLE`` rows are used at most.

    Without labels every text gets the score 0.5.
    """
    sample = sampled_labels(labels, label, SAMPLE)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(F.col("y").cast("long").alias("y"), "text")
    rows = texts.mapInArrow(_extract, "y long, " + ", ".join(f"{n} double" for n in NAMES)).orderBy("y", *NAMES).toArrow()
    x = np.stack([rows.column(n).to_numpy() for n in NAMES], 1) if rows.num_rows else np.empty((0, len(NAMES)))
    return fit_tables(x, rows.column("y").to_numpy().astype(float))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Rows ``(doc_id, score)``: one for every document, null and empty texts included.

    Texts are taken whole; other columns are ignored; nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in chunks(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predict(model, features(batch.column(1), powers)))], names=["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, score double")


ship_with_tasks(__name__)
