"""Text quality by a generalised additive model with pairwise interactions.

Features are row-local expressions of the whole text. The model is a sum of lookup
tables: one per feature, learnt by cyclic boosting (in each round every feature in
turn gets a shallow tree, with a small step, on what the others leave), and one per
pair of features, for the pairs that explain most of the rest. Scoring adds table
entries by bin, for a batch at once.

It is fitted in the driver on at most about ``max_rows`` labelled rows, chosen by a
hash of their id; all documents are scored in the tasks. Only feature rows, not
texts, meet the labels.

Defined results: null text is empty and is scored like it; several labels of an id
count by their mean; without both labels in the fitted rows the score is the share
of good ones, or 0.5 without any; equal rows get equal scores.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, WORD, blank_trimmed, col, let, saved, ship

FEATURES = (
    "words", "word_length", "symbols", "capitals", "digits", "stops", "bangs", "pipes", "distinct_words", "line_words",
    "repeated_lines", "stopped_lines", "long_words", "more_bytes",
)


def features(text: Column) -> Column:
    """The features as an array of doubles, each 0 for an empty text.

    One pass takes the small letters out; the other counts are of what is left.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(blank_trimmed(x)) > 0)
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        let(F.translate(text, string.ascii_lowercase, ""), lambda r: F.struct(r.alias("spaced"), F.translate(r, SPACES, "").alias("signs"))).alias("rest"),
    )

    def by_line(x: Column, words: Column) -> Column:
        k = F.greatest(F.size(x), F.lit(1))
        ends = F.size(F.filter(x, lambda s: F.substring(s, -1, 1).isin(".", "?", ":", '"')))
        return F.array(words / k, (F.size(x) - F.size(F.array_distinct(x))) / k, ends / k)

    def of(p: Column) -> Column:
        w, signs = p["words"], p["rest"]["signs"]
        n, many = F.size(w), F.greatest(F.size(w), F.lit(1))
        chars = F.length(text) - F.length(p["rest"]["spaced"]) + F.length(signs)
        part = lambda k: k / F.greatest(chars, F.lit(1))
        count = lambda these: F.length(signs) - F.length(F.translate(signs, these, ""))
        long = F.size(F.filter(w, lambda s: F.length(s) > 16))
        return F.concat(
            F.array(
                F.log1p(n.cast("double")), chars / many, part(count("#*$%&<>@^~_=\\{}[]")), part(count(string.ascii_uppercase)),
                part(count(string.digits)), part(count(".,;")), part(count("!")), part(count("|")),
                F.size(F.array_distinct(w)) / F.sqrt(many.cast("double")), long / many, part(F.octet_length(text) - F.length(text)),
            ),
            let(lines, lambda x: by_line(x, many)),
        )

    return let(parts, of)


@dataclass
class Model:
    """Tables over bins: ``cuts`` of each feature, one table each, and tables for pairs."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.cuts:
            b = self.bins(x)
            for f, table in enumerate(self.tables):
                total += table[b[:, f]]
            for f, g, table in self.pairs:
                total += table[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _shallow_tree(g: np.ndarray, h: np.ndarray, splits: int, ridge: float) -> np.ndarray:
    """The step of each bin from a tree with at most ``splits`` cuts over the ordered bins."""
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    edges = [0, len(g)]
    for _ in range(splits):
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:]):
            at = np.arange(a + 1, b)
            if not len(at):
                continue
            gain = _gain(gs[at] - gs[a], hs[at] - hs[a], ridge) + _gain(gs[b] - gs[at], hs[b] - hs[at], ridge) - _gain(gs[b] - gs[a], hs[b] - hs[a], ridge)
            k = int(gain.argmax())
            best = max(best, (float(gain[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    step = np.empty(len(g))
    for a, b in zip(edges, edges[1:]):
        step[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + ridge)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of both features at once: its gain, and the step of each pair of bins."""
    gs, hs = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    whole = lambda s: (s[1:-1, 1:-1], s[1:-1, -1:] - s[1:-1, 1:-1], s[-1:, 1:-1] - s[1:-1, 1:-1], s[-1, -1] - s[1:-1, -1:] - s[-1:, 1:-1] + s[1:-1, 1:-1])
    parts = list(zip(whole(gs), whole(hs)))
    if not parts[0][0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(a, b, ridge) for a, b in parts) - _gain(gs[-1, -1], hs[-1, -1], ridge)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    step = np.empty_like(g)
    values = [a[min(i, a.shape[0] - 1), min(j, a.shape[1] - 1)] / (b[min(i, b.shape[0] - 1), min(j, b.shape[1] - 1)] + ridge) for a, b in parts]
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = values
    return float(gain[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, pairs: int = 10, bins: int = 64, rate: float = 0.15, ridge: float = 5.0) -> Model:
    if not len(y):
        return Model(base=0.0)
    mean = float(y.mean())
    if not 0 < mean < 1:
        return Model(base=float(np.log((mean + 1e-3) / (1 - mean + 1e-3))))
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model = Model(float(np.log(mean / (1 - mean))), [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    b = model.bins(x)
    total = np.full(len(y), model.base)

    def rest() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            g, h = rest()
            step = rate * _shallow_tree(np.bincount(b[:, f], g, len(table)), np.bincount(b[:, f], h, len(table)), 2, ridge)
            table += step
            total += step[b[:, f]]

    def grid(f: int, e: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[f]), len(model.tables[e])
        at = b[:, f] * shape[1] + b[:, e]
        return np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape)

    g, h = rest()
    each = [(f, e) for f in range(x.shape[1]) for e in range(f)]
    gains = {(f, e): _quadrants(*grid(f, e, g, h), ridge)[0] for f, e in each}
    model.pairs = [(f, e, np.zeros((len(model.tables[f]), len(model.tables[e])))) for f, e in sorted(each, key=gains.get, reverse=True)[:pairs]]
    for _ in range(pair_rounds):
        for f, e, table in model.pairs:
            step = rate * _quadrants(*grid(f, e, *rest()), ridge)[1]
            table += step
            total += step[b[:, f], b[:, e]]
    return model


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(-1, len(FEATURES))
            scores = model.scores(x) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], pa.array(scores)], names=["id", "held_out", "score"])

    return run


def score(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 100_000, threshold: float = 0.3
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``; a fifth of the ids is never learnt from."""
    ship(docs.sparkSession)
    held_out = F.coalesce(F.crc32(col(id).cast("string")) % 5 == 0, F.lit(False))
    rows = saved(docs.select(col(id).alias("id"), held_out.alias("held_out"), features(col(text)).alias("x")), "quality-features")
    known = labels.filter(col(label).isNotNull()).groupBy(col(id).alias("id")).agg(F.avg(col(label).cast("double")).alias("y"))
    learnt = saved(rows.filter(~F.col("held_out")).join(known, "id").select("id", "x", "y"), "quality-labelled")
    part = min(1.0, max_rows / max(learnt.count(), 1))
    chosen = learnt.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(part * (1 << 30))).orderBy("id").toArrow()
    x = np.asarray(chosen["x"].combine_chunks().flatten()).reshape(-1, len(FEATURES))
    model = fit(x, (chosen["y"].to_numpy() >= 0.5).astype(float))
    schema = T.StructType([T.StructField("id", docs.schema[id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_scored(model), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
