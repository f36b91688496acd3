"""Near-duplicate vectors by a forest of random-projection trees.

1. Equal vectors are one class with a number of copies; copies never meet.
2. Each tree splits a bounded sample (``sample`` vectors) again and again by a
   direction at the median, until a leaf stands for about ``leaf`` vectors of the
   table. Vectors within a margin of a cut go to both sides. The margin is thin: just
   so wide that a pair at the threshold is parted with probability ``parted``, which
   each node measures on its own vectors; of ``tries`` directions the one with the
   smallest sides is taken. The number of trees follows from the levels, so that such
   a pair meets in one of them (``missed``); the rows per vector grow about as the
   fifth root of the table. A node whose cut would save less than a tenth of its
   comparisons, as in dense groups, is a leaf of any size.
3. Tight groups larger than a leaf have a core: the vectors within half the angle of
   the threshold of a centre (at most ``cores`` of them, from the sample). All pairs of
   a core are linked, by the triangle inequality: they are counted, never compared.
4. Within a leaf all other cosines are taken in double precision. Leaves with more
   than ``block`` vectors are compared block with block in several tasks. A pair found
   in several leaves counts in the first common one. Each task gives back one row per
   vector: its links there and a spanning forest.
5. Sums give the number of links, connected components the groups.

What stays quadratic is a loose group: vectors nearer than about twice the threshold's
distance, but outside a core. No cut helps there, and their links differ one by one.

Every link reported is exact. Links between vectors that no tree puts together are
missed: fewer than 0.01 of them (see the tests).

Defined results: vectors that are null, empty, zero or have null or non-finite
parts link with nothing, nor do rows with a null id or vectors of different length;
equal rows count as vectors of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, saved, ship
from .components import components
from .near_duplicates import forest


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.9
    trees: int | None = None
    parted: float = 0.1
    missed: float = 0.002
    leaf: int = 1000
    tries: int = 8
    block: int = 2048
    cores: int = 32
    sample: int = 50_000
    seed: int = 5

    def forest_size(self, n: int) -> int:
        """Trees after which a pair at the threshold among ``n`` vectors has met but for ``missed``."""
        together = (1 - self.parted) ** math.log2(max(n / self.leaf, 2))
        return self.trees or max(4, math.ceil(math.log(self.missed) / math.log(1 - together)))

    @property
    def core_cosine(self) -> float:
        """Two vectors this near to a third one are linked, rounding included."""
        return math.cos(math.acos(self.cosine) / 2 - 1e-7)


@dataclass
class Tree:
    """Nodes as arrays; a child below 0 is the leaf -1 - child."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int


def parting_margin(from_cut: np.ndarray, step: np.ndarray, parted: float) -> np.ndarray:
    """Per column the margin that leaves ``parted`` of the pairs (x, x + step) on two sides of the cut."""
    partner = from_cut + step
    nearer = np.minimum(np.abs(from_cut), np.abs(partner))
    return np.quantile(np.where(from_cut * partner < 0, nearer, 0), 1 - parted, axis=0)


def core_centres(unit: np.ndarray, scale: float, s: Settings) -> np.ndarray:
    """Centres of tight groups that stand for more than a leaf, largest first."""
    random = np.random.default_rng(s.seed)
    tried = unit[random.permutation(len(unit))[:500]]
    near = unit @ tried.T >= s.cosine
    left, centres = np.ones(len(unit), bool), []
    while len(centres) < s.cores and len(tried):
        sizes = (near & left[:, None]).sum(axis=0)
        best = sizes.argmax()
        if sizes[best] * scale <= s.leaf or sizes[best] < 8:
            break
        members = near[:, best] & left
        centre = unit[members].mean(axis=0)
        centre /= max(np.linalg.norm(centre), 1e-300)
        left &= ~members
        if ((unit[members] @ centre) >= s.core_cosine).sum() * scale > s.leaf:
            centres.append(centre)
    return np.array(centres).reshape(-1, unit.shape[1])


def grow(unit: np.ndarray, scale: float, s: Settings, seed: int) -> Tree:
    """A tree over sampled unit vectors, each of which stands for ``scale`` vectors."""
    random = np.random.default_rng(seed)
    directions, low, high, left, right = [], [], [], [], []
    leaves = 0

    def link(parent: int, side: list[int], child: int) -> None:
        if parent >= 0:
            side[parent] = child

    # a direction of length sqrt(dim) keeps distances in the mean
    distance = np.sqrt(2 * max(1 - s.cosine, 0.0))
    todo: list[tuple[np.ndarray, int, list[int]]] = [(np.arange(len(unit)), -1, left)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) * scale > s.leaf and len(rows) >= 8:
            tried = random.standard_normal((s.tries, unit.shape[1])).astype(np.float32)
            tried *= np.sqrt(unit.shape[1]) / np.linalg.norm(tried, axis=1, keepdims=True)
            p = unit[rows] @ tried.T
            cuts = np.median(p, axis=0)
            one = p[random.integers(0, len(rows), 1000)]
            margin = parting_margin(one - cuts, distance * random.standard_normal(one.shape), s.parted)
            work = (p <= cuts + margin).sum(axis=0) ** 2 + (p >= cuts - margin).sum(axis=0) ** 2
            k = work.argmin()
            if work[k] < 0.9 * len(rows) ** 2:
                low_, high_ = cuts[k] - margin[k], cuts[k] + margin[k]
                split = tried[k], low_, high_, rows[p[:, k] <= high_], rows[p[:, k] >= low_]
        if split is None:
            link(parent, side, -1 - leaves)
            leaves += 1
            continue
        me = len(low)
        link(parent, side, me)
        directions.append(split[0])
        low.append(split[1])
        high.append(split[2])
        left.append(0)
        right.append(0)
        todo += [(split[3], me, left), (split[4], me, right)]
    dim = unit.shape[1]
    return Tree(np.array(directions, np.float32).reshape(-1, dim), np.array(low), np.array(high), np.array(left, int), np.array(right, int), leaves)


def route(tree: Tree, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for all leaves of all rows."""
    rows_out, leaves_out = [], []
    todo = [(0 if len(tree.low) else -1, np.arange(len(unit)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node < 0:
            rows_out.append(rows)
            leaves_out.append(np.full(len(rows), -1 - node))
            continue
        p = unit[rows] @ tree.directions[node]
        todo += [(tree.left[node], rows[p <= tree.high[node]]), (tree.right[node], rows[p >= tree.low[node]])]
    if not rows_out:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(rows_out), np.concatenate(leaves_out)


def units(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of unit length, in double precision."""
    flat = np.asarray(lists.flatten().cast(pa.float64())).reshape(-1, dim)
    largest = np.abs(flat).max(axis=1, keepdims=True)  # squares of very large or small parts would leave the range
    flat = flat / largest
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


@dataclass
class Forest:
    trees: list[Tree]
    centres: np.ndarray


def core_of(unit: np.ndarray, centres: np.ndarray, s: Settings) -> np.ndarray:
    """The first centre whose core a vector is in, or -1."""
    inside = unit @ centres.T >= s.core_cosine
    return np.where(inside.any(axis=1), inside.argmax(axis=1) if len(centres) else 0, -1)


def _routed(forests: dict[int, Forest], s: Settings, most: int):
    """Rows (leaf, core, id, copies, vector, leaves), once per leaf. Numbers of leaves and cores have the vector length in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch["vector"].value_lengths())
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                forest_ = forests.get(int(dim))
                for begin in range(0, len(part), 1000):
                    some = part.slice(begin, 1000)
                    unit = units(some["vector"], int(dim))
                    single = unit.astype(np.float32)
                    # without a sample of this length there is one leaf
                    found = [route(t, single) for t in forest_.trees] if forest_ else [(np.arange(len(some)), np.zeros(len(some), int))]
                    core = core_of(unit, forest_.centres, s) if forest_ else np.full(len(some), -1)
                    core = np.where(core < 0, -1, int(dim) * s.cores + core)
                    rows = np.concatenate([r for r, _ in found])
                    names = np.concatenate([(int(dim) * most + k << 32) + leaf for k, (_, leaf) in enumerate(found)])
                    order = np.lexsort((names, rows))
                    rows, names = rows[order], names[order]
                    counts = np.bincount(rows, minlength=len(some))
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                    per_row = pa.ListArray.from_arrays(offsets, pa.array(names))
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names), pa.array(core[rows]), some["id"].take(at), some["copies"].take(at), some["vector"].take(at), per_row.take(at)],
                        names=["leaf", "core", "id", "copies", "vector", "leaves"],
                    )

    return run


def met_before(leaves: pa.Array, leaf: int) -> np.ndarray:
    """Which rows share a leaf with a smaller number: their links are counted there."""
    sizes = np.asarray(leaves.value_lengths())
    flat, owner = np.asarray(leaves.flatten()), np.repeat(np.arange(len(sizes)), sizes)
    earlier = flat < leaf
    names, codes = np.unique(flat[earlier], return_inverse=True)
    held = np.zeros((len(sizes), len(names)), np.float32)
    held[owner[earlier], codes] = 1
    return held @ held.T > 0


def _compare(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        leaf = table["leaf"][0].as_py()
        vectors = table["vector"].combine_chunks()
        unit = units(vectors, len(vectors[0]))
        side = table["side"].to_numpy()
        one_block = table["p1"][0].as_py() == table["p2"][0].as_py()
        left = np.flatnonzero(side == 0)
        right = left if one_block else np.flatnonzero(side == 1)
        close = unit[left] @ unit[right].T >= cosine
        if one_block:
            np.fill_diagonal(close, False)
        # most vectors have no link: the rest is about those that have
        some = np.union1d(left[close.any(axis=1)], right[close.any(axis=0)])
        place = np.full(len(side), -1)
        place[some] = np.arange(len(some))
        i, j = np.nonzero(close)
        linked = np.zeros((len(some), len(some)), bool)
        linked[place[left[i]], place[right[j]]] = True
        linked |= linked.T
        label = forest(linked)
        copies = table["copies"].to_numpy()[some].astype(float)
        here = linked & ~met_before(table["leaves"].combine_chunks().take(pa.array(some)), leaf)
        ids = table["id"].take(pa.array(some))
        return pa.table({"id": ids, "links": pa.array((here @ copies).astype(np.int64)), "to": ids.take(pa.array(label))})

    return run


def _sampled(classes: DataFrame, n: int, s: Settings) -> dict[int, Forest]:
    """The forest of each vector length, from at most about ``sample`` vectors in the driver."""
    part = min(1.0, s.sample / max(n, 1))
    rows = classes.filter(F.pmod(F.xxhash64(F.lit(s.seed), "id"), F.lit(1 << 30)) < int(part * (1 << 30))).select("vector").toArrow()
    vectors = rows["vector"].combine_chunks()
    if not len(vectors):
        return {}
    dims = np.asarray(vectors.value_lengths())
    found = {}
    for dim in np.unique(dims).tolist():
        unit = units(vectors.take(pa.array(np.flatnonzero(dims == dim))), dim)
        centres = core_centres(unit, 1 / part, s)
        # cores need no leaves of their own: the trees divide the others
        others = unit[core_of(unit, centres, s) < 0].astype(np.float32)
        found[dim] = Forest([grow(others, 1 / part, s, s.seed * 1000 + k) for k in range(s.forest_size(n))], centres)
    return found


def _dealt(routed: DataFrame, s: Settings) -> DataFrame:
    """Each row of a leaf once for every pair of blocks that its block is in. A block holds one core or none; blocks of one core never meet."""
    sizes = routed.groupBy("leaf", "core").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("n"))
    # a leaf has at most one row per core, and one without
    known = saved(sizes.groupBy("leaf").agg(F.collect_list(F.struct("core", "n")).alias("parts")), "vector-blocks")

    def block(core: Column, number: Column) -> Column:
        return F.struct(core.alias("core"), number.alias("b"))

    every = F.flatten(
        F.transform("parts", lambda part: F.transform(F.sequence(F.lit(0), part["n"] - 1), lambda b: block(part["core"], b)))
    )
    others = F.filter(every, lambda x: (x["core"] != F.col("core")) | (x["core"] < 0))
    own = F.filter("parts", lambda part: part["core"] == F.col("core"))[0]["n"]
    rows = routed.join(known, "leaf").withColumn("mine", block(F.col("core"), F.pmod(F.xxhash64("id"), own).cast("int")))
    rows = rows.withColumn("other", F.explode(others))
    return rows.select(
        "leaf", "id", "copies", "vector", "leaves", F.least("mine", "other").alias("p1"), F.greatest("mine", "other").alias("p2"),
        F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"),
    )


def _within_cores(routed: DataFrame) -> DataFrame:
    """(id, links, to): what each vector of a core owes to the others of it."""
    once = routed.filter((F.col("core") >= 0) & (F.col("leaf") == F.get("leaves", F.lit(0)))).select("core", "id", "copies")
    whole = saved(once.groupBy("core").agg(F.sum("copies").alias("total"), F.min("id").alias("to")), "vector-cores")
    return once.join(whole, "core").select("id", (F.col("total") - F.col("copies")).alias("links"), "to")


def links(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``."""
    s = settings
    ship(vectors.sparkSession)
    doubles = F.col("vector").cast("array<double>")
    sound = (
        F.col("id").isNotNull() & (F.size("vector") > 0)
        & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(doubles, lambda x: x != 0)
    )
    read = vectors.select(col(id).alias("id"), col(vector).alias("vector")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    keys = [F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2")]
    good = read.filter("sound").select("id", *keys, "vector")
    classes = saved(
        good.groupBy("k1", "k2").agg(F.min(F.struct("id", "vector")).alias("r"), F.count(F.lit(1)).alias("copies")).select("k1", "k2", "copies", "r.*"),
        "vector-classes",
    )
    n = classes.count()
    forests = _sampled(classes, n, s)
    kind, parts = vectors.schema[id].dataType, vectors.schema[vector].dataType
    leaf_row = T.StructType([
        T.StructField("leaf", T.LongType()), T.StructField("core", T.LongType()), T.StructField("id", kind),
        T.StructField("copies", T.LongType()), T.StructField("vector", parts), T.StructField("leaves", T.ArrayType(T.LongType())),
    ])
    routed = classes.select("id", "copies", "vector").mapInArrow(_routed(forests, s, s.forest_size(n)), leaf_row)
    routed = saved(routed, "vector-leaves")
    out = T.StructType([T.StructField("id", kind), T.StructField("links", T.LongType()), T.StructField("to", kind)])
    compared = _dealt(routed, s).groupBy("leaf", "p1", "p2").applyInArrow(_compare(s.cosine), out)
    found = saved(compared.union(_within_cores(routed)), "vector-links")
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    known = classes.select("k1", "k2", "copies", "id").join(sums, "id", "left").join(groups, "id", "left")
    known = known.select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    whole = good.select("id", "k1", "k2").join(known, ["k1", "k2"]).select("id", "n_links", "component_id")
    rest = read.filter(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return whole.union(rest).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
