"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of the word budget; shares above ``max_copies`` times
the source's words stop there, and what they leave goes to the others by weight.
Inside a source a document's expected number of copies grows with its
importance (rounded to eighth powers of two, by default the number of binary
digits of its size) and stops at ``max_copies``. Whole copies are certain; for the
rest documents are ranked by random odds over inclusion odds, and the ranking is
taken as far as the words that are left, to the nearest document.

The ranking of a source is never sorted as a whole: words are summed per bucket
of the ranking key, the bucket with the cut is summed in finer buckets, and only
the documents of one fine bucket are ordered. The decision is then a function of
the row and one small row per source, so texts are not shuffled by id.

Defined results: null texts have size 0; documents without words are taken 0
times; a null source is a source of its own and comes last; equal rows share
their ranking and are taken alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, n_words, saved

KEY_BITS, COARSE, FINE = 52, 42, 32


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_copies: int) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source."""
    totals = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.row_number().over(order) - 1) % len(weights) + 1,
    )
    ranked = (
        totals.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * float(max_copies))
        .withColumn("all_words", F.sum("source_size").over(Window.partitionBy()) * float(budget))
    )
    # the level if all before have got their most; the first that holds is the highest that holds
    up = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    later = up.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("all_words") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    levels = ranked.withColumn("level", F.when(level * F.col("weight") <= F.col("most"), level))
    share = F.coalesce(F.max("level").over(Window.partitionBy()), F.lit(float("inf")))
    return levels.select("source", "source_size", F.least("most", share * F.col("weight")).alias("target"))


def importance_class(importance: Column) -> Column:
    """Positive importances in eighths of a power of two, so that few classes occur."""
    return F.when(importance > 0, F.round(F.log2(importance) * 8).cast("int"))


def copies_per_weight(sizes: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Per source the factor c with sum(size * least(max_copies, c * weight)) = target, from its classes."""
    classes = sizes.filter("size > 0").groupBy("source", "class").agg(F.sum("size").alias("words"))
    joined = classes.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    down = Window.partitionBy("source").orderBy(F.col("class").desc())
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mass = F.sum(F.col("words") * _weight()).over(down.rowsBetween(0, Window.unboundedFollowing))
    c = (F.col("target") - max_copies * above) / mass
    fits = joined.withColumn("c", c).withColumn("fits", F.col("c") * _weight() <= max_copies)
    # the heaviest class that doesn't reach the most; if all do, the lightest one just does
    return fits.groupBy("source").agg(
        F.coalesce(
            F.max_by(F.when(F.col("fits"), F.col("c")), F.when(F.col("fits"), F.col("class"))),
            F.max(F.lit(float(max_copies)) / _weight()),
        ).alias("c")
    )


def _weight() -> Column:
    return F.pow(F.lit(2.0), F.col("class") / 8.0)


def _expected(max_copies: int) -> Column:
    """Expected copies; a hair's breadth from a whole number counts as that number."""
    raw = F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), F.col("c") * _weight()))
    near = F.abs(raw - F.round(raw)) < 1e-9
    return F.when(F.col("size") > 0, F.when(near, F.round(raw)).otherwise(raw)).otherwise(F.lit(0.0))


def _ranking_key(id: Column, seed: int) -> Column:
    """Random odds over inclusion odds, carried to 0..2^52 by q / (1 + q)."""
    u = (F.pmod(F.xxhash64(F.lit(seed), id), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    # q / (1 + q) with q = u (1 - p) / ((1 - u) p); u is never 0 or 1, so this never divides by 0
    above, below = u * (1 - F.col("part")), (1 - u) * F.col("part")
    return (above / (above + below) * float(1 << KEY_BITS)).cast("long")


def _cut(parts: DataFrame, bucket: Column, before: str | None) -> DataFrame:
    """Per source the first bucket in which the words left end, and the words before it."""
    start = F.col(before) if before else F.lit(0)
    buckets = parts.groupBy("source", "left", *([before] if before else []), bucket.alias("b")).agg(
        F.sum("size").alias("words")
    )
    through = start + F.sum("words").over(
        Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = buckets.withColumn("through", through).filter(F.col("through") > F.col("left"))
    return reached.groupBy("source").agg(
        F.min("b").alias("b"), F.min_by(F.col("through") - F.col("words"), "b").alias("before")
    )


def _with(df: DataFrame, small: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(small.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), how).drop("s")


def _measures(id: str, text: str, source: str, importance: Column | None) -> list[Column]:
    size = n_words(col(text))
    rank = importance if importance is not None else F.ceil(F.log2(size + 1)).cast("double")
    # documents without importance come last, not never
    at = F.when(size > 0, F.coalesce(importance_class(rank), F.lit(-8000)))
    return [col(id).alias("id"), col(source).alias("source"), size.alias("size"), at.alias("class")]


def plan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    budget: float = 1.5,
    max_copies: int = 2,
    importance: Column | None = None,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """The sizes (id, source, size, class), and per source its target, factor and cut of the ranking."""
    sizes = saved(docs.select(*_measures(id, text, source, importance)), "mix-sizes")
    targets = saved(source_targets(sizes, weights, budget, max_copies), "mix-targets")
    factors = saved(_with(targets, copies_per_weight(sizes, targets, max_copies), "left"), "mix-factors")
    expected = _with(sizes.filter("size > 0"), factors).withColumn("copies", _expected(max_copies))
    certain = expected.groupBy("source").agg(F.sum(F.floor("copies") * F.col("size")).alias("certain"))
    wanted = saved(
        _with(factors, certain, "left").withColumn(
            "left", F.greatest(F.col("target") - F.coalesce("certain", F.lit(0)), F.lit(0.0))
        ),
        "mix-wanted",
    )
    parts = (
        _with(sizes.filter("size > 0"), wanted)
        .withColumn("part", _expected(max_copies) - F.floor(_expected(max_copies)))
        .filter("part > 0")
        .withColumn("key", _ranking_key(F.col("id"), seed))
        .select("id", "source", "size", "key", "left")
    )
    first = saved(_cut(parts, F.shiftright("key", COARSE), None), "mix-cut")
    inside = _with(parts, first).filter(F.shiftright("key", COARSE) == F.col("b")).drop("b")
    second = saved(_cut(inside, F.shiftright("key", FINE), "before"), "mix-cut")
    last = _with(parts, second).filter(F.shiftright("key", FINE) == F.col("b"))
    one = last.groupBy("source", "key", "id", "left", "before").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("key", "id")
    through = F.col("before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    taken = one.withColumn("half", through - F.col("words") / 2).filter(F.col("half") <= F.col("left"))
    cut = taken.groupBy("source").agg(F.max(F.struct("key", "id")).alias("cut"))
    start = second.select("source", F.shiftleft("b", FINE).alias("from"))
    # no cut: the words left go beyond all documents
    factors = _with(_with(factors, start, "left"), cut, "left").select(
        "source", "source_size", "target", "c",
        F.coalesce(F.col("cut.key"), F.col("from"), F.lit(1 << 62)).alias("cut_key"),
        F.col("cut.id").alias("cut_id"),
    )
    return sizes, saved(factors, "mix-plan")


def _copies(id: Column, max_copies: int, seed: int) -> Column:
    expected = _expected(max_copies)
    more = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (F.col("id") <= F.col("cut_id")))
    return F.when((F.col("part") > 0) & F.coalesce(more, F.lit(False)), 1).otherwise(0) + F.floor(expected)


def _counted(rows: DataFrame, planned: DataFrame, max_copies: int, seed: int) -> DataFrame:
    expected = _expected(max_copies)
    return (
        _with(rows, planned, "left")
        .withColumn("part", expected - F.floor(expected))
        .withColumn("key", F.when(F.col("part") > 0, _ranking_key(F.col("id"), seed)))
        .withColumn("copies", F.coalesce(_copies(F.col("id"), max_copies, seed), F.lit(0)).cast("long"))
    )


def decide(sizes: DataFrame, planned: DataFrame, max_copies: int = 2, seed: int = 17) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for each row of ``sizes``."""
    counted = _counted(sizes, planned, max_copies, seed).withColumn("taken", F.col("copies") * F.col("size"))
    return counted.select("id", "source", "size", "source_size", "target", "copies", "taken")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    max_copies, seed = options.get("max_copies", 2), options.get("seed", 17)
    sizes, planned = plan(docs, id, text, source, **options)
    measures = _measures(id, text, source, options.get("importance"))
    keyed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), *measures)
    copies = _counted(keyed, planned, max_copies, seed).filter("copies > 0")
    return copies.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
