"""Near duplicates by bottom-k sketches of one hash function.

1. A document's set holds the 64-bit hashes of its distinct word shingles. Equal
   sets are one class from here on, so copies never meet.
2. The ``k`` smallest hashes are the sketch. Inverted lists of retained values give
   candidates. A document files only its rarest values: two sets of Jaccard
   similarity ``threshold`` share c values or more of their sketches, so one of the
   len(sketch) - c + 1 rarest is shared. Sets of up to threshold * k shingles are
   kept whole and c is exact. For larger ones c lies 5.3 standard deviations below
   the expected number (34 of 64), which misses about three pairs in ten million at
   the threshold itself and fewer above it.
3. Lists of at most ``short`` documents give pairs; the bottom-k sketch of the union
   estimates their similarity, and pairs within the same 5.3 deviations go on to
   the exact test on full sets.
4. Longer lists are never expanded into pairs. Documents connected by them form
   clusters, cut into blocks by set size; tasks compare block with block on full
   sets and give back a spanning forest, at most one edge per document. Only
   blocks whose sizes allow the similarity meet. This is the exact way for the rest.
5. Connected components of the links name each class by its smallest id.

Defined results: null and empty texts have empty sets and link with nothing; fewer
words than a shingle are one shingle; equal rows get equal results; rows that share
an id but not the text are documents of their own (a class is named by its smallest
id and a hash of its set); a null id links with nothing; an empty table gives no rows.
Texts of any length are read whole: a set is one array, in one row. Other columns of
``docs`` are never touched, whatever their names.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import WORD, bitmaps, col, fresh, let, perhaps_in, saved, ship
from .components import components


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80
    k: int = 64
    short: int = 32
    block: int = 512
    block_elements: int = 400_000

    @property
    def whole(self) -> int:
        """Largest set of which even the smallest possible partner's sketch is whole."""
        return self.k * self.percent // 100

    @property
    def shared(self) -> int:
        t = self.percent / 100
        return math.floor(self.k * t - 5.3 * math.sqrt(self.k * t * (1 - t)))


def shingles(text: Column, words: int) -> Column:
    """Array of the hashes of the distinct shingles; A to Z count as small letters."""
    small = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    hashes = F.transform(F.regexp_extract_all(small, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - words)
        each = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        return F.when(F.size(h) >= words, F.array_distinct(each)).when(F.size(h) > 0, F.array(F.xxhash64(h)))

    return F.coalesce(let(hashes, grams), F.array().cast("array<bigint>"))


def _marks(docs: DataFrame, id: str, text: str, s: Settings) -> DataFrame:
    def mark(x: Column) -> Column:
        return F.struct(*set_keys(x), F.slice(x, 1, s.k).alias("sketch"))

    found = let(F.sort_array(shingles(col(text), s.words)), mark)
    return saved(docs.select(col(id).alias("id"), found.alias("m")), "near-marks").select("id", "m.*")


def _prefix(reps: DataFrame, s: Settings) -> DataFrame:
    """(id, n, v, f): the values that each class files, with the number of sketches that hold them."""
    postings = reps.select("id", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("v"))
    shared = postings.groupBy("v").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    known = postings.join(saved(shared, "near-values"), "v")
    # values held by one sketch alone are the rarest: they come first, and need no row
    rank = F.row_number().over(Window.partitionBy("id").orderBy("f", "v"))
    alone = F.col("held") - F.count(F.lit(1)).over(Window.partitionBy("id"))
    least = F.when(F.col("n") <= s.whole, F.ceil(F.col("n") * s.percent / 100)).otherwise(s.shared)
    ranked = known.withColumn("rank", rank + alone).filter(F.col("rank") <= F.col("held") - least + 1)
    return saved(ranked.select("id", "n", "v", "f"), "near-lists")


def _alike(small: Column, large: Column, s: Settings) -> Column:
    return 100 * small >= s.percent * large


def _pairs(lists: DataFrame, s: Settings) -> DataFrame:
    short = lists.filter(F.col("f") <= s.short)
    a = short.select("v", F.col("id").alias("a"), F.col("n").alias("na"))
    b = short.select("v", F.col("id").alias("b"), F.col("n").alias("nb"))
    sizes = _alike(F.least("na", "nb"), F.greatest("na", "nb"), s)
    return a.join(b, "v").filter((F.col("a") < F.col("b")) & sizes).select("a", "b").distinct()


def _estimated(pairs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    sketches = reps.select("id", "n", "sketch")
    both = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a").join(
        sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b"
    )
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, s.k)
    enough = let(union, lambda u: F.size(F.array_intersect(u, F.array_intersect("sa", "sb"))) * s.k >= s.shared * F.size(u))
    return both.filter(enough).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb")
    return both.filter(let(common, lambda c: 100 * c >= s.percent * (union - c))).select("a", "b")


def _clusters(lists: DataFrame, s: Settings) -> DataFrame:
    """(id, cluster, size class, blocks of the class and of the next ones) of documents in long lists."""
    long = lists.filter(F.col("f") > s.short)
    first = long.groupBy("v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    edges = long.join(first, "v").select(F.col("id").alias("a"), F.col("first").alias("b"))
    cluster = components(edges).withColumnRenamed("component", "cluster")
    step = math.log(100 / s.percent)
    docs = long.select("id", "n").distinct().join(cluster, "id").withColumn("c", F.floor(F.log(F.col("n")) / step).cast("int"))
    docs = saved(docs, "near-clusters")
    per_block = F.greatest(F.lit(8), F.least(F.lit(s.block), F.lit(s.block_elements) / F.max("n")))
    classes = docs.groupBy("cluster", "c").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("blocks"))
    # a cluster has at most some sixty size classes
    known = classes.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("c", "blocks"))).alias("blocks"))
    return docs.join(known, "cluster")


def _block_rows(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """Each document once for every pair of blocks that its own block is in."""
    own, above, below = (F.coalesce(F.element_at("blocks", F.col("c") + d), F.lit(0)) for d in (0, 1, -1))
    block = F.pmod(F.xxhash64("id"), own).cast("int")

    def others(n: Column, make) -> Column:
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(
            F.array().cast("array<struct<c1:int,b1:int,c2:int,b2:int,side:int>>")
        )

    def pair(c1, b1, c2, b2, side) -> Column:
        return F.struct(c1.alias("c1"), b1.alias("b1"), c2.alias("c2"), b2.alias("b2"), side.cast("int").alias("side"))

    me, my = F.col("c"), F.col("b")
    same = others(own, lambda t: pair(me, F.least(my, t), me, F.greatest(my, t), F.when(my <= t, 0).otherwise(1)))
    up = others(above, lambda t: pair(me, my, me + 1, t, F.lit(0)))
    down = others(below, lambda t: pair(me - 1, t, me, my, F.lit(1)))
    rows = clusters.withColumn("b", block).withColumn("p", F.explode(F.concat(same, up, down)))
    return rows.select("id", "cluster", "p.*").join(sets, "id")


def intersections(left: list[np.ndarray], right: list[np.ndarray], wide: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of the one list with all of the other."""
    sizes = np.array([len(x) for x in (*left, *right)])
    values, codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    shared = np.bincount(codes, minlength=len(values)) > 1  # others can't be in an intersection
    renumbered = np.cumsum(shared) - 1
    keep = shared[codes]
    codes, owner = renumbered[codes[keep]], owner[keep]
    found = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    for begin in range(0, int(shared.sum()), wide):
        a, b = np.searchsorted(codes, (begin, begin + wide))
        held = np.zeros((len(sizes), wide), np.float32)
        held[owner[a:b], codes[a:b] - begin] = 1
        found += held[: len(left)] @ held[len(left) :].T
    return found.astype(np.int64)


def forest(links: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, of each row the smallest row reachable."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare(s: Settings):
    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        sets = [np.asarray(x.values) for x in table["set"]]
        one_block = table["c1"][0].as_py() == table["c2"][0].as_py() and table["b1"][0].as_py() == table["b2"][0].as_py()
        left = np.flatnonzero(side == 0)
        right = left if one_block else np.flatnonzero(side == 1)
        at = np.arange(0)
        to = at
        if len(left) and len(right):
            n = np.array([len(x) for x in sets])
            common = intersections([sets[i] for i in left], [sets[i] for i in right])
            linked = 100 * common >= s.percent * (n[left][:, None] + n[right][None, :] - common)
            whole = np.zeros((len(sets), len(sets)), bool)
            whole[np.ix_(left, right)] = linked
            label = forest(whole | whole.T)
            at = np.flatnonzero(label < np.arange(len(sets)))
            to = label[at]
        ids = table["id"]
        return pa.table({"a": ids.take(pa.array(at)), "b": ids.take(pa.array(to))})

    return run


def set_keys(x: Column) -> list[Column]:
    """Size and two hashes of a sorted set: equal sets are one class."""
    return [F.size(x).cast("long").alias("n"), F.xxhash64(x).alias("k1"), F.xxhash64(F.lit(1), x).alias("k2")]


def _grouped(docs: DataFrame, id: str, text: str, s: Settings) -> DataFrame:
    """(id, n, k1, k2, component) per row; components are (id, k1), the smallest class of the group."""
    ship(docs.sparkSession)
    marks = _marks(docs, id, text, s)
    full = marks.filter((F.col("n") > 0) & F.col("id").isNotNull())
    # an id may have several texts: a class goes by the smallest id of its rows and a hash of its set
    name = F.struct("r.id", "k1").alias("id")
    classes = saved(
        full.groupBy("n", "k1", "k2").agg(F.min(F.struct("id", "sketch")).alias("r")).select("n", "k1", "k2", name, "r.sketch"),
        "near-classes",
    )
    reps = classes.select("id", "n", "sketch")
    lists = _prefix(reps, s)
    pairs = saved(_estimated(_pairs(lists, s), reps, s), "near-pairs")
    clusters = saved(_clusters(lists, s), "near-blocks")
    # full sets, of the documents that are compared only
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(clusters.select("id")).distinct()
    asked = saved(asked.join(classes.select("id", "n", "k1", "k2"), "id"), "near-asked")
    wanted = asked.select("id.id").distinct()
    read = perhaps_in(docs.select(col(id).alias("id"), col(text).alias("text")), F.col("id"), bitmaps(wanted), "perhaps")
    compared = read.filter("perhaps").join(wanted, "id", "left_semi")
    sets = compared.select("id", F.sort_array(shingles(F.col("text"), s.words)).alias("set"))
    sets = sets.select(F.struct("id", F.xxhash64("set").alias("k1")).alias("id"), "set", *set_keys(F.col("set")))
    sets = saved(sets.join(asked, ["id", "n", "k1", "k2"], "left_semi").dropDuplicates(["id"]).select("id", "set"), "near-sets")
    kind = classes.schema["id"].dataType
    edge = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    hot = _block_rows(clusters, sets).groupBy("cluster", "c1", "b1", "c2", "b2").applyInArrow(_compare(s), edge)
    linked = components(saved(_verified(pairs, sets, s).union(hot), "near-links"))
    groups = classes.select("n", "k1", "k2", "id").join(linked, "id", "left")
    groups = groups.select("n", "k1", "k2", F.coalesce("component", "id").alias("component"))
    found = full.select("id", "n", "k1", "k2").join(groups, ["n", "k1", "k2"]).select("id", "n", "k1", "k2", "component")
    rest = marks.filter((F.col("n") == 0) | F.col("id").isNull())
    return found.union(rest.select("id", "n", "k1", "k2", F.struct("id", "k1").alias("component")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs``."""
    found = _grouped(docs, id, text, settings).select("id", F.col("n").alias("n_shingles"), F.col("component.id").alias("component_id"))
    return found.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay when of each group only the document with the smallest id does.

    Rows equal in id and text count as copies too, and one stays. Rows without an id
    stay. Of an id with several texts each text stays or goes for itself.
    """
    found = saved(_grouped(docs, id, text, settings), "near-result")
    first = F.struct("id", "k1").eqNullSafe(F.col("component"))
    gone = saved(found.filter(~first).select("id", "k1").distinct(), "near-gone")
    often = found.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    often = saved(often.select("id"), "near-often")
    name, hashed, perhaps = fresh(docs, "its_id"), fresh(docs, "its_k1"), fresh(docs, "perhaps")
    same = col(id) == F.col(name)
    # only rows that the bitmap can't clear are shuffled
    listed = saved(gone.select("id").union(often).distinct(), "near-listed")
    read = perhaps_in(docs, col(id), bitmaps(listed), perhaps)
    surely = read.filter(~F.col(perhaps)).drop(perhaps)
    rows = read.filter(perhaps).drop(perhaps)
    plain = rows.join(listed.withColumnRenamed("id", name), same, "left_anti").union(surely)
    if often.isEmpty():
        return plain
    its_set = F.sort_array(shingles(col(text), settings.words))
    shared = rows.join(often.withColumnRenamed("id", name), same, "left_semi").withColumn(hashed, F.xxhash64(its_set))
    theirs = gone.select(F.col("id").alias(name), F.col("k1").alias("k1"))
    stay = shared.join(theirs, same & (F.col(hashed) == theirs["k1"]), "left_anti").drop(hashed)
    return plain.union(stay.dropDuplicates([id, text]))
