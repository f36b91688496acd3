"""A Merkle manifest of a table: a tree per source, one over their roots, and proofs by a recursive climb.

A row's leaf is the digest of its fields. The leaves of a source stand in order of their
ids; as long as there are several nodes, each ``FAN`` neighbours become their digest. What
remains is the source's subroot, and the subroots become the root the same way.

*Order.* Positions come from one range exchange of the leaves (digests and ids, not texts)
and the row numbers inside its partitions, so a source with a third of all rows, or one
id with as many, is in many tasks. Equal leaves are told apart by their place in the
table that holds them.

*Levels.* Each level is written: one row per run of neighbours with its children's
digests and the link to its parent (level, tree, run, place there).

*Climb.* A recursive query starts from the runs of leaves. A row has the leaves of one
run, which have all further siblings in common; each step joins the parent, folds the
digest of every leaf (the one recomputed from perhaps altered fields) into its place among
the parent's children, and appends the siblings found there. It ends at the root. So the
siblings of a run are kept once instead of once per leaf, and no row grows with the table,
but for some 1,000 characters a level.

Defined results: a null field is ``-`` in the leaf; null sources are a source of their own,
the first; null ids come first; rows with equal ids are leaves of their own, ordered by
digest; a lone leaf is its source's subroot and a lone subroot the root, without siblings
of their own; a text of any length counts whole; an empty table has no root and gives no
rows. Fields are named by the caller, other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, saved

FAN = 16
LINK = ("up_level", "up_tree", "up_run", "up_place")
#: The tree of subroots among the numbered ones of the sources.
TOP = -1


def field(value: Column) -> Column:
    """A value in a leaf: ``-`` or its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def ascii_lower(text: Column) -> Column:
    """``text`` with small letters for A-Z alone."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, capitals, capitals.lower()))


def digest_of(children: Column) -> Column:
    """The digest of neighbours: of their digests' hexadecimal text, one after the other."""
    return F.unhex(F.sha2(text_of(children), 256))


def text_of(digests: Column) -> Column:
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def numbered(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` with ``position``, from 0 in this order over all rows."""
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tie.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = saved(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    joined = placed.withColumn("_part", part).join(saved(begins, f"{label}-begins"), "_part")
    return joined.withColumn("position", F.col("_begin") + row).drop("_part", "_at", "_begin")


def _run(i: Column) -> Column:
    return (i / FAN).cast("long")


def _up(level: int, n: Column, i: Column, beyond: Column | None) -> Column:
    """The link of node ``i`` of ``n`` at a level of its tree: to the next level, or to ``beyond`` from the last node."""
    link = lambda le, t, r, p: F.struct(F.lit(le).alias("up_level"), t.alias("up_tree"), r.alias("up_run"), p.cast("int").alias("up_place"))
    none = F.lit(None).cast("long")
    last = link(None, none, none, none) if beyond is None else link(1, F.lit(TOP).cast("long"), _run(beyond), beyond % FAN)
    return F.when(n > 1, link(level + 1, F.col("tree"), _run(i), i % FAN)).otherwise(last)


def _levels(nodes: DataFrame, most: int, beyond: Column | None, label: str, base: int = 0) -> list[DataFrame]:
    """The levels above (tree, i, n, digest), which is level ``base``: level, tree, run, n, children, digest and the link upwards."""
    levels = []
    while most > 1:
        level, most = base + len(levels) + 1, -(-most // FAN)
        runs = (
            nodes.filter("n > 1")
            .groupBy("tree", _run(F.col("i")).alias("run"))
            .agg(F.first(F.ceil(F.col("n") / FAN).cast("long")).alias("n"), F.sort_array(F.collect_list(F.struct("i", "digest")))["digest"].alias("children"))
        )
        row = runs.select(
            F.lit(level).alias("level"), "tree", "run", "n", "children", digest_of(F.col("children")).alias("digest"),
            _up(level, F.col("n"), F.col("run"), beyond).alias("up"),
        ).select("level", "tree", "run", "n", "children", "digest", "up.*")
        levels.append(saved(row, f"{label}-{level}"))
        nodes = levels[-1].withColumnRenamed("run", "i")
    return levels


@dataclass(frozen=True)
class Manifest:
    """The built tree: leaves in runs, levels of parent-linked nodes, subroots, and the root (None for an empty table).

    ``starts``: bundle, tree, run, n, leaves (array of id and leaf), ``folded`` (digests of the run, one per leaf, with its
    altered digest in place) and the link from there. ``nodes``: level, tree, run, n, children, digest and the link; without
    the runs of leaves. Digests are 32 bytes, the root is text.
    """

    starts: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def others(children: Column, place: Column) -> Column:
    """The siblings of the child at a place."""
    return F.concat(F.slice(children, F.lit(1), place), F.slice(children, place + 2, F.lit(FAN)))


def fold(children: Column, place: Column, digest: Column) -> Column:
    """The parent's digest with ``digest`` in place of the child there."""
    return digest_of(F.concat(F.slice(children, F.lit(1), place), F.array(digest), F.slice(children, place + 2, F.lit(FAN))))


def build(docs: DataFrame, fields: list[str], id: str = "doc_id", source: str = "source", altered: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``altered`` gives other values of fields, from which the digests to be checked are made."""
    changed = [(altered or {}).get(f, col(f)) for f in fields]
    leaves = saved(
        docs.select(
            col(id).alias("id"), col(source).alias("source"), F.unhex(leaf_digest(*[col(f) for f in fields])).alias("leaf"),
            F.unhex(leaf_digest(*changed)).alias("altered"),
        ),
        "leaves",
    )
    inorder = numbered(leaves, [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("altered")], "leaves-in-order")
    found = inorder.groupBy("source").agg(F.min("position").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = saved(numbered(found, [F.col("start")], "trees").withColumnRenamed("position", "tree").withColumnRenamed("source", "its_source"), "trees")
    count, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    placed = inorder.join(trees, F.col("source").eqNullSafe(F.col("its_source"))).withColumn("i", F.col("position") - F.col("start"))
    beyond = F.col("tree") if count > 1 else None

    item = F.struct("i", "leaf", "altered", "id", "position")
    runs = placed.groupBy("tree", "n", _run(F.col("i")).alias("run")).agg(F.sort_array(F.collect_list(item)).alias("leaves"))
    children = F.col("leaves")["leaf"]
    above = F.ceil(F.col("n") / FAN).cast("long")
    link = F.when(F.col("n") > 1, _up(1, above, F.col("run"), beyond)).otherwise(_up(0, F.col("n"), F.col("run"), beyond))
    folded = F.transform("leaves", lambda x, k: F.when(F.col("n") > 1, fold(children, k, x["altered"])).otherwise(x["altered"]))
    starts = saved(
        runs.select(
            F.get(F.col("leaves")["position"], F.lit(0)).alias("bundle"), "tree", "run", "n",
            F.transform("leaves", lambda x: F.struct(x["id"].alias("id"), x["leaf"].alias("leaf"))).alias("leaves"),
            folded.alias("folded"), link.alias("up"),
        ).select("*", "up.*").drop("up"),
        "leaf-runs",
    )

    first = starts.filter("n > 1").select("tree", F.col("run").alias("i"), above.alias("n"), digest_of(children).alias("digest"))
    inner = _levels(first, -(-most // FAN), beyond, "level", base=1)
    lone = starts.filter("n = 1").select("tree", F.get(children, F.lit(0)).alias("subroot"))
    tops = first.filter("n = 1").select("tree", F.col("digest").alias("subroot"))
    for level in inner:
        tops = tops.unionByName(level.filter("n = 1").select("tree", F.col("digest").alias("subroot")))
    subroots = saved(lone.unionByName(tops), "subroots")
    heads = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("i"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"))
    upper = _levels(heads, count, None, "top")
    last = upper[-1].select("digest") if upper else subroots.select("subroot")
    root = bytes(last.first()[0]).hex() if count else None
    nodes = None
    for level in [*inner, *upper]:
        nodes = level if nodes is None else nodes.unionByName(level)
    if nodes is None:
        nodes = _levels(heads.withColumn("n", F.lit(2).cast("long")), 2, None, "none")[0].limit(0)
    return Manifest(starts, saved(nodes, "nodes"), subroots, root)


CLIMB = f"""
WITH RECURSIVE climb(bundle, step, up_level, up_tree, up_run, up_place, folded, siblings) AS (
  SELECT bundle, 0, up_level, up_tree, up_run, up_place, folded, CAST(array() AS array<binary>) FROM {{starts}}
  UNION ALL
  SELECT c.bundle, c.step + 1, n.up_level, n.up_tree, n.up_run, n.up_place,
    transform(c.folded, f -> unhex(sha2(array_join(transform(
      concat(slice(n.children, 1, c.up_place), array(f), slice(n.children, c.up_place + 2, {FAN})), d -> lower(hex(d))), ''), 256))),
    concat(slice(n.children, 1, c.up_place), slice(n.children, c.up_place + 2, {FAN}))
  FROM climb c JOIN {{nodes}} n ON n.level = c.up_level AND n.tree = c.up_tree AND n.run = c.up_run
)
SELECT bundle, step, siblings, CASE WHEN up_level IS NULL THEN folded END AS folded FROM climb
"""


def climb(manifest: Manifest) -> DataFrame:
    """(bundle, folded, siblings) at the root: the folded digest per leaf of the bundle, and what all of them met above their run.

    The query's rows are the steps of each bundle; a step's siblings stay in its own row and are appended at the end, so the
    next step doesn't carry them.
    """
    spark = manifest.nodes.sparkSession
    starts = manifest.starts.select("bundle", *LINK, "folded")
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    try:
        steps = spark.sql(CLIMB, starts=starts, nodes=manifest.nodes)
        path = F.sort_array(F.collect_list(F.struct("step", "siblings", "folded")))
        whole = steps.groupBy("bundle").agg(path.alias("path"))
        last = F.element_at("path", -1)["folded"]
        return saved(whole.select("bundle", last.alias("folded"), F.flatten(F.col("path")["siblings"]).alias("siblings")), "climb")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)


def proofs(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, siblings, folded_root, verified) per row, digests as text; ``siblings`` from the leaf to the root, joined."""
    ends = climb(manifest).withColumnRenamed("folded", "at_root")
    rows = manifest.starts.join(ends, "bundle").join(manifest.subroots, "tree")
    digests, text = F.col("leaves")["leaf"], lambda d: F.lower(F.hex(d))
    each = F.transform(
        F.sequence(F.lit(0), F.size("leaves") - 1),
        lambda k: F.struct(
            F.get("leaves", k)["id"].alias("id"), text(F.get("leaves", k)["leaf"]).alias("leaf"), text_of(others(digests, k)).alias("own"),
            text(F.get("at_root", k)).alias("folded_root"),
        ),
    )
    one = rows.select(F.explode(each).alias("x"), text(F.col("subroot")).alias("subroot"), text_of(F.col("siblings")).alias("above"))
    root = F.lit(manifest.root).cast("string")
    return one.select(
        "x.id", "x.leaf", "subroot", root.alias("root"), F.concat("x.own", "above").alias("siblings"), "x.folded_root",
        (F.col("x.folded_root") == root).alias("verified"),
    )
