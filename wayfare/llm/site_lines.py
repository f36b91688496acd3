"""Boilerplate lines of a site: lines that a large part of the host's pages contain.

Lines are compared trimmed, by a 64-bit digest together with the host. Each page
counts once per line; counts are combined in the map tasks, so a line found on
every page, or a host with a third of all pages, arrives as one row per task.
At most (mean lines per page) / ``max_ratio`` lines of a host can pass the ratio:
that bounds the array of digests that is joined back to the pages by host, and
texts are not shuffled when that table is small.

Defined results: blank lines are neither counted nor dropped; null text stays
null; a null host is one host; equal rows are pages of their own; an empty table
gives no rows. ``min_pages`` keeps hosts with a page or two as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank_trimmed, col, fresh, let, saved


def _digest(line: Column) -> Column:
    trimmed = blank_trimmed(line)
    return F.when(F.length(trimmed) > 0, F.xxhash64(trimmed))


def boilerplate(docs: DataFrame, text: str, host: str, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): digests of the host's lines that pages hold more often than ``max_ratio``."""
    pages = docs.select(
        col(host).alias("host"),
        F.array_distinct(F.filter(F.transform(F.split(col(text), "\n"), _digest), lambda d: d.isNotNull())).alias("lines"),
    )
    # the number of pages travels as one more "line" of each page, so that one pass counts both
    counted = (
        pages.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), F.coalesce("lines", F.array()))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = saved(counted.filter((F.col("n") >= min_pages) | F.col("line").isNull()), "site-lines")
    totals = counted.filter(F.col("line").isNull()).select(F.col("host").alias("h"), F.col("n").alias("pages"))
    often = counted.filter(F.col("line").isNotNull()).join(totals, F.col("host").eqNullSafe(F.col("h")))
    return often.filter(F.col("n") > max_ratio * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    max_ratio: float = 0.05,
    min_pages: int = 3,
    counts_as: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of their texts.

    ``counts_as`` names two columns to add: the lines of the text and the dropped ones.
    """
    lines = saved(boilerplate(docs, text, host, max_ratio, min_pages), "site-boilerplate")
    its, found = fresh(docs, "its_host"), fresh(docs, "its_lines")
    joined = docs.join(
        lines.select(F.col("host").alias(its), F.col("lines").alias(found)), col(host).eqNullSafe(F.col(its)), "left"
    ).drop(its)
    stays = lambda line: ~F.coalesce(F.array_contains(F.col(found), _digest(line)), F.lit(False))
    kept = F.filter(F.split(col(text), "\n"), stays)
    if counts_as:
        n_lines = F.coalesce(F.size(F.split(col(text), "\n")), F.lit(0)).cast("long")
        done = let(kept, lambda k: F.struct(F.array_join(k, "\n").alias("text"), F.size(k).cast("long").alias("n")))
        result = fresh(joined, "result")
        joined = joined.withColumn(result, F.when(F.col(found).isNull(), F.struct(col(text).alias("text"), n_lines.alias("n"))).otherwise(done))
        joined = joined.withColumn(counts_as[0], n_lines)
        joined = joined.withColumn(counts_as[1], F.col(counts_as[0]) - F.greatest(F.col(result)["n"], F.lit(0)))
        return joined.withColumn(text, F.col(result)["text"]).drop(found, result)
    return joined.withColumn(text, F.when(F.col(found).isNull(), col(text)).otherwise(F.array_join(kept, "\n"))).drop(found)
