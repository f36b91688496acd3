"""Quality rules per document, and a verdict per host.

Counts per document are one row-local expression: no text is shuffled. Rule
failures are summed per host (combined in the map tasks, so a host with a third
of all rows arrives as one row per task). A host's failure rate is shrunk with a
beta prior fitted to all hosts by the method of moments: a host with few pages
is drawn towards the corpus, a large one keeps its own rate. Documents of hosts
above ``max_host_rate`` are rejected with it.

Defined results: null or empty text has no words and fails; a null host is one
host of its own; equal rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, col, fresh, let, n_words, saved

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5


def repeat_words(text: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more in the text, the first time included."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")
            ),
        )

    def starts(s: Column) -> Column:
        twice = F.transform(
            s,
            lambda x, j: F.when(
                (F.get(s, j + 1)["h"] == x["h"]) | (F.get(s, j - 1)["h"] == x["h"]), x["at"]
            ),
        )
        return F.filter(twice, lambda at: at.isNotNull())

    def covered(w: Column) -> Column:
        repeated = let(F.sort_array(windows(w)), starts)
        return F.size(F.array_distinct(F.flatten(F.transform(repeated, lambda at: F.array(at, at + 1, at + 2)))))

    hashes = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    return let(hashes, lambda w: F.when(F.size(w) >= 4, covered(w)).otherwise(0)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def counts(text: Column, rules: Rules = Rules()) -> Column:
    """All counts and ``base_failed`` of a text, as one struct."""
    text = F.coalesce(text, F.lit(""))
    found = F.struct(
        n_words(text).alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        repeat_words(text).alias("n_repeat_words"),
    )
    failed = lambda c: (c["n_words"] < rules.min_words) | (
        100 * c["n_repeat_words"] > rules.max_repeat_percent * c["n_words"]
    )
    return let(found, lambda c: c.withField("base_failed", failed(c)))


@dataclass(frozen=True)
class Prior:
    alpha: float
    beta: float


def beta_prior(hosts: DataFrame) -> Prior:
    """Moments of the hosts' failure rates, weighted by size, less the variance that sampling explains.

    One row of sums comes to the driver. Rates that vary no more than sampling
    makes them get a strong prior; a corpus without failures, or with nothing
    else, gets a flat one.
    """
    sums = hosts.agg(
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares"),
        F.count(F.lit(1)).alias("hosts"),
    ).first()
    n, hosts_n = float(sums["n"] or 0), sums["hosts"]
    mean = float(sums["failed"] or 0) / n if n else 0.0
    if hosts_n < 2 or not 0 < mean < 1:
        return Prior(1.0, 1.0)
    spread = mean * (1 - mean)
    variance = max(float(sums["squares"]) / n - mean * mean - spread * hosts_n / n, 0.0)
    strength = min(max(spread / variance - 1, 1.0), 1000.0) if variance > 0 else 1000.0
    return Prior(mean * strength, (1 - mean) * strength)


def host_verdicts(judged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(host, n, failed, rate, host_ok) from rows of (host, base_failed)."""
    hosts = saved(
        judged.groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
        ),
        "quality-hosts",
    )
    prior = beta_prior(hosts)
    rate = (F.col("failed") + prior.alpha) / (F.col("n") + (prior.alpha + prior.beta))
    return hosts.withColumn("rate", rate).withColumn("host_ok", F.col("rate") <= rules.max_host_rate)


def assess(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: id, host, the counts, ``base_failed``, the host's shrunk rate and ``kept``."""
    judged = saved(
        docs.select(col(id).alias("id"), col(host).alias("host"), counts(col(text), rules).alias("c")), "quality"
    ).select("id", "host", "c.*")
    hosts = host_verdicts(judged.select("host", "base_failed"), rules).select(
        F.col("host").alias("its_host"), "rate", "host_ok"
    )
    joined = judged.join(hosts, F.col("host").eqNullSafe(F.col("its_host")), "left").drop("its_host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_ok")).withColumnRenamed("rate", "host_rate")


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    The rules run once: rows are written with their verdict, those that fail
    without their text, and the hosts are judged from two narrow columns of that.
    """
    its, ok, failed = fresh(docs, "its_host"), fresh(docs, "host_ok"), fresh(docs, "base_failed")
    flagged = docs.withColumn(failed, counts(col(text), rules)["base_failed"])
    judged = saved(flagged.withColumn(text, F.when(~col(failed), col(text))), "quality-judged")
    hosts = host_verdicts(judged.select(col(host).alias("host"), col(failed).alias("base_failed")), rules)
    bad = hosts.filter(~F.col("host_ok")).select(F.col("host").alias(its), F.lit(True).alias(ok))
    good = judged.filter(~col(failed)).drop(col(failed))
    return good.join(bad, col(host).eqNullSafe(F.col(its)), "left_anti")
