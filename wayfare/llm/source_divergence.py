"""How far the sources of a language diverge in their words: all pairs of sources, and the words that set one apart.

*Collapse.* Identical texts of a language are one: the tasks that read them merge the copies
they meet, and one row per text and window goes by its digest to the task that owns it, with
the number of copies per source. That task tokenizes the text once and adds its words to the
counts of each source, times the copies, and to the documents that hold them. So a group of
copies with a third of all rows is a row or two from each reading task.

*Words.* A task has the words of one language at a time in its memory, and hands the partial
sums on when they reach ``HELD`` entries. They are added up by (language, word), where words of
fewer than ``min_docs`` documents go.

*Pairs.* With p and q a word's frequencies in two sources, in integers, f = (p - q)^2 / (p + q)
rounded down. Words that a source doesn't have all have the same p there. Hence, over V kept words,

    sum f = V f(p0, q0) + sum over words of the first (f(p, q0) - f(p0, q0)) + the same for the second
            + sum over words of both (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))

The second and third term need only how often each p occurs in a source. The last is summed in
blocks of words with equally many sources, by numpy, and each block hands on one sum per pair.
All numbers are integers; the result depends on no order.

Defined results: null text, language and source are empty strings; a document without words
counts for its group's existence alone; rows of one id are documents of their own; a language
without kept words has pairs of value 0; a text or a word of any length counts whole; an empty
table gives no rows. Other columns aren't read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, saved, ship

#: Bytes of distinct texts in which a reading task looks for copies.
WINDOW_BYTES = 32 << 20
#: Entries that a counting task holds before it hands its sums on.
HELD = 600_000
#: Pairs of cells that are evaluated at once.
BLOCK = 2_000_000
#: Parts per unit of a frequency.
UNIT = 1_000_000_000

#: Letters A-Z in small, blanks for all other ASCII; what is beyond ASCII stays.
WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_TEXT = "lang string, digest binary, text binary, sources array<string>, copies array<bigint>"
_TEXT_SCHEMA = pa.schema(
    [("lang", pa.string()), ("digest", pa.binary()), ("text", pa.binary()), ("sources", pa.list_(pa.string())), ("copies", pa.list_(pa.int64()))]
)
_SUMS = "lang string, word string, source string, n long"
_SUMS_SCHEMA = pa.schema([("lang", pa.string()), ("word", pa.string()), ("source", pa.string()), ("n", pa.int64())])


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(WORDS).split()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and text of a window, with its copies by source."""

    def out() -> pa.RecordBatch:
        keys = [(lang, xxhash.xxh3_128_digest(text), text) for lang, text in held]
        columns = [[k[i] for k in keys] for i in range(3)]
        columns += [[list(c.keys()) for c in held.values()], [list(c.values()) for c in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TEXT_SCHEMA)], schema=_TEXT_SCHEMA)

    held: dict[tuple[str, bytes], dict[str, int]] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            key = (lang.as_py(), text.as_py())
            if key not in held:
                held[key] = {}
                size += len(key[1]) + 200
            copies, name = held[key], source.as_py()
            copies[name] = copies.get(name, 0) + 1
            if size > WINDOW_BYTES:
                yield out()
                held, size = {}, 0
    if held:
        yield out()


class Sums:
    """Counts of one language: of each word by source, and its documents under no source."""

    def __init__(self, lang: str):
        self.lang = lang
        self.by_source: dict[str | None, Counter] = {None: Counter()}

    def add(self, text: bytes, copies: dict[str, int]) -> None:
        words = words_of(text)
        documents = self.by_source[None]
        if list(copies.values()) == [1]:
            self.by_source.setdefault(next(iter(copies)), Counter()).update(words)
            documents.update(set(words))
            return
        total = sum(copies.values())
        for word, n in Counter(words).items():
            documents[word] += total
            for source, times in copies.items():
                self.by_source.setdefault(source, Counter())[word] += n * times

    def __len__(self) -> int:
        return sum(map(len, self.by_source.values()))

    def rows(self) -> Iterator[pa.RecordBatch]:
        for source, counts in self.by_source.items():
            words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            columns = [pa.repeat(pa.scalar(self.lang, pa.string()), len(words)), words, pa.repeat(pa.scalar(source, pa.string()), len(words))]
            whole = pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], schema=_SUMS_SCHEMA)
            yield from (whole.slice(k, 50_000) for k in range(0, len(words), 50_000))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of rows sorted by language and digest; equal neighbours are one text."""
    sums: Sums | None = None
    held: tuple[str, bytes, bytes] | None = None
    copies: dict[str, int] = {}
    for batch in batches:
        for row in (batch.slice(k, 1) for k in range(batch.num_rows)):
            key = tuple(row[c][0].as_py() for c in ("lang", "digest", "text"))
            if key != held:
                if held:
                    sums.add(held[2], copies)
                held, copies = key, {}
                if sums is not None and (sums.lang != key[0] or len(sums) > HELD):
                    yield from sums.rows()
                    sums = None
                sums = sums or Sums(key[0])
            for source, n in zip(row["sources"][0].as_py(), row["copies"][0].as_py()):
                copies[source] = copies.get(source, 0) + n
    if held:
        sums.add(held[2], copies)
        yield from sums.rows()


def f(p, q):
    """The contribution of one word; of numbers, arrays or columns of 64-bit integers."""
    if isinstance(p, Column) or isinstance(q, Column):
        return F.call_function("div", (p - q) * (p - q), p + q)
    return (p - q) * (p - q) // (p + q)


_BOTH = "lang string, a int, b int, both long"
_BOTH_SCHEMA = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("both", pa.int64())])


def _summed(a: list[np.ndarray], b: list[np.ndarray], x: list[np.ndarray], lang: str) -> pa.RecordBatch:
    a, b, x = np.concatenate(a), np.concatenate(b), np.concatenate(x)
    order = np.lexsort((b, a))
    a, b, x = a[order], b[order], x[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    columns = [pa.repeat(pa.scalar(lang, pa.string()), len(at)), pa.array(a[at]), pa.array(b[at]), pa.array(np.add.reduceat(x, at))]
    return pa.RecordBatch.from_arrays(columns, schema=_BOTH_SCHEMA)


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last term of the sum for the words of each batch, by pair of sources (a < b).

    Words with equally many sources are a matrix; its columns are shifted against each other.
    """
    for batch in batches:
        sizes = np.array([len(x) for x in batch["at"]])
        for lang in batch["lang"].unique().to_pylist():
            mine = batch["lang"].to_numpy(zero_copy_only=False) == lang
            a, b, x, n = [], [], [], 0
            for k in np.unique(sizes[mine]).tolist():
                rows = batch.filter(pa.array(mine & (sizes == k)))
                at, p, p0 = (rows[c].flatten().to_numpy().reshape(-1, k) for c in ("at", "p", "p0"))
                for d in range(1, k):
                    p1, q1, p2, q2 = p[:, :-d], p[:, d:], p0[:, :-d], p0[:, d:]
                    x.append((f(p1, q1) - f(p1, q2) - f(p2, q1) + f(p2, q2)).ravel())
                    a.append(at[:, :-d].ravel())
                    b.append(at[:, d:].ravel())
                    n += len(x[-1])
                    if n > BLOCK:
                        yield _summed(a, b, x, lang)
                        a, b, x, n = [], [], [], 0
            if n:
                yield _summed(a, b, x, lang)


def kept_words(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, word, cells) of words in at least ``min_docs`` documents of (lang, source, text): cells are sources and counts."""
    ship(docs.sparkSession)
    merged = docs.select("lang", "source", F.encode("text", "UTF-8").alias("text")).mapInArrow(_merge, _TEXT)
    whole = merged.repartition("lang", "digest").sortWithinPartitions("lang", "digest")
    sums = whole.mapInArrow(_count, _SUMS).repartition("lang", "word").groupBy("lang", "word", "source").agg(F.sum("n").alias("n"))
    cells = F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n")))  # leaves nulls out
    words = sums.groupBy("lang", "word").agg(F.sum(F.when(F.col("source").isNull(), F.col("n"))).alias("docs"), cells.alias("cells"))
    return saved(words.filter(F.col("docs") >= min_docs).drop("docs"), "divergence-words")


def frequency(n: Column, total: Column, words: Column) -> Column:
    """1 + UNIT * (n + 2) / (total + 2 * words), rounded down; exact for any count of 64 bits."""
    whole = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", whole, (total + 2 * words).cast("decimal(20,0)")) + 1


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for each other source, ``term`` rows for the ``top`` words of a source.

    A word's frequency is compared with the other source's, or with the language's where it is above that.
    """
    empty = F.lit("")
    read = docs.select(*[F.coalesce(col(c).cast("string"), empty).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    words = kept_words(read, min_docs)
    cells = words.select("lang", "word", F.inline("cells"))
    kept = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c["n"])).alias("lang_n"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    groups = (
        read.select("lang", "source").distinct().join(saved(kept, "divergence-langs"), "lang", "left").join(saved(totals, "divergence-totals"), ["lang", "source"], "left")
        .select(
            "lang", "source", F.coalesce("v", zero).alias("v"), F.coalesce("n", zero).alias("total"), F.coalesce("lang_n", zero).alias("lang_total"),
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("at"),
        )
        .withColumn("p0", F.when(F.col("v") > 0, frequency(zero, F.col("total"), F.col("v"))))
    )
    groups = saved(groups, "divergence-groups")

    counts = words.select("lang", "word", F.aggregate("cells", zero, lambda s, c: s + c["n"]).alias("lang_count"), F.inline("cells"))
    placed = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "word", "at", "p0",
        frequency(F.col("n"), F.col("total"), F.col("v")).alias("p"), frequency(F.col("lang_count"), F.col("lang_total"), F.col("v")).alias("q"),
    )
    placed = saved(placed, "divergence-cells")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = placed.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("word").alias("item"), f(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("p0").alias("q0"))
    base = F.when(F.col("v") > 0, F.col("v") * f(F.col("p0"), F.col("q0"))).otherwise(zero)
    pairs = groups.join(other, "lang").filter(F.col("at") != F.col("b")).select("lang", "source", F.col("at").alias("a"), "item", "b", base.alias("base"))
    often = placed.groupBy("lang", F.col("at").alias("a"), "p0", "p").agg(F.count(F.lit(1)).alias("n"))
    alone = (
        often.join(other, "lang").filter(F.col("a") != F.col("b"))
        .groupBy("lang", "a", "b").agg(F.sum(F.col("n") * (f(F.col("p"), F.col("q0")) - f(F.col("p0"), F.col("q0")))).alias("alone"))
    )
    alone = saved(alone, "divergence-alone")
    row = F.sort_array(F.collect_list(F.struct("at", "p", "p0")))
    rows = placed.groupBy("lang", "word").agg(row.alias("c")).filter(F.size("c") > 1).select("lang", F.col("c")["at"].alias("at"), F.col("c")["p"].alias("p"), F.col("c")["p0"].alias("p0"))
    both = saved(rows.mapInArrow(_both, _BOTH).groupBy("lang", "a", "b").agg(F.sum("both").alias("both")), "divergence-both")
    turned = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both"))
    back = alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("alone").alias("back"))
    value = F.col("base") + F.coalesce("alone", zero) + F.coalesce("back", zero) + F.coalesce("both", zero)
    valued = pairs.join(alone, ["lang", "a", "b"], "left").join(back, ["lang", "a", "b"], "left").join(turned, ["lang", "a", "b"], "left")
    ranked = valued.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(best))
    return ranked.unionByName(terms)
