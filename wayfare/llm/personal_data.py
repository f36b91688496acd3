"""Personal data: patterns find protected entities, corpus statistics find the words that give them away.

Base spans (email, ip, card, phone) are regular expressions with checks. All words
of a document outside its spans are the context of its entities. Over the corpus,
with N documents, a word t and an entity e:

    pmi(t, e) = log2(N * together / (with_e * with_t)),   ic(e) = log2(N / with_e)

``together`` counts the documents with both, ``with_t`` those with t. pmi / ic is the
part of e's information that t discloses. Where fewer than ``support`` documents are
the evidence, half a document with the entity at its usual rate is added to those
with t: p(e|t) = (together + with_e / 2N) / (with_t + 1/2), so one document discloses
less than all. From ``disclosure`` on, t becomes a span of kind "term" in e's documents. ``sanitised`` replaces base spans by their kind,
generalises such words to ``[WORD]`` and removes those that disclose everything.

Only counts and the distinct words of documents with entities are shuffled, and
the texts of those with such words; all counts are combined in the map tasks, so a word or an entity in a third of all documents is no hot spot.
The patterns have possessive quantifiers and start at the begin of a run, so the
time is linear in the text also for runs of 100,000 letters or digits.

Defined results: null text is empty; rows of one id and text are one document
and get equal results; a null id is an id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, let, saved

KINDS = ("email", "ip", "card", "phone", "term")

# \G or a look-behind: where a run of such characters begins, or right after a match
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}++"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def matches(text: Column, pattern: str, check: Callable[[Column], Column]) -> Column:
    """Array of (start, end, value) of the pattern's matches that pass a check, in code points: the gaps come from a split.

    Only these are appended: that copies the array, and of the digits of a long table nearly none passes.
    """

    def placed(values: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(values))
        pairs = F.zip_with(gaps, values, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + F.length(x["value"])
            span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
            out = F.when(check(x["value"]), F.array_append(acc["out"], span)).otherwise(acc["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(pairs, begin, step, lambda acc: acc["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(F.array().cast(SPAN)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, entity): all kinds, by start and then kind. ``kind`` counts from 0 in KINDS."""
    checks = {
        "email": lambda v: F.lit(True),
        "ip": lambda v: v.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"),
        "card": lambda v: let(digits(v), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)),
        "phone": lambda v: F.length(digits(v)).between(10, 15),
    }
    entity = {"email": F.lower, "ip": lambda v: v, "card": digits, "phone": digits}
    needs = {"email": "@", "phone": "+"}
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,entity:string>>")

    def of(k: int, kind: str, pattern: str) -> Column:
        def span(s: Column) -> Column:
            name = F.concat(F.lit(f"{kind}:"), entity[kind](s["value"]))
            return F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), name.alias("entity"))

        spans = F.transform(matches(text, pattern, checks[kind]), span)
        return F.when(F.contains(text, F.lit(needs[kind])), spans).otherwise(none) if kind in needs else spans

    kinds = [of(k, kind, pattern) for k, (kind, pattern) in enumerate(PATTERNS.items())]
    return F.sort_array(F.concat(*kinds))


MARK = "\ufdd0"


def masked(text: Column, spans: Column) -> Column:
    """``text`` with blanks for the spans, of the same length; a letter at a span's edge leaves a mark there."""
    edge = lambda c: F.when(c.rlike(r"^\p{L}"), F.lit(MARK)).otherwise(F.lit(" "))
    at = lambda p: edge(F.substring(text, (p + 1).cast("int"), F.lit(1)))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(acc["at"], s["start"])  # spans of two kinds may overlap
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        blank = F.concat(at(begin), F.repeat(F.lit(" "), (s["end"] - begin - 2).cast("int")), F.when(s["end"] - begin > 1, at(s["end"] - 1)).otherwise(""))
        out = F.struct(s["end"].alias("at"), F.array_append(acc["out"], F.concat(gap, blank)).alias("out"))
        return F.when(s["end"] > acc["at"], out).otherwise(acc)

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def end(acc: Column) -> Column:
        return F.array_join(F.array_append(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))), "")

    return F.aggregate(spans, begin, step, end)


#: Whole words of a masked text: a word beside a mark goes on inside a span.
OUTSIDE = rf"(?<![{MARK}\p{{L}}])\p{{L}}++(?!{MARK})"


def find_base(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, row, spans, words) per row of ``docs``; ``row`` is a digest of the text, ``words`` are those near entities."""
    whole = F.coalesce(col(text), F.lit(""))

    def words(s: Column) -> Column:
        found = F.array_distinct(F.transform(F.regexp_extract_all(masked(whole, s), F.lit(OUTSIDE), F.lit(0)), F.lower))
        return F.when(F.size(s) > 0, found).otherwise(F.array().cast("array<string>"))

    found = let(base_spans(whole), lambda s: F.struct(s.alias("spans"), words(s).alias("words")))
    read = docs.select(col(id).alias("doc_id"), F.xxhash64(whole).alias("row"), found.alias("found"))
    return saved(read, "pii").select("doc_id", "row", "found.spans", "found.words")


def _with_entities(base: DataFrame) -> DataFrame:
    """(doc_id, row, entities, words): documents with entities, once each."""
    names = F.array_distinct(F.transform("spans", lambda s: s["entity"]))
    return base.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "row"]).select("doc_id", "row", names.alias("entities"), "words")


def disclosing(docs: DataFrame, held: DataFrame, text: str, disclosure: float, support: int) -> DataFrame:
    """(entity, term, part): words that disclose at least ``disclosure`` of an entity's information."""
    n = F.lit(float(docs.count()))
    entity = held.select(F.explode("entities").alias("entity"), "words")
    together = entity.select("entity", F.explode("words").alias("term")).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("together"))
    together = saved(together, "pii-pairs")
    entities = entity.groupBy("entity").agg(F.count(F.lit(1)).alias("with_e"))
    words = F.array_distinct(F.regexp_extract_all(F.lower(col(text)), F.lit(TERM), F.lit(0)))
    terms = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("with_t"))
    known = together.join(saved(entities, "pii-entities"), "entity").join(terms, "term")
    # a word may be counted more often together than alone where its small letters have another spelling
    alone = F.greatest("with_t", "together")
    rate = F.col("with_e") / n
    few = F.col("together") < support
    pmi = F.log2(F.when(few, (F.col("together") + rate / 2) / (alone + 0.5)).otherwise(F.col("together") / alone) / rate)
    # what every document holds gives nothing away
    part = F.when(rate < 1, pmi / F.log2(1 / rate)).otherwise(0.0)
    return known.select("entity", "term", part.alias("part")).filter(F.col("part") >= disclosure)


def _placed(text: Column, spans: Column, terms: Column, parts: Column) -> Column:
    """Array of (start, end, part) of the words of ``terms`` outside the spans, with the largest of their ``parts``."""
    kind = "array<struct<start:bigint,end:bigint,part:double>>"

    def of(masked_text: Column) -> Column:
        words = F.regexp_extract_all(masked_text, F.lit(OUTSIDE), F.lit(0))
        gaps = F.split(masked_text, OUTSIDE, -1)
        pairs = F.zip_with(F.slice(gaps, 1, F.size(words)), words, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("n"), F.array_position(terms, F.lower(v)).alias("k")))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + x["n"]
            span = F.struct(start.alias("start"), end.alias("end"), F.get(parts, (x["k"] - 1).cast("int")).alias("part"))
            out = F.when(x["k"] > 0, F.array_append(acc["out"], span)).otherwise(acc["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(pairs, begin, step, lambda acc: acc["out"])

    return let(masked(text, spans), of)


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", disclosure: float = 0.9, support: int = 2) -> DataFrame:
    """(doc_id, row, base, terms) per row of ``docs``: ``terms`` is an array of (start, end, part)."""
    base = find_base(docs, id, text)
    held = saved(_with_entities(base), "pii-held")
    telling = saved(disclosing(docs, held, text, disclosure, support), "pii-terms")
    pairs = held.select("doc_id", "row", F.explode("entities").alias("entity"), "words").select("doc_id", "row", "entity", F.explode("words").alias("term"))
    marked = (
        pairs.join(telling, ["entity", "term"])
        .groupBy("doc_id", "row", "term")
        .agg(F.max("part").alias("part"))
        .groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r"))
        .agg(F.sort_array(F.collect_list(F.struct("term", "part"))).alias("telling"))
    )
    marked = saved(marked, "pii-marked")
    whole = F.coalesce(col(text), F.lit(""))
    read = docs.select(col(id).alias("doc_id"), F.xxhash64(whole).alias("row"), whole.alias("text"))
    mine = lambda a: a["doc_id"].eqNullSafe(F.col("d")) & (a["row"] == F.col("r"))
    spans = base.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "row"]).select(F.col("doc_id").alias("d2"), F.col("row").alias("r2"), "spans")
    near = read.join(marked, mine(read)).join(spans, F.col("d").eqNullSafe(F.col("d2")) & (F.col("r") == F.col("r2")))
    placed = _placed(F.col("text"), F.col("spans"), F.col("telling")["term"], F.col("telling")["part"])
    terms = saved(near.select("d", "r", placed.alias("terms")).dropDuplicates(["d", "r"]), "pii-placed")
    none = F.array().cast("array<struct<start:bigint,end:bigint,part:double>>")
    return base.join(terms, mine(base), "left").select("doc_id", "row", F.col("spans").alias("base"), F.coalesce("terms", none).alias("terms"))


def joined_spans(base: Column, terms: Column | None = None) -> Column:
    """kind:start:end by start and then kind, comma-joined."""
    spans = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    if terms is not None:
        more = F.transform(
            terms, lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), t["end"].alias("end"))
        )
        spans = F.sort_array(F.concat(spans, more))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def sanitised(docs: DataFrame, found: DataFrame, id: str = "doc_id", text: str = "text", remove_from: float = 1.0) -> DataFrame:
    """(doc_id, text): base spans replaced by ``[EMAIL]`` and so on, words by ``[WORD]`` or by nothing.

    Words that disclose ``remove_from`` or more are removed, others generalised.
    Of overlapping spans the first counts.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    word = lambda t: F.when(t["part"] >= remove_from - 1e-9, "").otherwise("[WORD]")
    edits = F.sort_array(
        F.concat(
            F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("put"))),
            F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), word(t).alias("put"))),
        )
    )
    whole = F.coalesce(col(text), F.lit(""))
    read = docs.select(col(id).alias("doc_id"), F.xxhash64(whole).alias("row"), whole.alias("text"))
    per_row = found.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), edits.alias("edits")).distinct()
    joined = read.join(per_row, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left")

    def step(acc: Column, e: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (e["start"] - acc["at"]).cast("int"))
        done = F.struct(e["end"].alias("at"), F.array_append(acc["out"], F.concat(gap, e["put"])).alias("out"))
        return F.when(e["start"] >= acc["at"], done).otherwise(acc)

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def end(acc: Column) -> Column:
        rest = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))
        return F.array_join(F.array_append(acc["out"], rest), "")

    return joined.select("doc_id", F.coalesce(F.aggregate("edits", begin, step, end), F.col("text")).alias("text"))
