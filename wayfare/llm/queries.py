"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_pairs, main_text, manifest, mixing, near_duplicates, packing, personal_data, quality_model, quality_rules, repeated_passages, site_lines, source_divergence, vector_links


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, planned = mixing.plan(_table(spark, sf_dir, "documents"))
    return mixing.decide(sizes, planned).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken"
    )


def op2_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.repeats(_table(spark, sf_dir, "documents")).drop("row")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(_table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.array_remove(F.transform("base", lambda s: s["kind"] == k), False)).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(personal_data.KINDS[:4])
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.joined_spans(F.col("base")), 256).alias("base_sha256"),
        personal_data.joined_spans(F.col("base"), F.col("terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )


def op4_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = site_lines.drop_boilerplate(_table(spark, sf_dir, "documents"), counts_as=("n_lines", "n_dropped"))
    return done.select("doc_id", "source", "text", "n_lines", "n_dropped")


def tokenizer_path() -> str:
    """The vocabulary that the packing query is defined with; it lies beside the library of that name."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select(
        F.col("id").alias("doc_id"), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op7_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.links(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_model.score(documents, labels).withColumnRenamed("id", "doc_id")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    four_words = near_duplicates.Settings(words=4)
    found = near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), settings=four_words)
    return found.withColumnRenamed("id", "doc_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def byte_pairs_path() -> str:
    """The vocabulary of the encoding query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = byte_pairs_path()
    whole = byte_pairs.decode(byte_pairs.encode(_table(spark, sf_dir, "documents"), path), path)
    return whole.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_pairs.joined_ids(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(tampered, manifest.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    built = manifest.build(documents, ["doc_id", "source", "lang", "n_chars", "text"], altered={"text": text})
    return manifest.proofs(built).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pareto_mix, op2_repeated_lines, op3_personal_data, op4_site_lines, op5_packing, op6_main_text, op7_vector_links,
        op8_quality_model, op9_near_duplicates,
        op10_quality_rules, op11_byte_pairs, op12_merkle_manifest, op13_source_divergence,
    )
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"

_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _leaf_sql(text: str) -> str:
    parts = ("doc_id", "source", "lang", "n_chars", text)
    whole = " || ".join(f"coalesce(strlen(({p})::VARCHAR) || ':' || ({p})::VARCHAR, '-')" for p in parts)
    return f"sha256({whole})"


SQL = {
    "op13_source_divergence": rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), groups AS (SELECT DISTINCT lang, source FROM docs),
kept AS (SELECT lang, word FROM (SELECT lang, unnest(list_distinct(words)) AS word FROM docs) GROUP BY ALL HAVING count(*) >= 10),
counts AS (SELECT lang, source, word, count(*) AS n FROM (SELECT lang, source, unnest(words) AS word FROM docs) SEMI JOIN kept USING (lang, word) GROUP BY ALL),
cells AS (SELECT lang, source, word, coalesce(n, 0)::HUGEINT AS n FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, word)),
valued AS (
  SELECT *, 1 + 1000000000 * (n + 2) // (sum(n) OVER g + 2 * count(*) OVER g)::HUGEINT AS p,
    1 + 1000000000 * (sum(n) OVER w + 2)::HUGEINT // (sum(n) OVER l + 2 * (count(*) OVER g))::HUGEINT AS q
  FROM cells WINDOW g AS (PARTITION BY lang, source), w AS (PARTITION BY lang, word), l AS (PARTITION BY lang)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(c.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source AS s, y.source AS t, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM valued x JOIN valued y ON x.lang = y.lang AND x.word = y.word AND x.source <> y.source GROUP BY ALL
  ) c ON c.lang = a.lang AND c.s = a.source AND c.t = b.source
), terms AS (SELECT lang, source, 'term' AS part, word AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM valued WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE crc AS (
  SELECT *, list_reduce(
    [4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END) AS state
  FROM documents
), leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN xor(state, 4294967295) % 5 = 0 THEN {_leaf_sql(f"translate(text, {_CAPITALS})")} ELSE {_leaf_sql("text")} END AS altered
  FROM crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree FROM leaves
), low(tree, level, i, n, h) AS (
  SELECT tree, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY tree, level, i // 16
), subroots AS (SELECT tree, h FROM low WHERE n = 1),
high(level, i, n, h) AS (
  SELECT 0, tree, count(*) OVER (), h FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 16
), runs AS (
  SELECT 0 AS top, tree, level, i // 16 AS run, list(h ORDER BY i) AS c FROM low WHERE n > 1 GROUP BY tree, level, i // 16
  UNION ALL
  SELECT 1, 0, level, i // 16, list(h ORDER BY i) FROM high WHERE n > 1 GROUP BY level, i // 16
), climb(doc_id, leaf, tree, source_n, top, level, i, n, proof, folded) AS (
  SELECT doc_id, leaf, tree, n, 0, 0, i, n, '', altered FROM placed
  UNION ALL
  SELECT k.doc_id, k.leaf, k.tree, k.source_n,
    CASE WHEN k.n = 1 THEN 1 ELSE k.top END, CASE WHEN k.n = 1 THEN 0 ELSE k.level + 1 END,
    CASE WHEN k.n = 1 THEN k.tree ELSE k.i // 16 END,
    CASE WHEN k.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (k.n + 15) // 16 END,
    CASE WHEN k.n = 1 THEN k.proof ELSE k.proof || array_to_string(r.c[:k.i % 16] || r.c[k.i % 16 + 2:], '') END,
    CASE WHEN k.n = 1 THEN k.folded ELSE sha256(array_to_string(r.c[:k.i % 16] || [k.folded] || r.c[k.i % 16 + 2:], '')) END
  FROM climb k LEFT JOIN runs r ON k.n > 1 AND r.top = k.top AND r.tree = CASE WHEN k.top = 1 THEN 0 ELSE k.tree END AND r.level = k.level AND r.run = k.i // 16
  WHERE NOT (k.top = 1 AND k.n = 1)
)
SELECT c.doc_id, c.leaf, s.h AS subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.h AS verified
FROM climb c JOIN subroots s USING (tree), (SELECT h FROM high WHERE n = 1) r WHERE c.top = 1 AND c.n = 1
""",
    "op2_repeated_lines": r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?]*|[.!?]+|\n') AS parts FROM documents WHERE length(text) > 0
), lined AS (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS k FROM cut),
placed AS (
  SELECT *, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "start",
    trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS norm
  FROM lined
), units AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS unit, "start"::BIGINT AS "start",
    ("start" + length(part))::BIGINT AS "end", norm, (length(norm) - length(replace(norm, ' ', '')) + 1)::BIGINT AS n_words
  FROM placed WHERE norm <> ''
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS first_doc_id, first_value("start") OVER w AS first_start
  FROM units WINDOW w AS (PARTITION BY norm ORDER BY doc_id, unit)
), again AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM ranked WHERE place > 1
), runs AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, run) AS run_words FROM again)
SELECT doc_id, unit::BIGINT AS unit, "start", "end", n_words, first_doc_id, first_start FROM runs WHERE run_words >= 16
""",
    "op4_site_lines": f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k
  FROM documents
), clean AS (SELECT *, trim(line, {_SPACES}) AS norm FROM lines),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
often AS (
  SELECT source, norm FROM clean JOIN pages USING (source) WHERE norm <> ''
  GROUP BY source, norm, pages HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) > 0.05 * pages
), marked AS (
  SELECT c.*, o.norm IS NOT NULL AS gone FROM clean c LEFT JOIN often o ON c.source = o.source AND c.norm = o.norm
)
SELECT doc_id, source, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '') AS text,
  count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped
FROM marked GROUP BY doc_id, source
""",
    "op10_quality_rules": f"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents
), grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lined AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, {_SPACES}) <> '') AS l FROM words),
counted AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM words d JOIN lined USING (doc_id) LEFT JOIN covered c USING (doc_id)
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
hosts AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS f FROM judged GROUP BY source),
sums AS (SELECT sum(n) AS n, sum(f) / sum(n) AS m, sum(f * f / n) AS q, count(*) AS k FROM hosts),
spread AS (SELECT *, m * (1 - m) AS s, greatest(q / n - m * m - m * (1 - m) * k / n, 0) AS v FROM sums),
strengths AS (SELECT *, CASE WHEN v > 0 THEN least(greatest(s / v - 1, 1), 1000) ELSE 1000 END AS t FROM spread),
prior AS (
  SELECT CASE WHEN k < 2 OR m <= 0 OR m >= 1 THEN 1 ELSE m * t END AS a,
    CASE WHEN k < 2 OR m <= 0 OR m >= 1 THEN 1 ELSE (1 - m) * t END AS b FROM strengths
), verdicts AS (SELECT source, (f + a) / (n + a + b) <= 0.5 AS ok FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
""",
}
