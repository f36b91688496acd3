"""Registered queries of the subpackage: SQL twins, native plans, and the pipeline against its stages."""

import collections
import re

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tokenizers import Tokenizer
from verification.compare import compare, connect
from wayfare.llm import queries

from .test_brute_force import plain_components


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, sf_dir, name):
    assert compare(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None


def test_one_query_per_operator():
    numbers = [re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES]
    assert sorted(map(int, numbers)) == list(range(1, len(numbers) + 1)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op1_pareto_mix", "op3_personal_data", "op4_site_lines", "op10_quality_rules"])
def test_native_operators_run_no_python(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_pipeline_against_plain_python(spark, sf_dir):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}

    kept = corpus_pipeline.quality(spark, docs, sf_dir)
    assert kept.columns == columns
    good = set()
    for d, r in before.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        grams = collections.defaultdict(list)
        for k in range(len(w) - 2):
            grams[tuple(w[k : k + 3])].append(k)
        again = {k + j for at in grams.values() if len(at) > 1 for k in at for j in range(3)}
        if len(w) >= 50 and 2 * len(again) <= len(w):
            good.add(d)
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert set(rows) == good  # no host fails more than half of its documents here

    lined = corpus_pipeline.lines(spark, kept, sf_dir)
    assert lined.columns == columns
    pages = collections.Counter(r["source"] for r in rows.values())
    holds = collections.Counter((r["source"], x) for r in rows.values() for x in {y.strip() for y in r["text"].split("\n")} if x)
    often = {k for k, n in holds.items() if n >= 3 and n > 0.05 * pages[k[0]]}
    want = {d: "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip()) not in often) for d, r in rows.items()}
    texts = {r["doc_id"]: r["text"] for r in lined.collect()}
    assert texts == want

    single = corpus_pipeline.near(spark, lined, sf_dir)
    assert single.columns == columns
    groups = plain_components(texts, 5, 80)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, (_, c) in groups.items() if c == d)

    mixed = corpus_pipeline.mix(spark, single, sf_dir)
    assert mixed.columns == columns
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())

    whole = Tokenizer.from_file(queries.tokenizer_path())
    found = corpus_pipeline.run(spark, sf_dir).collect()
    tokens = {d: len(whole.encode(texts[d], add_special_tokens=False).ids) + 1 for d in copies}
    held = collections.Counter()
    for r in found:
        held[r["doc_id"]] += r["length"]
    assert held == {d: n * tokens[d] for d, n in copies.items()}
    places = collections.defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(x)])]
        assert [at for at, _ in sorted(x)] == ends[:-1] and ends[-1] <= 4096
