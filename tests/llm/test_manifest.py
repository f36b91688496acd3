"""The Merkle manifest and its recursive climb against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wayfare.llm import manifest

FIELDS = ["doc_id", "source", "text"]
SCHEMA = "doc_id long, source string, text string, id long, tree long, run long, position long, bundle long, leaf string, n long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(level):
    """The node that remains, and per node of the first level the siblings on its way, level by level."""
    paths = [[] for _ in level]
    owners = [[k] for k in range(len(level))]
    while len(level) > 1:
        above, over = [], []
        for k in range(0, len(level), 16):
            run = level[k : k + 16]
            for j in range(len(run)):
                for leaf in owners[k + j]:
                    paths[leaf].append((run[:j], run[j + 1 :]))
            above.append(sha(*run))
            over.append([leaf for j in range(len(run)) for leaf in owners[k + j]])
        level, owners = above, over
    return level[0], paths


def plain(rows, altered):
    leaf = lambda r: sha(*map(field, r))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    built = {s: plain_tree([leaf(r) for r in t]) for s, t in trees.items()}
    root, upper = plain_tree([built[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for r, path in zip(trees[s], built[s][1]):
            path, digest = path + upper[k], leaf(altered(r))
            for before, after in path:
                digest = sha(*before, digest, *after)
            out.append((r[0], leaf(r), built[s][0], root, "".join(x for b, a in path for x in b + a), digest, digest == root))
    return sorted(out, key=repr)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 9, 9, 9, 9, 9, "x", 9) for r in rows], SCHEMA)
    # even ids and nulls are altered
    text = F.when(F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True)), manifest.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    lower = lambda t: t and t.encode().lower().decode()
    altered = lambda r: (r[0], r[1], lower(r[2])) if r[0] is None or r[0] % 2 == 0 else r
    found = manifest.proofs(manifest.build(docs, FIELDS, altered={"text": text})).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain(rows, altered)


def test_levels_ties_and_nulls(spark):
    rng = random.Random(2)
    rows = [(k, "big", rng.choice(["Ab", "cd", "ÉÀ A", "", None])) for k in range(300)]
    rows += [(7, "big", "other text"), (7, "big", "other text"), (None, "big", "x"), (None, None, None), (1, None, "Two"), (2, "lone", "B"), (3, "", "C")]
    rows += [(k, f"s{k}", "T") for k in range(20)] + [(9, "é", "x" * 100_000), (8, "z", "Y")]
    rng.shuffle(rows)
    check(spark, rows)


@pytest.mark.parametrize("rows", [[(1, "a", "A")], [(2, "a", "Z"), (1, "b", "y")], [(k, None, "q") for k in range(17)], [(1, "a", "A")] * 40])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_empty(spark):
    built = manifest.build(spark.createDataFrame([], SCHEMA), FIELDS)
    assert built.root is None and manifest.proofs(built).count() == 0
