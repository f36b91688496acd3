"""The audit of sources against plain Python."""

import random
import re
from collections import Counter

import pytest

from wayfare.llm import source_divergence

SCHEMA = "doc_id long, lang string, source string, text string, word string, n long, a long, b long, p long, v long"


def plain(rows, min_docs, top):
    words = lambda t: re.findall(r"[a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    rows = [(a or "", b or "", words(c or "")) for a, b, c in rows]
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        docs = Counter(w for r in mine for w in set(r[2]))
        kept = {w for w, n in docs.items() if n >= min_docs}
        counts = {s: Counter() for s in {r[1] for r in mine}}
        for _, s, w in mine:
            counts[s].update(x for x in w if x in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept}
        shares, every = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(sum(f(p[w], q[w]) for w in kept), t) for t, q in shares.items() if t != s]
            terms = [(f(p[w], every[w]), w) for w in kept if counts[s][w] and p[w] > every[w]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [2_000_000, 7])
def test_audit(spark, monkeypatch, block):
    rng = random.Random(block)
    vocabulary = [f"w{c}{d}" for c in "abcdefgh" for d in "xyz"] + ["Éa", "漢字", "É", "don't", "a1b"]
    rows = []
    for _ in range(400):
        text = " ".join(rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randint(0, 12)))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", None, "s10"]), rng.choice([text, text.upper(), text + "\n"])))
    rows += [("en", rng.choice(["s1", "s2"]), "a text with Many copies")] * 150 + [("en", s, "a text with Many copies") for s in ("s3", "s3", "s2")]
    rows += [("xx", "only", None), ("xx", "two", ""), ("yy", "single", "w w w"), ("en", "empty", "  "), ("en", "long", "wax " * 30_000 + "x" * 100_000)]
    docs = spark.createDataFrame([(1, *r, "w", 1, 1, 1, 1, 1) for r in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(source_divergence, "WINDOW_BYTES", 10_000)
    found = source_divergence.audit(docs, min_docs=4, top=3).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 4, 3)


def test_empty(spark):
    assert source_divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_frequency_is_exact(spark):
    from pyspark.sql import functions as F

    rows = [(n, t, v) for n, t, v in [(10**15 + 7, 10**17 + 3, 10**8), (0, 1, 1), (0, 10**17, 10**9), (10**17, 10**17, 1)]]
    df = spark.createDataFrame(rows, "n long, t long, v long").select("*", source_divergence.frequency(F.col("n"), F.col("t"), F.col("v")).alias("p"))
    assert [r["p"] for r in df.collect()] == [1 + 10**9 * (n + 2) // (t + 2 * v) for n, t, v in rows]
