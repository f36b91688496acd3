"""Operators that SQL can't express, against plain Python on small tables."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm import main_text, mixing, near_duplicates, packing, personal_data, queries, vector_links
from wayfare.llm.components import components

TOKENIZER = queries.tokenizer_path()


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r for r in documents.collect()}


# --- mixing


def water(sizes, weights, total, most):
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        share = {k: total * weights[k] / sum(weights[j] for j in open_) for k in open_}
        over = [k for k in open_ if share[k] > most * sizes[k]]
        for k in over or open_:
            target[k] = most * sizes[k] if over else share[k]
        if not over:
            break
        total -= sum(target[k] for k in over)
        open_ -= set(over)
    return target


def test_mix(spark, sf_dir, texts):
    rows = queries.op1_pareto_mix(spark, sf_dir).collect()
    sources = sorted({r["source"] for r in rows})
    sizes = [sum(r["size"] for r in rows if r["source"] == s) for s in sources]
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]]["text"] or "")) for r in rows)
    targets = water(sizes, [(3, 1, 2)[k % 3] for k in range(len(sources))], 1.5 * sum(sizes), 2)
    u = {r["id"]: (r["h"] % (1 << 52) + 0.5) / (1 << 52) for r in spark.createDataFrame([(r["doc_id"],) for r in rows], "id long").select("id", F.xxhash64(F.lit(17), "id").alias("h")).collect()}
    for source, size, target in zip(sources, sizes, targets):
        own = [r for r in rows if r["source"] == source]
        assert all(abs(r["target"] - target) < 1e-6 and r["source_size"] == size for r in own)
        weight = {r["doc_id"]: 2 ** (round(8 * np.log2(max(np.ceil(np.log2(r["size"] + 1)), 1))) / 8) for r in own}
        low, high = 0.0, 1e9  # the factor by bisection
        for _ in range(200):
            c = (low + high) / 2
            low, high = (low, c) if sum(r["size"] * min(2, c * weight[r["doc_id"]]) for r in own) > target else (c, high)
        copies = {r["doc_id"]: min(2, high * weight[r["doc_id"]]) for r in own}
        copies = {d: round(x) if abs(x - round(x)) < 1e-9 else x for d, x in copies.items()}
        want = {r["doc_id"]: int(copies[r["doc_id"]]) * r["size"] for r in own}
        left = target - sum(want.values())
        odds = {d: (u[d] / (1 - u[d])) / (x % 1 / (1 - x % 1)) for d, x in copies.items() if x % 1}
        for d in sorted(odds, key=odds.get):
            size_d = next(r["size"] for r in own if r["doc_id"] == d)
            if size_d / 2 > left:
                break
            want[d] += size_d
            left -= size_d
        assert {r["doc_id"]: r["taken"] for r in own} == want


def test_mix_repeats_rows(spark, sf_dir, documents):
    planned = queries.op1_pareto_mix(spark, sf_dir)
    want = {r["doc_id"]: r["copies"] for r in planned.collect() if r["copies"]}
    assert dict(collections.Counter(r["doc_id"] for r in mixing.mix(documents).collect())) == want


# --- personal data

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            double = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            good = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(d) <= 19 and double % 10 == 0, "phone": 10 <= len(d) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, m.end()))
    return ",".join(f"{list(KINDS)[k]}:{a}:{b}" for a, k, b in sorted(found))


TRICKY = [
    "a@b@c.de x.y+z%q@h-1.a.b.c. 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3",
    "é😀 a@b.c_d@e.f +1 (415) 555-1234. +12 3 4111 1111 1111 1111, 4111-1111-1111-1112 0 1",
    "4" * 3000 + "@" + "a." * 3000 + "b", "+" * 50 + "1" * 12, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "@a.b a@.b a@b. +1-- +1--2",
]


def test_base_spans(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in queries.op3_personal_data(spark, sf_dir).collect()}
    for d, t in texts.items():
        want = plain_spans(t["text"] or "")
        assert rows[d]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert ",".join(s for s in rows[d]["spans"].split(",") if not s.startswith("term")) == want


def test_base_spans_of_tricky_texts(spark):
    signs = random.Random(3)
    made = TRICKY + ["".join(signs.choice("a1.@+- ()2") for _ in range(80)) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    found = personal_data.find(rows).select("doc_id", personal_data.joined_spans(F.col("base")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found} == dict(enumerate(map(plain_spans, made)))


def test_words_that_disclose(spark):
    rows = [(k, f"call zanzibar office of common people at ann{k % 2}@x.org soon") for k in range(4)]
    rows += [(k, "common people soon call the head of office") for k in range(10, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal_data.find(docs, support=2, disclosure=0.8)
    terms = {r["doc_id"]: [docs_text[t["start"] : t["end"]] for t in r["terms"]] for r in found.collect() for docs_text in [dict(rows)[r["doc_id"]]]}
    # "zanzibar" and "at" occur with the two addresses only, and tell most of which one it is
    assert all(terms[k] == ["zanzibar", "at"] for k in range(4)) and not any(terms[k] for k in range(10, 400))
    clean = {r["doc_id"]: r["text"] for r in personal_data.sanitised(docs, found).collect()}
    assert clean[0] == "call [WORD] office of common people [WORD] [EMAIL] soon" and clean[10] == rows[4][1]


# --- packing


def test_tokens_equal_the_tokenizers(texts):
    whole = Tokenizer.from_file(TOKENIZER)
    signs = random.Random(1)
    made = [t["text"] or "" for t in texts.values()]
    made += ["", " ", "It's 12 o'clock\x1c\x1d a'll", "<|endoftext|> x<|startoftext|>y", "ΣΑΣ İstanbul é café", "你好 ½²३ ﬁ\x85\xa0'll ''s"]
    made += ["".join(signs.choice("aZ'sS tredTvlm.,<|>1é́ΣİßǅÀ\x1c \n") for _ in range(60)) for _ in range(1500)]
    found = [x.tolist() for x in packing.Tokens(TOKENIZER).ids(pa.array(made))]
    assert found == [e.ids for e in whole.encode_batch(made, add_special_tokens=False)]


def test_tokens_are_the_same_wherever_texts_are_cut(monkeypatch, texts):
    whole = Tokenizer.from_file(TOKENIZER)
    monkeypatch.setattr(packing, "CHUNK", 1)  # each text is the last one of its array
    made = [f"{'ab' * (k % 40)}queñ{k}ó{'xyz'[k % 3] * (k % 17)}{end}" for k in range(600) for end in (".", "!?", ". ", "\n")]
    made += [t["text"] or "" for t in texts.values()]
    found = [x.tolist() for x in packing.Tokens(TOKENIZER).ids(pa.array(made))]
    assert found == [e.ids for e in whole.encode_batch(made, add_special_tokens=False)]


def test_a_batch_of_texts_needs_little_memory():
    rng, words = random.Random(2), [f"w{chr(97 + k % 26)}{k}" for k in range(500)]
    texts = pa.array([" ".join(rng.choices(words, k=3000)) for _ in range(500)])
    tokens = packing.Tokens(TOKENIZER)
    tracemalloc.start()
    n = sum(len(x) for x in tokens.ids(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 3_000_000 and peak < 60_000_000


def test_packing_is_a_round_trip(spark, sf_dir, texts):
    whole = Tokenizer.from_file(TOKENIZER)
    rows = queries.op5_packing(spark, sf_dir).collect()
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, t in texts.items():
        ids = whole.encode(t["text"] or "", add_special_tokens=False).ids + [1]
        parts = [(s, ids[s : s + 4096]) for s in range(0, len(ids), 4096)]
        assert sorted(pieces[d]) == [(k, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, (s, p) in enumerate(parts)]
    for held in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)])]
        assert [at for at, _ in sorted(held)] == ends[:-1] and ends[-1] <= 4096
    lengths = np.array([r["length"] for r in rows])
    assert len(places) <= packing.lower_bound(lengths, 4096) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_bound_and_best_fit(lengths):
    bins = packing.best_fit_decreasing(np.array(lengths), 40)
    assert np.bincount(bins, weights=lengths).max() <= 40
    least = packing.lower_bound(np.array(lengths), 40)
    assert -(-sum(lengths) // 40) <= least <= bins.max() + 1


def test_groups_with_a_gap_exchange(spark):
    random_ = np.random.default_rng(2)
    lengths = random_.integers(200, 2500, 4000)
    items = spark.createDataFrame([(int(k), int(x)) for k, x in enumerate(lengths)], "k long, length long")
    once = packing.pack(items, group_size=40, rounds=0).select("sequence_id").distinct().count()
    packed = packing.pack(items, group_size=40, rounds=3)
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert packed.count() == 4000 and max(r["n"] for r in held) <= 4096
    assert -(-int(lengths.sum()) // 4096) <= len(held) < once


# --- main text

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header class=top><h1>Site</h1></header>
<nav><ul><li><a href=x>Home</a></ul></nav><div id="cookie-notice"><p>We use cookies, really, lots of them, and so on and on.</p></div>
<div class="content"><div class="post"><h2>Title &amp; more</h2><p>First   paragraph, with <b>bold</b>,
and <a href=y>a link</a>.<p>Second one, unclosed, with &eacute;t&eacute; &lt;tags&gt;<ul><li>item one<li>item two</ul>
<div class="ad">Buy, buy, buy, now, now, now</div><p>Third, <!-- not <p>this --> the last paragraph of it.</p></div></div>
<aside><p>Other, stories, you, may, like, and, many, more, commas, here.</p></aside>
<section class="reader-comments"><p>Great, article, I, liked, it, very, much, thanks, for, all.</p></section>
<form><p>Mail, address, please</p></form><script>if (a < b) { x = "<p>no</p>" }</script><footer><p>&copy; all, rights</p></footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.main_text(PAGE) == "\n".join(
        ["Title & more", "First paragraph, with bold, and a link.", "Second one, unclosed, with été <tags>", "item one", "item two", "Third, the last paragraph of it."]
    )


@pytest.mark.parametrize(
    ("attributes", "kept"),
    [
        ('class="story"', True), ('style="overflow:hidden"', True), ('data-id="nav"', True), ("id=text-1 lang=en", True),
        ('class="social-share"', False), ("id='sidebarLeft'", False), ('role="navigation"', False), ("hidden", False), ('style="display: none"', False),
    ],
)
def test_elements_left_out(attributes, kept):
    found = main_text.main_text(f"<body><p>One, two, three, four.</p><div {attributes}><p>Five, six, seven, eight.</p></div></body>")
    assert ("Five" in found) == kept and "One" in found


def test_main_text_of_all_pages(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op6_main_text(spark, sf_dir).collect():
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        want = re.sub(r"<[^>]+>", " ", article).replace("&quot;", '"').replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")
        assert r["text"].split() == want.split() and r["n_chars"] == len(r["text"])


# --- vectors


def test_links_of_vectors(spark):
    random_ = np.random.default_rng(4)
    far = random_.standard_normal((3000, 24))
    near = far[:300] + 0.28 * random_.standard_normal((300, 24))
    tight = far[:1] + 0.01 * random_.standard_normal((400, 24))
    x = np.concatenate([far, near, tight, far[5:6].repeat(20, axis=0)])
    docs = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    small = vector_links.Settings(leaf=200, block=128)
    found = {r["id"]: r for r in vector_links.links(docs, settings=small).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    n = linked.sum(axis=1)
    got = np.array([found[k]["n_links"] for k in range(len(x))])
    assert (got <= n).all() and got.sum() >= 0.98 * n.sum()
    label = near_duplicates.forest(linked)
    same = np.array([found[k]["component_id"] == label[k] for k in range(len(x))])
    assert same[got == n].mean() > 0.98 and all(found[k]["component_id"] >= label[k] for k in range(len(x)))


# --- quality


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op8_quality_model(spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    assert all(rows[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in labels)
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert sum(right) >= 0.95 * len(right) and all(rows[r["doc_id"]]["predicted"] for r in labels if r["quality"])


# --- near duplicates and components


def plain_components(texts, words, percent):
    small = {k: k + 32 for k in range(65, 91)}
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(small))
        sets[d] = {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, min(len(w), 1)))}
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}


def near_texts():
    """Copies, near copies at all distances, a large group of near copies, and passages that many share."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    prose = lambda n: [word() for _ in range(n)]
    shared, made = prose(40), []
    for _ in range(40):
        base = prose(r.choice([3, 8, 30, 60, 90, 300]))
        made.append(base)
        for _ in range(r.choice([0, 1, 3])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 5, 12])):
                copy[r.randrange(len(copy))] = word()
            made.append(copy)
    hot = prose(200)
    for k in range(150):
        copy = list(hot)
        for _ in range(k % 10):
            copy[r.randrange(200)] = word()
        made.append(copy)
    made += [prose(20) + shared + prose(20) for _ in range(60)] + [hot] * 30
    return {k: " ".join(w).title() for k, w in enumerate(made)}


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, words):
    texts = near_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # tiny lists and blocks, so that all ways are taken
    small = near_duplicates.Settings(words=words, short=8, block=32)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(docs, settings=small).collect()}
    assert found == plain_components(texts, words, 80)


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(5).shuffle(order)
    edges = [(a, b) for a, b in zip(order, order[1:])] + [(1000, 1001), (1001, 1002), (1000, 1000)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(200)} | {1000: 1000, 1001: 1000, 1002: 1000}
