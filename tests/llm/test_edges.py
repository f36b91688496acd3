"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import numpy as np
import public_tokenizers
from wayfare.llm import (
    main_text, mixing, near_duplicates, packing, personal_data, quality_model, quality_rules, repeated_passages, site_lines, vector_links,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CLASHING = "id row copies size source_size key host its_host its_lines c set sketch n kept s left target cut b start text2 its_id".split()
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in CLASHING]
)
PROSE = " ".join(f"word{k} and more of it" for k in range(30))
ROWS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", "a"),
    (4, PROSE, "a"),
    (5, PROSE, None),
    (5, PROSE, None),
    (None, PROSE, "b"),
    (None, None, None),
    (6, "x" * 200_000, "b"),
    (7, "one two " * 30_000, "b"),
    (8, PROSE + "\n" + PROSE.upper() + "\nmail a@b.example.org", "c"),
    (9, "two\nwords", "c"),
]
EXTRA = (0,) * len(CLASHING)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + EXTRA for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, id="id"):
    return {r[id]: r for r in df.collect() if r[id] is not None}


def test_quality_rules(docs, none):
    rows = quality_rules.assess(docs).collect()
    assert len(rows) == len(ROWS)
    found = {r["id"]: r for r in rows if r["id"] is not None}
    assert [found[k]["n_words"] for k in (1, 2, 3, 9)] == [0, 0, 0, 2]
    assert found[6]["word_chars"] == 200_000 and found[7]["n_repeat_words"] == 60_000
    assert found[4]["base_failed"]  # four of five words repeat
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} <= {4, 5, 8, None}
    assert quality_rules.assess(none).count() == 0 and quality_rules.keep_good(none).count() == 0


def test_rules_keep_what_they_assess(docs, none):
    good = quality_rules.keep_good(docs)
    judged = quality_rules.assess(docs).filter("kept")
    assert good.columns == docs.columns and quality_rules.keep_good(none).count() == 0
    assert sorted(r["doc_id"] or 0 for r in good.collect()) == sorted(r["id"] or 0 for r in judged.collect())
    texts = {r[0]: r[1] for r in ROWS}
    assert all(r["text"] == texts[r["doc_id"]] for r in good.collect() if r["doc_id"] is not None)


def test_host_verdict_is_shrunk_to_the_corpus(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [("bad", "short")] * 40 + [("bad", good)] + [("good", good)] * 60 + [("tiny", "short"), ("tiny", good)]
    docs = spark.createDataFrame([(k, t, s) for k, (s, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = {(r["host"], r["base_failed"], r["kept"]) for r in quality_rules.assess(docs).collect()}
    assert kept == {("bad", True, False), ("bad", False, False), ("good", False, True), ("tiny", True, False), ("tiny", False, True)}


def test_mixing(docs, none):
    sizes, planned = mixing.plan(docs)
    rows = mixing.decide(sizes, planned).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(none).count() == 0


def test_site_lines(docs, none):
    done = site_lines.drop_boilerplate(docs, min_pages=2, max_ratio=0.4)
    assert done.columns == docs.columns and done.count() == len(ROWS)
    found = by_id(done, "doc_id")
    assert found[1]["text"] is None and found[2]["text"] == "" and found[5]["text"] == "" and found[4]["text"] == PROSE
    assert site_lines.drop_boilerplate(none).count() == 0


def test_repeated_passages(docs, none):
    found = repeated_passages.repeats(docs, kind="line")
    rows = {(r["doc_id"], r["start"], r["end"], r["first_doc_id"]) for r in found.collect()}
    n = len(PROSE)
    assert rows == {(5, 0, n, 4), (8, 0, n, 4), (8, n + 1, 2 * n + 1, 4), (None, 0, n, 4)}
    clean = by_id(repeated_passages.cleaned(docs, found, kind="line"), "doc_id")
    assert clean[8]["text"] == "mail a@b.example.org" and clean[5]["text"] == ""
    assert repeated_passages.repeats(none).count() == 0


def test_passages_inside_lines(spark, docs, none):
    words = [f"w{k}" for k in range(400)]
    shared = " ".join(words[:60])
    rows = [(1, "a b\n" + shared + " c"), (2, "x y " + shared.upper().replace(" W30 ", "\n\nW30  ") + " z"), (3, " ".join(words[11:60])), (4, " ".join(words[200:]))]
    found = repeated_passages.passages(spark.createDataFrame(rows, "doc_id long, text string"))
    (r,) = found.collect()
    assert (r["doc_id"], r["n_words"], r["first_doc_id"], r["first_start"]) == (2, 60, 1, 4)
    assert rows[1][1][r["start"] : r["end"]].lower().split() == words[:60]
    assert repeated_passages.passages(none).count() == 0
    # a text that repeats itself keeps its begin
    spans = {(r["doc_id"], r["start"]) for r in repeated_passages.passages(docs).collect()}
    assert (7, 200) in spans and (8, len(PROSE) + 1) in spans and (5, 0) in spans and not any(d == 4 for d, _ in spans)


def test_paragraph_units():
    assert list(repeated_passages.spans("a\nb\n\n c \n\n", "paragraph")) == [(0, 3, "a\nb"), (5, 8, " c ")]
    assert list(repeated_passages.spans("", "paragraph")) == []


def test_personal_data(docs, none):
    found = personal_data.find(docs)
    assert found.count() == len(ROWS)
    base = {r["doc_id"]: r["base"] for r in found.collect()}
    at = 2 * len(PROSE) + 7
    assert [(s["start"], s["end"], s["kind"]) for s in base[8]] == [(at, at + 15, 0)] and base[6] == []
    text = by_id(personal_data.sanitised(docs, found), "doc_id")
    assert text[8]["text"].endswith("[EMAIL]") and text[1]["text"] == "" and len(text[6]["text"]) == 200_000
    assert personal_data.find(none).count() == 0


def test_words_of_single_and_distant_evidence(spark):
    far = "plain words of all " * 40
    rows = [(0, f"zanzibar {far}at ann@x.org naïveann@x.org plain"), (1, f"hapax {far}")] + [(k, far) for k in range(2, 400)]
    found = personal_data.find(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: [(rows[r["doc_id"]][1][t["start"] : t["end"]], t["part"] < 1) for t in r["terms"]] for r in found.collect()}
    # "zanzibar" stands once, far from the address; "na" goes on into an address
    assert got[0] == [("zanzibar", True), ("at", True)] and not any(got[k] for k in range(1, 400))


def test_near_duplicates(docs, none):
    rows = near_duplicates.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    found = {r["id"]: r for r in rows if r["id"] is not None}
    assert (found[1]["n_shingles"], found[1]["component_id"], found[1]["kept"]) == (0, 1, True)
    assert (found[5]["component_id"], found[5]["kept"]) == (4, False) and found[9]["n_shingles"] == 1
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 7, 9]
    assert near_duplicates.near_duplicates(none).count() == 0


def test_near_duplicates_keeps_one_of_equal_rows(spark):
    docs = spark.createDataFrame([(1, PROSE), (1, PROSE), (2, PROSE)], "doc_id long, text string")
    assert [r["doc_id"] for r in near_duplicates.keep_one(docs).collect()] == [1]


def test_texts_that_share_an_id_stay_or_go_for_themselves(spark):
    other = " ".join(f"clean{k} text of its own" for k in range(30))
    rows = [(0, PROSE), (1, PROSE + " end"), (1, other), (2, other + " end"), (3, PROSE), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["id"], r["n_shingles"]): r["component_id"] for r in near_duplicates.near_duplicates(docs).collect()}
    sizes = {text: len(text.split()) - 4 for text in (PROSE, PROSE + " end", other, other + " end")}
    assert found == {
        (0, sizes[PROSE]): 0, (1, sizes[PROSE + " end"]): 0, (3, sizes[PROSE]): 0, (3, 0): 3,
        (1, sizes[other]): 1, (2, sizes[other + " end"]): 1,
    }
    kept = sorted(((r["doc_id"], r["text"] or "") for r in near_duplicates.keep_one(docs).collect()))
    assert kept == [(0, PROSE), (1, other), (3, "")]


def test_packing(docs, none):
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    lengths = [r["length"] for r in rows if r["id"] in (1, 2, 3)]
    assert lengths == [1, 1, 1]
    assert sum(r["id"] is None for r in rows) == 2 and max(r["length"] for r in rows) == 4096
    assert sum(r["length"] for r in rows if r["id"] == 7) == 60_001
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_quality_model(docs, none, spark):
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 1), (8, 1), (None, 1), (9, None)], "doc_id long, quality int")
    rows = quality_model.score(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    unlabelled = quality_model.score(docs, labels.limit(0))
    assert {r["score"] for r in unlabelled.collect()} == {0.5}
    assert quality_model.score(none, labels).count() == 0


def test_main_text(spark):
    pages = [(1, None, None), (None, "u", ""), (2, "u", "<p>" + "a, b. " * 50_000), (3, "u", "<b><i" * 1000), (4, "u", "&amp;lt; <unknown>x</p></div>")]
    schema = "page_id long, url string, html string, id long, text string"
    rows = by_id(main_text.extract(spark.createDataFrame([p + (0, "t") for p in pages], schema)))
    assert rows[1]["text"] == "" and rows[2]["n_chars"] == 299_999 and rows[3]["text"] == "" and rows[4]["text"] == "&lt; x"
    assert main_text.extract(spark.createDataFrame([], schema)).count() == 0


FIVE = "".join(f"<p>Paragraph {k}, with commas, and words, to score well, {'and more ' * 12}</p>" for k in range(5))


@pytest.mark.parametrize(
    "opening",
    ['<div class="content with-sidebar">', '<div id="page-has-nav">', '<section class="related-work">', '<div class="post-header">', '<div class="alert">', "<form id=aspnetForm>"],
)
def test_names_do_not_take_the_article(opening):
    for inner in (FIVE, f"<article>{FIVE}</article>"):
        text = main_text.main_text(f"<body>{opening}{inner}<div class='ad'>Buy, now, this</div></{opening[1:].split()[0]}></body>")
        assert text.count("Paragraph") == 5 and "Buy" not in text
    assert main_text.main_text("<body><article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article></body>") == "So x=1 holds."
    menu = "<div class='nav'>" + "<li><a href=x>Somewhere, else</a></li>" * 60 + "</div>"
    assert "Somewhere" not in main_text.main_text(f"<body><div>{menu}{FIVE}</div></body>")


def test_text_beside_the_best_container():
    beside = "<p>Short one.</p><table><tbody><tr><td>A cell</td></tr></tbody></table><pre>x = 1</pre><figure><figcaption>Seen</figcaption></figure>"
    links = "<ul>" + "<li><a href=x>Elsewhere</a></li>" * 5 + "</ul>"
    page = f"<body><div class=post>Bare, with <a href=y>a link</a> in it.<div class=intro>{FIVE}</div>{beside}{links}</div></body>"
    lines = main_text.main_text(page).split("\n")
    assert lines[0] == "Bare, with a link in it." and lines[6:] == ["Short one.", "A cell", "x = 1", "Seen"]


def test_vector_links(spark):
    unit = [1.0, 0.0, 0.0]
    rows = [(5, unit), (3, [2.0, 0.0, 0.0]), (4, unit), (4, unit), (7, None), (8, []), (9, [0.0, 0.0, 0.0]), (10, [1.0, None, 0.0]),
            (11, [float("nan"), 1.0, 0.0]), (12, [float("inf"), 1.0, 0.0]), (None, unit), (13, [1.0, 0.0]), (14, [1e-30, 1e-30, 0.0])]
    docs = spark.createDataFrame([r + (0,) for r in rows], "vec_id long, embedding array<float>, copies long")
    found = sorted((r["id"] or 0, r["n_links"], r["component_id"]) for r in vector_links.links(docs).collect())
    alone = [(k, 0, k) for k in (7, 8, 9, 10, 11, 12, 13, 14)]
    assert found == [(0, 0, None), (3, 3, 3), (4, 3, 3), (4, 3, 3), (5, 3, 3), *alone]
    assert vector_links.links(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [12_000, 48_000])
def test_forest_keeps_a_loose_group_together(n):
    random_ = np.random.default_rng(1)
    centre = random_.standard_normal(64)
    loose = centre / np.linalg.norm(centre) + np.sqrt((1 / 0.92 - 1) / 64) * random_.standard_normal((n // 3, 64))
    x = np.concatenate([loose, random_.standard_normal((n - n // 3, 64))])
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    s = vector_links.Settings()
    pairs = random_.integers(0, n // 3, (4000, 2))
    pairs = pairs[(unit[pairs[:, 0]] * unit[pairs[:, 1]]).sum(axis=1) >= s.cosine]
    sample = random_.random(n) < s.sample / n
    met = np.zeros(len(pairs), bool)
    for k in range(s.forest_size(n)):
        rows, leaves = vector_links.route(vector_links.grow(unit[sample], max(n / s.sample, 1), s, k), unit)
        held = np.zeros((n // 3, leaves.max() + 1), bool)
        held[rows[rows < n // 3], leaves[rows < n // 3]] = True
        met |= (held[pairs[:, 0]] & held[pairs[:, 1]]).any(axis=1)
    assert met.mean() > 0.99


def planted(n, kind):
    """Unit vectors and pairs of them at the threshold or in a tight group with a third of the rows."""
    random_ = np.random.default_rng(2)
    x = random_.standard_normal((n, 64))
    if kind == "pairs":
        m = n // 10
        x[n - m :] = x[:m] + 0.47 * random_.standard_normal((m, 64))
        pairs = np.stack([np.arange(m), np.arange(n - m, n)], axis=1)
    else:
        x[: n // 3] = random_.standard_normal(64) + 0.12 * x[: n // 3]
        pairs = random_.integers(0, n // 3, (3000, 2))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return unit, pairs[(unit[pairs[:, 0]] * unit[pairs[:, 1]]).sum(axis=1) >= 0.9]


@pytest.mark.parametrize("kind", ["pairs", "tight"])
def test_rows_and_comparisons_of_a_forest_grow_slowly(kind):
    s, rows_each, work = vector_links.Settings(), [], []
    for n in (12_000, 96_000):
        unit, pairs = planted(n, kind)
        sample = np.random.default_rng(3).random(n) < s.sample / n
        scale = max(n / s.sample, 1)
        core = vector_links.core_of(unit, vector_links.core_centres(unit[sample], scale, s), s)
        assert (core >= 0).mean() > 0.3 if kind == "tight" else (core < 0).all()
        single = unit.astype(np.float32)
        met = (core[pairs[:, 0]] == core[pairs[:, 1]]) & (core[pairs[:, 0]] >= 0)
        all_rows = compared = 0
        for k in range(s.forest_size(n)):
            rows, leaves = vector_links.route(vector_links.grow(single[sample & (core < 0)], scale, s, k), single)
            all_rows += len(rows)
            compared += (np.bincount(leaves).astype(float) ** 2).sum() - (np.bincount(leaves[core[rows] >= 0]).astype(float) ** 2).sum()
            met |= meets(rows, leaves, pairs)
        assert met.mean() > 0.98
        rows_each.append(all_rows / n)
        work.append(compared / n)
    assert rows_each[1] < 1.8 * rows_each[0] and rows_each[1] < 15 and work[1] < 3 * work[0]


def meets(rows, leaves, pairs):
    order = np.lexsort((leaves, rows))
    rows, leaves = rows[order], leaves[order]
    of = lambda k: leaves[np.searchsorted(rows, k) : np.searchsorted(rows, k + 1)]
    return np.array([len(np.intersect1d(of(a), of(b))) > 0 for a, b in pairs])


def test_a_core_is_counted_not_compared(spark):
    random_ = np.random.default_rng(6)
    x = random_.standard_normal((1500, 16))
    x[:600] = x[0] + 0.1 * random_.standard_normal((600, 16))
    x[600:700] = x[0] + 0.45 * random_.standard_normal((100, 16))
    x[700:705] = x[3]
    docs = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    small = vector_links.Settings(leaf=100, block=64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (vector_links.core_of(unit, vector_links.core_centres(unit, 1, small), small) >= 0).sum() > 500
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    found = {r["id"]: r["n_links"] for r in vector_links.links(docs, settings=small).collect()}
    got = np.array([found[k] for k in range(len(x))])
    assert (got <= linked.sum(axis=1)).all() and got.sum() >= 0.99 * linked.sum()


def test_sentences_are_units():
    assert list(repeated_passages.spans("A b. C!? d\n...e\n\n", "sentence")) == [(0, 4, "A b."), (4, 8, " C!?"), (8, 10, " d"), (11, 14, "..."), (14, 15, "e")]


def test_a_passage_inside_lines_is_found(spark):
    passage = " ".join(f"Sentence number {k} of the passage." for k in range(6))
    rows = [(1, f"Begin one {passage} End one."), (2, f"Yes. Other start. Then\n{passage}\n\nAnd on. Yes."), (3, "Yes. No. Yes.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages.repeats(docs).collect()
    # its first sentence begins in another one of the first document
    assert {(r["doc_id"], r["first_doc_id"]) for r in found} == {(2, 1)} and len(found) == 5
    texts = by_id(repeated_passages.cleaned(docs, repeated_passages.repeats(docs)), "doc_id")
    assert texts[2]["text"] == "Yes. Other start. Then\nSentence number 0 of the passage.\n\nAnd on. Yes."
    every = repeated_passages.repeats(docs, min_words=1).collect()
    assert sorted((r["doc_id"], r["start"]) for r in every if r["n_words"] == 1) == [(2, len(rows[1][1]) - 5), (3, 0), (3, 8)]


def test_an_entity_of_every_document_discloses_nothing(spark):
    for rows in ([(1, "write to a@b.example.org now")], [(k, f"page{k} contact a@b.example.org") for k in range(5)]):
        found = personal_data.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert [(len(r["base"]), len(r["terms"])) for r in found] == [(1, 0)] * len(rows)


def test_many_numbers_in_one_text(spark):
    text = " ".join(str(10 + k % 90) + "," for k in range(100_000)) + " 4111 1111 1111 1111"
    start = time.time()
    found = personal_data.find(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).collect()
    assert [len(r["base"]) for r in sorted(found, key=lambda r: r["doc_id"])] == [1, 0]
    assert time.time() - start < 60


LEAKS = (
    "comment-list comments-area commentlist ad-container ad-wrapper ad-slot ads-block advert-box cookie-bar cookie-consent-bar sidebar-content "
    "sidebar-inner newsletter-box nav-links menu-item footer-links notice-box promo-block social-icons share-buttons site-header-wrap ad"
).split()


@pytest.mark.parametrize("holder", ["article", "div"])
def test_usual_names_of_furniture(holder):
    prose = "".join(f"<p>The article goes on, sentence {k}, with words, commas and enough length to count.</p>" for k in range(5))
    want = main_text.main_text(f"<body><{holder}>{prose}</{holder}></body>")
    for name in LEAKS:
        for kind in ("class", "id"):
            page = f"<body><{holder}>{prose}<div {kind}='{name}'><p>Not of it, but long, with commas, and so on, and so on.</p></div></{holder}></body>"
            assert main_text.main_text(page) == want, name
    for name in ("related-work", "post-content", "entry-header", "content with-sidebar", "page-has-nav", "article-body-inner"):
        page = f"<body><{holder}>{prose}<div class='{name}'><p>This one is of it, and stays.</p></div></{holder}></body>"
        assert main_text.main_text(page).endswith("stays."), name


@pytest.mark.parametrize(
    "page", ["<b>" * 100_000 + "</i>" * 100_000, "<b>" * 20_000 + "<span>x<div>y</div></span>" * 20_000, "<b>" * 20_000 + "<option>o</option>" * 20_000]
)
def test_stray_and_deep_tags_take_linear_time(page):
    start = time.time()
    main_text.main_text(f"<body><article><p>The text, long enough.</p>{page}</article></body>")
    assert time.time() - start < 20
