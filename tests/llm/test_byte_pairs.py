"""Byte-pair encoding against the library on whole texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm import byte_pairs, queries

PATH = queries.byte_pairs_path()
SIGNS = ["a", "b", "th", "e", "'", "s", "'s", "'re", " ", "  ", "\n", "\n\n", "\t", "1", "22", "é", "漢", "字", "<|endoftext|>", "<|end", "oftext|>", "!", "?'", "😀", "́", "the ", "ing", " of"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def made(rng, n):
    signs = rng.sample(SIGNS, rng.randint(1, len(SIGNS)))
    return "".join(rng.choice(signs) for _ in range(n))


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_tree_of_halves_gives_the_whole(library):
    rng, words = random.Random(7), byte_pairs.vocabulary(PATH)
    for _ in range(300):
        text, leaf = made(rng, rng.randint(1, 1500)), rng.choice([60, 100, 300])
        n = byte_pairs.halves(len(text), leaf)
        parts = [text[len(text) * k // n : len(text) * (k + 1) // n] for k in range(n)]
        assert max(map(len, parts)) <= leaf
        nodes = [(p.encode(), np.array(words.encode(p), np.int64)) for p in parts]
        while len(nodes) > 1:
            nodes = [(a + b, byte_pairs.join(a, x, b, y, words)) for (a, x), (b, y) in zip(nodes[::2], nodes[1::2])]
        assert nodes[0][1].tolist() == ids_of(library, text)


def test_windows_stay_small_on_an_unsplit_run(library, monkeypatch):
    rng, words = random.Random(3), byte_pairs.vocabulary(PATH)
    text = "".join(rng.choice("abcdefgh") for _ in range(40_000))
    a, b = text[:20_000], text[20_000:]
    x, y = (np.array(words.encode(p), np.int64) for p in (a, b))
    seen = []
    plain = words.encode
    monkeypatch.setattr(words, "encode", lambda t: seen.append(len(t)) or plain(t))
    assert byte_pairs.join(a.encode(), x, b.encode(), y, words).tolist() == ids_of(library, text)
    assert sum(seen) < 2_000


def test_remembered_words(library):
    rng = random.Random(11)
    texts = ["", " ", "  ", "a ", "a b", " a", "a\n b", "a \nb", "a \n", "x﷐y z"] + [made(rng, rng.randint(0, 40)) for _ in range(2_000)]
    want = [ids_of(library, t) for t in texts]
    words = byte_pairs.Vocabulary(PATH)
    assert words.encode_all(pa.array(texts)).to_pylist() == want == words.encode_all(pa.array(texts)).to_pylist()


def test_table(spark, library):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "x" * 5_000), (4, "x" * 5_000), (5, "é" * 3_001), (6, "<|endoftext|>" * 90)]
    rows += [(10 + k, made(rng, rng.randint(0, 1_200))) for k in range(40)]
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, ids long, key long")
    for leaf in (100, 1 << 20):
        found = byte_pairs.decode(byte_pairs.encode(docs, PATH, leaf=leaf), PATH).collect()
        got = sorted(((r["id"], r["ids"], r["text"]) for r in found), key=repr)
        assert got == sorted(((d, ids_of(library, t or ""), t or "") for d, t in rows), key=repr)
    assert byte_pairs.decode(byte_pairs.encode(docs.limit(0), PATH), PATH).count() == 0


def test_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for d, t in texts.items():
        ids = ids_of(library, t)
        want[d] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    rows = queries.op11_byte_pairs(spark, sf_dir).collect()
    assert len(rows) == len(want) and {r["doc_id"]: tuple(r)[1:] for r in rows} == want


def test_decoding_of_any_ids(library):
    rng = random.Random(13)
    for _ in range(500):  # mostly no valid UTF-8
        lists = [[rng.choice([rng.randrange(50_257), rng.randrange(256), 50_256]) for _ in range(rng.randint(0, 6))] for _ in range(3)]
        got = byte_pairs.texts_of(pa.array(lists, pa.list_(pa.int32())), PATH).to_pylist()
        assert got == [library.decode(ids, skip_special_tokens=False) for ids in lists]
    halves = [x for t in ("é", "漢") for x in ([i] for i in ids_of(library, t))]  # a character over the end of a list
    assert byte_pairs.texts_of(pa.array(halves, pa.list_(pa.int32())), PATH).to_pylist() == [library.decode(x) for x in halves]
    odd = pa.array([None, ids_of(library, "é x"), None, []], pa.list_(pa.int32()))
    assert byte_pairs.texts_of(odd, PATH).to_pylist() == ["", "é x", "", ""]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        byte_pairs.Vocabulary(queries.tokenizer_path())


def test_parts_move_as_ids_and_finished_texts_leave_the_levels(spark, library, monkeypatch):
    rng, plain, seen = random.Random(17), byte_pairs.saved, []

    def saved(df, label):
        found = plain(df, label)
        seen.append((label, found.columns, found.count()))
        return found

    monkeypatch.setattr(byte_pairs, "saved", saved)
    texts = [made(rng, 1_000)[:n] for n in (190, 150, 799, 60)]
    texts.append(texts[2])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["ids"] for r in byte_pairs.encode(docs, PATH, leaf=100).collect()}
    assert got == {d: ids_of(library, t) for d, t in enumerate(texts)}
    levels = [x for x in seen if x[0] in ("leaves", "joined")]
    assert [n for _, _, n in levels] == [2 + 2 + 8, 1 + 1 + 4, 2, 1]
    assert not any({"text", "data"} & set(columns) for _, columns, _ in levels) and "halves" not in {x[0] for x in seen}
