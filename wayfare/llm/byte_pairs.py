"""Byte-pair encoding of texts of any length, and decoding: halves are encoded apart and joined exactly.

Texts of up to ``leaf`` characters are encoded whole, in batches inside the tasks. A
longer one is halved until its parts are no longer than that, whether or not it has
a place to split; the parts are rows of their own, dealt over the cluster and
encoded in parallel. Then they are joined up the tree, two by two, level by level. A
join takes the bytes around the cut, from a token's edge on the left to one on the
right, and encodes this window anew. If it begins with the left side's token and ends
with the right side's, both sides agree and the window replaces what it covers;
otherwise it grows to four times its reach, in the end to both parts as a whole.

Why that is exact: a sequence of tokens is what byte-pair merges give for its text if
and only if each two neighbours are what they give for theirs. All neighbours in a
part and in the window are; the agreeing tokens carry that over the window's edges.
The window's edges lie far enough from the cut that no special token, contraction or
look-ahead reaches both, and beside no apostrophe, where a split could depend on what
stood before.

The vocabulary is a file of the tokenizers library of byte-level pairs; other kinds are
refused. No text is cut short: what comes out is what the library gives for the whole.

Defined results: null text is empty and has no ids; rows of one id are rows of their
own, equal ones too; a null id is an id; copies of a long text are encoded once; an
empty table gives no rows. Other columns of the table aren't read, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, saved, ship
from .packing import Memory

#: Characters of a text that are encoded at once.
LEAF = 1 << 15
#: Characters of text, or ids, that are worked on at once.
CHUNK = 1 << 19
#: Words that a worker remembers; beyond that it forgets all and begins anew. No result depends on it.
MEMORY = 200_000
#: Parts a text's words; texts that hold it are encoded whole.
MARK = "\ufdd0"
WHOLE = f"  | $|{MARK}"
#: Bytes beside a cut that a window takes at least; several times the longest special token.
REACH = 64

_loaded: dict[str, "Vocabulary"] = {}


def byte_letters() -> dict[str, int]:
    """The sign that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@functools.cache
def spelled(path: str) -> list[bytes]:
    """The bytes of each id, read from the vocabulary's file; decoding needs nothing else of it."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    letters, found = byte_letters(), {id: token for token, id in whole["model"]["vocab"].items()}
    special = {t["id"]: t["content"].encode() for t in whole["added_tokens"]}
    return [special[k] if k in special else bytes(letters[c] for c in found.get(k, "")) for k in range(max([*found, *special]) + 1)]


@functools.cache
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids after each other, where each id's begin, and how many they are."""
    sizes = np.array([len(b) for b in spelled(path)], np.int64)
    return np.frombuffer(b"".join(spelled(path)), np.uint8), np.cumsum(sizes) - sizes, sizes


def text_of(ids: list[int], bytes_of: list[bytes]) -> str:
    """The text of ids; bytes that are no UTF-8 become the replacement sign, as in the library."""
    return b"".join(map(bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def texts_of(lists: pa.ListArray, path: str) -> pa.Array:
    """The text of each list of ids. Where all bytes are UTF-8 they are the texts; else each list is decoded by itself."""
    flat, starts, sizes = byte_table(path)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    n = sizes[ids]
    through = np.concatenate([[0], np.cumsum(n)])
    data = flat[np.repeat(starts[ids] - through[:-1], n) + np.arange(through[-1])]
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = through[np.concatenate([[0], np.cumsum(counts)])]
    whole = data.tobytes()
    inside = ends[ends < len(data)]
    try:
        whole.decode()
        clean = not (data[inside] & 0xC0 == 0x80).any()  # no character goes over the end of a list
    except UnicodeDecodeError:
        clean = False
    if not clean:
        return pa.array([text_of(x or [], spelled(path)) for x in lists.to_pylist()], pa.string())
    return pa.StringArray.from_buffers(len(lists), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(whole))


class Vocabulary:
    """A tokenizer, and the bytes that each id stands for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel" or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} is no vocabulary of byte-level pairs")
        self.memory = Memory()
        self.bytes = np.array([len(b) for b in spelled(path)], np.int64)
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.reach = max([REACH, *(4 * len(t.content.encode()) for t in special)])

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, words: pa.Array) -> np.ndarray:
        """Places of new words, remembered: those with a blank before are encoded as one text and told apart by their bytes."""
        spaced = pc.starts_with(words, " ").to_numpy(zero_copy_only=False).astype(bool)
        one, apart = pc.filter(words, pa.array(spaced)), pc.filter(words, pa.array(~spaced)).to_pylist()
        one_list = one.to_pylist()
        ids = np.array(self.encode("".join(one_list)), "<u4")
        ends = np.cumsum(pc.binary_length(one).to_numpy(zero_copy_only=False))
        sizes = np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), ends) + 1, prepend=0) if one_list else np.zeros(0, np.int64)
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)]
        rest_sizes = np.array([len(x) for x in rest], np.int64)
        flat = np.concatenate([ids, np.fromiter(itertools.chain.from_iterable(rest), "<u4", int(rest_sizes.sum()))])
        places = np.empty(len(words), np.int64)
        places[np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])] = self.memory.learn(
            one_list + apart, flat, np.concatenate([sizes, rest_sizes]).astype(np.int64)
        )
        return places

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Lists of ids. A single blank always begins a piece, so what stands between blanks is encoded once and remembered.

        Texts with two blanks in a row, or one at the end, go through the library whole.
        """
        if len(self.memory.place) > MEMORY:
            self.memory = Memory()
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False).astype(bool)
        lists = pc.split_pattern(pc.replace_substring(pc.filter(texts, pa.array(~whole)), " ", MARK + " "), MARK)
        coded = lists.flatten().dictionary_encode()
        at = self.memory.places(coded.dictionary.to_pylist())
        if len(new := np.flatnonzero(at < 0)):
            at[new] = self.learn(coded.dictionary.take(pa.array(new)))
        flat, ends = self.memory.gather(at[coded.indices.to_numpy()] if len(at) else at, lists)
        if not whole.any():
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))
        usual = (flat[a:b] for a, b in itertools.pairwise(ends.tolist()))
        odd = (e.ids for e in self.tokenizer.encode_batch_fast(pc.filter(texts, pa.array(whole)).to_pylist(), add_special_tokens=False))
        return _lists([next(odd) if w else next(usual) for w in whole])


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once per worker process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _edge(data: bytes, at: int) -> bool:
    """Whether a window may begin or end at this byte: a character's begin, beside no apostrophe."""
    return data[at] & 0xC0 != 0x80 and data[at] != 0x27 and data[at - 1] != 0x27


def join(left: bytes, left_ids: np.ndarray, right: bytes, right_ids: np.ndarray, words: Vocabulary) -> np.ndarray:
    """The ids of two texts put together, from those of each."""
    if not left or not right:
        return np.concatenate([left_ids, right_ids])
    left_ends, right_ends = np.cumsum(words.bytes[left_ids]), np.cumsum(words.bytes[right_ids])
    reach = words.reach
    while True:
        # tokens of the left before the window, and of the right inside it
        before = int(np.searchsorted(left_ends, len(left) - reach, "right"))
        while before and not _edge(left, int(left_ends[before - 1])):
            before -= 1
        inside = int(np.searchsorted(right_ends, reach, "left")) + 1
        while inside < len(right_ids) and not _edge(right, int(right_ends[inside - 1])):
            inside += 1
        inside = min(inside, len(right_ids))
        begin, end = int(left_ends[before - 1]) if before else 0, int(right_ends[inside - 1])
        window = words.encode((left[begin:] + right[:end]).decode())
        agreed_left = before == 0 or window[0] == left_ids[before]
        agreed_right = inside == len(right_ids) or window[-1] == right_ids[inside - 1]
        if agreed_left and agreed_right:
            return np.concatenate([left_ids[:before], np.array(window, np.int64), right_ids[inside:]])
        reach *= 4


def halves(n: int, leaf: int) -> int:
    """How many parts of at most ``leaf`` characters a text of ``n`` is halved into: a power of two."""
    return 1 << max((-(-n // leaf) - 1).bit_length(), 0)


# --- in the tasks

_IDS = pa.list_(pa.int32())
_PART = "key binary, count long, node long, ids array<int>"
_PART_SCHEMA = pa.schema([("key", pa.binary()), ("count", pa.int64()), ("node", pa.int64()), ("ids", _IDS)])


def _lists(ids: list) -> pa.ListArray:
    """An Arrow array of lists of ids."""
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _rows(batch: pa.RecordBatch, size: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose column ``size`` adds up to about ``limit``."""
    ends = np.cumsum(batch[size].to_numpy(zero_copy_only=False))
    cuts = [0, *(np.flatnonzero(np.diff(ends // limit)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in itertools.pairwise(cuts) if b > a)


def _encoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in itertools.chain.from_iterable(_rows(b, "size") for b in batches):
            yield pa.RecordBatch.from_arrays([batch["id"], words.encode_all(pc.fill_null(batch["text"], ""))], names=["id", "ids"])

    return run


def _decoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_rows(b, "size") for b in batches):
            yield pa.RecordBatch.from_arrays([batch["id"], batch["ids"], texts_of(batch["ids"], path)], names=["id", "ids", "text"])

    return run


def _leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for row in (batch.slice(k, 1) for k in range(batch.num_rows)):
                columns = [row["key"], row["count"], row["node"], words.encode_all(row["text"])]
                yield pa.RecordBatch.from_arrays(columns, schema=_PART_SCHEMA)

    return run


def _joining(path: str):
    def run(parts: pa.Table) -> pa.Table:
        words = vocabulary(path)
        parts = parts.sort_by("node")
        data, ids = b"", np.zeros(0, np.int64)
        for part in parts["ids"]:
            more = part.values.to_numpy(zero_copy_only=False).astype(np.int64)
            text = b"".join(map(spelled(path).__getitem__, more.tolist()))  # a part's bytes are those of its ids
            ids = join(data, ids, text, more, words)
            data += text
        joined = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids.astype(np.int32)))
        up = [pa.array([parts[c][0].as_py() >> 1]) for c in ("count", "node")]
        return pa.Table.from_arrays([parts["key"].slice(0, 1), *up, joined], schema=_PART_SCHEMA)

    return run


# --- on the cluster


def encode_long(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    """(key, ids) of each different long text (key, text), copies too in ``texts``, by the tree of halves.

    A part's text moves once, to the task that encodes it; from there on only ids do. A text whose
    tree is done leaves the levels.
    """
    n = F.length("text")
    # as ``halves``: the power of two at or above the number of leaves
    doublings = F.ceil(F.log2(F.ceil(n / leaf).cast("double"))).cast("int")
    count = F.call_function("shiftleft", F.lit(1), doublings).cast("long")
    at = lambda k: (n * k / F.col("count")).cast("long")
    nodes = (
        texts.select("key", "text", count.alias("count"))
        .select("key", "text", "count", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("node"))
        .select("key", "count", "node", F.substring("text", (at(F.col("node")) + 1).cast("int"), (at(F.col("node") + 1) - at(F.col("node"))).cast("int")).alias("text"))
    )
    different = nodes.groupBy("key", "count", "node").agg(F.first("text").alias("text"))
    level = saved(different.mapInArrow(_leaves(path), _PART), "leaves")
    done, most = level.filter(F.col("count") == 1), level.agg(F.max("count")).first()[0] or 1
    while most > 1:
        pairs = level.filter(F.col("count") > 1).groupBy("key", (F.col("node") / 2).cast("long").alias("above"))
        level, most = saved(pairs.applyInArrow(_joining(path), _PART), "joined"), most >> 1
        done = done.unionByName(level.filter(F.col("count") == 1))
    return done.select("key", "ids")


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """(id, ids) per row of ``docs``: the ids that the library gives for the whole text."""
    ship(docs.sparkSession)
    size = F.coalesce(F.length(col(text)), F.lit(0))
    read = docs.select(col(id).cast("long").alias("id"), col(text).alias("text"), size.alias("size"))
    short = read.filter(F.col("size") <= leaf).mapInArrow(_encoding(path), "id long, ids array<int>")
    long = saved(read.filter(F.col("size") > leaf).select("id", F.unhex(F.sha2("text", 256)).alias("key"), "text"), "long-texts")
    if long.isEmpty():
        return short
    return short.unionByName(long.select("id", "key").join(encode_long(long.select("key", "text"), path, leaf), "key").select("id", "ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, ids, text) of rows (id, ids); special tokens are text again."""
    ship(encoded.sparkSession)
    return encoded.select("id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("size")).mapInArrow(
        _decoding(path), "id long, ids array<int>, text string"
    )


def joined_ids(ids: Column) -> Column:
    """The ids in decimal digits, with commas."""
    return F.array_join(ids.cast("array<string>"), ",")
