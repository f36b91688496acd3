"""Packing token sequences: best-fit decreasing, certified by lower bounds, repacked where there is a gap.

Documents are tokenized in batches inside the tasks; only lengths and checksums
are shuffled. Pieces are dealt by a hash over groups of bounded size and packed by
best-fit decreasing. Dual feasible functions give a lower bound for the number of
sequences of each group. Groups above their bound exchange: the pieces of their
sequences with room are dealt anew, sequence by sequence and mixed with those of
other groups, and packed again; a new packing is taken only if it needs fewer
sequences. The driver sees one number per round.

Defined results: null text is empty (one end token); equal rows are packed each;
an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, saved, ship

#: Words that a worker remembers; beyond that it forgets all and begins anew. No result depends on it.
MEMORY = 400_000
#: Characters of text that are tokenized at once.
CHUNK = 2_000_000
#: Texts with other characters (these are composed and have plain small letters), or with a
#: special token, go through the tokenizer as they are.
UNUSUAL = (
    r"[^\t-\r\x20-\x7e\x{a1}-\x{ac}\x{ae}-\x{12f}\x{131}-\x{24f}\x{2010}-\x{2027}\x{2030}-\x{205e}]|<\|(?:start|end)oftext\|>"
)
#: What the vocabulary's own file splits off: all but runs of letters.
NO_LETTERS = r"('s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+)"

_tokenizers: dict[str, "Tokens"] = {}


class Memory:
    """Strings and the token ids that each stands for."""

    def __init__(self):
        self.place: dict[str, int] = {"": 0}
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, "<u4"), 0

    def places(self, strings: list[str]) -> np.ndarray:
        """Where each string is, -1 for the unknown."""
        get = self.place.get
        return np.array([get(s, -1) for s in strings], np.int64)

    def learn(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Remembers new strings with their ids, one after the other; returns their places."""
        n = len(self.place)
        while n + len(strings) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.start[n : n + len(strings)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(strings)] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.place.update(zip(strings, range(n, n + len(strings))))
        return np.arange(n, n + len(strings))

    def gather(self, at: np.ndarray, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all lists of strings, given by place, in turn; and where each list's begin and end."""
        sizes = self.size[at]
        through = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.start[at] - through[:-1], sizes) + np.arange(through[-1])]
        return ids, through[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def _split(texts: pa.Array) -> pa.ListArray:
    """Parts between white space. Arrow leaves white space at the very end of an array in its last part, hence the trim."""
    return pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))


class Tokens:
    """Token ids of texts, by way of their distinct words.

    The vocabulary's file lower-cases a text, splits it into runs of letters,
    single digits and runs of other signs, and tokenizes each by itself; no piece
    spans white space. Here Arrow finds the distinct words of many texts at once.
    New ones are split, their new pieces tokenized once, and both remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for pieces that are normalised and split already
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words, self.pieces = Memory(), Memory()

    def _gather(self, memory: Memory, lists: pa.ListArray, learn) -> tuple[np.ndarray, np.ndarray]:
        coded = lists.flatten().dictionary_encode()
        strings = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = memory.places(strings)
        if len(new := np.flatnonzero(at < 0)):
            at[new] = learn([strings[k] for k in new.tolist()])
        return memory.gather(at[coded.indices.to_numpy()] if len(at) else at, lists)

    def _learn_pieces(self, pieces: list[str]) -> np.ndarray:
        found = []
        for k in range(0, len(pieces), 20_000):
            found += [e.ids for e in self.plain.encode_batch_fast(pieces[k : k + 20_000], add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        return self.pieces.learn(pieces, np.fromiter(itertools.chain.from_iterable(found), "<u4", int(sizes.sum())), sizes)

    def _learn_words(self, words: list[str]) -> np.ndarray:
        pieces = _split(pc.replace_substring_regex(pa.array(words, pa.string()), NO_LETTERS, r" \1 "))
        ids, ends = self._gather(self.pieces, pieces, self._learn_pieces)
        return self.words.learn(words, ids, np.diff(ends))

    def _usual(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.words.place) > MEMORY:
            self.words, self.pieces = Memory(), Memory()
        ids, ends = self._gather(self.words, _split(pc.utf8_lower(texts)), self._learn_words)
        return [ids[a:b] for a, b in itertools.pairwise(ends.tolist())]

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Of each text, an array of unsigned 32-bit ids; null is empty."""
        texts = pc.fill_null(texts, "")
        through = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(through // CHUNK)) + 1).tolist(), len(texts)]
        for a, b in itertools.pairwise(cuts):
            part = texts.slice(a, b - a)
            unusual = pc.match_substring_regex(part, UNUSUAL).to_numpy(zero_copy_only=False).astype(bool)
            usual = iter(self._usual(pc.filter(part, pa.array(~unusual))))
            for text, odd in zip(part, unusual):
                yield np.array(self.tokenizer.encode(text.as_py(), add_special_tokens=False).ids, "<u4") if odd else next(usual)


def tokens_of(path: str) -> Tokens:
    """The tokenizer of a file, once per worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokens(path)
    return _tokenizers[path]


def pieces(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each document; longer ones are cut."""
    kind = docs.schema[id].dataType
    fields = [T.StructField("id", kind), *[T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]]
    fields += [T.StructField("ids", T.BinaryType())] if with_ids else []
    schema = T.StructType(fields)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        for batch in batches:
            at, out = [], []
            for k, found in enumerate(tokens.ids(batch["text"])):
                ids = found.tobytes() + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    at.append(k)
                    out.append((piece, start // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            columns = [batch["id"].take(pa.array(at, pa.int64())), *[pa.array(c, pa.int64()) for c in list(zip(*out))[:4] or [[]] * 4]]
            if with_ids:
                columns.append(pa.array([o[4] for o in out], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ship(docs.sparkSession)
    return docs.select(col(id).alias("id"), col(text).alias("text")).mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, into the open bin with the least room that is enough."""
    bins = np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # bit r of ``rooms``: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        enough = rooms >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            bin = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            bin, room, n = n, capacity, n + 1
        bins[item] = bin
        if room > length:
            with_room[room - length].append(bin)
            rooms |= 1 << (room - length)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing needs fewer bins: the best of two families of dual feasible functions, in whole numbers."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    # items longer than capacity - a count as full, those shorter than a as nothing
    words = np.concatenate([[0], np.cumsum(count * x)])
    items = np.concatenate([[0], np.cumsum(count)])
    a = np.arange(1, capacity // 2 + 1)
    full = items[-1] - items[capacity - a + 1]
    rest = words[capacity - a + 1] - words[a]
    best = max(best, int((full + -(-rest // capacity)).max()))
    for k in range(1, 101):
        scaled = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * scaled).sum()) // (capacity * k)))
    return best


def _packed(capacity: int, round: int):
    def run(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        group = table["group"][0].as_py()
        bins, bound = best_fit_decreasing(lengths, capacity), lower_bound(lengths, capacity)
        n = int(bins.max()) + 1
        before = table["sequence_id"].to_numpy(zero_copy_only=False) if round else None
        if before is not None and n >= len(np.unique(before)):  # no gain: all stays as it was
            return table.drop_columns(["group"]).set_column(
                table.drop_columns(["group"]).schema.get_field_index("gap"), "gap", pa.array(np.full(len(lengths), n > bound))
            )
        order = np.argsort(bins, kind="stable")
        run_on = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[True], np.diff(bins[order]) > 0])
        offset = np.empty(len(lengths), np.int64)
        offset[order] = run_on - np.maximum.accumulate(np.where(first, run_on, 0))
        room = capacity - np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        new = {
            "sequence_id": (((round << 26) + group) << 26) + bins, "offset": offset, "room": room, "gap": np.full(len(lengths), n > bound)
        }
        kept = table.drop_columns(["group", *(new if round else [])])
        for name, values in new.items():
            kept = kept.append_column(name, pa.array(values))
        return kept

    return run


def pack(items: DataFrame, capacity: int = 4096, group_size: int = 65_536, rounds: int = 3) -> DataFrame:
    """``items`` (with a column ``length`` of 1 to ``capacity``) with sequence_id and offset.

    Also ``room``, what the sequence has left, and ``gap``, whether the group it
    was packed in last is above its lower bound.
    """
    ship(items.sparkSession)
    numbered = saved(items.withColumn("item", F.monotonically_increasing_id()), "pieces")
    names = ("sequence_id", "offset", "room")
    out = T.StructType([*numbered.schema.fields, *[T.StructField(n, T.LongType()) for n in names], T.StructField("gap", T.BooleanType())])

    def deal(rows: DataFrame, n: int, *key: str) -> DataFrame:
        groups = max(1, -(-n // group_size))
        return rows.withColumn("group", F.pmod(F.xxhash64(*key), F.lit(groups)))

    todo, done = deal(numbered, numbered.count(), "item"), []
    for round in range(rounds + 1):
        packed = saved(todo.groupBy("group").applyInArrow(_packed(capacity, round), out), "packed")
        again = packed.filter(F.col("gap") & (F.col("room") > 0))
        n = again.count() if round < rounds else 0
        if not n:
            done.append(packed)
            break
        done.append(packed.filter(~(F.col("gap") & (F.col("room") > 0))))
        todo = deal(again.withColumn("round", F.lit(round)), n, "round", "sequence_id").drop("round")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("item")


def pack_documents(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1, **options
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset, room, gap), one row per piece."""
    return pack(pieces(docs, tokenizer, id, text, capacity, end_id), capacity, **options)
