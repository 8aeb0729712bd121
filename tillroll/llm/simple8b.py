"""Token files: ids in word-aligned Simple-8b blocks, written and read by Spark.

Coding. Ids are unsigned 32-bit integers, cut into blocks of BLOCK_IDS. A block
is a row of 64-bit words; the top 4 bits of a word select one of SELECTORS
(count, width) and its other 60 bits hold ``count`` ids of ``width`` bits, the
first in the lowest bits. The greatest value of a width is the escape: the id
itself then stands in the block's list of escapes. The last word of a block may
hold fewer ids than its selector says. Offsets of each block's first word and
first escape let any block be decoded alone, and all blocks at once in numpy:
words of one selector are unpacked together.

Files. A row of the (Parquet) files is a slab: whole documents in order, with
their keys, their lengths (coded like ids) and the blocks of all their ids. A
segment is the slabs of one writing task. Documents are sorted by key, nulls
first, rows of one key by a hash of the text; equal rows are interchangeable.
Spark's commit makes a file appear whole or not at all, so a lost executor
leaves no half-written segment.

Encoding. The tokenizer reads a text in words, cut where no match of its pattern
can cross (``WordTokenizer``; tokenizers that keep white space are refused). A
distinct word is encoded once and remembered, up to about MEMO_WORDS in a worker.

Rows: a null text is the empty text; both give just the end id. A text of any
length is read in slices of SLICE_BYTES; only a text without any white space is
one piece. Repeated rows are all kept; no table of one row per key is built, so
skew has no effect but that of the sort, which spreads the rows of one key. An
empty table gives no rows. Only the key and the text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, returns_memory, shuffle_partitions, sized_slices, text_bytes
from tillroll.session import checkpoint_dir

# Fixed values of the format: (count, width) by selector.
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
BLOCK_IDS = 1024
SLAB_IDS = 1 << 18
SLICE_BYTES = 1 << 20
MEMO_WORDS = 1_000_000
# A table of one row (16 bytes) per segment is broadcast up to this many.
BROADCAST_SEGMENTS = 1_000_000

_COUNT = np.array([c for c, _ in SELECTORS])
_WIDTH = np.array([w for _, w in SELECTORS])
# The least id that a selector does not hold.
_ESCAPE = np.array([max(1, 2 ** w - 1) for _, w in SELECTORS], np.uint64)


# -- coding ----------------------------------------------------------------

def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escapes, first escape of each block)."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    escaped, choice = _choose(ids, blocks)
    # follow the words of all blocks at the same time
    at = np.arange(blocks) * BLOCK_IDS
    end = np.minimum(at + BLOCK_IDS, n)
    steps = _COUNT[choice]
    starts = [np.empty(0, np.int64)]
    while len(at):
        starts.append(at)
        at = at + steps[at]
        at, end = at[at < end], end[at < end]
    starts = np.sort(np.concatenate(starts))
    chosen = choice[starts].astype(np.int64)
    block = starts // BLOCK_IDS
    held = np.minimum(_COUNT[chosen], np.minimum((block + 1) * BLOCK_IDS, n) - starts)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        count, width = SELECTORS[s]
        mine = np.flatnonzero(chosen == s)
        if width == 0:
            continue
        top = np.uint64(2 ** width - 1)
        for k in range(count):
            some = mine[held[mine] > k]
            place = starts[some] + k
            words[some] |= np.where(escaped[place], top, ids[place]) << np.uint64(k * width)
    escape_at = np.flatnonzero(escaped)
    first_word = np.searchsorted(block, np.arange(blocks)).astype("<u4")
    first_escape = np.searchsorted(escape_at // BLOCK_IDS, np.arange(blocks)).astype("<u4")
    return words.astype("<u8"), first_word, ids[escape_at].astype("<u4"), first_escape


def _choose(ids: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Which ids are escaped, and for every place the selector of a word that
    would begin there: the one of most ids that holds all of them."""
    n = len(ids)
    # the least selector that holds an id; places after the end hold anything
    level = np.zeros((blocks, BLOCK_IDS + SELECTORS[0][0]), np.int8)
    inside = level[:, :BLOCK_IDS]
    flat = np.zeros(blocks * BLOCK_IDS, np.int8)
    flat[:n] = np.searchsorted(_ESCAPE, ids, side="right")
    inside[:] = flat.reshape(blocks, BLOCK_IDS)
    # an id far wider than the four before and after it is escaped: 32 bits of
    # its own cost less than as many wide neighbours
    width = _WIDTH[np.minimum(flat, len(SELECTORS) - 1)].astype(np.int8).reshape(blocks, BLOCK_IDS)
    around = np.zeros_like(width)
    for d in range(1, 5):
        np.maximum(around[:, d:], width[:, :-d], out=around[:, d:])
        np.maximum(around[:, :-d], width[:, d:], out=around[:, :-d])
    escaped = (width - around >= 8) & (inside > 2)
    inside[escaped] = 2  # any width but none holds the escape
    choice = np.full((blocks, BLOCK_IDS), len(SELECTORS) - 1, np.int8)
    most, length = level, 1
    for s in range(len(SELECTORS) - 2, -1, -1):
        longer = SELECTORS[s][0]  # at most twice the length before
        most = np.maximum(most[:, :most.shape[1] - (longer - length)], most[:, longer - length:])
        length = longer
        choice[most[:, :BLOCK_IDS] <= s] = s
    return escaped.ravel()[:n], choice.ravel()


def unpack(words: np.ndarray, first_word: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``pack`` as little-endian unsigned 32-bit integers."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[selector]
    first_word = first_word.astype(np.int64)
    block = np.repeat(np.arange(len(first_word)), np.diff(np.append(first_word, len(words))))
    start = np.cumsum(count) - count
    start = start - start[first_word][block] + block * BLOCK_IDS
    # the last word of a block may hold fewer ids
    held = np.minimum(count, np.minimum((block + 1) * BLOCK_IDS, n) - start)
    out = np.zeros(n, np.uint64)
    escaped = np.zeros(n, bool)
    for s in np.unique(selector):
        _, width = SELECTORS[s]
        if width == 0:
            continue
        mine = np.flatnonzero(selector == s)
        top = np.uint64(2 ** width - 1)
        for k in range(SELECTORS[s][0]):
            some = mine[held[mine] > k]
            value = (words[some] >> np.uint64(k * width)) & top
            out[start[some] + k] = value
            escaped[start[some] + k] = value == top
    out[escaped] = escapes[:int(escaped.sum())]
    return out.astype("<u4")


# -- encoding --------------------------------------------------------------

# Bytes: white space to a blank, ASCII letters to lower case; where a word may be cut.
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[9:14] = 32
_FOLD = _BLANK.copy()
_FOLD[65:91] += 32
_ALNUM = np.array([chr(b).isascii() and chr(b).isalnum() for b in range(256)])
_MARK = np.array([chr(b) in ".,;:!?" for b in range(256)])
# Lead bytes of combining marks, with which a letter's case and its composed form may not commute.
_COMBINING = (0xCC, 0xCD)


class _Memo(dict):
    """Numbers words as they are met; ``new`` are those not yet encoded."""

    def __init__(self):
        super().__init__({b"": 0})
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class WordTokenizer:
    """Ids of texts by the ``tokenizers`` library, each distinct word encoded once.

    A text is cut at ASCII white space and before a mark that follows an ASCII
    letter or digit; no match of the tokenizer's pattern crosses such a place.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._limit = memo_words
        self._forget()
        self._fold = self._plain(["Ab C"]) == self._plain(["ab c"])
        letters = "abcdefghijklmnopqrstuvwxyz"
        self._bare = (re.compile("[a-z]+").fullmatch if self._steps(letters) == letters else lambda word: False)
        probes = ["the quick", "a b", "a\nb", "a \n  b", " a", "b ", "a, b.", "a b!", "a.b c,d", "1.2", "a.'s b's", "A;:b ?"]
        for probe, ids in zip(probes, self.encode(pa.array(probes))):
            if self._plain([probe])[0] != ids.tolist():
                raise ValueError("this tokenizer does not drop white space, so its texts cannot be cut at it")

    def _steps(self, word: str) -> str | None:
        """What the library hands its model for a word, if it is one piece."""
        if self._library.normalizer is not None:
            word = self._library.normalizer.normalize_str(word)
        pieces = self._library.pre_tokenizer.pre_tokenize_str(word) if self._library.pre_tokenizer else [(word, None)]
        return pieces[0][0] if len(pieces) == 1 else None

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        self._memo = _Memo()
        self._flat, self._from = np.empty(0, np.uint32), np.zeros(2, np.int64)

    def _learn(self) -> None:
        """Encode the new words. What the steps before the library's model leave
        as it is goes straight to the model."""
        words = [w.decode("utf-8", "replace") for w in self._memo.new]
        self._memo.new = []
        others = iter(self._plain([w for w in words if not self._bare(w)]))
        model = self._library.model
        lists = [[t.id for t in model.tokenize(w)] if self._bare(w) else next(others) for w in words]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        added = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, sizes.sum())
        self._flat = np.concatenate([self._flat, added])
        self._from = np.concatenate([self._from, self._from[-1] + np.cumsum(sizes)])

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]``."""
        if len(self._memo) > self._limit:
            self._forget()
        fold = self._fold and not any((data == b).any() for b in _COMBINING)
        cuts = 1 + np.flatnonzero(_ALNUM[data[:-1]] & _MARK[data[1:]])
        body = np.insert((_FOLD if fold else _BLANK)[data], cuts, 32).tobytes()
        places = (offsets + np.searchsorted(cuts, offsets)).tolist()
        lists = [body[i:j].split(b" ") for i, j in zip(places, places[1:])]
        words = itertools.chain.from_iterable(lists)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(self._memo.__getitem__, words), np.int64, counts.sum())
        if self._memo.new:
            self._learn()
        start, sizes = self._from[at], self._from[at + 1] - self._from[at]
        upto = np.cumsum(sizes)
        ids = self._flat[np.repeat(start - upto + sizes, sizes) + np.arange(sizes.sum())]
        return np.split(ids, upto[np.cumsum(counts)[:-1] - 1])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each whole text (no nulls) as unsigned 32-bit integers."""
        body, offsets = text_bytes(texts)
        data = np.frombuffer(body, np.uint8)
        for i, j in sized_slices(np.diff(offsets).tolist(), SLICE_BYTES):
            part = data[offsets[i]:offsets[j]]
            if len(part) <= SLICE_BYTES:
                yield from self._slice(part, offsets[i:j + 1] - offsets[i])
            else:  # one long text
                yield np.concatenate([self._slice(p, np.array([0, len(p)]))[0] for p in cut_at_space(part)])


def cut_at_space(data: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of SLICE_BYTES and more, cut before ASCII white space."""
    spaces = np.flatnonzero(_BLANK[data] == 32)
    start = 0
    while start < len(data):
        k = np.searchsorted(spaces, start + SLICE_BYTES)
        end = int(spaces[k]) if k < len(spaces) else len(data)
        yield data[start:end]
        start = end


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


# -- files -----------------------------------------------------------------

def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, key: str = "doc_id",
                 text: str = "text", end_id: int = 2) -> str:
    """Write the ids of all ``docs``, each followed by ``end_id``, in order of
    ``key`` and return the folder (by default one in the shared checkpoint
    folder)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or f"{checkpoint_dir(spark)}/tillroll-tokens-{uuid.uuid4().hex}"
    rows = docs.select(F.col(f"`{key}`").alias("key"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    # the last column only spreads equal rows; it decides nothing
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("spread")]
    dealt = (rows.withColumn("spread", F.monotonically_increasing_id())
             .repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order))
    kind = dict(rows.dtypes)["key"]
    fields = {"slab": pa.int32(), "first": pa.int64(), "n": pa.int64(), "keys": None, **dict.fromkeys(
        ["lengths", "length_first", "length_escapes", "words", "first_word", "escapes", "first_escape"], pa.binary())}
    slab = ", ".join(f"{name} {'array<' + kind + '>' if t is None else _SPARK[t]}" for name, t in fields.items())

    @returns_memory
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer)
        keys, ids, held, number, first = [], [], 0, 0, 0

        def slab_of() -> pa.RecordBatch:
            coded, first_word, escapes, first_escape = pack(np.concatenate(ids))
            lengths, length_first, length_escapes, _ = pack(np.array([len(x) for x in ids]))
            all_keys = pa.concat_arrays(keys)
            row = [number, first, held, None, lengths, length_first, length_escapes, coded, first_word,
                   escapes, first_escape]
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, len(all_keys)], all_keys) if t is None else
                 pa.array([v.tobytes() if t == pa.binary() else v], t)
                 for v, t in zip(row, fields.values())], names=list(fields))

        for batch in batches:
            for k, encoded in enumerate(words.encode(batch.column("text"))):
                ids.append(np.append(encoded, np.uint32(end_id)))
                keys.append(batch.column("key").slice(k, 1))
                held += len(ids[-1])
                if held >= SLAB_IDS:
                    yield slab_of()
                    number, first = number + 1, first + held
                    keys, ids, held = [], [], 0
        if ids:
            yield slab_of()

    (dealt.select("key", "text").mapInArrow(encode, slab)
     .withColumn("segment", F.spark_partition_id())
     .write.option("compression", "uncompressed").parquet(path))
    return path


_SPARK = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def segment_starts(slabs: DataFrame) -> DataFrame:
    """(segment, segment_start): ids in all segments before. One row per
    segment, summed in two levels: no task sees more than a thousandth of them
    or a thousand, whichever is more."""
    sums = (slabs.groupBy("segment").agg(F.sum("n").alias("n"))
            .withColumn("big", F.floor(F.col("segment") / 1000)))
    inner = Window.partitionBy("big").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("big").rowsBetween(Window.unboundedPreceding, -1)
    groups = (sums.groupBy("big").agg(F.sum("n").alias("n"))
              .select("big", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("before")))
    return sums.join(groups, "big").select(
        "segment", (F.col("before") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("segment_start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of token files: key, start (ids of all documents before
    it), n_tokens (with the end id), token_ids (binary, little-endian unsigned
    32-bit integers)."""
    bounded_batches(spark)
    slabs = spark.read.parquet(path)
    starts = segment_starts(slabs.select("segment", "n"))
    if (slabs.agg(F.max("segment")).first()[0] or 0) < BROADCAST_SEGMENTS:
        starts = F.broadcast(starts)
    slabs = slabs.join(starts, "segment")
    kind = slabs.schema["keys"].dataType.elementType.simpleString()

    @returns_memory
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                raw = {c: np.frombuffer(row.column(c)[0].as_py(), "<u8" if c in ("words", "lengths") else "<u4")
                       for c in ("words", "first_word", "escapes", "lengths", "length_first", "length_escapes")}
                ids = unpack(raw["words"], raw["first_word"], raw["escapes"], row.column("n")[0].as_py())
                keys = row.column("keys").flatten()
                sizes = unpack(raw["lengths"], raw["length_first"], raw["length_escapes"], len(keys)).astype(np.int64)
                ends = np.cumsum(sizes)
                before = row.column("segment_start")[0].as_py() + row.column("first")[0].as_py()
                # offsets of 32 bits hold a slab: whole documents, about SLAB_IDS ids
                data = pa.py_buffer(ids.tobytes())
                offsets = pa.py_buffer((np.concatenate([[0], ends]) * 4).astype("<i4").tobytes())
                binary = pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, data])
                yield pa.RecordBatch.from_arrays([keys, pa.array(before + ends - sizes), pa.array(sizes), binary],
                                                 names=["key", "start", "n_tokens", "token_ids"])

    return slabs.mapInArrow(decode, f"key {kind}, start long, n_tokens long, token_ids binary")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs``, read them back and give per document
    doc_id, start, n_tokens and the CRC-32 of its ids."""
    path = write_tokens(docs, tokenizer, end_id=end_id)
    return read_tokens(docs.sparkSession, path).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("token_ids").cast("long").alias("ids_crc32"))
