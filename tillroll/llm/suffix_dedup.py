"""Repeated byte strings by a distributed, prefix-aware merge sort of suffixes.

Every byte that lies in a string of ``length`` bytes that starts at two or more
places of the input goes. Sorting the suffixes of every position would move
``length`` bytes for each byte of input, so only suffixes at anchors are
sorted, and of these only the ones that can matter:

1. The documents are packed into blocks. Each window of ``length`` bytes has an
   anchor, the start of its substring of ``gram`` bytes with the smallest hash.
   Equal windows have their anchors at equal offsets. Consecutive windows
   mostly share one, so there is an anchor for every 40 bytes or so; its
   context is the bytes of all windows that it stands for.
2. Blocks send the hashes of their anchors' substrings and contexts to hash
   buckets. The answer for a substring is: it occurs once (its windows are
   unique), always in the same context (all its windows repeat), or in several.
3. For the third kind the suffixes at the anchors are sorted. Each block sorts
   its own and front-codes them (length of the common prefix with the one
   before, then the rest), cut into ranges at splitters from a bounded sample.
   A range's runs are merged by a loser tree that keeps with each candidate the
   length of the prefix it shares with the last output: candidates compare by
   these numbers, and bytes are looked at from there on only if they are equal.
   The merge gives the order and the common prefixes of neighbours. Windows at
   offset ``o`` are equal when the suffixes share ``length - o`` bytes, which
   makes them neighbours, and the ``o`` bytes to the left are equal.
   A range's answer to a block is which of its windows repeat.
4. Each block marks its repeating windows and cuts their bytes out.

What is sent is two hashes and a count for an anchor and one answer; the texts are read
from the stored blocks. A substring with ``hot`` suffixes or more (contexts, counted in each
block) would make one range too large: the hashes of its windows are
counted in hash buckets instead, like in step 2, which is exact too. Copies
within a block are sent once with their number.

Rows: a null text counts as the empty text. A very long text is a block of its
own, whose windows are worked on in ranges of a megabyte. Texts shorter than ``length`` keep
all bytes. Matches never cross documents. Every row is a document of its own,
so a repeated row's text repeats; ids need not be unique or present. No rows
give no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import sized_slices, store, table, text_bytes, text_or_empty
from tillroll.llm.hashing import Substrings, mix, sliding_min

LENGTH = 200
GRAM = 96
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
BUCKET_ENTRIES = 500_000   # hashes in a bucket
RANGE_ENTRIES = 40_000     # suffixes in a range
HOT = RANGE_ENTRIES        # suffixes of a substring, over all blocks
SAMPLE = 20_000            # suffixes from which splitters are taken, at most
SAMPLE_BLOCKS = 256        # blocks they come from, at most

UNIQUE, CLOSED, OPEN, HOT_OPEN = 0, 1, 2, 3


# -- one block ----------------------------------------------------------------

def find_anchors(buf: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(anchor, first window, last window) by position, windows ascending."""
    n, width = len(buf), length - gram + 1
    empty = np.empty(0, np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(n, dtype=np.int64)
    starts = at[at + length <= ends]
    if not len(starts):
        return empty, empty, empty
    grams = np.arange(n - gram + 1, dtype=np.int64)
    order = Substrings(buf).hash(grams, grams + gram) & np.uint64(0xFFFFFFFF00000000)
    least = sliding_min(order | grams.astype(np.uint64), width)
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)]))
    last = starts[np.append(new[1:], len(starts)) - 1]
    return anchor[new], starts[new], last


def window_spans(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, int]]:
    """(start, end, end of the bytes to read) of ranges of window starts in packed
    documents: whole documents, and longer documents in ranges of ``limit``."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    for i, j in sized_slices(lengths, limit):
        a, b = int(bounds[i]), int(bounds[j])
        for at in range(a, b, limit) if j == i + 1 else [a]:
            yield at, (min(at + limit, b) if j == i + 1 else b), b


def block_anchors(buf: np.ndarray, lengths: np.ndarray, length: int, gram: int,
                  limit: int = SLICE_BYTES) -> np.ndarray:
    """Rows anchor, first and last window of packed documents, the same for any ``limit``."""
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    found = [np.empty((3, 0), np.int64)]
    for a, b, end in window_spans(lengths, limit):
        end = min(end, b + length - 1)   # the last window that starts before b
        inside = bounds[np.searchsorted(bounds, a, "right"):np.searchsorted(bounds, end)]
        edges = np.concatenate([[a], inside, [end]]) - a
        found.append(np.stack(find_anchors(buf[a:end], edges, length, gram)) + a)
    anchor, first, last = np.concatenate(found, axis=1)
    # an anchor whose windows go on behind the end of a range is one anchor
    new = np.ones(len(anchor), bool)
    new[1:] = (np.diff(anchor) != 0) | (first[1:] != last[:-1] + 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(anchor)) - 1 if len(starts) else starts
    return np.stack([anchor[starts], first[starts], last[ends]])


class Block:
    """A block's bytes, its documents and its anchors with their hashes."""

    def __init__(self, row: dict, length: int, gram: int):
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.text = zstandard.decompress(row["text"]) if row["text"] else b""
        packed = np.frombuffer(zstandard.decompress(row["anchors"]), np.int32).reshape(3, -1).astype(np.int64)
        self.first = packed[0]
        self.anchor = packed[0] + packed[1]
        self.last = packed[0] + packed[2]
        self.length, self.gram = length, gram
        buf = np.frombuffer(self.text, np.uint8)
        self.h = np.empty(len(self.first), np.uint64)
        self.c = np.empty(len(self.first), np.uint64)
        # an anchor's windows end less than two lengths behind its first window's start
        self.spans = [(a, b, min(end, b + 2 * length)) for a, b, end in window_spans(lengths)]
        for a, b, end in self.spans:
            x, y = np.searchsorted(self.first, [a, b])
            sub = Substrings(buf[a:end], seed=3)
            at, lo, hi = self.anchor[x:y] - a, self.first[x:y] - a, self.last[x:y] - a + length
            self.h[x:y] = sub.hash(at, at + gram)
            self.c[x:y] = mix(sub.hash(lo, hi) + mix((at - lo).astype(np.uint64)))
        self.grams, self.of = np.unique(self.h, return_inverse=True)

    def entries(self):
        """Per distinct substring: a context, bit 0: occurs twice here, bit 1: in two contexts,
        and its number of contexts here."""
        order = np.lexsort((self.c, self.of))
        of, c = self.of[order], self.c[order]
        starts = np.searchsorted(of, np.arange(len(self.grams)))
        if not len(c):
            return c, np.empty(0, np.uint8), np.empty(0, np.uint32)
        new = np.concatenate([[True], (np.diff(of) != 0) | (c[1:] != c[:-1])])
        contexts = np.add.reduceat(new, starts, dtype=np.uint32)
        count = np.diff(np.append(starts, len(c)))
        return c[starts], (count >= 2).astype(np.uint8) | ((contexts >= 2).astype(np.uint8) << 1), contexts

    def open_contexts(self, state: np.ndarray):
        """The distinct contexts of open substrings in the order of their suffixes:
        (a representative anchor number of each, its number here, which context each anchor has)."""
        mine = np.flatnonzero(state[self.of] == OPEN)
        _, first, context, count = np.unique(
            self.c[mine] ^ mix(self.h[mine]), return_index=True, return_inverse=True, return_counts=True)
        represent = mine[first]
        strings = [self.suffix(k) for k in represent]
        order = sorted(range(len(strings)), key=strings.__getitem__)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return represent[order], count[order], mine, place[context], [strings[k] for k in order]

    def suffix(self, k: int) -> bytes:
        return self.text[self.anchor[k]:self.last[k] + self.length]

    def prefix(self, k: int) -> bytes:
        return self.text[self.first[k]:self.anchor[k]]

    def hot_windows(self, state: np.ndarray):
        """(window, hash, second hash) of the windows of hot substrings."""
        mine = np.flatnonzero(state[self.of] == HOT_OPEN)
        runs = self.last[mine] - self.first[mine] + 1
        windows = np.repeat(self.first[mine] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        one, two = np.empty(len(windows), np.uint64), np.empty(len(windows), np.uint64)
        buf = np.frombuffer(self.text, np.uint8)
        for a, b, end in self.spans:
            x, y = np.searchsorted(windows, [a, b])
            if y > x:
                for out, seed in ((one, 7), (two, 8)):
                    out[x:y] = Substrings(buf[a:end], seed).hash(windows[x:y] - a, windows[x:y] - a + self.length)
        return windows, one, two


def _pack(docs: DataFrame, length: int, gram: int, block_bytes: int, id_type: T.DataType) -> DataFrame:
    """Stored blocks of documents with their anchors."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("lengths", T.BinaryType()), T.StructField("text", T.BinaryType()),
        T.StructField("anchors", T.BinaryType()), T.StructField("n_anchors", T.LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, lengths, total, first = [], [], [], 0, None

        def block() -> pa.RecordBatch:
            data = b"".join(texts)
            buf = np.frombuffer(data, np.uint8)
            size = np.concatenate(lengths)
            anchor, lo, hi = block_anchors(buf, size, length, gram)
            anchors = np.stack([lo, anchor - lo, hi - lo])
            all_ids = pa.chunked_array(ids).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), all_ids),
                 pa.array([size.astype(np.int64).tobytes()], pa.binary()),
                 pa.array([zstandard.compress(data, 3)], pa.binary()),
                 pa.array([zstandard.compress(anchors.astype(np.int32).tobytes(), 3)], pa.binary()),
                 pa.array([anchors.shape[1]], pa.int64())], names=schema.names)

        for b in batches:
            text = b.column("text")
            data, offsets = text_bytes(text)
            number = b.column("at").to_numpy()
            size = np.diff(offsets)
            for i, j in sized_slices(size, block_bytes):
                if total and total + offsets[j] - offsets[i] > block_bytes:
                    yield block()
                    ids, texts, lengths, total, first = [], [], [], 0, None
                first = int(number[i]) if first is None else first
                ids.append(b.column("id").slice(i, j - i))
                texts.append(bytes(data[offsets[i]:offsets[j]]))
                lengths.append(size[i:j])
                total += int(offsets[j] - offsets[i])
        if lengths:
            yield block()

    return store(docs.withColumn("at", F.monotonically_increasing_id()).mapInArrow(pack, schema),
                 "suffix-blocks", "snappy")


# -- hashes to buckets and answers back ----------------------------------------

def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a hash; ascends with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _entries_by_bucket(block: int, h: np.ndarray, c: np.ndarray, flags: np.ndarray, number: np.ndarray,
                       buckets: int):
    """Rows (bucket, block, payload) of sorted hashes."""
    cuts = np.searchsorted(_bucket(h, buckets), np.arange(buckets + 1))
    for r in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[r], cuts[r + 1]
        yield int(r), block, b"".join(x[a:b].tobytes() for x in (h, c, flags, number))


def _pairs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of two hashes, ascending: the place of one of each,
    how often it occurs, and the number of the pair at every place."""
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    starts = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[starts], np.diff(np.append(starts, len(order))), which


def _unpack_entries(payload: bytes):
    n = len(payload) // 21
    return (np.frombuffer(payload, np.uint64, n), np.frombuffer(payload, np.uint64, n, 8 * n),
            np.frombuffer(payload, np.uint8, n, 16 * n), np.frombuffer(payload, np.uint32, n, 17 * n))


def _resolve(kind: int, hot: int):
    """A bucket's answers: the state of every hash, to each block in its order."""
    def resolve(rows: pa.Table) -> pa.Table:
        part = rows["bucket"][0].as_py()
        blocks = rows["block"].to_pylist()
        got = [_unpack_entries(p.as_py()) for p in rows["payload"]]
        h, c, flags, number = (np.concatenate([g[k] for g in got]) for k in range(4))
        # windows (kind 3) are the same if both hashes are
        order = np.lexsort((c, h)) if kind == 3 else np.argsort(h, kind="stable")
        new = np.diff(h[order]) != 0
        if kind == 3:
            new |= np.diff(c[order]) != 0
        starts = np.flatnonzero(np.concatenate([[True], new]))
        n = np.diff(np.append(starts, len(h)))
        several = (np.minimum.reduceat(c[order], starts) != np.maximum.reduceat(c[order], starts)) \
            | (np.bitwise_or.reduceat(flags[order], starts) >= 2)
        twice = (n > 1) | ((np.bitwise_or.reduceat(flags[order], starts) & 1) > 0)
        suffixes = np.add.reduceat(number[order].astype(np.int64), starts)
        state = np.where(several, np.where(suffixes >= hot, HOT_OPEN, OPEN), np.where(twice, CLOSED, UNIQUE))
        each = np.empty(len(h), np.uint8)
        each[order] = np.repeat(state, n)
        out, at = [], 0
        for g in got:
            out.append(each[at:at + len(g[0])])
            at += len(g[0])
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "kind": pa.array([kind] * len(out), pa.int32()),
            "part": pa.array([part] * len(out), pa.int32()),
            "payload": pa.array([o.tobytes() for o in out], pa.binary()),
            "open": pa.array([int(g[3][o == OPEN].sum()) for g, o in zip(got, out)], pa.int64()),
            "hot": pa.array([int(g[3][o == HOT_OPEN].sum()) for g, o in zip(got, out)], pa.int64())})

    return resolve


ENTRIES = "bucket int, block long, payload binary"
ANSWERS = "block long, kind int, part int, payload binary, open long, hot long"


def _entry_batch(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_pydict({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                                       "block": pa.array([r[1] for r in rows], pa.int64()),
                                       "payload": pa.array([r[2] for r in rows], pa.binary())})


def _joined(answers: pa.Table, kind: int) -> list[bytes]:
    """Payloads of one kind, by part."""
    rows = [r for r in answers.to_pylist() if r["kind"] == kind]
    return [r["payload"] for r in sorted(rows, key=lambda r: r["part"])]


def _states(answers: pa.Table, kind: int) -> np.ndarray:
    return np.frombuffer(b"".join(_joined(answers, kind)), np.uint8)


# -- sorted runs ----------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    n = min(len(a), len(b))
    step = 16
    while start < n:
        if a[start:start + step] != b[start:start + step]:
            while start < n and a[start] == b[start]:
                start += 1
            return start
        start += step
    return n


def front_code(strings: list[bytes], lefts: list[bytes], counts: np.ndarray) -> bytes:
    """A sorted run: shared prefix lengths, rests, and what lies to the left."""
    shared = np.zeros(len(strings), np.uint16)
    rests, before = [], b""
    for i, s in enumerate(strings):
        k = common_prefix(before, s) if i else 0
        shared[i] = k
        rests.append(s[k:])
        before = s
    rest_sizes = np.array([len(r) for r in rests], np.uint16)
    left_sizes = np.array([len(x) for x in lefts], np.uint16)
    head = np.array([len(strings)], np.int64).tobytes()
    body = (head + shared.tobytes() + rest_sizes.tobytes() + left_sizes.tobytes()
            + np.asarray(counts, np.int64).tobytes() + b"".join(rests) + b"".join(lefts))
    return zstandard.compress(body, 3)


def front_decode(payload: bytes):
    """(strings, shared prefix lengths, lefts, counts) of a run."""
    body = zstandard.decompress(payload)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    shared = np.frombuffer(body, np.uint16, n, 8)
    rest = np.cumsum(np.concatenate([[0], np.frombuffer(body, np.uint16, n, 8 + 2 * n)]), dtype=np.int64)
    left = np.cumsum(np.concatenate([[0], np.frombuffer(body, np.uint16, n, 8 + 4 * n)]), dtype=np.int64)
    counts = np.frombuffer(body, np.int64, n, 8 + 6 * n)
    at = 8 + 14 * n
    strings, before = [], b""
    for i, k in enumerate(shared.tolist()):
        before = before[:k] + body[at + rest[i]:at + rest[i + 1]]
        strings.append(before)
    at += int(rest[-1])
    lefts = [body[at + left[i]:at + left[i + 1]] for i in range(n)]
    return strings, shared.tolist(), lefts, counts


def merge_runs(runs: list[tuple[list[bytes], list[int]]]):
    """Merge sorted runs, each with the shared prefix lengths of its neighbours.

    Returns (run numbers, common prefix of each output with the one before). A
    loser in the tree keeps the length of the prefix it shares with the winner
    that passed it, which is the last output whenever it is met again.
    """
    runs = list(runs)
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    end = [len(r[0]) for r in runs] + [0] * (k - len(runs))
    at = [0] * k
    loser = [-1] * k          # run at an inner node
    prefix = [0] * k          # of that run with the winner that passed
    total = sum(end)

    def build(node: int) -> tuple[int, int]:
        """Winner below a node, and the prefix it shares with nothing yet (0)."""
        if node >= k:
            return node - k, 0
        a, _ = build(2 * node)
        b, _ = build(2 * node + 1)
        if at[b] >= end[b]:
            loser[node], prefix[node] = b, 0
            return a, 0
        if at[a] >= end[a]:
            loser[node], prefix[node] = a, 0
            return b, 0
        x, y = runs[a][0][0], runs[b][0][0]
        h = common_prefix(x, y)
        if x <= y:
            loser[node], prefix[node] = b, h
            return a, 0
        loser[node], prefix[node] = a, h
        return b, 0

    out_run = np.empty(total, np.int32)
    out_prefix = np.empty(total, np.int32)
    if not total:
        return out_run, out_prefix
    winner, shared = build(1) if k > 1 else (0, 0)
    for i in range(total):
        out_run[i] = winner
        out_prefix[i] = shared
        at[winner] += 1
        w = winner
        done = at[w] >= end[w]
        h = -1 if done else runs[w][1][at[w]]
        s = None if done else runs[w][0][at[w]]
        node = (w + k) // 2
        while node:
            other = loser[node]
            if at[other] < end[other]:
                p = prefix[node]
                if p > h:
                    loser[node], prefix[node] = w, max(h, 0)
                    w, h, s = other, p, runs[other][0][at[other]]
                elif p == h:
                    t = runs[other][0][at[other]]
                    m = common_prefix(s, t, h)
                    if s[m:m + 1] <= t[m:m + 1]:
                        prefix[node] = m
                    else:
                        loser[node], prefix[node] = w, m
                        w, h, s = other, p, t
            node //= 2
        winner, shared = w, max(h, 0)
    return out_run, out_prefix


def repeated_windows(shared: np.ndarray, sizes: np.ndarray, lefts: list[bytes], counts: np.ndarray,
                     length: int) -> np.ndarray:
    """For suffixes in order: bits of the offsets whose windows occur twice.

    ``shared``: common prefix with the suffix before; ``sizes``: lengths of the
    suffixes. A suffix of size s has windows at the offsets ``length - s`` to
    the length of its left string.
    """
    n = len(sizes)
    left_size = np.array([len(x) for x in lefts], np.int64)
    low = length - sizes
    top = int(left_size.max(initial=0))
    bits = np.zeros((n, (top + 8) // 8), np.uint8)
    ends = np.cumsum(left_size)
    sub = Substrings(b"".join(lefts), seed=9)
    near = np.maximum(shared, np.append(shared[1:], 0))
    for o in range(top + 1):
        able = np.flatnonzero((low <= o) & (left_size >= o) & ((near >= length - o) | (counts > 1)))
        if not len(able):
            continue
        group = np.cumsum(shared < length - o)[able]
        key = mix(sub.hash(ends[able] - o, ends[able]) ^ mix(group.astype(np.uint64)))
        _, which = np.unique(key, return_inverse=True)
        twice = able[np.bincount(which, counts[able])[which] > 1.5]
        bits[twice, o // 8] |= np.uint8(1 << (o % 8))
    return bits


def _merge_range(length: int):
    def merge(rows: pa.Table) -> pa.Table:
        part = rows["bucket"][0].as_py()
        blocks = rows["block"].to_pylist()
        runs = [front_decode(p.as_py()) for p in rows["payload"]]
        order, shared = merge_runs([(r[0], r[1]) for r in runs])
        # the outputs of a run come in its order
        number = np.empty(len(order), np.int64)
        for r in range(len(runs)):
            mine = np.flatnonzero(order == r)
            number[mine] = np.arange(len(mine))
        lefts = [runs[r][2][i] for r, i in zip(order.tolist(), number.tolist())]
        sizes = np.array([len(runs[r][0][i]) for r, i in zip(order.tolist(), number.tolist())], np.int64)
        counts = np.array([runs[r][3][i] for r, i in zip(order.tolist(), number.tolist())], np.int64)
        bits = repeated_windows(shared.astype(np.int64), sizes, lefts, counts, length)
        payloads = []
        for r in range(len(runs)):
            mine = bits[order == r]
            payloads.append(zstandard.compress(
                np.array(mine.shape, np.int64).tobytes() + mine.tobytes(), 3))
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "kind": pa.array([2] * len(blocks), pa.int32()),
            "part": pa.array([part] * len(blocks), pa.int32()), "payload": pa.array(payloads, pa.binary()),
            "open": pa.array([0] * len(blocks), pa.int64()), "hot": pa.array([0] * len(blocks), pa.int64())})

    return merge


def _ranges(strings: list[bytes], splitters: list[bytes], gram: int) -> np.ndarray:
    """Where sorted strings pass the splitters, by their first ``gram`` bytes only,
    so that suffixes with equal substrings stay together."""
    return np.array([0, *[bisect.bisect_left(strings, s, key=lambda x: x[:gram]) for s in splitters],
                     len(strings)])


# -- the whole -------------------------------------------------------------------

def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int | None = None, block_bytes: int = BLOCK_BYTES,
                   bucket_entries: int = BUCKET_ENTRIES, range_entries: int = RANGE_ENTRIES,
                   hot: int = HOT) -> DataFrame:
    """Per row of ``df``: ``doc_id``, n_bytes, spans (array of (start, size):
    the maximal removed runs) and kept (binary: the remaining bytes)."""
    gram = gram if gram is not None else max(1, length * 12 // 25)
    if not 1 <= gram <= length <= 60_000:
        raise ValueError("need 1 <= gram <= length <= 60000")
    id_type = df.schema[doc_id].dataType
    docs = df.select(F.col(f"`{doc_id}`").alias("id"), text_or_empty(text).alias("text"))
    blocks = _pack(docs, length, gram, block_bytes, id_type)
    n_blocks, n_anchors = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_anchors"), F.lit(0))).first()
    buckets = max(1, -(-int(n_anchors) // bucket_entries))

    def send_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            b = Block(row, length, gram)
            yield _entry_batch(_entries_by_bucket(row["block"], b.grams, *b.entries(), buckets))

    read = blocks.select("block", "lengths", "text", "anchors")
    answers = store(read.mapInArrow(send_hashes, ENTRIES).groupBy("bucket")
                    .applyInArrow(_resolve(1, hot), ANSWERS), "suffix-answers")
    n_open, n_hot = answers.agg(F.coalesce(F.sum("open"), F.lit(0)), F.coalesce(F.sum("hot"), F.lit(0))).first()
    every = answers.select("block", "kind", "part", "payload")

    if n_open:
        splitters = _splitters(read, every, int(n_blocks), max(1, -(-int(n_open) // range_entries)), length, gram)

        def send_runs(left: pa.Table, right: pa.Table) -> pa.Table:
            rows = []
            for row in left.to_pylist():
                b = Block(row, length, gram)
                represent, count, _, _, strings = b.open_contexts(_states(right, 1))
                cuts = _ranges(strings, splitters, gram)
                for r in np.flatnonzero(np.diff(cuts)):
                    i, j = cuts[r], cuts[r + 1]
                    rows.append((int(r), row["block"], front_code(
                        strings[i:j], [b.prefix(k) for k in represent[i:j]], count[i:j])))
            return pa.Table.from_batches([_entry_batch(rows)])

        runs = (read.groupBy("block").cogroup(every.groupBy("block")).applyInArrow(send_runs, ENTRIES))
        found = store(runs.groupBy("bucket").applyInArrow(_merge_range(length), ANSWERS), "suffix-merged")
        every = every.union(found.select("block", "kind", "part", "payload"))

    if n_hot:
        def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
            rows = []
            for row in left.to_pylist():
                b = Block(row, length, gram)
                _, one, two = b.hot_windows(_states(right, 1))
                first, count, _ = _pairs(one, two)
                rows += _entries_by_bucket(row["block"], one[first], two[first], (count > 1).astype(np.uint8),
                                           np.ones(len(first), np.uint32), hot_buckets)
            return pa.Table.from_batches([_entry_batch(rows)])

        hot_buckets = max(1, -(-int(n_hot) * (length - gram + 1) // bucket_entries))
        windows = (read.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send_windows, ENTRIES))
        counted = store(windows.groupBy("bucket").applyInArrow(_resolve(3, 1 << 62), ANSWERS), "suffix-hot")
        every = every.union(counted.select("block", "kind", "part", "payload"))

    schema = T.StructType([
        T.StructField(doc_id, id_type), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("size", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, n_bytes, spans, kept = [], [], [], []
        for row in left.to_pylist():
            b = Block(row, length, gram)
            covered = _covered(b, right)
            for k in range(len(b.bounds) - 1):
                x, y = int(b.bounds[k]), int(b.bounds[k + 1])
                gone = np.flatnonzero(np.diff(np.concatenate([[0], covered[x:y].astype(np.int8), [0]])))
                starts, ends = gone[::2], gone[1::2]
                n_bytes.append(y - x)
                spans.append([{"start": int(s), "size": int(e - s)} for s, e in zip(starts, ends)])
                edges = [x, *(x + gone).tolist(), y]
                kept.append(b"".join(b.text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)))
        ids = pa.concat_arrays([v.values for v in left["ids"]]) if len(left) else pa.array([])
        return pa.table([ids, pa.array(n_bytes, pa.int64()), pa.array(spans, pa.list_(pa.struct(
            [("start", pa.int64()), ("size", pa.int64())]))), pa.array(kept, pa.binary())], names=schema.names)

    return (blocks.select("block", "ids", "lengths", "text", "anchors").groupBy("block")
            .cogroup(every.groupBy("block")).applyInArrow(cut, schema))


def _splitters(blocks: DataFrame, answers: DataFrame, n_blocks: int, ranges: int, length: int,
               gram: int) -> list[bytes]:
    """Substrings that cut the suffixes of open substrings into ``ranges`` parts, from a bounded sample.

    Each block drawn gives an equal share of its suffixes, so a substring counts as often as
    it has contexts and a block as much as it has suffixes.
    """
    if ranges == 1:
        return []
    share = max(1, -(-n_blocks // SAMPLE_BLOCKS))
    some = F.pmod(F.xxhash64("block"), F.lit(share)) == 0
    most = max(1, SAMPLE // min(n_blocks, SAMPLE_BLOCKS))

    def draw(left: pa.Table, right: pa.Table) -> pa.Table:
        out, weight = [], []
        for row in left.to_pylist():
            b = Block(row, length, gram)
            strings = b.open_contexts(_states(right, 1))[4]
            step = max(1, -(-len(strings) // most))
            out += [x[:gram] for x in strings[step // 2::step]]
            weight += [step] * len(strings[step // 2::step])
        return pa.table({"s": pa.array(out, pa.binary()), "weight": pa.array(weight, pa.int64())})

    drawn = (blocks.where(some).groupBy("block").cogroup(answers.where(some).groupBy("block"))
             .applyInArrow(draw, "s binary, weight long").groupBy("s").agg(F.sum("weight").alias("weight")).collect())
    if not drawn:
        return []
    drawn = sorted((bytes(r.s), r.weight) for r in drawn)
    upto = np.cumsum([w for _, w in drawn])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges, side="right")
    return sorted({drawn[min(i, len(drawn) - 1)][0] for i in at.tolist()})


def _covered(b: Block, answers: pa.Table) -> np.ndarray:
    """Which bytes of a block repeating windows cover."""
    edges = np.zeros(len(b.text) + 1, np.int32)
    state = _states(answers, 1)

    def mark(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(edges, first, 1)
        np.add.at(edges, last + b.length, -1)

    if len(state):
        closed = state[b.of] == CLOSED
        mark(b.first[closed], b.last[closed])
        if (state == OPEN).any():
            represent, _, mine, place, _ = b.open_contexts(state)
            width = b.length - b.gram + 1
            repeats = np.zeros((len(represent), width), bool)
            at = 0
            for payload in _joined(answers, 2):
                body = zstandard.decompress(payload)
                n, m = np.frombuffer(body, np.int64, 2)
                bits = np.unpackbits(np.frombuffer(body, np.uint8, n * m, 16).reshape(n, m),
                                     axis=1, bitorder="little")[:, :width]
                repeats[at:at + n, :bits.shape[1]] = bits
                at += n
            who, offset = np.nonzero(repeats[place])
            windows = b.anchor[mine[who]] - offset
            mark(windows, windows)
        if (state == HOT_OPEN).any():
            windows, one, two = b.hot_windows(state)
            which = _pairs(one, two)[2]
            again = windows[_states(answers, 3)[which] != UNIQUE]
            mark(again, again)
    return np.cumsum(edges[:-1], out=edges[:-1]) > 0


def without_repeats(spark, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start twice."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["size"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
    WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    windows AS (
      SELECT doc_id, place, md5(substr(x, 2 * place + 1, 400)) AS w
      FROM (SELECT doc_id, x, unnest(range(CAST(len(x) / 2 AS BIGINT) - 199)) AS place FROM docs WHERE len(x) >= 400)
    ),
    again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
    hits AS (SELECT doc_id, place FROM windows SEMI JOIN again USING (w)),
    runs AS (
      SELECT doc_id, min(place) AS a, max(place) + 200 AS b FROM (
        SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM (
          SELECT doc_id, place, CASE WHEN place - lag(place) OVER (PARTITION BY doc_id ORDER BY place) <= 200
                                     THEN 0 ELSE 1 END AS fresh FROM hits))
      GROUP BY doc_id, run
    ),
    gaps AS (
      SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM runs
      UNION ALL
      SELECT d.doc_id, coalesce(max(b), 0), CAST(any_value(len(x)) / 2 AS BIGINT)
      FROM docs d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id
    ),
    kept AS (
      SELECT d.doc_id, coalesce(string_agg(substr(x, 2 * s + 1, 2 * (e - s)), '' ORDER BY s), '') AS k
      FROM docs d JOIN gaps g ON g.doc_id = d.doc_id GROUP BY d.doc_id
    )
    SELECT d.doc_id, CAST(len(x) / 2 AS BIGINT) AS n_bytes,
           CAST((len(x) - len(k)) / 2 AS BIGINT) AS n_removed,
           CAST((SELECT count(*) FROM runs r WHERE r.doc_id = d.doc_id) AS BIGINT) AS n_spans,
           sha256(unhex(k)) AS kept_sha256
    FROM docs d JOIN kept USING (doc_id)"""
