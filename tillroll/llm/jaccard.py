"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of ``SHINGLE`` consecutive words. Two sets
link when their Jaccard similarity is at least ``threshold``. A run of the join
splits the sets recursively: in a node, a set goes on into the branch of each
of its tokens whose hash, drawn anew for every node, is below ``1 / (threshold
* size)``. So a set follows 1 / threshold branches on average, and two sets
that link share one branch or more on average, however common their tokens
are. A node with at most ``limit`` sets is compared by brute force; a larger
one is split once more. What is still large then (many sets that resemble each
other) is compared in blocks, pair of blocks by pair of blocks, so no task ever
holds more than two blocks. Blocks are bounded by their sets and their tokens
(on average: sets are dealt by hash). Runs are repeated until a pair at the threshold is
met with probability ``recall``.

The brute force goes from cheap to exact: sets whose sizes differ too much
cannot link; a sketch of 128 bytes (the smallest token of each of 128 ranges)
drops pairs that are five standard deviations below the threshold; what is left
is compared token by token. Only sets with such a partner have their tokens
moved, and nodes that are left with the same sets are compared once.

Equal sets are one set with a number of documents from the start. No list of
pairs is made: a node's task reports how many links each set has in it, and
the edges of a spanning forest. A pair that meets in several nodes is counted
in the one with the smallest number only, which the task can tell because
every set carries the numbers of its nodes. Classes are the connected
components of all links.

Words are runs of characters other than blank, tab, line feed, form feed and
carriage return, in lower case. A text of fewer words than a shingle has one
shingle of all its words.

Rows: null texts and texts without words link with nothing; each is a class of
its own. Repeated rows and copies are members of one class. A row with a null
id is a member like others; a class is named after its smallest id (null if
all are null) and represented by the first row with that id. A very long text is
read in pieces of a megabyte; its set takes eight bytes a distinct shingle. No
rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import internal, lookup_split, returns_memory, sized_slices, store, table, text_bytes, \
    with_row_id
from tillroll.llm.components import components
from tillroll.llm.hashing import Substrings, mix, whole_hash

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
LIMIT = 256      # sets that a node may have to be compared whole
DEPTH = 2        # levels of splitting
BLOCK = 2048     # sets in a block of a node that stays large
TOKENS = 2 << 20 # tokens in a block, and of a node that is compared whole (one set at least)
BINS = 128       # bytes in a sketch
SURE = 5.0       # standard deviations that a sketch may fall short
SLICE_BYTES = 1 << 20
SLICE_TOKENS = 1 << 17   # tokens of a set drawn for at a time
SLAB = 256       # rows of a block's matrix worked on at a time

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 12, 13, 32]] = True
_STEPS = np.random.default_rng(11).integers(0, 2 ** 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EDGES = (np.arange(BINS, dtype=np.uint64) << np.uint64(57))


def runs_needed(threshold: float, depth: int, recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    The number of branches two sets share is about Poisson with mean
    ``intersection / (threshold * larger size)`` at every level. At the threshold
    that is 1 at least, for a set contained in the other (2 / (1 + threshold) for
    sets of equal size); a pair meets at ``depth`` if that branching process lives
    so long.
    """
    lives = 1.0
    for _ in range(depth):
        lives = 1 - math.exp(-lives)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - lives)))


def _words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of bytes that end in white space."""
    space = _SPACE[buf]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    return starts, Substrings(buf, seed=5).hash(starts, np.flatnonzero(space & ~before))


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += words[j:j + n] * _STEPS[j]
    return mix(out)


def _few_words(words: np.ndarray) -> np.ndarray:
    """The one token of a text with fewer words than a shingle (none without words)."""
    if not len(words):
        return np.empty(0, np.uint64)
    whole = (words * _STEPS[:len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
    return mix(np.array([whole], np.uint64))


def shingle_sets(texts: list[str], size: int = SHINGLE, limit: int = SLICE_BYTES) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles. A text of more than
    ``limit`` bytes is read in pieces."""
    parts = [t.lower().encode("utf-8", "replace") + b" " for t in texts]
    if any(len(p) > limit for p in parts):
        if len(parts) == 1:
            return [_long_set(np.frombuffer(parts[0], np.uint8), size, limit)]
        del parts
        return [s for t in texts for s in shingle_sets([t], size, limit)]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    starts, words = _words(buf)
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(p) for p in parts])]))
    shingles = _shingles(words, size)
    return [np.unique(shingles[a:b - size + 1]) if b - a >= size else _few_words(words[a:b])
            for a, b in zip(bounds[:-1], bounds[1:])]


def _long_set(buf: np.ndarray, size: int, limit: int) -> np.ndarray:
    """The set of one long text, by pieces of whole words; the last words of a
    piece go on into the next."""
    found, held = [], 0
    words = np.empty(0, np.uint64)
    for piece in _pieces(buf, limit):
        new = _words(piece)[1] if len(piece) <= limit else np.array([whole_hash(piece[:-1], 5)])
        words = np.concatenate([words, new])
        if len(words) >= size:
            found.append(np.unique(_shingles(words, size)))
            held += len(found[-1])
            if held > 2 * len(found[0]) + limit:   # the merged ones come first
                found = [_merged(found)]
                held = len(found[0])
            words = words[-(size - 1):] if size > 1 else words[:0]
    return _merged(found) if found else _few_words(words)


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """The sorted distinct values of ``parts``, which are let go."""
    x = np.concatenate(parts)
    parts.clear()
    x.sort()
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def _pieces(buf: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """``buf``, which ends in white space, cut behind white space into pieces of
    at most ``limit`` bytes; a longer piece is one longer word and its white space."""
    a = 0
    while len(buf) - a > limit:
        space = np.flatnonzero(_SPACE[buf[a:a + limit]])
        b = a + int(space[-1]) + 1 if len(space) else a
        at = a + limit
        while b == a:
            space = np.flatnonzero(_SPACE[buf[at:at + limit]])
            b = at + int(space[0]) + 1 if len(space) else a
            at += limit
        yield buf[a:b]
        a = b
    yield buf[a:]


def set_id(tokens: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    at = mix(tokens)
    other = mix(at ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return (np.array([at.sum(dtype=np.uint64), other.sum(dtype=np.uint64) ^ np.uint64(len(tokens))])
            .astype("<u8").tobytes())


def branches(nodes: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``nodes``, child node) of the branches a set takes from nodes."""
    share = 1 / (threshold * len(tokens))
    limit = np.uint64(2 ** 64 - 1 if share >= 1 else int(share * 2 ** 64))
    factors = (mix(nodes) | np.uint64(1))[:, None]
    where, which = [], []
    for a in range(0, len(tokens), SLICE_TOKENS):
        i, j = np.nonzero(tokens[None, a:a + SLICE_TOKENS] * factors <= limit)
        where.append(i)
        which.append(j + a)
    where, which = np.concatenate(where), np.concatenate(which)
    order = np.argsort(where, kind="stable")
    where, which = where[order], which[order]
    return where, mix(mix(tokens[which] ^ np.uint64(0x5851F42D4C957F2D)) + nodes[where])


def sketch(tokens: np.ndarray) -> bytes:
    """A byte of the smallest token in each of BINS ranges (0: no token there)."""
    at = np.searchsorted(tokens, _EDGES)
    upto = np.append(at[1:], len(tokens))
    low = tokens[np.minimum(at, len(tokens) - 1)]
    byte = (mix(low) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return np.where(at < upto, byte, 0).astype(np.uint8).tobytes()


def alike(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two arrays of sketches may belong to sets that link."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return same >= threshold * used - SURE * np.sqrt(used * threshold * (1 - threshold))


_BRANCHES = "array<struct<node:long,children:array<long>>>"


def _describe(docs: DataFrame, text: str, runs: int, threshold: float) -> DataFrame:
    """(row, id, sid, size, sketch, branches): each document's set, and its
    nodes of the first level in all runs with their children."""
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64))
    kind = pa.list_(pa.struct([("node", pa.int64()), ("children", pa.list_(pa.int64()))]))

    @F.arrow_udf(f"struct<sid:binary,size:int,sketch:binary,branches:{_BRANCHES}>")
    @returns_memory
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.to_pylist()
            sids, sizes, sketches, counts, nodes, fans, children = [], [], [], [], [], [], []
            for i, j in sized_slices([len(v or "") for v in values], SLICE_BYTES):
                for tokens in shingle_sets([v or "" for v in values[i:j]]):
                    if not len(tokens):
                        sids.append(None), sizes.append(0), sketches.append(None), counts.append(0)
                        continue
                    first = branches(roots, tokens, threshold)[1]
                    where, child = branches(first, tokens, threshold)
                    sids.append(set_id(tokens))
                    sizes.append(len(tokens))
                    sketches.append(sketch(tokens))
                    counts.append(len(first))
                    nodes.append(first)
                    fans.append(np.bincount(where, minlength=len(first)))
                    children.append(child)
            flat = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.uint64)
            inner = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(flat(fans))]).astype(np.int32)),
                pa.array(flat(children).astype(np.int64)))
            pairs = pa.StructArray.from_arrays([pa.array(flat(nodes).astype(np.int64)), inner], ["node", "children"])
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pairs).cast(kind)
            yield pa.StructArray.from_arrays(
                [pa.array(sids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), lists],
                ["sid", "size", "sketch", "branches"])

    return docs.select("row", "id", describe(F.col(text)).alias("d")).select("row", "id", "d.*")


def _tokens_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, tokens) of the wanted sets, from the document that stands for each."""
    @F.arrow_udf("binary")
    @returns_memory
    def tokens_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values, out = batch.to_pylist(), []
            for i, j in sized_slices([len(v) for v in values], SLICE_BYTES):
                out += [s.tobytes() for s in shingle_sets(values[i:j])]
            yield pa.array(out, pa.binary())

    return (docs.join(wanted, docs["row"] == wanted["set"]).select("set", tokens_of("text").alias("tokens")))


_GROUP = ["node", "i", "j"]


def _groups(batches: Iterator[pa.RecordBatch], rows: int, size: int = 8 * TOKENS) -> Iterator[pa.Table]:
    """Tables of whole (node, i, j) groups, about ``rows`` rows or ``size`` bytes each, from sorted batches."""
    held: list[pa.RecordBatch] = []
    n = 0
    batches = (b.slice(i, j - i) for b in batches for i, j in _cuts(b, size))
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows or sum(x.nbytes for x in held) >= size:
            t = pa.Table.from_batches(held).combine_chunks()
            key = np.stack([t[c].to_numpy() for c in _GROUP])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if len(cut):
                at = int(cut[-1]) + 1
                yield t.slice(0, at)
                rest = t.slice(at)
                held, n = rest.to_batches(), rest.num_rows
            # else one group goes on: it has two blocks at most
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _cuts(b: pa.RecordBatch, size: int) -> Iterator[tuple[int, int]]:
    """Slices of a batch of about ``size`` bytes of tokens."""
    if "tokens" not in b.schema.names:
        return iter([(0, b.num_rows)])
    return sized_slices(np.diff(text_bytes(b.column("tokens"))[1]), size)


def _bounds(t: pa.Table) -> np.ndarray:
    key = np.stack([t[c].to_numpy() for c in _GROUP])
    return np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [len(t)]])


def _by_group(df: DataFrame) -> DataFrame:
    return df.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


def _sift(threshold: float, pairs_at_once: int = 1 << 16):
    """Rows that have a partner of fitting size and sketch in their group."""
    @returns_memory
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 4096):
            size, part = t["size"].to_numpy(), t["part"].to_numpy()
            across = t["i"].to_numpy() != t["j"].to_numpy()
            marks = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
            keep = np.zeros(len(t), bool)
            bounds = _bounds(t)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                # in order of size a row's partners are the next ones
                order = lo + np.argsort(size[lo:hi], kind="stable")
                s = size[order]
                upto = np.searchsorted(s, s / threshold + 1e-9, side="right")
                counts = upto - np.arange(len(s)) - 1
                for x, y in sized_slices(counts, pairs_at_once):
                    c = counts[x:y]
                    first = np.repeat(np.arange(x, y), c)
                    second = first + 1 + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                    a, b = order[first], order[second]
                    if across[lo]:
                        other = part[a] != part[b]
                        a, b = a[other], b[other]
                    for z in range(0, len(a), pairs_at_once):
                        p, q = a[z:z + pairs_at_once], b[z:z + pairs_at_once]
                        near = alike(marks[p], marks[q], threshold)
                        keep[p[near]] = True
                        keep[q[near]] = True
            yield from t.filter(pa.array(keep)).select(["node", "i", "j", "part", "n", "weight", "set"]).to_batches()

    return sift


def intersections(sets: list[np.ndarray], chunk: int = 1 << 11, at_once: int = TOKENS) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets, summed over ranges of
    tokens (hashes) that hold about ``at_once`` tokens."""
    parts = max(1, -(-sum(map(len, sets)) // at_once))
    if parts == 1:
        return _intersections(sets, chunk)
    # the sample's quantiles; equal tokens stay in one range
    sample = np.sort(np.concatenate([s[::parts] for s in sets]))
    edges = np.unique(sample[len(sample) * np.arange(1, parts) // parts])
    cuts = [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]) for s in sets]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for k in range(len(edges) + 1):
        total += _intersections([s[c[k]:c[k + 1]] for s, c in zip(sets, cuts)], chunk)
    return total


def _intersections(sets: list[np.ndarray], chunk: int) -> np.ndarray:
    """Sizes of all pairwise intersections, through dense columns of shared tokens."""
    n = len(sets)
    who = np.repeat(np.arange(n), [len(s) for s in sets])
    tokens, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count >= 2
    number = np.cumsum(shared) - 1
    keep = shared[column]
    who, column = who[keep], number[column[keep]]
    by = np.argsort(column, kind="stable")
    who, column = who[by], column[by]
    total = np.zeros((n, n), np.float32)  # exact below 2^24 shared tokens
    last = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, last, chunk):
        a, b = np.searchsorted(column, [start, start + chunk])
        block = np.zeros((n, min(chunk, last - start)), np.float32)
        block[who[a:b], column[a:b] - start] = 1
        total += block @ block.T
    return total


def _compare(threshold: float):
    """Exact links of every group: per set its number of new links and a root."""
    @returns_memory
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 512):
            bounds = _bounds(t)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                yield _links(t.slice(lo, hi - lo), threshold)

    return compare


def _links(t: pa.Table, threshold: float) -> pa.RecordBatch:
    node, across = t["node"][0].as_py(), t["i"][0].as_py() != t["j"][0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in t["tokens"].to_pylist()]
    size = np.array([len(x) for x in sets], np.float64)
    shared = intersections(sets)
    linked = np.empty(shared.shape, bool)
    for k in range(0, len(size), SLAB):  # a slab of rows at a time: no other n x n numbers
        s = slice(k, k + SLAB)
        linked[s] = shared[s] >= threshold * (size[s, None] + size[None, :] - shared[s]) - 1e-9
    del shared
    np.fill_diagonal(linked, False)
    if across:
        part = t["part"].to_numpy()
        linked &= part[:, None] != part[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    linked = linked[np.ix_(some, some)]
    docs, ids = t["n_docs"].to_numpy()[some], t["set"].to_numpy()[some]
    nodes = t["nodes"].to_pylist()
    earlier = [[x for x in nodes[k] if x < node] for k in some]
    known = np.unique(np.concatenate([np.array(e, np.int64) for e in earlier])) if len(some) else []
    new = linked
    if len(known):
        met = np.zeros((len(some), len(known)), np.float32)
        for k, e in enumerate(earlier):
            met[k, np.searchsorted(known, e)] = 1
        new = linked.copy()
        for k in range(0, len(met), SLAB):
            new[k:k + SLAB] &= (met[k:k + SLAB] @ met.T) == 0
    return pa.RecordBatch.from_pydict({
        "set": pa.array(ids, pa.int64()), "root": pa.array(_roots(linked, ids), pa.int64()),
        "sets": pa.array(new.sum(axis=1).astype(np.int64), pa.int64()),
        "docs": pa.array([int(docs[row].sum()) for row in new], pa.int64())})


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id in each row's component."""
    label = ids.astype(np.int64)
    while len(label):
        least = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == label).all():
            break
        label = least
    return label


def link_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD, recall: float = RECALL, limit: int = LIMIT,
                 block: int = BLOCK, tokens: int = TOKENS) -> DataFrame:
    """One row per row of ``docs``: row (its number, see ``with_row_id``), id,
    class_id, class_row (the row that represents the class), class_size,
    n_links (documents linked to it, copies included) and n_linked_sets
    (different shingle sets linked to its own)."""
    named = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return _link_numbered(with_row_id(named, "row"), threshold, recall, limit, block, tokens)


def _link_numbered(numbered: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                   limit: int = LIMIT, block: int = BLOCK, most: int = TOKENS) -> DataFrame:
    """``link_classes`` of stored rows (row, id, text)."""
    runs = runs_needed(threshold, DEPTH, recall)
    told = store(_describe(numbered, "text", runs, threshold), "jaccard-documents")
    # the row that represents a set, and later a class: with the smallest id, null last
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    classes = store(told.where(F.col("sid").isNotNull()).groupBy("sid").agg(
        F.min(first).alias("least"), F.count(F.lit(1)).alias("n_docs"),
        F.min(F.struct("row", "size", "sketch", "branches")).alias("one"))
        .select("sid", "least", "n_docs", F.col("one.row").alias("set"), "one.size", "one.sketch", "one.branches"),
        "jaccard-sets")

    top = classes.select("set", "size", F.explode("branches").alias("b")).select(
        "set", "size", "b.node", "b.children")
    met = _met(top)
    whole = (F.col("n") <= limit) & ((F.col("weight") <= most) | (F.col("n") <= 2))
    deeper = _met(met.where(~whole).select("set", "size", F.explode("children").alias("node")))
    leaves = met.where(whole).drop("children").unionByName(deeper)
    # a set without a set of fitting size in its node has no link there; large
    # nodes are sifted block by block
    by_size = Window.partitionBy("node").orderBy("size")
    small = (leaves.where(whole)
             .withColumn("below", F.lag("size").over(by_size)).withColumn("above", F.lead("size").over(by_size))
             .where((F.col("below") >= threshold * F.col("size") - 1e-9)
                    | (F.col("above") * threshold <= F.col("size") + 1e-9))
             .select("node", "n", "weight", "set", "size", F.lit(0).alias("part"), F.lit(0).alias("i"), F.lit(0).alias("j")))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(block)), F.least("n", F.ceil(F.col("weight") / F.lit(most)))).cast("int")
    large = (leaves.where(~whole)
             .withColumn("part", F.pmod(F.xxhash64("set", "node"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("node", "n", "weight", "set", "size", "part", F.least("part", "other").alias("i"),
                     F.greatest("part", "other").alias("j")))
    sifted = store(_by_group(small.unionByName(large).join(classes.select("set", "sketch"), "set"))
                   .mapInArrow(_sift(threshold), "node long, i int, j int, part int, n long, weight long, set long"),
                   "jaccard-sifted")
    # small nodes left with the same sets are compared once
    same = (sifted.groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor("set").alias("x"), F.bit_xor(F.xxhash64("set")).alias("y"),
        F.max(F.when(~whole, F.struct(*_GROUP))).alias("own"))
        .groupBy("m", "x", "y", "own").agg(F.min(F.struct(*_GROUP)).alias("g")).select("g.*"))
    kept = store(sifted.join(same, _GROUP, "left_semi"), "jaccard-kept")
    own = kept.groupBy("set").agg(F.collect_set("node").alias("nodes"))
    tokens = _tokens_of(numbered, own.select("set"))
    sets = store(tokens.join(own, "set").join(classes.select("set", "n_docs"), "set"), "jaccard-tokens")
    found = store(_by_group(kept.join(sets, "set")).select(
        *_GROUP, "part", "set", "n_docs", "tokens", "nodes").mapInArrow(
        _compare(threshold), "set long, root long, sets long, docs long"), "jaccard-links")
    degrees = found.groupBy("set").agg(F.sum("sets").alias("sets"), F.sum("docs").alias("docs"))
    roots = components(found.where("set <> root").select(F.col("set").alias("a"), F.col("root").alias("b")))
    return _result(told, classes, degrees, roots)


def _met(frontier: DataFrame) -> DataFrame:
    """The rows of ``frontier`` in nodes of two sets or more, with their number ``n`` and their tokens ``weight``."""
    counts = store(frontier.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight")).where("n >= 2"), "jaccard-counts")
    total = int(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return store(lookup_split(frontier, counts, ["node"], "n", total, F.xxhash64("set"))
                 .where(F.col("n").isNotNull()), "jaccard-met")


def _result(told: DataFrame, classes: DataFrame, degrees: DataFrame, roots: DataFrame) -> DataFrame:
    rooted = store(classes.select("sid", "set", "least", "n_docs")
                   .join(roots.withColumnRenamed("node", "set"), "set", "left")
                   .withColumn("root", F.coalesce("root", "set")).join(degrees, "set", "left"), "jaccard-rooted")
    top = rooted.groupBy("root").agg(F.min("least").alias("first"), F.sum("n_docs").alias("class_size"),
                                     F.count(F.lit(1)).alias("n_sets"))
    named = store(lookup_split(rooted, top, ["root"], "n_sets", int(rooted.count()), F.xxhash64("set")).select(
        "sid", "n_docs", F.col("first").alias("least"), "class_size", F.coalesce("docs", F.lit(0)).alias("linked_docs"),
        F.coalesce("sets", F.lit(0)).alias("linked_sets")), "jaccard-classes")
    n_rows = int(named.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0])
    joined = lookup_split(told.select("row", "id", "sid"), named, ["sid"], "n_docs", n_rows, F.xxhash64("row"))
    alone = F.col("n_docs").isNull()
    return joined.select(
        "row", "id", F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        F.when(alone, F.col("row")).otherwise(F.col("least.row")).alias("class_row"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.when(alone, F.lit(0)).otherwise(F.col("linked_docs") + F.col("n_docs") - 1).cast("long").alias("n_links"),
        F.coalesce("linked_sets", F.lit(0)).cast("long").alias("n_linked_sets"))


def first_of_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that represent their classes, with all columns."""
    row, = internal(docs, "__row")
    numbered = with_row_id(docs, row)
    named = numbered.select(F.col(row).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                            F.col(f"`{text}`").cast("string").alias("text"))
    kept = _link_numbered(named, **options).where(F.col("row") == F.col("class_row"))
    return (numbered.join(kept.select(F.col("row").alias(row)), row, "left_semi")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def linked(spark, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and its numbers of links."""
    return link_classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "class_size", "n_links", "n_linked_sets")


ORACLE = r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \t\n\f\r]+'), lambda w: w <> '') AS w
      FROM documents
    ),
    shingles AS (
      SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                                   ELSE array_to_string(w[i:i + 4], ' ') END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS sid
              FROM shingles GROUP BY doc_id),
    met AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ),
    links AS (
      SELECT a, b, y.sid AS b_sid, x.sid AS a_sid FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE c * 1.8 >= 0.8 * (x.n + y.n) - 1e-9
    ),
    reach(a, b) AS (
      SELECT doc_id, doc_id FROM documents
      UNION
      SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
    ),
    classes AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY a)
    SELECT c.doc_id, c.class_id, CAST(c.class_size AS BIGINT) AS class_size,
           CAST(coalesce(l.n, 0) AS BIGINT) AS n_links, CAST(coalesce(l.m, 0) AS BIGINT) AS n_linked_sets
    FROM classes c LEFT JOIN (
      SELECT a, count(*) AS n, count(DISTINCT CASE WHEN b_sid <> a_sid THEN b_sid END) AS m FROM links GROUP BY a
    ) l ON l.a = c.doc_id"""
