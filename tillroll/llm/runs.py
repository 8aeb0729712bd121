"""Periodic runs of words, and texts without their repetitions.

The words of a text are its maximal stretches without ASCII white space. A run
is a stretch of words whose smallest period q fits ``MIN_REPEATS`` times, of at
least ``MIN_WORDS`` words, that cannot be made longer on either side keeping
that period.

How far two places of a text agree (their LCE) is answered from suffixes at
places of a difference cover only: for any two places there is a shift, smaller
than the cover's modulus, that brings both onto the cover. So a query compares
a few words, and if they all agree the rest is a range minimum over the common
prefixes of neighbours among the sorted sampled suffixes.

Runs come from a harmonic grid. A run of period q holds a stretch of places
that equal the place q further on, of 3q at least, so one of the places 0, q,
2q, ... lies in it together with the 2q places after it. Asking those places
for every q up to a fourth of the words is n log n queries, of which nearly all
end at the first word.

Whole texts of a batch are worked on together, SLAB_BYTES at a time; the words
of a text never meet those of another (each ends in a number of its own). A
longer text is a slab of its own: memory is about 25 bytes for each byte of the
longest text. Every row is on its own, so ties, repeated rows and skew have no
effect. A null or empty text has no words, no runs and an empty collapsed text.
An empty table gives an empty table. The output columns replace input columns
of the same name; all other columns pass through.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, returns_memory, sized_slices, text_bytes
from tillroll.llm.oracles import CRC_TABLE, crc32

MIN_WORDS = 6
MIN_REPEATS = 4
# A difference cover (fixed value): every number modulo MODULUS is a difference of two of COVER.
MODULUS = 21
COVER = (3, 6, 7, 12, 14)
SLAB_BYTES = 1 << 20
GRID_CHUNK = 1 << 19

_IN_COVER = np.isin(np.arange(MODULUS), COVER)


def _shifts() -> np.ndarray:
    """The least shift that brings two places, by their residues, onto the cover."""
    a, b, d = np.ogrid[:MODULUS, :MODULUS, :MODULUS]
    return (_IN_COVER[(a + d) % MODULUS] & _IN_COVER[(b + d) % MODULUS]).argmax(axis=2)


_SHIFT = _shifts()


class Agreement:
    """LCE queries on a row of numbers from 0 whose suffixes all differ: the
    caller ends each text in a number that occurs nowhere else."""

    def __init__(self, values: np.ndarray):
        # behind the end stand numbers that occur nowhere else either
        self._rows = -(-len(values) // MODULUS) + 1
        past = (self._rows + 1) * MODULUS - len(values)
        self.values = np.concatenate([values, int(values.max(initial=0)) + 1 + np.arange(past)]).astype(np.int64)
        # sampled places, all of one residue together: the place MODULUS
        # further on is the next one
        self._class = np.full(MODULUS, -1)
        self._class[list(COVER)] = np.arange(len(COVER)) * self._rows
        self._places = np.concatenate([c + MODULUS * np.arange(self._rows) for c in COVER])
        self._sort()

    def _sort(self) -> None:
        """Sort the sampled suffixes; ``names[k]`` are equal for suffixes equal
        in their first ``MODULUS << k`` words."""
        m = len(self._places)
        rank = np.zeros(m, np.int64)
        open_ = np.arange(m)
        # as many words at a time as a number holds, of the suffixes not yet told apart
        bits = max(1, int(self.values.max()).bit_length())
        for first in range(0, MODULUS, 63 // bits):
            if len(open_):
                key = np.zeros(len(open_), np.int64)
                for w in range(first, min(first + 63 // bits, MODULUS)):
                    key = key << bits | self.values[self._places[open_] + w]
                open_ = self._refine(rank, open_, key)
        self._names = [rank.copy()]
        step = 1
        while len(open_):
            after = open_ + step
            # a suffix that runs out of its residue class is the last of all of
            # it, in numbers that occur once: it is told apart before
            inside = after % self._rows >= step
            key = np.where(inside, rank[np.minimum(after, m - 1)], -1)
            open_ = self._refine(rank, open_, key)
            self._names.append(rank.copy())
            step *= 2
        self._rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        self._table = [self._common(order[:-1], order[1:]).astype(np.int32)]
        length = 1
        while 2 * length <= m - 1:
            last = self._table[-1]
            self._table.append(np.minimum(last[:-length], last[length:]))
            length *= 2

    @staticmethod
    def _refine(rank: np.ndarray, open_: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Order the suffixes ``open_`` of equal rank by ``key``; return those still equal.

        The rank of a suffix is the number of suffixes before its group.
        """
        order = np.lexsort((key, rank[open_]))
        open_, key = open_[order], key[order]
        old = rank[open_]
        group = np.append(True, old[1:] != old[:-1])
        new = group | np.append(True, key[1:] != key[:-1])
        at = np.arange(len(open_))
        start = np.maximum.accumulate(np.where(group, at, 0))
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_] = old + head - start
        size = np.diff(np.append(np.flatnonzero(new), len(open_)))
        return open_[np.repeat(size > 1, size)]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that pairs of sampled suffixes (by number) have in common."""
        out = np.zeros(len(a), np.int64)
        a, b = a.copy(), b.copy()
        for k in range(len(self._names) - 1, -1, -1):
            same = np.flatnonzero(self._names[k][a] == self._names[k][b])
            out[same] += MODULUS << k
            a[same] += 1 << k
            b[same] += 1 << k
        i, j = self._places[a], self._places[b]
        going = np.arange(len(a))
        while len(going):
            going = going[self.values[i[going]] == self.values[j[going]]]
            out[going] += 1
            i[going] += 1
            j[going] += 1
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i < j, how many words from each on are equal."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        going = np.arange(len(i))
        for d in range(MODULUS):
            going = going[shift[going] > d]
            if not len(going):
                break
            same = self.values[i[going] + d] == self.values[j[going] + d]
            out[going[same]] += 1
            going = going[same]
        synced = np.flatnonzero(out == shift)
        if len(synced):
            x, y = i[synced] + shift[synced], j[synced] + shift[synced]
            a = self._rank[self._class[x % MODULUS] + x // MODULUS]
            b = self._rank[self._class[y % MODULUS] + y // MODULUS]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                q = np.flatnonzero(level == k)
                t = self._table[k]
                out[synced[q]] += np.minimum(t[low[q]], t[high[q] - (1 << int(k))])
        return out


def _grid(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, period, start of its text): the grid of every period of every text, in chunks."""
    periods = sizes // MIN_REPEATS
    periods[sizes < MIN_WORDS] = 0
    text = np.repeat(np.arange(len(sizes)), periods)
    period = 1 + np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods)
    counts = (sizes[text] - 1) // period
    upto = np.cumsum(counts)
    for low in range(0, int(counts.sum()), GRID_CHUNK):
        high = min(low + GRID_CHUNK, int(upto[-1]))
        first, last = np.searchsorted(upto, [low, high - 1], side="right")
        some = counts[first:last + 1].copy()
        some[0] = min(upto[first], high) - low
        if last > first:
            some[-1] = high - upto[last - 1]
        row = np.repeat(np.arange(first, last + 1), some)
        k = np.arange(low, high) - (upto - counts)[row]
        begin = starts[text[row]]
        yield begin + k * period[row], period[row], begin


def find_runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and end, in texts at
    ``starts`` with ``sizes`` words; each text is followed by a number that
    occurs nowhere else."""
    agreement = None
    found = []
    for place, period, begin in _grid(sizes, starts):
        # the stretch goes on for 2q + 1 places or more (five for q = 1)
        least = np.maximum(2 * period + 1, MIN_WORDS - period)
        for d in range(3):
            same = values[place + d] == values[place + d + period]
            place, period, begin, least = place[same], period[same], begin[same], least[same]
        if not len(place):
            continue
        agreement = agreement or Agreement(values)
        ahead = agreement.lce(place, place + period)
        # the first grid place of a stretch only
        back = np.maximum(place - period, begin)
        first = (ahead >= least) & ~((back + period == place) & (agreement.lce(back, back + period) >= period))
        place, period, begin, ahead = place[first], period[first], begin[first], ahead[first]
        # how far the stretch reaches back: the most that agrees, by halving
        low, high = np.zeros(len(place), np.int64), np.minimum(period - 1, place - begin)
        while (low < high).any():
            middle = (low + high + 1) // 2
            reach = agreement.lce(place - middle, place - middle + period) >= middle
            low, high = np.where(reach, middle, low), np.where(reach, high, middle - 1)
        start, end = place - low, place + ahead + period
        long = end - start >= np.maximum(MIN_WORDS, MIN_REPEATS * period)
        found.append(np.stack([start[long], end[long], period[long]]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, end, period = np.concatenate(found, axis=1)
    # a stretch is found under every multiple of its period: the least is it
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _words(text: memoryview, numbers: _Numbers) -> np.ndarray:
    """The words of a text as numbers, in pieces cut at white space."""
    parts, start = [], 0
    data = bytes(text)
    while start < len(data):
        end = start + SLAB_BYTES
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = data[start:end].split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _slab(texts: list[memoryview]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Runs (start, length, period) and collapsed text of each text."""
    numbers = _Numbers()
    words = [_words(t, numbers) for t in texts]
    vocabulary = list(numbers)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = len(vocabulary) + np.arange(len(texts))
    values = np.concatenate([x for w, e in zip(words, ends) for x in (w, [e])])
    # the first look at the grid reads two places past the last text
    past = len(vocabulary) + len(texts) + np.arange(3)
    starts = np.cumsum(sizes + 1) - sizes - 1
    start, end, period = find_runs(np.append(values, past), starts, sizes)
    dropped = np.zeros(len(values) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    kept = np.cumsum(dropped)[:-1] == 0
    text = np.searchsorted(starts, start, side="right") - 1
    # places within a text, by start and then period
    order = np.lexsort((period, start))
    rows = np.stack([start - starts[text], end - start, period], axis=1)[order].tolist()
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1)).tolist()
    runs = [[tuple(r) for r in rows[i:j]] for i, j in zip(cuts, cuts[1:])]
    collapsed = [b" ".join(map(vocabulary.__getitem__, w[kept[s:s + len(w)]].tolist()))
                 for w, s in zip(words, starts.tolist())]
    return runs, collapsed


_RUN = "struct<start:long,length:long,period:long>"


def collapse_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Add ``runs`` (array of start, length, period, by start and then period)
    and ``collapsed`` (the words, without those that a run holds after its
    first period, joined by one blank)."""
    bounded_batches(df.sparkSession)

    @F.arrow_udf(f"struct<runs:array<{_RUN}>,collapsed:binary>")
    @returns_memory
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            body, offsets = text_bytes(batch.fill_null(""))
            found, texts = [], []
            for i, j in sized_slices(np.diff(offsets).tolist(), SLAB_BYTES):
                r, c = _slab([memoryview(body)[offsets[k]:offsets[k + 1]] for k in range(i, j)])
                found += r
                texts += c
            flat = list(itertools.chain.from_iterable(found))
            columns = zip(*flat) if flat else ([], [], [])
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(run))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends), structs),
                                              pa.array(texts, pa.binary())], ["runs", "collapsed"])

    both = work(F.col(f"`{text}`").cast("string"))
    name = "__both"
    while name in df.columns:
        name += "_"
    out = df.withColumn(name, both)
    return (out.withColumns({runs: F.col(name)["runs"], collapsed: F.col(name)["collapsed"].cast("string")})
            .drop(name))


def plant(text: bytes, doc_id: int) -> bytes:
    """The text, its words from some place on replaced by a repetition if the
    CRC-32 of ``doc_id`` says so."""
    seed, is_other = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if is_other:
        return text
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]])
    first = np.flatnonzero(inside[1:] & ~inside[:-1])
    last = np.flatnonzero(inside[:-1] & ~inside[1:])
    n = len(first)
    if not n:
        return text
    a = seed % n
    period = 1 + (n - a) // (3 + seed % 8)
    whole, rest = divmod(n - a, period)

    def piece(words: int) -> bytes:
        return b" ".join(text[first[a]:last[a + words - 1]].split()) + b" " if words else b""

    return text[:first[a]] + (piece(period) * whole + piece(rest) if whole else piece(n - a))


def planted(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``plant`` applied to its texts (a null text or key: left alone)."""
    bounded_batches(df.sparkSession)

    @F.arrow_udf("binary")
    def work(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in batches:
            yield pa.array((t if t is None or k is None else plant(t, k)
                            for t, k in zip((x.as_py() for x in texts), keys.to_pylist())), pa.binary())

    return df.withColumn(text, work(F.col(f"`{text}`").cast("binary"), F.col(f"`{key}`")).cast("string"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document: its runs with planted repetitions, the longest of them and digests."""
    found = collapse_runs(planted(docs.select("doc_id", "text")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.when(F.size("runs") > 0, F.concat(F.concat_ws("\n", lines), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


ORACLE = f"""
WITH {CRC_TABLE},
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
seeded AS (
  SELECT doc_id, w, len(w) AS n, CAST({crc32("CAST(doc_id AS VARCHAR)")} AS BIGINT) AS h FROM split, crc),
placed AS (
  SELECT *, h // 10 % greatest(n, 1) AS a FROM seeded),
periods AS (
  SELECT *, 1 + (n - a) // (3 + h // 10 % 8) AS p FROM placed),
words AS (
  SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[CAST(a + (i - a) % p AS BIGINT) + 1]
                            ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM periods)),
pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS q FROM stretches GROUP BY ALL),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(printf('%d,%d,%d', start, length, q) || chr(10), '' ORDER BY start, q) AS t,
         min(struct_pack(l := -length, s := start, q := q)) AS best
  FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.q AND w.i < r.start + r.length)
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, CAST(-best.l AS BIGINT) AS length,
       CAST(best.q AS BIGINT) AS period, CAST(1000 * -best.l // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
