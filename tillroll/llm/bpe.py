"""Byte-level BPE encoding and decoding with the tiktoken library.

The ranks come from a local file (a parameter; workers read their own copy of
the installed file). A text is encoded as a whole: ids never depend on where a
long text is cut, because it is only cut where no match of the pattern can
cross. Such places are known for SAFE_PATTERN; with any other pattern the
matches of a long text are found first and handed to the library one by one.

Rows: a null text counts as the empty text and gives no ids. Texts are read as
UTF-8; a byte sequence that is not UTF-8 is read as U+FFFD, as the library
reads it. Every row is on its own, so ties, repeated rows and skew have no
effect, and an empty table gives an empty table. Output columns replace input
columns of the same name; all other columns pass through.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import returns_memory

# Texts up to this many characters go to the library in one piece.
PIECE_CHARS = 1 << 16
# The pattern that the places of _SAFE and _LONG_RUN are safe for; a fixed value.
SAFE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space (Unicode White_Space) as the patterns' \s has it; a fixed value.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_RUN = re.compile(f"[{_SPACE}]{{4096,}}")
# A place between a non-space and a blank or line feed. No match of SAFE_PATTERN goes
# on from a non-space to white space, and what follows such a place is matched
# without looking back.
_SAFE = re.compile(r"[^\s](?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """The library's encoding for a rank file, once per worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def split_safely(text: str, limit: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """Pieces of ``text`` in order, and whether a piece is one pattern match.

    Cuts lie at safe places only. A very long run of white space is handed out
    as the one match it is (without its last character if a non-space
    follows), because the pattern's look-ahead would exhaust the regex stack.
    """
    if len(text) <= limit:
        if text:
            yield text, False
        return
    start = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((p, False) for p in _cut(text, start, run.start(), limit))
        yield text[run.start():end], True
        start = end
    yield from ((p, False) for p in _cut(text, start, len(text), limit))


def _cut(text: str, start: int, end: int, limit: int) -> Iterator[str]:
    while end - start > limit:
        place = _SAFE.search(text, start + limit - 1, end)
        if place is None or place.end() >= end:
            break
        yield text[start:place.end()]
        start = place.end()
    if start < end:
        yield text[start:end]


def _matches(pattern: str, text: str) -> Iterator[tuple[str, bool]]:
    """The matches of ``pattern``, which the library encodes one by one."""
    import regex

    return ((m[0], True) for m in regex.finditer(pattern, text) if m[0])


def encode_text(enc, text: str, limit: int = PIECE_CHARS) -> np.ndarray:
    """Ids of one whole text as little-endian unsigned 32-bit integers."""
    parts = []
    safe = enc._pat_str == SAFE_PATTERN or len(text) <= limit
    for piece, single in split_safely(text, limit) if safe else _matches(enc._pat_str, text):
        ids = enc._encode_single_piece(piece) if single else enc.encode_ordinary(piece)
        parts.append(np.asarray(ids, dtype="<u4"))
        if len(parts) > 4096:
            parts = [np.concatenate(parts)]
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.empty(0, "<u4")


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids",
           count: str = "n_tokens") -> DataFrame:
    """Add ``ids`` (binary: the ids as little-endian unsigned 32-bit integers)
    and ``count`` (long) to every row of ``df``."""

    @F.arrow_udf("binary")
    @returns_memory
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(path, pattern)
        for batch in batches:
            yield pa.array((encode_text(enc, (v.as_py() or b"").decode("utf-8", "replace")).tobytes()
                            for v in batch), pa.binary())

    return (df.withColumn(ids, ids_of(F.col(f"`{text}`").cast("binary")))
            .withColumn(count, (F.octet_length(F.col(f"`{ids}`")) / 4).cast("long")))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids",
           decoded: str = "decoded") -> DataFrame:
    """Add ``decoded`` (binary: the raw bytes of the ids). Null ids give null;
    an id that the rank file lacks is an error."""

    @F.arrow_udf("binary")
    @returns_memory
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(path, pattern)
        for batch in batches:
            yield pa.array((None if v is None else
                            enc.decode_bytes(np.frombuffer(v, "<u4").tolist())
                            for v in (x.as_py() for x in batch)), pa.binary())

    return df.withColumn(decoded, bytes_of(F.col(f"`{ids}`")))


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the ids and of the decoded bytes."""
    one = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))
    out = decode(encode(one, path, pattern), path, pattern)
    return out.select(key, "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
