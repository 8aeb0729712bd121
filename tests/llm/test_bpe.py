import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tillroll.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

TEXTS = [
    "", None, " ", "\n\n  x", "plain words, and more.", "don't we'll 've  ", "tab\tand nbsp 　 x",
    "größe été niño", "日本語 テキスト", "🙂🙂 emoji", "<|endoftext|>", "a" * 3000, "12345 678 9,0",
    "same", "same",
]


def _whole(text):
    return bpe.encoder(PATH, PATTERN).encode_ordinary(text or "")


@pytest.mark.parametrize("limit", [1, 2, 5, 17, 100])
def test_cuts_never_change_ids(limit):
    rng = np.random.default_rng(limit)
    alphabet = list("ab'st \n\t \x1c\x85.1é") + ["'s", "  ", "\r\n"]
    enc = bpe.encoder(PATH, PATTERN)
    for _ in range(300):
        text = "".join(rng.choice(alphabet, rng.integers(0, 60)))
        assert bpe.encode_text(enc, text, limit).tolist() == enc.encode_ordinary(text), repr(text)


def test_other_patterns_are_cut_at_their_matches():
    assert bpe.SAFE_PATTERN == PATTERN
    rng = np.random.default_rng(5)
    # joins punctuation with the line feeds behind it, which the known safe places cut
    joins = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    enc = bpe.encoder(PATH, joins)
    for _ in range(200):
        text = "".join(rng.choice(list("ab.,;\n\n 1é"), rng.integers(0, 80)))
        for limit in (1, 9):
            assert bpe.encode_text(enc, text, limit).tolist() == enc.encode_ordinary(text), repr(text)
    long = "word,\n\n" * 5000 + "\n"
    assert bpe.encode_text(enc, long, 10).tolist() == enc.encode_ordinary(long)


def test_long_white_space_is_one_match():
    enc = bpe.encoder(PATH, PATTERN)
    for tail in ("", "x", "\nx", "."):
        text = "word" + " " * 70_000 + tail
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)
    huge = "a" + " " * 3_000_000 + "x"  # the library alone runs out of stack here
    assert enc.decode_bytes(bpe.encode_text(enc, huge).tolist()) == huge.encode()


def test_digests_match_library(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in bpe.digests(df, PATH, PATTERN).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = _whole(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_round_trip_keeps_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", b"old")], "id long, text string, token_ids binary")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN).first()
    assert out.decoded == b"a b" and out.id == 1
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).count() == 0


def test_tiktoken_agrees_with_itself():
    enc = tiktoken.Encoding("t", pat_str=PATTERN, special_tokens={},
                            mergeable_ranks=bpe.encoder(PATH, PATTERN)._mergeable_ranks)
    text = "Is <|endoftext|> special? " * 9000
    assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)
