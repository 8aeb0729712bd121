import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillroll.llm import simple8b

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, " ", "Plain words, and more.", "a\n\n b\tc\r\nd", "don't, won't... 12,000.5!", "größe ÉTÉ ñandú",
         "日本語 テキスト。", "é ́x ΑΣ Σ", "# ! \" #", "same", "same", "x" * 5000, "<|endoftext|> <|endoftext|>."]


@pytest.mark.parametrize("high", [1, 2, 6, 300, 50_000, 2 ** 30, 2 ** 32])
def test_pack_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (0, 1, 2, 239, 1023, 1024, 1025, 9000):
        ids = rng.integers(0, high, n)
        ids[rng.random(n) < 0.3] = 0
        ids[rng.random(n) < 0.02] = 2 ** 32 - 1
        words, first_word, escapes, first_escape = simple8b.pack(ids)
        assert (simple8b.unpack(words, first_word, escapes, n) == ids).all()
        for b in range(len(first_word)):  # any block alone
            some = slice(first_word[b], first_word[b + 1] if b + 1 < len(first_word) else None)
            m = min(simple8b.BLOCK_IDS, n - b * simple8b.BLOCK_IDS)
            alone = simple8b.unpack(words[some], np.zeros(1), escapes[first_escape[b]:], m)
            assert (alone == ids[b * simple8b.BLOCK_IDS:][:m]).all()


def test_words_follow_the_format():
    words, _, escapes, _ = simple8b.pack(np.array([3] * 20 + [5] * 3 + [70_000] + [5] * 11))
    by_hand, at = [], 0
    for word in map(int, words):
        count, width = simple8b.SELECTORS[word >> 60]
        for k in range(count):
            value = word >> (k * width) & (2 ** width - 1)
            if value == 2 ** width - 1 and width:
                value, at = int(escapes[at]), at + 1
            by_hand.append(value)
    assert by_hand[:35] == [3] * 20 + [5] * 3 + [70_000] + [5] * 11 and at == len(escapes) == 1


def test_small_ids_take_few_bits():
    assert len(simple8b.pack(np.zeros(1024))[0]) == 5
    assert len(simple8b.pack(np.full(1000, 9))[0]) == -(-1000 // 15)


def _plain(texts):
    lib = Tokenizer.from_file(PATH)
    return [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("memo", [3, 400_000])
def test_encoding_is_the_library_s(memo, monkeypatch):
    monkeypatch.setattr(simple8b, "SLICE_BYTES", 40)
    rng = np.random.default_rng(memo)
    parts = ["don't", "H", "ẖ", "̱", "ẗ", "T", "'s", ".", ",", "...", "A", "ß", "Σ", "́", "1", " ", "\n", "\t", " ", "\x1c", "word", "!"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(300)] + [t or "" for t in TEXTS]
    words = simple8b.WordTokenizer(PATH, memo_words=memo)
    for text, got, want in zip(texts, words.encode(pa.array(texts)), _plain(texts)):
        assert got.tolist() == want, repr(text)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        simple8b.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_files_read_back(spark, monkeypatch):
    rows = [(None if i == 3 else i * 7 % 50, t, "x") for i, t in enumerate(TEXTS * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = simple8b.token_files(df, PATH).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: r.start)
    at, last = 0, None
    for r in got:  # gapless, in ascending order of ids, nulls first
        assert r.start == at and (last is None or r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id
    want = sorted((-1 if i is None else i, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
                  for (i, _, _), ids in zip(rows, _plain([t for _, t, _ in rows])))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def test_long_text_and_several_slabs(spark, monkeypatch):
    long = "Some words, and 12 more of them. " * 60_000  # 2 MB, more ids than a slab
    df = spark.createDataFrame([(2, long), (1, "first"), (3, "last")], "doc_id long, text string")
    one, two, three = sorted(simple8b.token_files(df, PATH).collect())
    ids = _plain([long])[0] + [2]
    assert (two.start, two.n_tokens) == (one.n_tokens, len(ids)) and three.start == one.n_tokens + len(ids)
    assert two.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_empty_table(spark):
    assert simple8b.token_files(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
