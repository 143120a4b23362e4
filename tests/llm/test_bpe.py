import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termflow.llm.bpe import WordBpe, bpe_round_trip, decode, op3_bpe_encoding
from termflow.llm.library import LibraryEncoder
from termflow.llm.words import Words, cut, mix

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
MODELS = [WordBpe(PATH), LibraryEncoder(PATH)]
ODD = ["", " ", "a", "'s", "don't we'll", "a\x1cb \x1f", "\x85x　y\xa0z", "ΑΣ Σ ς", "İstanbul Kelvin",
       "é ñ", "１２ ٣ Ⅳ ²", "<|endoftext|>", "x<|startoftext|>Y<|endoftext|><|endoftext|>z", "<|end",
       "a" * 5001, "=" * 777, "漢字 नमस्ते 😀👍🏽", "​x", "a\tb\nc\r\nd\x0be\x0cf", "\x00 \x7f"]


def ids_of(model, texts):
    flat, ends = model.table.encode(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]


def wanted(texts):
    return [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("model", MODELS)
def test_odd_texts(model):
    assert ids_of(model, ODD) == wanted(ODD)
    assert ids_of(model, []) == []


@pytest.mark.parametrize("model", MODELS)
def test_random_mixtures(model):
    rng = random.Random(5)
    letters = "aàáeE's 'RE ΣςİÁ\x1c\x85　\xa0😀1٣²ⅣßDž_!?..\n\t​KÅﬁ漢नम" + " " * 6
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    assert ids_of(model, texts) == wanted(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=6))
def test_any_text(texts):
    for model in MODELS:
        assert ids_of(model, texts) == wanted(texts)


def test_table_starts_anew(monkeypatch):
    model = WordBpe(PATH)
    model.table.limit = 3
    for text in ("one two three four", "five one six", "two"):
        assert ids_of(model, [text]) == wanted([text])


def test_one_merge_of_each_word_at_a_time_gives_the_same():
    model = MODELS[0]
    rank = {k: r for k, r in zip(model.keys.tolist(), model.ranks.tolist())}
    for word in [b"thththth", b"aaaaaaa", b"mississippi", b"x", "ééé".encode()]:
        sym = [*model.inner[list(word[:-1])], model.final[word[-1]]]
        while True:
            best = min(((rank.get(int(a) << 32 | int(b), 1 << 50), i) for i, (a, b) in enumerate(zip(sym, sym[1:]))),
                       default=(1 << 50, 0))
            if best[0] == 1 << 50:
                break
            sym[best[1]:best[1] + 2] = [model.made[best[0]]]
        assert model.merge([word])[0].tolist() == [int(s) for s in sym]


def test_documents_against_the_library(spark):
    import hashlib

    rows = {r.doc_id: r for r in op3_bpe_encoding(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 7, "x"), (1, "", 8, "y"), (2, "Hello hello", 9, "z"), (2, "Hello hello", 9, "z")],
                               "doc_id long, text string, word int, `__row` string")
    got = bpe_round_trip(df, PATH).collect()
    assert len(got) == 4 and got[0].word == 7 and got[0]["__row"] == "x"
    assert got[0].ids == got[1].ids == [] and got[0].decoded == got[1].decoded == ""
    assert got[2].ids == got[3].ids == wanted(["Hello hello"])[0]
    assert bpe_round_trip(df.limit(0), PATH).collect() == []
    none = spark.createDataFrame([(None,)], "ids array<int>").select(decode(F.col("ids"), PATH).alias("t")).collect()
    assert none[0].t == ""


def test_unknown_id():
    with pytest.raises(ValueError):
        MODELS[0].decode(pa.array([[10**6]], pa.list_(pa.int32())))
    assert MODELS[0].decode(pa.array([[], None], pa.list_(pa.int32()))).to_pylist() == ["", ""]


def colliding_words(n):
    """Pairs of words with the same unkeyed hash, as they can be made in seconds."""
    rng = np.random.default_rng(0)
    pairs = [("uugnoyeywqsspuzt", 'eddhzacd&*e/y"yt')]
    while len(pairs) < n:
        a, c = rng.integers(97, 123, (2, 200_000, 16)).astype(np.uint8)
        first = [mix(x[:, :8].copy().view(np.uint64).ravel() + np.uint64(16 * 0x9E3779B97F4A7C15 & 2**64 - 1)) for x in (a, c)]
        second = (first[0] + a[:, 8:].copy().view(np.uint64).ravel() - first[1]).view(np.uint8).reshape(-1, 8)
        good = ((second > 32) & (second < 127)).all(axis=1)
        pairs += [(bytes(x).decode(), bytes(y[:8]).decode() + bytes(z).decode()) for x, y, z in zip(a[good], c[good], second[good])]
    return pairs[:n]


def test_words_made_to_collide_keep_their_ids():
    pairs = colliding_words(1001)
    words = cut(pa.array([f"{a} {b}" for a, b in pairs]))
    h = words.hashes()
    assert (h[::2] == h[1::2]).all() and not (words.hashes(seed=5)[::2] == words.hashes(seed=5)[1::2]).any()
    texts = [w for p in pairs for w in p]
    for model in (WordBpe(PATH), LibraryEncoder(PATH)):
        assert ids_of(model, texts) == wanted(texts)


def test_lengths_are_part_of_a_key():
    # Under additive keys a word of 7 bytes and one of 8 could share a hash whatever the seed.
    short = np.frombuffer(b"abcdefg\0", np.uint64)
    long = (short - np.uint64(0x9E3779B97F4A7C15)).tobytes()
    buf = np.frombuffer(b"abcdefg" + long + bytes(8), np.uint8).copy()
    words = Words(buf, np.array([0, 7]), np.array([7, 15]), np.array([0, 2]))
    assert len(set(words.hashes().tolist())) == 1 and len(set(words.hashes(seed=9).tolist())) == 2
