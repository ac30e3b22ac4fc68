import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradelake.llm import packing, tokens
from tradelake.llm.queries import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "",
    " ",
    "  a  b\n\n c \t d ",
    "don't it's we'll I'D  <|endoftext|> x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>",
    "été ÉTÉ naïve İstanbul ẞ Ω",
    "\x1c a\x1cb   c d 　 e   f",
    "12 345.67, (89) -- ... !? _x_ a_b 's 't 're",
    "你好世界 \U0001f600 \U0001f1e9\U0001f1ea a‍b",
    "word " * 3000 + "end",
    "x" * 5000,
]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


def _lengths(library, texts):
    return [len(library.encode(t, add_special_tokens=False)) for t in texts]


def _ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_cut_texts_count_as_whole_ones(byte_library):
    assert tokens.counter(BYTES)(ODD) == _lengths(byte_library, ODD)


TEXTS = st.lists(st.text(st.sampled_from(list(" \n\t ab'sS1.,é<|>\x1c")), max_size=30), min_size=1, max_size=5)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_any_text_counts_as_the_library_has_it(texts):
    assert tokens.counter(BYTES)(texts) == _lengths(Tokenizer.from_file(BYTES), texts) if len(texts) < 2 else True
    assert tokens.counter(BYTES)(texts) == tokens.counter(BYTES).encode(texts)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_any_text_encodes_as_the_library_has_it(texts):
    encode = packing.encoder(WORDS)
    whole = [e.ids for e in encode.library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == whole


def test_words_encode_as_whole_texts(word_library):
    found = packing.encoder(WORDS)(ODD)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [_ids(word_library, t) for t in ODD]


def test_forgetting_changes_nothing(byte_library, word_library, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 1)
    encode = packing.Encoder(WORDS)
    for text in ODD * 3 + ["ÀÉ, Ünd!! àé, ünd ß ÿ×÷", "x" * 100, "É" * 40 + "!", "x" * 100]:
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == _ids(word_library, text)
    assert all(len(w) <= packing.LONG_WORD for w in [*encode.words, *encode.older])
    monkeypatch.setattr(tokens, "REMEMBERED", 1)
    counter = tokens.LengthCounter(BYTES)
    assert [counter([t])[0] for t in ODD * 2] == _lengths(byte_library, ODD * 2)


def test_letters_are_remembered_under_other_marks(word_library, monkeypatch):
    """Words that differ in their marks alone share the ids of their letters, also after words were forgotten."""
    monkeypatch.setattr(packing, "REMEMBERED", 16)
    encode = packing.Encoder(WORDS)
    calls, library = [], encode.library
    model = SimpleNamespace(tokenize=lambda run: calls.append(run) or library.model.tokenize(run))
    encode.library = SimpleNamespace(model=model, encode=library.encode)
    texts = ["un deux trois quatre", "UN, deux! trois. quatre?", "un. Deux, trois! quatre.", "\xe9t\xe9! \xc9T\xc9"]
    for text in texts:
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == _ids(word_library, text)
    assert calls.count("un") == calls.count("trois") == 1


def test_counts(docs, byte_library):
    texts = [*ODD, None, ODD[3]]
    df = docs(*enumerate(texts)).withColumnRenamed("source", "n_tokens")
    got = {r[0]: tuple(r)[1:] for r in tokens.count_tokens(df, BYTES, limit=10).collect()}
    for i, t in enumerate(texts):
        n = len(byte_library.encode(t or "", add_special_tokens=False))
        assert got[i] == (len((t or "").encode()), n, n > 10)
    assert tokens.count_tokens(df.limit(0), BYTES).count() == 0


def test_count_query(spark, sf_dir, read, byte_library):
    got = {r.doc_id: r.n_tokens for r in QUERIES["op10_token_counts"](spark, sf_dir).collect()}
    rows = read("SELECT doc_id, text FROM '{d}/documents.parquet'")
    assert got == {i: len(byte_library.encode(t, add_special_tokens=False)) for i, t in rows}


def _check_pieces(rows, ids_of, window=2048):
    """Every id in one piece, every sequence gapless and without padding but at powers of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        ids, at = [*ids_of[doc], 1], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert len(part) == 4 * r["length"] and zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == window or (at < window and at & (at - 1) == 0)


def test_pack_query(spark, sf_dir, read, word_library):
    rows = [r.asDict() for r in QUERIES["op3_packing"](spark, sf_dir).collect()]
    texts = read("SELECT doc_id, text FROM '{d}/documents.parquet'")
    _check_pieces(rows, {i: _ids(word_library, t) for i, t in texts})


def test_pack_odd_texts(docs, word_library):
    from pyspark.sql import functions as F

    texts = [*ODD, None]
    df = docs(*enumerate(texts)).withColumnRenamed("source", "ids").repartition(3)
    packed = packing.pack(df, WORDS, window=64).withColumn("ids_crc32", F.crc32("ids"))
    _check_pieces([r.asDict() for r in packed.collect()], {i: _ids(word_library, t or "") for i, t in enumerate(texts)}, 64)
    assert packing.pack(df.limit(0), WORDS).count() == 0


def test_sum_of_squares_takes_the_least():
    rng = random.Random(1)
    capacity, packer = 12, packing.SumOfSquares(12)
    levels = [0] * (capacity + 1)
    for _ in range(500):
        size = rng.randint(1, capacity - 1)

        def cost(level):
            after = levels[:]
            if level:
                after[level] -= 1
            after[level + size] += 1
            return sum(n * n for n in after[1:capacity])

        usable = [h for h in range(capacity - size + 1) if h == 0 or levels[h]]
        least = min(map(cost, usable))
        window, full = packer.place(size)
        level = sum(window)
        assert level in usable and cost(level) == least
        window.append(size)
        if level:
            levels[level] -= 1
        levels[level + size] += 1
        assert full == (level + size == capacity)
        assert packer.levels[1:capacity].tolist() == levels[1:capacity]


@pytest.mark.parametrize("tasks", [1, 8, 32])
def test_most_pieces_stay_where_they_were_placed(tasks):
    """At the ends of tasks, under a twentieth of the documents' rests is cut to fill other windows."""
    rng = random.Random(tasks)
    moved, total = 0, 0
    for _ in range(tasks):
        packer = packing.SumOfSquares(2048)
        for doc in range(10_000 // tasks):
            size = min(2047, int(rng.expovariate(1 / 600)) + 1)
            packer.place(size)[0].append((doc, 0, size, bytes(4 * size)))
            total += 1
        placed = {p[0]: i for i, w in enumerate(packer.rest()) for p in w}
        found: dict[int, list] = {}
        for sequence in packing._closed(packer, 2048):
            assert sum(map(packing._length, sequence)) in (2048, *(1 << k for k in range(11)))
            windows = {placed[p[0]] for p in sequence}
            home = min(windows)
            for doc, start, whole, data in sequence:
                found.setdefault(doc, []).append((start, len(data) // 4, whole, placed[doc] == home))
        assert set(found) == set(placed)
        for pieces in found.values():
            pieces.sort()
            assert sum(p[1] for p in pieces) == pieces[0][2]
            moved += not (len(pieces) == 1 and pieces[0][3])
    assert moved < 0.05 * total
