import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from tradelake.llm import decontam, language
from tradelake.llm.queries import QUERIES


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_hits(text, items, window=10):
    """Hit word numbers and items by trying every window at every place."""
    words = plain_words(text)
    grams = {}
    for name, t in items:
        own = plain_words(t)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            grams.setdefault(tuple(own[i : i + size]), set()).add(name)
    hit, met = set(), set()
    for size in {len(g) for g in grams}:
        for i in range(len(words) - size + 1):
            found = grams.get(tuple(words[i : i + size]))
            if found:
                hit |= set(range(i, i + size))
                met |= found
    return len(words), hit, met


def random_text(rng, n, letters="abc"):
    return " ".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("window", [1, 3, 5])
def test_automaton_against_every_window(seed, window):
    rng = random.Random(seed)
    items = [(str(i), random_text(rng, rng.randint(0, 14), "ab" if seed % 2 else "abcd")) for i in range(12)]
    matcher = decontam.Automaton(items, window)
    for _ in range(40):
        text = random_text(rng, rng.randint(0, 40), "abcd")
        n, hit, met = plain_hits(text, items, window)
        spans, names = matcher.hits(decontam.words_of(text))
        assert {i for a, b in spans for i in range(a, b)} == hit
        assert names == met
        assert all(a < b for a, b in spans) and all(x[1] < y[0] or x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        clean = decontam.without_hits(text, matcher, 1.0)
        assert not plain_hits(clean, items, window)[1]
        if not hit:
            assert clean == text


def test_words_and_their_places():
    text = "Été 12x_y\x00É-B\x7fC 你好 ǅ"
    assert [w.decode() for w in decontam.words_of(text)] == plain_words(text)
    assert [text[a:b] for a, b in decontam.word_places(text)] == ["Été", "12x", "y", "É", "B", "C", "你好", "ǅ"]


def test_query_against_every_window(spark, sf_dir, read):
    items = read("SELECT item_id, text FROM '{d}/benchmark.parquet'")
    items = [(str(i), t) for i, t in items]
    got = {r.doc_id: r for r in QUERIES["op8_benchmark_decontamination"](spark, sf_dir).collect()}
    for i, t in read("SELECT doc_id, text FROM '{d}/documents.parquet'"):
        n, hit, met = plain_hits(t, items)
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        r = got.pop(i)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), len(met), digest, bool(hit))
    assert not got


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 60])
def test_odd_rows(spark, docs, block):
    rng = random.Random(1)
    items = [("b", random_text(rng, 30, "abcdef")), ("a", "x Y z"), ("c", None), ("d", "... !"), (None, "q r"), ("a2", "X y Z")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    named = [(n or "", t) for n, t in items]
    texts = [None, "", "x y z X Y Z", "w " * 50_000 + "x y z", items[0][1] + " " + items[0][1], "a x y q r", "Q-R", "x y"]
    df = docs(*enumerate(texts), (2, texts[2]), (None, "x y z")).withColumnRenamed("lang", "n_words")
    found = decontam.find_overlaps(df, bench, block_bytes=block).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = "x y z" if r.doc_id is None else texts[r.doc_id]
        n, hit, met = plain_hits(text, named)
        assert r.n_words == n and r.item_ids == sorted(met)
        assert {i for s in r.word_spans for i in range(s["start"], s["end"])} == hit
    assert decontam.find_overlaps(df.limit(0), bench).count() == 0
    assert decontam.find_overlaps(df, bench.limit(0)).where("size(word_spans) > 0").count() == 0


def test_cut(spark, docs):
    bench = spark.createDataFrame([("1", "one two three four five six seven eight nine ten eleven")], "item_id string, text string")
    item = "One two, three four five six seven eight nine ten eleven"
    long = "clean words here. " * 20
    df = docs((1, long), (2, long + item + ". tail"), (3, item), (4, None), (5, ""), (2, long + item + ". tail"))
    got = decontam.cut_overlaps(df, bench)
    assert got.columns == df.columns
    rows = sorted((r.doc_id, r.text, r.n_chars) for r in got.collect() if r.text is not None)
    cut = long + "\n. tail"
    assert rows == [(1, long, len(long)), (2, cut, len(cut)), (2, cut, len(cut)), (5, "", 0)]
    assert got.where("text IS NULL").count() == 1


def test_blocks_change_no_cut(spark, docs):
    rng = random.Random(4)
    items = [(str(i), random_text(rng, rng.randint(2, 9), "abcdefgh")) for i in range(30)]
    items += [("x", "one two three"), ("y", "four five six"), ("z", "p q")]
    texts = [random_text(rng, rng.randint(0, 60), "abcdefghijklm") for _ in range(80)]
    # Hit for 30 % by each of two items; an item that forms where another was cut out; none.
    texts += ["one two three k l four five six m n", "p one two three q m n o r s t u v w x y", "k l m", None, ""]
    bench = spark.createDataFrame(items, "item_id string, text string")
    df = docs(*enumerate(texts), (None, texts[0])).withColumnRenamed("source", "_text")
    matcher = decontam.Automaton(items, 3)
    plain = [(i, t, decontam.without_hits(t or "", matcher, 0.5)) for i, t in [*enumerate(texts), (None, texts[0])]]
    expected = sorted(str((i, cut if t else t, len(cut))) for i, t, cut in plain if cut is not None)
    for block in (decontam.BLOCK_BYTES, 150, 60):
        got = decontam.cut_overlaps(df, bench, window=3, block_bytes=block)
        assert got.schema == df.schema
        assert sorted(str((r.doc_id, r.text, r.n_chars)) for r in got.collect()) == expected
    assert len(plain) > len(expected) > 20 and any(t != cut for _, t, cut in plain if t and cut)
    assert [cut and cut.split() for _, _, cut in plain[80:83]] == [None, list("mnorstuvwxy"), list("klm")]


def plain_bits(texts, text, most):
    """Code length with escapes (method C) and exclusion, symbol by symbol."""
    seen = [{} for _ in range(most + 1)]
    for t in texts:
        padded = b" " * most + t
        for i in range(most, len(padded)):
            for order in range(most + 1):
                ctx = padded[i - order : i]
                seen[order].setdefault(ctx, {}).setdefault(padded[i], 0)
                seen[order][ctx][padded[i]] += 1
    bits, padded = 0.0, b" " * most + text
    for i in range(most, len(padded)):
        excluded = set()
        for order in range(most, -1, -1):
            counts = seen[order].get(padded[i - order : i], {})
            counts = {s: c for s, c in counts.items() if s not in excluded}
            if not counts:
                continue
            total = sum(counts.values()) + len(counts)
            if padded[i] in counts:
                bits -= math.log2(counts[padded[i]] / total)
                break
            bits -= math.log2(len(counts) / total)
            excluded |= set(counts)
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("order", range(6))
@pytest.mark.parametrize("scored", [6, 1 << 20])
def test_code_lengths_are_exact(monkeypatch, order, scored):
    monkeypatch.setattr(language, "SCORED", scored)
    monkeypatch.setattr(language, "COMPUTED", 4 * scored)
    samples = {"x": ["abracadabra ab", "banana bread", ""], "y": ["zyx zzz", "été"]}
    models = language.Models(samples, order)
    assert models.tree.order == order
    texts = [language.normalised(t) for t in ("abra zyx", "", "ba", "Été!7q", "quux" * 50)]
    got = models.bits(texts)
    for k, name in enumerate(models.names):
        learned = [language.normalised(t) for t in samples[name]]
        plain = [plain_bits(learned, t, order) for t in texts]
        assert np.allclose(got[:, k], plain, rtol=1e-5)


def test_query_on_held_out_rows(spark, sf_dir, read):
    rows = QUERIES["op9_language_id"](spark, sf_dir).collect()
    known = dict(read("SELECT doc_id, lang FROM '{d}/documents.parquet'"))
    assert {r.doc_id for r in rows} == set(known) and len(rows) == len(known)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(known[r.doc_id] == r.lang_pred for r in held) >= 0.99 * len(held)


def test_odd_languages(docs):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze " * 5, "de") for i in range(20)] + [(200, None, "en"), (201, "x", None)]
    df = docs(*rows).withColumnRenamed("source", "lang_pred")
    models = language.learn(df)
    assert models.names == ["de", "en"]
    texts = [None, "", "123 !?", "the dog", "und die", "the " * 100_000, "你好"]
    odd = docs(*enumerate(texts)).withColumnRenamed("lang", "score")
    got = [r.lang_pred for r in sorted(language.identify(odd, models).collect())]
    assert got[:6] == ["und", "und", "und", "en", "de", "en"] and got[6] in ("de", "en")
    kept = language.keep_identified(odd, models)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} >= {3, 4, 5} and kept.where("doc_id < 3").count() == 0
    assert language.identify(odd.limit(0), models).count() == 0
    nothing = language.learn(df.limit(0))
    assert {r.lang_pred for r in language.identify(odd, nothing).collect()} == {"und"}


def test_texts_that_fit_several_languages_stay(docs):
    models = language.Models({name: ["the same words"] for name in "abcd"})
    df = docs((1, "words"), (2, "same"), (3, "12 !"))
    assert max(r.score for r in language.identify(df, models).collect()) < 0.5
    assert {r.doc_id for r in language.keep_identified(df, models).collect()} == {1, 2}


def test_the_sample_is_bounded(docs):
    rng = random.Random(3)
    df = docs(*((i, random_text(rng, 20, "abcdef"), "en") for i in range(200)))
    few = language.learn(df, max_docs=5, max_bytes=10**6)
    many = language.learn(df)
    assert many.tables[0].size > few.tables[0].size
    shallow = language.Models({"en": ["some text"]}, table_bytes=1000)
    assert 0 < shallow.tree.order < language.ORDER and shallow.tables[0].nbytes <= 1000
    whole = language.learn(df, max_docs=1, max_bytes=1)
    assert whole.names == ["en"]


def test_a_full_block_fits_a_worker():
    """The states of as much text as a block may have, all of it different."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(decontam.BLOCK_BYTES // 6)]
    items = [(str(i), " ".join(words[i : i + 60])) for i in range(0, len(words), 60)]
    assert sum(len(t) for _, t in items) > decontam.BLOCK_BYTES * 0.9
    tracemalloc.start()
    automaton = decontam.Automaton(items, 10)
    assert tracemalloc.get_traced_memory()[0] < 160e6
    tracemalloc.stop()
    assert automaton.hits(items[3][1].encode().split())[0] == [(0, 60)]
