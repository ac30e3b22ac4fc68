import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelake.llm import minhash
from tradelake.llm.queries import QUERIES


def plain_set(text, shingle=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1)))


def plain_groups(sets, percent=85):
    """Smallest reachable identifier by comparing all pairs."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small < percent * large:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (small + large - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_query_against_all_pairs(spark, sf_dir, read):
    sets = {i: plain_set(t) for i, t in read("SELECT doc_id, text FROM '{d}/documents.parquet'")}
    rows = QUERIES["op11_minhash_near_dedup"](spark, sf_dir).collect()
    groups = plain_groups(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (len(s), groups[i], groups[i] == i) for i, s in sets.items()
    }
    assert len(rows) == len(sets)


def variants(rng, n, words=60, vocabulary=400):
    """Texts around a few bases, some so far apart that only others connect them."""
    bases = [[f"w{rng.randrange(vocabulary)}" for _ in range(words)] for _ in range(3)]
    out = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            text[rng.randrange(len(text))] = f"v{rng.randrange(20)}"
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize("limit, shingles", [(1024, 1 << 21), (24, 1 << 21), (1024, 900)])
def test_large_groups_lose_no_link(spark, docs, monkeypatch, limit, shingles):
    monkeypatch.setattr(minhash, "GROUP_ROWS", limit)
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", shingles)
    rows = variants(random.Random(limit + shingles), 300)
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:20])]
    found = {r.doc_id: r.component_id for r in minhash.near_groups(docs(*rows)).collect()}
    assert found == plain_groups({i: plain_set(t) for i, t in rows})
    assert len(set(found.values())) > 10


@pytest.mark.parametrize("sides", [1, 2])
def test_forest_joins_what_all_links_join(sides):
    rng = random.Random(sides)
    sets = [np.array(sorted(plain), np.uint64) for plain in (
        {*range(100)} - {rng.randrange(100) for _ in range(rng.randint(0, 12))} for _ in range(120))]
    sets = [minhash.shingle_set(" ".join(f"w{x}" for x in s), 1) for s in sets]
    side = np.array([i % sides for i in range(120)])
    found = minhash.forest(sets, side, np.zeros(120, bool), minhash.match_threshold(64, 85), 85)
    root = list(range(120))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(120):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if (sides == 1 or side[i] != side[j]) and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    plain = [find(i) for i in range(120)]
    root = list(range(120))
    for a, b in found:
        assert find(a) != find(b)
        root[find(a)] = find(b)
    assert [[find(i) == find(j) for i in range(120)] for j in range(120)] == [[p == q for p in plain] for q in plain]


def test_threshold_is_rarely_missed():
    t = minhash.match_threshold(64, 85)
    rng = np.random.default_rng(5)
    equal = rng.random((200_000, 64)) < 0.85
    assert 20 < t < 40 and (equal.sum(axis=1) >= t).all()
    assert minhash.match_threshold(64, 100) == 64 and minhash.match_threshold(64, 1) == 1


def test_long_text_and_signature():
    text = "a b c d " * 100_000 + "end"
    assert len(minhash.shingle_set(text)) == len(plain_set(text))
    hashes = minhash.shingle_set("x y z u v w")
    least = [min((int(h) * int(a) + int(b)) % 2**64 for h in hashes) >> 32 for a, b in zip(minhash._FACTORS, minhash._TERMS)]
    assert minhash.signature(hashes).tolist() == least


def test_odd_rows(docs):
    text = "one two three four five"
    df = docs((5, text), (3, text.upper()), (9, None), (7, ""), (None, "q r s"), (None, "q r s"), (3, text), (2, "u v"), (8, "U  v"), (None, text), (4, " \n"))
    df = df.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "_node").withColumn("_key", F.lit("k"))
    rows = [(str(r[0]), *r[1:]) for r in minhash.near_groups(df).collect()]
    expected = [("5", 3, 3, False), ("3", 3, 3, True), ("3", 3, 3, True), ("9", 0, 9, True), ("7", 0, 7, True), ("4", 0, 4, True),
                ("None", 1, None, True), ("None", 1, None, True), ("2", 1, 2, True), ("8", 1, 2, False), ("None", 3, 3, False)]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert minhash.near_groups(df.limit(0)).count() == 0
