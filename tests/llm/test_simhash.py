import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tradelake.llm import simhash
from tradelake.llm.components import components
from tradelake.llm.queries import QUERIES


def plain_fingerprint(text, shingle=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes, budget):
    """Smallest reachable identifier by comparing all pairs."""
    root = {i: i for i in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(codes)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (codes[a] ^ codes[b]).bit_count() <= budget:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_codes(rng, n, centres=4, flips=6):
    """Codes that crowd around a few centres, so that many are linked."""
    middle = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        code = rng.choice(middle)
        for _ in range(rng.randint(0, flips)):
            code ^= 1 << rng.randrange(64)
        out.add(code)
    return sorted(out)


@pytest.mark.parametrize("text", ["", " \n", "a", "a b", "A b\tc", "é É x y z", "w " * 70_000, "x y z " * 400])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_finds_every_pair(budget, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    codes = np.array(near_codes(random.Random(budget), 300), np.uint64)
    groups = (codes >> np.uint64(63)).astype(np.int64)
    found = {tuple(sorted(p)) for part in simhash.linked_pairs(codes, groups, budget, 63) for p in part.tolist()}
    plain = {
        (i, j)
        for j in range(len(codes))
        for i in range(j)
        if groups[i] == groups[j] and (int(codes[i]) ^ int(codes[j])).bit_count() <= budget
    }
    assert found == plain


@pytest.mark.parametrize("limit, held", [(4096, 1 << 16), (5, 20)])
def test_links_connect_what_is_near(spark, monkeypatch, limit, held):
    monkeypatch.setattr(simhash, "HELD", held)
    codes = near_codes(random.Random(7), 400)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(i, c) for i, c in enumerate(signed)], "_node long, _code long")
    links = simhash.link_nodes(nodes, 2, limit=limit).collect()
    assert all((codes[r.a] ^ codes[r.b]).bit_count() <= 2 for r in links)
    near = {i: i for i in range(len(codes))}

    def find(x):
        while near[x] != x:
            x = near[x]
        return x

    for r in links:
        x, y = find(r.a), find(r.b)
        near[max(x, y)] = min(x, y)
    assert {i: find(i) for i in near} == plain_groups(dict(enumerate(codes)), 2)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    rng = random.Random(3)
    mixed = [p if rng.random() < 0.5 else p[::-1] for p in links] + [(300, 300)]
    rng.shuffle(mixed)
    found = {r.node: r.root for r in components(spark.createDataFrame(mixed, "a long, b long"), "a", "b").collect()}
    plain = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | dict.fromkeys((200, 201, 202), 200)
    assert found == plain
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_query_against_all_pairs(spark, sf_dir, read):
    codes = {i: plain_fingerprint(t) for i, t in read("SELECT doc_id, text FROM '{d}/documents.parquet'")}
    rows = QUERIES["op4_simhash_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{c:016x}" for i, c in codes.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_groups(codes, 2)


def test_odd_rows(docs):
    df = docs((5, "one two three four"), (3, "One two three four"), (9, None), (7, ""), (None, "q r s"), (None, "q r s"), (3, "u v"))
    df = df.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fingerprint")
    rows = sorted((str(r[0]), r[1], r[2]) for r in simhash.near_groups(df).collect())
    zero = "0" * 16
    one, q, u = (f"{plain_fingerprint(t):016x}" for t in ("one two three four", "q r s", "u v"))
    expected = [("5", one, 3), ("3", one, 3), ("9", zero, 7), ("7", zero, 7), ("None", q, None), ("None", q, None), ("3", u, 3)]
    assert rows == sorted(expected)
    assert simhash.near_groups(df.limit(0)).count() == 0
    kept = sorted((str(r[0]), r[1]) for r in simhash.keep_one(df).collect())
    assert kept == [("3", "One two three four"), ("3", "u v"), ("7", ""), ("None", "q r s")]
    clash = df.select("doc_id", "text", *(F.lit(c).alias(c) for c in ("_key", "_fp", "_place", "component_id")))
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == 4
    assert {r[2:] for r in kept.collect()} == {("_key", "_fp", "_place", "component_id")}
