import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tradelake.llm import resampling
from tradelake.llm.queries import QUERIES


def plain_features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resample(docs, target, percent=25, min_words=20, buckets=10_000):
    def counted(texts):
        out = np.zeros(buckets, int)
        for t in texts:
            for f in plain_features(t)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out.tolist()

    s, t = counted(x for _, x in docs), counted(target)
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (big_s + buckets) / ((a + 1) * (big_t + buckets)))) for a, b in zip(s, t)]
    rows, fit = {}, []
    for i, text in docs:
        words, features = plain_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[i] = [len(features), weight, score, None]
        if len(words) >= min_words:
            fit.append((-score, i))
    for rank, (_, i) in enumerate(sorted(fit)[: percent * len(fit) // 100]):
        rows[i][3] = rank + 1
    return rows


def test_query_against_plain_code(spark, sf_dir, read):
    docs = read("SELECT doc_id, text FROM '{d}/documents.parquet'")
    target = [t for (t,) in read("SELECT text FROM '{d}/benchmark.parquet'")]
    rows = QUERIES["op13_importance_resampling"](spark, sf_dir).collect()
    assert {r.doc_id: [r.n_features, r.weight, r.score, r.rank] for r in rows} == plain_resample(docs, target)
    assert len(rows) == len(docs)


@pytest.mark.parametrize("most", [1, 2, 7, 40, 1 << 20])
def test_parts_of_long_texts(most):
    text = "Ab-céd  x1 " * 9 + "word" * 30 + "\tEnd. Of\x00it"
    found = list(resampling.feature_parts(text, 1 << 32, 3, most))
    words, pairs = plain_features(text)
    triples = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    for k, plain in enumerate([words, pairs[len(words) :], triples]):
        got = [b for _, part in found for b in part[k].tolist()]
        assert got == [zlib.crc32(f.encode()) for f in plain]
    assert sum(n for n, _ in found) == len(words)


def test_draw_prefers_the_target(docs):
    like, other = "apple pear plum fig " * 8, "stone iron zinc lead " * 8
    df = docs(*((i, f"{like if i % 2 else other} t{i}") for i in range(400)))
    rows = resampling.resample(df, docs((0, like))).collect()
    drawn = [r for r in rows if r.rank is not None]
    assert sorted(r.rank for r in drawn) == list(range(1, 101))
    assert [r.score for r in sorted(drawn, key=lambda r: r.rank)] == sorted((r.score for r in drawn), reverse=True)
    assert sum(r.doc_id % 2 for r in drawn) >= 90


def test_odd_rows(spark, docs):
    long = "many words stand here " * 6
    df = docs((1, None), (2, ""), (3, "..."), (4, long), (4, long), (None, long), (None, None), (5, "few words"))
    df = df.withColumnRenamed("lang", "rank").withColumnRenamed("source", "_row").withColumnRenamed("n_chars", "n_words")
    rows = resampling.resample(df, df.select("text"), percent=100).collect()
    assert sorted((str(r.doc_id), r.n_features, r.rank is not None) for r in rows) == sorted(
        [("1", 0, False), ("2", 0, False), ("3", 0, False), ("4", 47, True), ("4", 47, True), ("None", 47, True), ("None", 0, False), ("5", 3, False)]
    )
    assert sorted(r.rank for r in rows if r.rank) == [1, 2, 3]
    assert all(r.weight == 0 for r in rows if not r.n_features)
    nothing = df.limit(0)
    assert resampling.resample(nothing, df).count() == 0
    assert resampling.resample(df, nothing).count() == 8
    empty = resampling.resample(docs((1, "a b")), nothing).collect()
    assert [(r.doc_id, r.n_features, r.rank) for r in empty] == [(1, 3, None)]
