import hashlib
import math
import random

import numpy as np
import pytest

from tradelake.llm import vector_codes as vc
from tradelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_compress(rows, parts=16, entries=64, rounds=2):
    """Nearest entries by comparing all, in whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = max((len(r[1]) for r in kept), default=0)
    vectors = [[math.floor(256 * x) for x in r[1]] + [0] * (dim - len(r[1])) for r in kept]
    pieces = [slice(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]
    books = [[v[cut] for v in vectors[:entries]] for cut in pieces]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(v[cut], c)), e) for e, c in enumerate(book)) for cut, book in zip(pieces, books)]
            for v in vectors
        ]

    for _ in range(rounds):
        found = assign()
        for p, cut in enumerate(pieces):
            for e in range(len(books[p])):
                mine = [v[cut] for v, f in zip(vectors, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    digest = hashlib.sha256(",".join(str(n) for b in books for c in b for n in c).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for r, e in zip(kept, errors):
        total[r[2]] = total.get(r[2], 0) + e
    return sorted(
        (str(r[0]), "".join(f"{e:02x}" for _, e in f), e, total[r[2]], digest) for r, f, e in zip(kept, found, errors)
    )


def results(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_query_against_plain_code(spark, sf_dir, read):
    rows = read("SELECT vec_id, embedding, label FROM '{d}/embeddings.parquet'")
    assert results(QUERIES["op12_vector_code_compression"](spark, sf_dir)) == plain_compress(rows)


@pytest.mark.parametrize("near, rounds, dim", [(1, 1, 16), (2, 4, 16), (4, 3, 37), (64, 2, 8), (3, 0, 5)])
def test_ties_and_many_rounds(spark, near, rounds, dim):
    rng = random.Random(dim + rounds)
    rows = [(i, [rng.choice([-0.01, 0.0, 0.25, 1.0, rng.random()]) for _ in range(dim)], rng.choice([1, 2, None])) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [(i, [float(np.float32(x)) for x in v], la) for i, v, la in rows]
    assert results(vc.compress(df, near=near, rounds=rounds)) == plain_compress(rows, rounds=rounds)


@pytest.mark.parametrize("b", [1, 3, 8])
def test_bounds_hold_and_save_distances(b):
    rng = np.random.default_rng(b)
    x = rng.integers(-300, 300, (2000, 4))
    book = x[:40].copy()
    near, bounds = vc.search(x, book, b)
    for step in (3, 1, 0):
        moved = book + rng.integers(-step, step + 1, book.shape)
        drift = np.sqrt(((moved - book) ** 2).sum(axis=1))
        near, bounds, depth = vc.reassign(x, moved, near, bounds, drift)
        book, plain = moved, vc.squared(x, moved)
        assert (near[:, 0] == (plain * 40 + np.arange(40)).argmin(axis=1)).all()
        roots = np.sqrt(plain)
        rest = roots.copy()
        np.put_along_axis(rest, near, np.inf, axis=1)
        assert (bounds[:, 0] >= roots.min(axis=1)).all() and (bounds[:, b] <= rest.min(axis=1)).all()
        listed = np.take_along_axis(roots, near, axis=1)
        lowest = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        assert (lowest[:, 1:b] <= listed[:, 1:]).all()
    assert (depth == 0).mean() > 0.9


def test_b_follows_what_was_looked_at():
    assert vc.adapted(8, np.array([90, 8, 2, 0, 0, 0, 0, 0, 0, 0, 0])) == 3
    assert vc.adapted(4, np.array([50, 0, 0, 0, 0, 0, 0, 0, 50])) == 8
    assert vc.adapted(4, np.array([100, 0, 0, 0, 0])) == 1


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.1], 1), (1, [0.5, -0.1], 1), (None, [0.25, 2.0], None), (2, None, 1), (3, [1.0, None], 1),
            (4, [inf, 0.0], 1), (5, [nan, 0.0], 2), (6, [], None), (7, [3.0], None), (0, [9.0, 9.0], 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], la) for i, v, la in rows]
    clash = df.selectExpr("*", "1 AS _id", "'x' AS code", "2 AS error", "3 AS _label", "4 AS _near")
    assert results(vc.compress(clash)) == plain_compress(plain)
    assert vc.compress(df.limit(0)).count() == 0
    assert vc.compress(df.where("vec_id = 2")).count() == 0
    with pytest.raises(Exception, match="too large"):
        vc.compress(spark.createDataFrame([(1, [3e38], 1)], SCHEMA)).collect()
