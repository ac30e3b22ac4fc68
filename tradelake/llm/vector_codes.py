"""Vector compression by part codebooks, assigned with adaptive distance bounds."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import checkpointed, field

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Closest entries that a part keeps at first, and rows handled at once, which share their b.
NEAR = 4
ROWS = 4096
# Bounds are kept as 32-bit floats, moved outwards by more than rounding can.
SLACK = 2e-7
# b grows while a larger share of all parts passes its outer bound.
BEYOND = 0.05

STATE = T.StructType(
    [
        field("_vector", "binary"),  # integer components, 32 bit
        field("_codes", "binary"),  # per part: its entry
        field("_near", "binary"),  # per part: b closest entries, the own one first
        field("_bounds", "binary"),  # per part: upper bound of the first, lower ones of the others, outer bound
    ]
)


def is_whole(vector: Column) -> Column:
    """Neither the vector nor a component is null, and all are finite."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def cuts(dim: int, parts: int) -> list[slice]:
    return [slice(dim * i // parts, dim * (i + 1) // parts) for i in range(parts)]


def as_integers(vectors: pa.Array, dim: int, largest: int) -> np.ndarray:
    """``floor(256 x)`` per component; a shorter vector ends in zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * SCALE)
    if len(whole) and np.abs(whole).max() > largest:
        raise OverflowError("a component is too large for distances of 64 bits")
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = whole.astype(np.int64)
    return out


def largest_component(dim: int, entries: int) -> int:
    """Up to here distances, times the number of entries, fit into 64 bits, and components into 32."""
    return min((1 << 31) - 1, isqrt((1 << 62) // (4 * max(1, dim) * entries)))


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows ``(n, w)`` to entries ``(k, w)`` or ``(n, k, w)``."""
    if entries.ndim == 3:
        diff = x[:, None, :] - entries
        return (diff * diff).sum(axis=2)
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    # Products of doubles are exact as long as every sum stays below 2**53.
    kind = np.float64 if 4 * int(most) ** 2 * max(1, x.shape[1]) < 1 << 53 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    found = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    return found.astype(np.int64)


def _above(distance: np.ndarray) -> np.ndarray:
    return (distance * (1 + SLACK)).astype(np.float32)


def _below(distance: np.ndarray) -> np.ndarray:
    return (np.maximum(distance, 0) * (1 - SLACK)).astype(np.float32)


def search(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``b`` closest entries in order, ties to the lower index, and their bounds."""
    k = len(book)
    # One number per distance and index, so that there are no ties.
    keys = squared(x, book) * k + np.arange(k)
    first = np.partition(keys, min(b, k - 1), axis=1)[:, : b + 1]
    first.sort(axis=1)
    near, roots = first[:, :b] % k, np.sqrt(first // k)
    bounds = np.empty((len(x), b + 1), np.float32)
    bounds[:, 0], bounds[:, 1 : roots.shape[1]] = _above(roots[:, 0]), _below(roots[:, 1:])
    bounds[:, roots.shape[1] :] = np.inf
    return near, bounds


def reassign(
    x: np.ndarray, book: np.ndarray, near: np.ndarray, bounds: np.ndarray, drift: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New ``near`` and ``bounds`` after each entry moved by ``drift``, and the entries looked at.

    A lower bound holds for its entry and all behind it.  Where the upper bound of the
    own entry lies below the first lower bound nothing can have changed.  Else the integer
    distance replaces the upper bound, and the entries up to the first lower bound above
    it are compared as integers; beyond the outer bound all entries are.
    """
    b, k = near.shape[1], len(book)
    upper = (bounds[:, 0] + drift[near[:, 0]]) * (1 + SLACK)
    lower = np.empty((len(x), b))
    lower[:, : b - 1] = bounds[:, 1:b] - drift[near[:, 1:]]
    lower[:, b - 1] = bounds[:, b] - drift.max(initial=0)
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1] * (1 - SLACK)
    depth = (lower <= upper[:, None]).sum(axis=1)
    unsure = np.flatnonzero(depth)
    own = squared(x[unsure], book[near[unsure, :1]])[:, 0]
    upper[unsure] = np.sqrt(own) * (1 + SLACK)
    depth[unsure] = (lower[unsure] <= upper[unsure, None]).sum(axis=1)

    new_near, new_bounds = near.copy(), np.empty_like(bounds)
    new_bounds[:, 0], new_bounds[:, 1:] = _above(upper), _below(lower)
    some = np.flatnonzero((depth > 0) & (depth < b))
    if len(some):
        keys = squared(x[some], book[near[some]]) * k + near[some]
        # Entries behind the depth stay where they are.
        out = np.arange(b) > depth[some, None]
        keys[out] = np.iinfo(np.int64).max
        order = np.argsort(keys, axis=1, kind="stable")
        new_near[some] = np.take_along_axis(near[some], order, axis=1)
        roots = np.sqrt(np.take_along_axis(keys, order, axis=1) // k)
        found = new_bounds[some, :b]
        found[~out] = np.where(np.arange(b) == 0, _above(roots), _below(roots))[~out]
        new_bounds[some, :b] = found
    every = np.flatnonzero(depth == b)
    if len(every):
        new_near[every], new_bounds[every] = search(x[every], book, b)
        depth[every] = k
    return new_near, new_bounds, depth


def resized(near: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``b`` entries of each part; the outer bound then covers the others."""
    if b >= near.shape[1]:
        return near, bounds
    outer = bounds[:, b:].min(axis=1)
    return near[:, :b], np.concatenate([bounds[:, :b], outer[:, None]], axis=1)


def _state(df: DataFrame, kept: list[str], vector: str, books: list[np.ndarray], dim: int, b: int) -> DataFrame:
    """The first assignment: all distances."""
    pieces, largest = cuts(dim, len(books)), largest_component(dim, len(books[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = as_integers(batch.column(len(kept)), dim, largest)
            yield _packed(batch, len(kept), x, [search(x[:, cut], book, b) for cut, book in zip(pieces, books)])

    rows = df.select(*kept, F.col(vector).cast("array<double>").alias("_v"))
    return rows.mapInArrow(run, _schema(df, kept))


def _moved(state: DataFrame, kept: list[str], books: list[np.ndarray], drifts: list[np.ndarray], dim: int) -> DataFrame:
    """The next assignment, from the persisted bounds."""
    pieces, n, k = cuts(dim, len(books)), len(kept), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            widths = pc.binary_length(batch.column(n + 2)).to_numpy() // len(books)
            for b in np.unique(widths).tolist():
                rows = batch.filter(pa.array(widths == b))
                x = _numbers(rows.column(n), np.int32, dim).astype(np.int64)
                near = _numbers(rows.column(n + 2), np.uint8, len(books), b).astype(np.int64)
                bounds = _numbers(rows.column(n + 3), np.float32, len(books), b + 1)
                found, depths = [], np.zeros(k + 1, np.int64)
                for p, (cut, book) in enumerate(zip(pieces, books)):
                    *part, depth = reassign(x[:, cut], book, near[:, p], bounds[:, p], drifts[p])
                    found.append(part)
                    depths += np.bincount(depth, minlength=k + 1)
                keep = adapted(b, depths)
                if keep > b:
                    found = [search(x[:, cut], book, keep) for cut, book in zip(pieces, books)]
                yield _packed(rows, n, x, [resized(*part, keep) for part in found])

    return state.mapInArrow(run, _schema(state, kept))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _schema(df: DataFrame, kept: list[str]) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in kept), *STATE.fields])


def _numbers(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(rows)], pa.binary())


def _packed(batch: pa.RecordBatch, n: int, x: np.ndarray, found: list) -> pa.RecordBatch:
    near = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
    made = (x.astype(np.int32), near[:, :, 0], near, np.stack([f[1] for f in found], axis=1))
    names = [batch.schema.names[i] for i in range(n)] + STATE.names
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), *map(_bytes, made)], names)


def _sums(state: DataFrame, books: list[np.ndarray], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry the sum of its parts (k, dim), and per part and entry their number.

    Each task adds up its share, so that it sends on one row per component of an entry.
    """
    pieces, k = cuts(dim, len(books)), len(books[0])
    schema = T.StructType([field(c, "bigint") for c in ("kind", "cell", "place", "value")])

    def zeros() -> tuple[np.ndarray, np.ndarray]:
        return np.zeros((k, dim), np.int64), np.zeros((len(books), k), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = zeros()
        for batch in _slices(batches):
            x = _numbers(batch.column(0), np.int32, dim).astype(np.int64)
            codes = _numbers(batch.column(1), np.uint8, len(books))
            for p, cut in enumerate(pieces):
                np.add.at(sums[:, cut], codes[:, p], x[:, cut])
                counts[p] += np.bincount(codes[:, p], minlength=k)
        rows = []
        for kind, found in enumerate((sums, counts)):
            cell, place = np.nonzero(found)
            rows.append(np.stack([np.full(len(cell), kind), cell, place, found[cell, place]], axis=1))
        flat = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(flat[:, i]) for i in range(4)], schema.names)

    parts = state.select("_vector", "_codes").mapInArrow(run, schema)
    out = zeros()
    for r in parts.groupBy("kind", "cell", "place").agg(F.sum("value").alias("value")).collect():
        out[r["kind"]][r["cell"], r["place"]] = r["value"]
    return out


def adapted(b: int, depths: np.ndarray) -> int:
    """The next b: twice as many where too many parts pass the outer bound, else as many as were looked at.

    ``depths[j]``: parts of which j entries behind the own one were looked at, in the last place all.
    """
    k, total = len(depths) - 1, max(1, int(depths.sum()))
    if int(depths[k]) > BEYOND * total:
        return min(2 * b, k)
    within = np.flatnonzero(depths[:b])
    return min(b, int(within.max(initial=0)) + 1)


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    near: int = NEAR,
) -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256`` per whole vector.

    Components are ``floor(256 x)``, vectors are cut into equal parts.  Each part's codebook
    starts as that part of the vectors with the smallest identifiers; each round
    assigns all parts to their nearest entries (ties to the lower index) and replaces
    an entry by the floored mean of its parts; unused ones stay.  ``code`` has two hex
    digits per part, ``error`` is the sum of the final squared distances, ``label_error`` its
    sum over all rows of that label (those without one together).

    Every part keeps its ``b`` closest entries (at first ``near``) in order with lower
    bounds of their distances and an outer bound for all others, persisted from
    round to round.  When entries move the bounds give way by as much; only where they no
    longer prove the assignment are distances computed, as integers.  ``b`` follows
    what rows needed in the last round.

    Vectors that are null or hold a null or a value that is not finite are dropped.
    A null identifier comes after all others as a start; repeated rows are rows of their
    own, and among equal identifiers the smaller vector is the earlier start.  With fewer
    vectors than entries the codebooks are shorter.  A vector shorter than the longest
    ends in zeros; a length that parts do not divide gives parts of nearly the same
    length.  Components too large for distances of 64 bits fail the job.  An empty
    table gives no rows; further columns are ignored.
    """
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).cast("array<double>").alias("_v")
    ).where(is_whole(F.col("_v")))
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).collect()
    dim = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    # Without rows there is nothing to assign; one entry keeps the shapes.
    start = pa.array([r["_v"] for r in first] or [[]], pa.list_(pa.float64()))
    seeds = as_integers(start, dim, largest_component(dim, entries))
    pieces = cuts(dim, parts)
    books = [seeds[:, cut] for cut in pieces]
    kept = ["_id", "_label"]
    state = checkpointed(_state(rows, kept, "_v", books, dim, min(near, len(seeds))))
    for turn in range(rounds):
        sums, counts = _sums(state, books, dim)
        drifts, new = [], []
        for p, cut in enumerate(pieces):
            used = counts[p] > 0
            book = books[p].copy()
            book[used] = sums[used][:, cut] // counts[p][used, None]
            drift = book - books[p]
            drifts.append(np.sqrt((drift * drift).sum(axis=1)) * (1 + SLACK))
            new.append(book)
        books = new
        moved = _moved(state, kept, books, drifts, dim)
        state = moved if turn == rounds - 1 else checkpointed(moved)
    return _results(state, books, dim, id_col)


def _results(state: DataFrame, books: list[np.ndarray], dim: int, id_col: str) -> DataFrame:
    pieces = cuts(dim, len(books))
    identifier, label = state.schema["_id"], state.schema["_label"]
    schema = T.StructType([identifier, label, field("code", "string"), field("error", "bigint")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = _numbers(batch.column(2), np.int32, dim).astype(np.int64)
            codes = _numbers(batch.column(3), np.uint8, len(books))
            error = np.zeros(len(x), np.int64)
            for p, cut in enumerate(pieces):
                error += squared(x[:, cut], books[p][codes[:, p], None, :])[:, 0]
            texts = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, pa.array(error)], schema.names)

    coded = checkpointed(state.select("_id", "_label", "_vector", "_codes").mapInArrow(run, schema))
    totals = coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    numbers = (str(n) for book in books for entry in book.tolist() for n in entry)
    digest = sha256(",".join(numbers).encode()).hexdigest()
    return coded.join(totals, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
