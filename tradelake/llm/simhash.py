"""SimHash near-dedup: fingerprints linked by a binary trie self-join."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import checkpointed, field, kept_rows, per_text, text_column
from tradelake.llm.components import components

BITS = 64
SEED = 42
# Shingles hashed at once.
HASHED = 1 << 16
# A trie node with more fingerprints is cut into smaller ones.
NODE_LIMIT = 4096
# Pairs of nodes, and fingerprints, that a task holds at once.
FRONTIER = 1 << 17
HELD = 1 << 16

# _LANES[x] has bit i of the byte x in its i-th byte.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    lanes = _LANES[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)]
    out = np.zeros(BITS, np.int64)
    for i in range(0, len(lanes), 255):  # a lane counts to 255
        out += lanes[i : i + 255].sum(axis=0, dtype=np.uint64).astype("<u8").view(np.uint8)
    return out


def fingerprint(text: str, shingle: int) -> int:
    """Bits that over half of the shingles' hashes have.

    A-Z are lower-cased and words are what blanks, tabs and line ends separate;
    a text of fewer words is one shingle, one without words has fingerprint 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = ends[min(shingle, len(words)) - 1 :]
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, HASHED):
        found = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[i : i + HASHED], last[i : i + HASHED])]
        counts += _bit_counts(np.array(found, np.uint64))
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id, _fp`` per row; the fingerprint's 64 bits as a (signed) long."""

    def make():
        def work(texts):
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            return [pa.array(found.view(np.int64))]

        return work

    return per_text(df, [text_col], [field("_fp", "bigint")], make, kept=[id_col, *keep])


def linked_pairs(codes: np.ndarray, groups: np.ndarray, budget: int, top: int) -> Iterator[np.ndarray]:
    """Index pairs within a group whose codes differ in at most ``budget`` bits.

    ``codes`` (unsigned, sorted within groups, distinct there) are the leaves of
    one trie per group; a node is a range of them that share their first
    bits.  Pairs of nodes, at first each group's root with itself, go down one
    bit at a time together; a pair whose paths differ in more bits than the
    budget is dropped with all below it.  ``top`` is the first bit looked at.
    """
    bounds = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True]).astype(np.int64)
    lo, hi = bounds[:-1], bounds[1:]
    some = hi - lo > 1
    lo, hi = lo[some], hi[some]
    stack = [(top, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, a0, a1, b0, b1, used = stack.pop()
        if not len(a0):
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack.append((bit, *(x[:half] for x in (a0, a1, b0, b1, used))))
            stack.append((bit, *(x[half:] for x in (a0, a1, b0, b1, used))))
            continue
        if bit < 0:
            yield np.stack([a0, b0], axis=1)
            continue
        a, b = _middle(codes, a0, a1, bit), _middle(codes, b0, b1, bit)
        same = a0 == b0
        apart = ~same
        children = [
            (a0, a, b0, b, used),
            (a, a1, b, b1, used),
            (a0, a, b, b1, used + 1),
            tuple(x[apart] for x in (a, a1, b0, b, used + 1)),
        ]
        a0, a1, b0, b1, used = (np.concatenate(x) for x in zip(*children))
        fits = (a0 < a1) & (b0 < b1) & (used <= budget) & ((a0 != b0) | (a1 - a0 > 1))
        stack.append((bit - 1, *(x[fits] for x in (a0, a1, b0, b1, used))))


def _middle(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where, in each range that agrees above ``bit``, the codes with that bit begin."""
    lo, hi = lo.copy(), hi.copy()
    one = np.uint64(1 << bit)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        ones = (codes[mid] & one) != 0
        hi[open_[ones]] = mid[ones]
        lo[open_[~ones]] = mid[~ones] + 1


def _forest(pairs: Iterator[np.ndarray], n: int) -> list[tuple[int, int]]:
    """Those pairs, one by one, that join two trees of the forest so far."""
    parent = list(range(n))
    out = []
    for part in pairs:
        for a, b in part.tolist():
            x, y = a, b
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a, b))
    return out


def _turned(code: Column, low: int, by: int) -> Column:
    """The lowest ``low`` bits turned left by ``by``."""
    if low == BITS:
        return F.shiftleft(code, by).bitwiseOR(F.shiftrightunsigned(code, BITS - by)) if by else code
    mask = (1 << low) - 1
    part = code.bitwiseAND(F.lit(mask))
    turned = F.shiftleft(part, by).bitwiseOR(F.shiftrightunsigned(part, low - by)) if by else part
    return code.bitwiseAND(F.lit(~mask)).bitwiseOR(turned.bitwiseAND(F.lit(mask)))


def _widths(bits: int, blocks: int) -> list[int]:
    return [bits * (i + 1) // blocks - bits * i // blocks for i in range(blocks)]


def _rekeyed(rows: DataFrame, fixed: int, budget: int) -> tuple[DataFrame, int]:
    """Each row once per block of the bits below ``fixed``, that block turned to the front.

    Two codes that differ in at most ``budget`` of those bits agree in one of
    ``budget + 1`` blocks: there they lie under one node, whose path is ``_key``.
    """
    free = BITS - fixed
    widths = _widths(free, budget + 1)
    least = min(widths)
    ways = []
    for i in range(budget + 1):
        code = _turned(F.col("_code"), free, sum(widths[:i]))
        way = F.col("_way") * (budget + 1) + i
        ways.append(F.struct(way.alias("_way"), code.alias("_code")))
    out = rows.select("_node", F.explode(F.array(*ways)).alias("_w")).select("_node", "_w._way", "_w._code")
    fixed += least
    return out.withColumn("_key", F.shiftrightunsigned("_code", BITS - fixed)), fixed


def _joined(rows: DataFrame, fixed: int, budget: int) -> DataFrame:
    """A spanning forest of the links under each node, as pairs of ``_node``."""
    schema = T.StructType([field("a", "bigint"), field("b", "bigint")])
    top = BITS - 1 - fixed

    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        node = t.column("_node").to_numpy()
        code = t.column("_code").to_numpy().view(np.uint64)
        way, key = t.column("_way").to_numpy(), t.column("_key").to_numpy()
        changes = np.r_[True, (way[1:] != way[:-1]) | (key[1:] != key[:-1])]
        groups = np.cumsum(changes)
        # Sorted as signed numbers; within a group all share the first bit.
        pairs = _forest(linked_pairs(code, groups, budget, top), len(node))
        found = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if sum(b.num_rows for b in held) >= HELD:
                # Only the last node may go on in what comes.
                t = pa.Table.from_batches(held).combine_chunks()
                way, key = t.column("_way").to_numpy(), t.column("_key").to_numpy()
                last = int(np.flatnonzero(np.r_[True, (way[1:] != way[:-1]) | (key[1:] != key[:-1])])[-1])
                if last:
                    yield links(t.slice(0, last).to_batches())
                    held = t.slice(last).to_batches()
            held.append(batch)
        if held:
            yield links(held)

    dealt = rows.repartition("_way", "_key").sortWithinPartitions("_way", "_key", "_code")
    return dealt.mapInArrow(run, schema)


def link_nodes(nodes: DataFrame, budget: int, limit: int = NODE_LIMIT) -> DataFrame:
    """Links ``a, b`` that connect what codes at most ``budget`` bits apart connect.

    ``nodes`` has a ``_node`` per distinct ``_code``.  The binary trie is walked in
    as many bit orders as there are blocks (one more than the budget), because two
    codes so close agree in a whole block: with that block first, they lie
    under one node at its depth.  The tries are dealt out by these nodes and each
    is joined with itself in a task.  A node with more than ``limit`` codes is
    first cut in the same way by blocks of the bits below, again and again,
    until at most a few bits are left, so that no task gets an unbounded one.
    """
    rows, fixed = _rekeyed(nodes.withColumn("_way", F.lit(0).cast("long")), 0, budget)
    out = None
    while True:
        if BITS - fixed > 16:
            large = checkpointed(rows.groupBy("_way", "_key").count().where(F.col("count") > limit).drop("count"))
            split = not large.isEmpty()
        else:
            split = False
        done = rows.join(large, ["_way", "_key"], "left_anti") if split else rows
        found = _joined(done, fixed, budget)
        out = found if out is None else out.union(found)
        if not split:
            return out
        rest = rows.join(large, ["_way", "_key"], "left_semi").select("_node", "_way", "_code")
        rows, fixed = _rekeyed(checkpointed(rest), fixed, budget)


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id, fingerprint, component_id`` per row, and the columns ``keep``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest identifier that can be reached over links.
    Equal fingerprints are one node, so copies make no pairs.

    Null or empty texts and texts without words have fingerprint 0 and are
    linked like any other.  Repeated rows are copies.  A null identifier is in
    the group of its fingerprint but names none; a group of nulls only has a
    null name.  An empty table gives no rows; further columns are ignored.
    """
    rows = checkpointed(fingerprints(df, id_col, text_col, shingle, keep))
    nodes = checkpointed(rows.groupBy(F.col("_fp").alias("_code")).agg(F.min(id_col).alias("_least")))
    links = link_nodes(nodes.select(F.col("_code").alias("_node"), "_code"), max_bits)
    found = components(links, "a", "b")
    rooted = nodes.join(found, nodes["_code"] == found["node"], "left")
    rooted = checkpointed(rooted.select("_code", "_least", F.coalesce("root", "_code").alias("_root")))
    least = checkpointed(rooted.groupBy("_root").agg(F.min("_least").alias("_best")))
    named = checkpointed(rooted.join(least, "_root").select("_code", "_best"))
    return rows.join(named, rows["_fp"] == named["_code"]).select(
        id_col,
        *keep,
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_best").alias("component_id"),
    )


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Of each group of :func:`near_groups` the row with the smallest identifier, all columns.

    In a group without identifiers one row per different text stays.  Rows that
    repeat identifier and text count as one.
    """
    key = F.concat_ws(":", F.md5(text_column(df, text_col)), df[id_col].cast("string"))
    texts = df.select(df[id_col], df[text_col], key.alias("_key"))
    groups = near_groups(texts, id_col, text_col, shingle, max_bits, keep=("_key",))
    kept = F.col(id_col).eqNullSafe(F.col("component_id"))
    # The row goes along as one value, so that its columns may have any name.
    keyed = df.select(F.struct("*").alias("_whole"), key.alias("_key"))
    return kept_rows(keyed, groups.select("_key", kept.alias("_kept")))
