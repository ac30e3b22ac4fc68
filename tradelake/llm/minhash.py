"""MinHash near-dedup: an inverted index of signature coordinates, joined with itself."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import checkpointed, field, per_text, text_column
from tradelake.llm.components import components

SHINGLE = 3
PERCENT = 85
COORDINATES = 64
SEED = 42
# Chance that a pair of just the similarity asked for has fewer equal coordinates than the threshold.
MISS = 1e-9
# Shingles hashed at once, and numbers compared at once.
HASHED = 1 << 16
COMPARED = 1 << 22
# A group of more documents, or with more shingles, is cut.
GROUP_ROWS = 1024
GROUP_SHINGLES = 1 << 21
# Bits of the filter that says which texts are read again; a fixed size, whatever the input.
FILTER_BITS = 1 << 26
# Distances from a group's hub are told apart in this many steps up to the largest of a link.
STEPS = 3

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def match_threshold(coordinates: int, percent: int, miss: float = MISS) -> int:
    """Most equal coordinates that a pair ``percent`` similar has but for a chance of ``miss``."""
    p, tail, t = percent / 100, 0.0, 0
    while t < coordinates:
        tail += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if tail > miss:
            break
        t += 1
    return max(1, t)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's distinct runs of words.

    A-Z are lower-cased and words are what blanks, tabs and line ends separate;
    a text of fewer words is one shingle, one without words has none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts, last = [0, *ends], ends[min(shingle, len(words)) - 1 :]
    out, digest = np.empty(n, np.uint64), xxhash.xxh64_intdigest
    for i in range(0, n, HASHED):
        found = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[i : i + HASHED], last[i : i + HASHED])]
        out[i : i + len(found)] = found
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Per coordinate the least of the hashes under a permutation of its own, 32 bits of it."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[i : i + 1024, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def signed_rows(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: identifier, a key of the row, size and digest of its shingle set, signature."""

    def make():
        def work(texts):
            sets = [shingle_set(t, shingle) for t in texts]
            return (
                [len(s) for s in sets],
                [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                [signature(s).view(np.int32) for s in sets],
            )

        return work

    fields = [field("n_shingles", "bigint"), field("_digest", "binary"), field("_sig", T.ArrayType(T.IntegerType()))]
    return per_text(_keyed(df, id_col, text_col), ["_text"], fields, make, kept=["_id", "_key"])


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_column(df, text_col)
    name = F.coalesce(df[id_col].cast("string"), F.lit(""))
    # The length tells where the identifier ends, and a null one from the empty text.
    size = F.coalesce(F.char_length(df[id_col].cast("string")), F.lit(-1)).cast("string")
    key = F.unhex(F.md5(F.concat(size, F.lit(":"), name, text)))
    return df.select(df[id_col].alias("_id"), text.alias("_text"), key.alias("_key"))


# --- the inverted index -------------------------------------------------------------


def postings(nodes: DataFrame, threshold: int) -> DataFrame:
    """``_token, _node, _centre``: every node under the rarest of its coordinate-value pairs.

    A token is a coordinate and its value.  Two signatures with ``threshold``
    equal coordinates share one of the ``coordinates - threshold + 1`` rarest tokens of either,
    in one order for all; so only those are posted.  Tokens that one node alone has
    come first in that order and are never posted.  ``_centre`` is how
    often the node's tokens stand elsewhere.
    """
    at = nodes.select("_node", F.posexplode("_sig").alias("_at", "_value"))
    token = F.shiftleft(F.col("_at").cast("bigint"), 32).bitwiseOR(F.col("_value").cast("bigint").bitwiseAND(F.lit((1 << 32) - 1)))
    tokens = at.select("_node", token.alias("_token"))
    common = checkpointed(tokens.groupBy("_token").agg(F.count("*").alias("_df")).where("_df > 1"))
    # At most one entry per coordinate.
    listed = tokens.join(common, "_token").groupBy("_node").agg(
        F.array_sort(F.collect_list(F.struct("_df", "_token"))).alias("_tokens")
    )
    rarest = F.slice("_tokens", 1, F.greatest(F.size("_tokens") - (threshold - 1), F.lit(0)))
    centre = F.aggregate("_tokens", F.lit(0).cast("bigint"), lambda a, t: a + t["_df"])
    posted = listed.select("_node", centre.alias("_centre"), F.explode(rarest).alias("_t"))
    return posted.select("_t._token", "_node", "_centre")


def hub_groups(posted: DataFrame) -> DataFrame:
    """``_hub, _node``: lists of one hub as one group, each node in it once, the hub too.

    A list's hub is its most central node.  The many lists that a set of near
    copies has in common have the same hub, so their nodes meet once and not list by list.
    """
    hubs = posted.groupBy("_token").agg(F.max(F.struct("_centre", "_node")).alias("_top"), F.count("*").alias("_n"))
    hubs = checkpointed(hubs.where("_n > 1").select("_token", F.col("_top._node").alias("_hub")))
    return posted.join(hubs, "_token").select("_hub", "_node").distinct()


# --- counting collisions, confirming links ----------------------------------------


def confirmed(own: np.ndarray, others: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """Sizes of the intersections of one set with others, some at a time."""
    sizes = np.array([len(o) for o in others])
    start = 0
    while start < len(others):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), COMPARED, side="right")))
        flat = np.concatenate(others[start:end])
        place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        yield np.add.reduceat((own[place] == flat).astype(np.int64), np.r_[0, np.cumsum(sizes[start:end])[:-1]])
        start = end


def forest(
    sets: Sequence[np.ndarray], side: np.ndarray, joined: np.ndarray, threshold: int, percent: int
) -> list[tuple[int, int]]:
    """Links, as index pairs, that join what all links among the sets join.

    ``side`` 0 meets ``side`` 1; with one side only, all meet.  Those ``joined`` are
    known to be connected already.  Collisions of signatures are counted rarest coordinates
    first: who has none among the first ``coordinates - threshold + 1`` is out, and who cannot
    reach the threshold any more is skipped from then on.  What reaches it is confirmed on
    the full sets.
    """
    n = len(sets)
    if n < 2:
        return []
    codes, sizes = np.stack([signature(s) for s in sets]), np.array([len(s) for s in sets])
    rarest = np.argsort([-len(np.unique(codes[:, c])) for c in range(COORDINATES)], kind="stable")
    codes = codes[:, rarest]
    prefix = COORDINATES - threshold + 1
    label = np.arange(n)
    if joined.any():
        label[joined] = np.flatnonzero(joined)[0]
    two = len(np.unique(side)) > 1
    right, out = np.flatnonzero(side == 1), []
    for i in np.flatnonzero(side == 0) if two else range(n):
        js = right if two else np.arange(i + 1, n)
        near = 100 * np.minimum(sizes[js], sizes[i]) >= percent * np.maximum(sizes[js], sizes[i])
        js = js[near & (label[js] != label[i])]
        count = np.zeros(len(js), np.int64)
        for start in range(0, COORDINATES, 8):
            end = min(start + 8, COORDINATES)
            count += (codes[js, start:end] == codes[i, start:end]).sum(axis=1)
            alive = (count + COORDINATES - end >= threshold) & ((count > 0) | (end < prefix))
            js, count = js[alive], count[alive]
            if not len(js):
                break
        if not len(js):
            continue
        both = np.concatenate(list(confirmed(sets[i], [sets[j] for j in js])))
        for j in js[100 * both >= percent * (sizes[i] + sizes[js] - both)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((i, j))
    return out


LINK = T.StructType([field("a", "bigint"), field("b", "bigint")])


def _sets(table: pa.Table) -> list[np.ndarray]:
    column = table.column("_set").combine_chunks()
    flat, ends = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy()
    ends = ends - ends[0]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _group_links(rows: DataFrame, keys: list[str], threshold: int, percent: int) -> DataFrame:
    """Links among the rows with the same keys: ``_node, _set, _side, _joined``."""

    def links(group: pa.Table) -> pa.Table:
        node = group.column("_node").to_numpy()
        side = group.column("_side").to_numpy()
        joined = group.column("_joined").to_numpy(zero_copy_only=False)
        pairs = np.array(forest(_sets(group), side, joined, threshold, percent), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(node[pairs[:, 0]]), "b": pa.array(node[pairs[:, 1]])})

    return rows.groupBy(*keys).applyInArrow(links, LINK)


def _from_hub(rows: DataFrame, percent: int) -> DataFrame:
    """``_hub, _node, _n, _step, _linked``: how far each node of a large group is from its hub.

    ``rows`` have the node, its set and the share (``_salt``) of the group that it is in; the hub
    is in every share.
    """
    schema = T.StructType(
        [field("_hub", "bigint"), field("_node", "bigint"), field("_n", "bigint"), field("_step", "bigint"), field("_linked", T.BooleanType())]
    )

    def measure(group: pa.Table) -> pa.Table:
        node, hub = group.column("_node").to_numpy(), group.column("_hub").to_numpy()
        sets, own = _sets(group), int(np.flatnonzero(node == hub)[0])
        rest = np.flatnonzero(node != hub)
        both = np.concatenate([np.zeros(0, np.int64), *confirmed(sets[own], [sets[i] for i in rest])])
        sizes = np.array([len(sets[i]) for i in rest], np.int64)
        union = sizes + len(sets[own]) - both
        # Distance 1 - both/union, in steps of (1 - percent/100) / STEPS, in whole numbers.
        step = STEPS * 100 * (union - both) // ((100 - percent) * np.maximum(union, 1))
        return pa.table(
            [hub[rest], node[rest], sizes, step, 100 * both >= percent * union], schema=pa.schema(
                [("_hub", pa.int64()), ("_node", pa.int64()), ("_n", pa.int64()), ("_step", pa.int64()), ("_linked", pa.bool_())])
        )

    return rows.groupBy("_hub", "_salt").applyInArrow(measure, schema)


def _shares(n: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(n / GROUP_ROWS), F.ceil(shingles / GROUP_SHINGLES)).cast("int")


def _salt(shares: Column) -> Column:
    return F.pmod(F.xxhash64("_node"), shares).cast("int")


def large_group_links(rows: DataFrame, sizes: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Links of groups too large for one task: ``rows`` are ``_hub, _node, _n, _set``.

    First each node is measured against the hub, in shares of bounded size.  The Jaccard
    distance is a metric: linked nodes differ by at most one link's distance in how far they
    are from the hub.  So the group is cut into steps of that distance (and shares, where many are
    equally far), and only parts close enough meet, two by two.  Nodes linked with
    the hub need not meet each other.
    """
    every = rows.join(sizes.select("_hub", "_shares"), "_hub")
    salts = F.when(F.col("_node") == F.col("_hub"), F.sequence(F.lit(0), F.col("_shares") - 1)).otherwise(
        F.array(_salt(F.col("_shares")))
    )
    star = checkpointed(_from_hub(every.select("_hub", "_node", "_set", F.explode(salts).alias("_salt")), percent))
    steps = star.groupBy("_hub", "_step").agg(_shares(F.count("*"), F.sum("_n")).alias("_shares"))
    # As many entries as there are steps up to distance 1.
    layout = checkpointed(steps.groupBy("_hub").agg(F.map_from_entries(F.collect_list(F.struct("_step", "_shares"))).alias("_layout")))

    placed = star.join(layout, "_hub").withColumn("_own", _salt(F.element_at("_layout", F.col("_step"))))
    close = F.filter(
        F.map_keys("_layout"), lambda s: (F.abs(s - F.col("_step")) <= STEPS) & ~((s < STEPS) & (F.col("_step") < STEPS))
    )

    def cells(s: Column) -> Column:
        salts = F.sequence(F.lit(0), F.element_at("_layout", s) - 1)
        return F.transform(salts, lambda z: F.struct(s.alias("step"), z.alias("salt")))

    own = F.struct(F.col("_step").alias("step"), F.col("_own").alias("salt"))
    met = placed.select(
        "_hub", "_node", "_linked", own.alias("_cell"), F.explode(F.flatten(F.transform(close, cells))).alias("_other")
    ).select(
        "_hub",
        "_node",
        F.col("_linked").alias("_joined"),
        F.least("_cell", "_other").alias("_a"),
        F.greatest("_cell", "_other").alias("_b"),
        (F.col("_cell") > F.col("_other")).cast("int").alias("_side"),
    )
    keys = ["_hub", "_a_step", "_a_salt", "_b_step", "_b_salt"]
    flat = met.select(
        "_hub", "_node", "_joined", "_side",
        F.col("_a.step").alias("_a_step"), F.col("_a.salt").alias("_a_salt"),
        F.col("_b.step").alias("_b_step"), F.col("_b.salt").alias("_b_salt"),
    )
    sets = rows.select("_hub", "_node", "_set")
    found = _group_links(flat.join(sets, ["_hub", "_node"]), keys, threshold, percent)
    return found.union(star.where("_linked").select("_hub", "_node"))


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    miss: float = MISS,
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` per row.

    Documents whose sets of distinct shingles have an intersection of at least ``percent`` of
    their union are linked; ``component_id`` is the smallest identifier that can be
    reached over links, and the row that has it is kept.

    Every set is posted under the coordinate-value pairs of its MinHash signature; pairs with
    too few equal coordinates (:func:`match_threshold`) are dropped, the others confirmed
    on their full sets, held as 64-bit hashes of the shingles.  Equal sets are one
    node, and each task gives back only links that join something, so copies make no pairs.

    Null or empty texts and texts without words have no shingles and are linked with nothing,
    not even each other.  Repeated rows are copies.  A null identifier is in the group of
    its text but names none; a group of nulls only has a null name, and all its rows count
    as kept.  An empty table gives no rows; further columns are ignored.
    """
    threshold = match_threshold(COORDINATES, percent, miss)
    rows = checkpointed(signed_rows(df, id_col, text_col, shingle))
    worded, wordless = rows.where("n_shingles > 0"), rows.where("n_shingles = 0")
    sets = worded.select("_digest", "_id", F.struct("_key", "n_shingles", "_sig").alias("_one"))
    nodes = checkpointed(
        sets.groupBy("_digest")
        .agg(F.min("_one").alias("_one"), F.min("_id").alias("_least"))
        .select("_digest", "_least", "_one.*", F.monotonically_increasing_id().alias("_node"))
    )
    members = checkpointed(hub_groups(checkpointed(postings(nodes, threshold))))
    links = _links(members, nodes, _keyed(df, id_col, text_col), shingle, threshold, percent)
    found = components(links, "a", "b")
    rooted = checkpointed(
        nodes.select("_digest", "_least", "_node")
        .join(found, nodes["_node"] == found["node"], "left")
        .select("_digest", "_least", F.coalesce("root", "_node").alias("_root"))
    )
    best = checkpointed(rooted.groupBy("_root").agg(F.min("_least").alias("_best")))
    named = checkpointed(rooted.join(best, "_root").select("_digest", "_best"))
    columns = ["_id", "n_shingles", "_best"]
    out = worded.join(named, "_digest").select(*columns).unionByName(wordless.withColumn("_best", F.col("_id")).select(*columns))
    return out.select(
        F.col("_id").alias(id_col),
        "n_shingles",
        F.col("_best").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_best")).alias("kept"),
    )


def _filtered(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts whose key may be among the wanted ones, so that few others are shuffled.

    A bit per hash of a wanted key, 64 to a row: at most ``FILTER_BITS / 64`` rows are
    broadcast.  With far more keys than bits all texts pass, and the join that follows sorts them out.
    """

    def bit(df: DataFrame) -> DataFrame:
        at = F.pmod(F.xxhash64("_key"), F.lit(FILTER_BITS))
        return df.withColumn("_word", F.shiftright(at, 6)).withColumn("_bit", F.expr("shiftleft(1L, cast(pmod(xxhash64(_key), 64) AS int))"))

    words = bit(wanted).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = bit(texts).join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return met.select(*texts.columns)


def _links(members: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, threshold: int, percent: int) -> DataFrame:
    """A forest of the confirmed links within the groups, by nodes."""
    # Only texts with a possible partner are read into sets again.
    wanted = checkpointed(members.select("_node").distinct().join(nodes.select("_node", "_key"), "_node"))
    maybe = _filtered(texts.select("_key", "_text"), wanted)
    again = maybe.join(wanted, "_key").groupBy("_key", "_node").agg(F.first("_text").alias("_text"))

    def make():
        return lambda found: [[s.view(np.int64) for s in (shingle_set(t, shingle) for t in found)]]

    sets = per_text(again, ["_text"], [field("_set", T.ArrayType(T.LongType()))], make, kept=["_node"])
    sets = checkpointed(sets.withColumn("_n", F.size("_set").cast("bigint")))
    sizes = members.join(sets.select("_node", "_n"), "_node").groupBy("_hub").agg(
        _shares(F.count("*"), F.sum("_n")).alias("_shares")
    )
    large = checkpointed(sizes.where("_shares > 1"))
    small = members.join(large, "_hub", "left_anti").join(sets, "_node")
    found = _group_links(
        small.select("_hub", "_node", "_set", F.lit(0).alias("_side"), F.lit(False).alias("_joined")), ["_hub"], threshold, percent
    )
    if large.isEmpty():
        return found
    rows = members.join(large, "_hub", "left_semi").join(sets, "_node")
    return found.union(large_group_links(rows, large, threshold, percent))
