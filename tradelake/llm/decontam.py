"""Benchmark decontamination by a generalised suffix automaton of the items."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import byte_slices, checkpointed, field, text_column

# Benchmark text per automaton; a larger benchmark takes several passes.  A block's states take about 110
# times its text, in the driver while it is built and in each Python worker.
BLOCK_BYTES = 1 << 20

_OTHER = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_TABLE = bytes.maketrans(
    _OTHER + bytes(range(0x41, 0x5B)), b" " * len(_OTHER) + bytes(range(0x61, 0x7B))
)


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased: digits, letters and all beyond ASCII."""
    return text.encode().translate(_TABLE).split()


def word_places(text: str) -> list[tuple[int, int]]:
    """Code point ranges of :func:`words_of`."""
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


class Automaton:
    """All word sequences that occur in some item.

    A state stands for sequences that end at the same places; ``link`` leads to
    the longest suffix that ends at more of them.  ``grams`` has the items of a
    state's suffix of ``window`` words, ``short`` those items of fewer words that
    end there as a whole.
    """

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        named = [(name, words_of(text)) for name, text in items]
        for _, words in named:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.grams: dict[int, set[str]] = {}
        ends: dict[int, list[tuple[int, str]]] = {}
        for name, words in named:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.grams.setdefault(self._suffix(state, window), set()).add(name)
            if 0 < len(words) < window:
                ends.setdefault(self._suffix(state, len(words)), []).append((len(words), name))
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            found = ends.get(state, []) + self.short.get(self.link[state], [])
            if found:
                self.short[state] = found

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = self._new(self.length[last] + 1, {}, 0)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at != -1:
            known = self.next[at][word]
            fits = self.length[known] == self.length[at] + 1
            self.link[state] = known if fits else self._clone(at, word, known)
        return state

    def _clone(self, at: int, word: bytes, known: int) -> int:
        clone = self._new(self.length[at] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = clone
        while at != -1 and self.next[at].get(word) == known:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def _new(self, length: int, following: dict[bytes, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _suffix(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words (ascending, apart) and the items that hit."""
        following, link, length, window = self.next, self.link, self.length, self.window
        short, root = self.short, self.next[0]
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state, matched, step = 0, 0, root
        for i, word in enumerate(words):
            to = step.get(word)
            if to is None:
                if not state:
                    continue
                while state and word not in step:
                    state = link[state]
                    step = following[state]
                matched = length[state]
                to = step.get(word)
                if to is None:
                    continue
            state, matched, step = to, matched + 1, following[to]
            hit = 0
            if matched >= window:
                hit = matched
                items |= self.grams[self._suffix(state, window)]
            if state in short:
                for n, name in short[state]:
                    if n <= matched:
                        items.add(name)
                        hit = max(hit, n)
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(
    benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int = BLOCK_BYTES
) -> list[DataFrame]:
    """The items (item, text) in blocks of about ``block_bytes`` of text."""
    name = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    text = text_column(benchmark, text_col)
    items = benchmark.select(name.alias("item"), text.alias("text"))
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    if blocks == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) for block in range(blocks)]


def _shared(items: DataFrame, window: int) -> Broadcast:
    """The automaton of one block of items; the driver keeps none."""
    automaton = Automaton([(r[0], r[1]) for r in items.collect()], window)
    return items.sparkSession.sparkContext.broadcast(automaton)


SPANS = T.ArrayType(T.StructType([field("start", "bigint"), field("end", "bigint")]))
NAMES = T.ArrayType(T.StringType())


def find_overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    keep: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``id, n_words, word_spans, item_ids`` per row, and the columns ``keep``.

    A document's words run through the automaton of the items; wherever the
    longest match reaches ``window`` words, or a whole item of fewer words ends,
    the matched words are hit.  ``word_spans`` are the ranges of hit words (end
    exclusive, ascending, apart), ``item_ids`` the items met, sorted.

    The automaton of :data:`BLOCK_BYTES` of items at most is broadcast; each
    further block of a larger benchmark is a further pass over the documents.

    Null or empty texts have no words; items without words match nothing;
    equal items all count.  Repeated rows count each for itself; an empty table on
    either side is no hit; further columns are ignored.
    """
    kept = [id_col, *(c for c in keep if c != id_col)]
    found = df.select(
        *(F.col(c) for c in kept),
        text_column(df, text_col).alias("_text"),
        F.lit(None).cast(SPANS).alias("word_spans"),
        F.lit(None).cast(NAMES).alias("item_ids"),
    )
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    for i, items in enumerate(blocks):
        shared = _shared(items, window)
        found = _passed(found, kept, shared)
        if i + 1 < len(blocks):
            found = checkpointed(found)
            shared.destroy()
    return found.drop("_text")


def _passed(found: DataFrame, kept: list[str], shared: Broadcast) -> DataFrame:
    fields = [found.schema[c] for c in kept]
    schema = T.StructType(
        [*fields, field("_text", "string"), field("n_words", "bigint"), field("word_spans", SPANS)]
        + [field("item_ids", NAMES)]
    )
    n = len(kept)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = shared.value
        for batch in batches:
            sizes = pc.binary_length(batch.column(n)).to_numpy(zero_copy_only=False)
            for lo, hi in byte_slices(sizes):
                part = batch.slice(lo, hi - lo)
                before = zip(part.column(n + 1).to_pylist(), part.column(n + 2).to_pylist(), strict=True)
                counts, spans, items = [], [], []
                for text, (old_spans, old_items) in zip(part.column(n).to_pylist(), before, strict=True):
                    words = words_of(text)
                    here, met = matcher.hits(words)
                    if old_spans:
                        here = _merge([*here, *((s["start"], s["end"]) for s in old_spans)])
                    counts.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in here])
                    items.append(sorted(met.union(old_items or ())))
                arrays = [part.column(i) for i in range(n + 1)]
                arrays += [pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    columns = [*kept, "_text", "word_spans", "item_ids"]
    return found.select(*columns).mapInArrow(run, schema)


def cut_overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``df`` without the benchmark's passages, with the same columns.

    Hit words go, with all between them; what stays is joined by a line
    break and looked at again until nothing is hit.  A document of whose words
    more than ``max_coverage`` were hit goes as a whole.  Other rows stay as they
    are.  ``n_chars``, if there is such a column, follows the text.

    Of a benchmark in several blocks, the hits of all are gathered before a text is
    judged and cut, so that blocks change no result.  Every look at the texts is
    then a pass per block; after the first look only cut texts are looked at.
    """
    schema = df.schema
    place = schema.names.index(text_col)
    chars = schema.names.index("n_chars") if "n_chars" in schema.names else None
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    if len(blocks) == 1:
        shared = _shared(blocks[0], window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = shared.value
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
                for lo, hi in byte_slices(sizes):
                    yield _cleaned(batch.slice(lo, hi - lo), place, chars, matcher, max_coverage)

        return df.mapInArrow(run, schema)
    return _cut_by_blocks(df, blocks, place, chars, window, max_coverage)


# Columns of a row on its way through several blocks: the row's own, then these.
STATE = [field("_text", "string"), field("_total", "bigint"), field("_hit", "bigint")]


def _cut_by_blocks(
    df: DataFrame, blocks: list[DataFrame], place: int, chars: int | None, window: int, most: float
) -> DataFrame:
    """:func:`without_hits` for all rows, with one automaton at a time."""
    schema, own = df.schema, len(df.schema)
    inner = T.StructType([field(f"_c{i}", f.dataType) for i, f in enumerate(schema)])
    state = T.StructType([*inner, *STATE])
    looked = T.StructType([*state, field("_spans", SPANS), field("_names", NAMES)])
    rows = df.toDF(*inner.names)
    text = F.coalesce(F.col(f"_c{place}"), F.lit(""))
    rows = rows.select("*", text.alias("_text"), F.lit(None).cast("bigint").alias("_total"), F.lit(0).cast("bigint").alias("_hit"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, texts, totals, hits = [], [], [], []
            columns = (batch.column(own + k).to_pylist() for k in range(4))
            for i, (old, total, hit, spans) in enumerate(zip(*columns, strict=True)):
                spans = [(s["start"], s["end"]) for s in spans]
                total = len(words_of(old)) if total is None else total
                hit += sum(b - a for a, b in spans)
                if hit <= most * total or not spans:
                    keep.append(i)
                    texts.append(_cut(old, spans) if spans else old)
                    totals.append(total)
                    hits.append(hit)
            kept = batch.take(pa.array(keep, pa.int64()))
            arrays = [*kept.columns[:own], pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(hits, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, state.names)

    done = []
    while True:
        found = rows.select("*", F.lit(None).cast(SPANS).alias("word_spans"), F.lit(None).cast(NAMES).alias("item_ids"))
        for items in blocks:
            shared = _shared(items, window)
            found = checkpointed(_passed(found, [*inner.names, "_total", "_hit"], shared))
            shared.destroy()
        found = found.select(*state.names, F.col("word_spans").alias("_spans"), F.col("item_ids").alias("_names"))
        hit = F.size("_spans") > 0
        done.append(found.where(~hit).select(*state.names))
        if found.where(hit).isEmpty():
            break
        rows = checkpointed(found.where(hit).select(*looked.names).mapInArrow(cut, state))
    whole = functools.reduce(DataFrame.union, done)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, new = batch.column(place), batch.column(own)
            new = pc.if_else(pc.is_valid(old), new, old)
            yield _with_text(pa.RecordBatch.from_arrays(batch.columns[:own], schema.names), place, chars, new)

    return whole.select(*inner.names, "_text").mapInArrow(finished, schema)


def _cleaned(part, place: int, chars: int | None, matcher: Automaton, most: float):
    rows, texts = [], []
    for i, text in enumerate(part.column(place).to_pylist()):
        cut = without_hits(text or "", matcher, most)
        if cut is None:
            continue
        rows.append(i)
        texts.append(cut if text is not None else None)
    part = part.take(pa.array(rows, pa.int64()))
    return _with_text(part, place, chars, pa.array(texts, part.column(place).type))


def _with_text(part: pa.RecordBatch, place: int, chars: int | None, new: pa.Array) -> pa.RecordBatch:
    """The rows with another text, which ``n_chars`` follows."""
    arrays = list(part.columns)
    old, arrays[place] = arrays[place], new
    if chars is not None and pa.types.is_integer(arrays[chars].type):
        same = pc.fill_null(pc.equal(old, new), True)
        arrays[chars] = pc.if_else(same, arrays[chars], pc.cast(pc.utf8_length(new), arrays[chars].type))
    return pa.RecordBatch.from_arrays(arrays, part.schema.names)


def without_hits(text: str, matcher: Automaton, most: float) -> str | None:
    """The text without hit words; None if too many are."""
    words = words_of(text)
    total, hit = len(words), 0
    spans, _ = matcher.hits(words)
    while spans:
        hit += sum(b - a for a, b in spans)
        if hit > most * total:
            return None
        text = _cut(text, spans)
        spans, _ = matcher.hits(words_of(text))
    return text


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these words."""
    places, kept, at = word_places(text), [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "\n".join([*kept, text[at:]])
