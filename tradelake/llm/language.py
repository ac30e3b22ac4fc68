"""Language identification by prediction by partial matching (PPM)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import byte_slices, field, per_text, text_column

# Documents and bytes per language that the statistics are learned from.
TRAIN_DOCS = 200
TRAIN_BYTES = 400_000
# The longest context, in bytes.
ORDER = 4
# Bytes of all languages' tables together, which are broadcast.
TABLE_BYTES = 256 << 20
UNKNOWN = "und"
# Bytes scored, and code lengths computed, at once.
SCORED = 1 << 20
COMPUTED = 1 << 20

_BLANK = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def normalised(text: str) -> bytes:
    """Lower-cased; all of ASCII but letters is blank."""
    return text.lower().encode().translate(_BLANK)


class Contexts:
    """The tree of contexts of all languages: the symbols before a place, nearest first.

    A context of ``k`` symbols is a node of level ``k`` below the context without its
    farthest symbol, and :meth:`walk` goes down from the root as far as the text's
    symbols lead.  ``keys[k]`` numbers the contexts of a level in ascending order
    and ``above[k]`` has the place, one level up, of each one's parent.
    """

    def __init__(self, keys: list[np.ndarray], n: int):
        self.keys, self.n, self.order = keys, n, len(keys) - 1
        self.above = [np.zeros(1, np.int64)]
        self.above += [np.searchsorted(keys[k - 1], keys[k] % n ** (k - 1)) for k in range(1, self.order + 1)]
        starts = np.cumsum([0, *(len(k) for k in keys)])
        # A walk that finds no child stays: it goes on in a copy of the node without ways out.
        self.inner = int(starts[self.order])
        stay = self.inner + np.arange(self.inner, dtype=np.int32)
        below = np.repeat(np.concatenate([stay, stay])[:, None], n, axis=1)
        for k in range(1, self.order + 1):
            children = np.arange(starts[k], starts[k + 1]) + (self.inner if k == self.order else 0)
            below[starts[k - 1] + self.above[k], keys[k] // n ** (k - 1)] = children
        self.below = below.ravel()

    def walk(self, s: np.ndarray) -> np.ndarray:
        """The longest context known at each symbol of ``s`` from the place ``order`` on."""
        m = len(s) - self.order
        node = np.zeros(m, np.int32)
        for j in range(1, self.order + 1):
            node = self.below.take(node * self.n + s[self.order - j : self.order - j + m])
        return np.where(node >= self.inner, node - self.inner, node)

    def code_lengths(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Bits of each symbol (columns) in each context (rows) in one language.

        ``grams[k]`` are the language's contexts of level ``k`` with a symbol behind
        them, and how often each came.  Escape method C: a context seen ``m`` times
        with ``q`` different symbols gives a symbol seen ``c`` times c/(m+q), and
        q/(m+q) to the next shorter context, in which the symbols already excluded
        no longer count.  A context never seen gives way for nothing.  At the end
        all 256 bytes are equally likely.
        """
        counted = []
        for keys, (found, times) in zip(self.keys, grams):
            counts = np.zeros((len(keys), self.n), np.int32)
            counts[np.searchsorted(keys, found // self.n), found % self.n] = times
            counted.append(counts)
        rows, step = [], max(1, COMPUTED // self.n)
        for k, keys in enumerate(self.keys):
            for lo in range(0, len(keys), step):
                rows.append(self._rows(counted, k, np.arange(lo, min(lo + step, len(keys)))))
        return np.concatenate(rows)

    def _rows(self, counted: list[np.ndarray], level: int, nodes: np.ndarray) -> np.ndarray:
        bits = np.zeros((len(nodes), self.n))
        escaped = np.zeros((len(nodes), 1))
        open_ = np.ones((len(nodes), self.n), bool)  # not yet coded
        for k in range(level, -1, -1):
            counts = np.where(open_, counted[k][nodes], 0)
            seen = counts > 0
            total, kinds = counts.sum(-1, keepdims=True), seen.sum(-1, keepdims=True)
            whole = np.maximum(total + kinds, 1)
            bits = np.where(seen, escaped - np.log2(np.maximum(counts, 1) / whole), bits)
            escaped = escaped + np.where(total > 0, -np.log2(np.maximum(kinds, 1) / whole), 0)
            open_ &= ~seen
            nodes = self.above[k][nodes]
        return np.where(open_, escaped + 8, bits).astype(np.float32)


def _grams(texts: list[np.ndarray], n: int, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Contexts of no to ``order`` symbols with the symbol behind, as numbers, and their counts."""
    keys = [np.zeros(len(t) - order, np.int64) for t in texts]
    last = np.concatenate([t[order:] for t in texts])
    out = []
    for k in range(order + 1):
        if k:
            keys = [key + t[order - k : len(t) - k] * n ** (k - 1) for key, t in zip(keys, texts)]
        out.append(np.unique(np.concatenate(keys) * n + last, return_counts=True))
    return out


class Models:
    """Frozen code lengths of all languages."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER, table_bytes: int = TABLE_BYTES):
        self.names = sorted(samples)
        texts = {k: [b" " * order + normalised(t) for t in v] for k, v in samples.items()}
        seen = np.zeros(256, np.int64)
        for found in texts.values():
            for t in found:
                seen += np.bincount(np.frombuffer(t, np.uint8), minlength=256)
        # Bytes never learned from share the last symbol.
        used = np.flatnonzero(seen)
        self.n = len(used) + 1
        self.symbols = np.full(256, len(used), np.int32)
        self.symbols[used] = np.arange(len(used))
        coded = {k: [self.symbols[np.frombuffer(t, np.uint8)].astype(np.int64) for t in v] for k, v in texts.items()}
        grams = {k: _grams(v, self.n, order) for k, v in coded.items()}
        keys = [np.zeros(1, np.int64)]
        for k in range(1, order + 1):
            known = np.unique(np.concatenate([np.zeros(0, np.int64), *(g[k][0] // self.n for g in grams.values())]))
            nodes = sum(map(len, keys)) + len(known)
            # Where the tables would be too large, the tree is less deep.
            if not len(known) or nodes * self.n * 4 * len(self.names) > table_bytes:
                break
            keys.append(known)
        self.tree = Contexts(keys, self.n)
        self.tables = [self.tree.code_lengths(grams[k]).ravel() for k in self.names]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of every text (rows) in every language."""
        out = np.zeros((len(texts), len(self.names)))
        # A long text is scored in parts, each with the bytes before it as context.
        order = self.tree.order
        parts = [
            (i, (t[at - order : at] if at else b" " * order) + t[at : at + SCORED])
            for i, t in enumerate(texts)
            for at in range(0, len(t), SCORED)
        ]
        sizes = np.array([len(p) - order for _, p in parts], np.int64)
        for lo, hi in byte_slices(sizes, SCORED):
            rows = [i for i, _ in parts[lo:hi]]
            np.add.at(out, rows, self._scored([p for _, p in parts[lo:hi]], sizes[lo:hi]))
        return out

    def _scored(self, parts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        s = self.symbols[np.frombuffer(b"".join(parts), np.uint8)]
        at = self.tree.walk(s) * self.n + s[self.tree.order :]
        starts = np.concatenate([[0], np.cumsum(sizes + self.tree.order)[:-1]])
        # Sums from each part's start to its end; what lies between parts is left out.
        edges = np.stack([starts, starts + sizes], axis=1).ravel()
        sums = [np.add.reduceat(np.append(t[at], 0), edges, dtype=np.float64)[::2] for t in self.tables]
        return np.stack(sums, axis=1)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        bits = self.bits([normalised(t) for t in texts]) if self.names else np.zeros((len(texts), 0))
        names, scores = [], []
        for text, row in zip(texts, bits, strict=True):
            if not self.names or not any(map(str.isalpha, text)):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(np.argmin(row))
            names.append(self.names[best])
            scores.append(float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum()))
        return names, scores


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def learn(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = TRAIN_DOCS,
    max_bytes: int = TRAIN_BYTES,
) -> Models:
    """Models from a bounded sample of the rows that are not held out.

    Per language at most ``max_docs`` documents, those first in the order of a
    hash of their identifier, and of these as many whole texts as ``max_bytes``
    hold (the first one always).  Only they reach the driver.
    """
    rows = labelled.where(
        ~is_held_out(F.col(id_col)) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()
    )
    size = F.octet_length(text_column(rows, text_col))
    keys = rows.select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), size.alias("_size")
    ).withColumn("_order", F.xxhash64("_id"))
    ranked = Window.partitionBy("_lang").orderBy("_order", "_id")
    chosen = (
        keys.withColumn("_place", F.row_number().over(ranked))
        .where(F.col("_place") <= max_docs)
        .withColumn("_sum", F.sum("_size").over(ranked.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("_sum") <= max_bytes) | (F.col("_place") == 1))
        .select("_id", "_lang")
    )
    wanted = [(r[0], r[1]) for r in chosen.distinct().collect()]
    samples: dict[str, list[str]] = {lang: [] for _, lang in wanted}
    if wanted:
        texts = rows.where(F.col(id_col).isin([i for i, _ in wanted])).select(id_col, lang_col, text_col)
        known = set(wanted)
        for identifier, lang, text in sorted(texts.distinct().collect(), key=lambda r: (r[1], str(r[0]), r[2])):
            if (identifier, lang) in known:
                samples[lang].append(text)
    return Models(samples)


def identify(
    df: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, lang_pred, score`` per row.

    A text's code length under each language's frozen statistics is exact over
    its whole length; the shortest wins (the first name on a tie).  ``score`` is
    the winner's share when each language is as likely as its code is short.

    Null or empty text, and text without a letter, is ``und`` with score 0.
    Repeated rows count each for itself; an empty table gives no rows; further
    columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)

    def make():
        def work(texts):
            return shared.value.predict(texts)

        return work

    fields = [field("lang_pred", "string"), field("score", "double")]
    return per_text(df, [text_col], fields, make, kept=[id_col])


def keep_identified(df: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with a language, with all their columns.

    Rows go whose text has none (:data:`UNKNOWN`); one that fits several languages
    alike has one of them, and stays.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)
    place = df.schema.names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(place), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for lo, hi in byte_slices(sizes):
                names, _ = shared.value.predict(texts.slice(lo, hi - lo).to_pylist())
                mask = [n != UNKNOWN for n in names]
                yield batch.slice(lo, hi - lo).filter(pa.array(mask, pa.bool_()))

    return df.mapInArrow(run, df.schema)
