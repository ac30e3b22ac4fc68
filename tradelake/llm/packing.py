"""Sum-of-squares online packing of token sequences."""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import byte_slices, field, text_column

# Distinct words in each of a worker's two generations of remembered words.
REMEMBERED = 250_000
LONG_WORD = 64
# Rows handed to Spark at once, in bytes of ids.
OUT_BYTES = 4 << 20

_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
# Letters that the normalizer only lower-cases, one by one, then ASCII marks.
_LETTERS = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\\[-`{-~]*)")
_MARKED = re.compile(_LETTERS.pattern.replace("+)", "*)"))


def cuts_at_white_space(spec: dict) -> bool:
    """Whether white space only separates words, each encoded for itself.

    True where the normalizer works inside words or on white space, and the
    pre-tokenizer drops white space.  The letters a-z then lower-case A-Z.
    """
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = pre[0] if pre else {}
    known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
    drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")
    added = spec.get("added_tokens") or []
    whole = all(not (a["lstrip"] or a["rstrip"] or re.search(r"\s", a["content"])) for a in added)
    return bool(known and drops and whole)


# Formats of short lists, by length.
_FORMATS = [struct.Struct(f"<{n}I").pack for n in range(LONG_WORD + 1)]


def _packed(ids: list[int]) -> bytes:
    n = len(ids)
    return _FORMATS[n](*ids) if n <= LONG_WORD else struct.pack(f"<{n}I", *ids)


class _Words(dict):
    """Ids by word; a word that is not there is encoded and, unless it is long, remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encode(word)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    Words are encoded by the tokenizer's library, each distinct one once, and a
    text's ids are its words' ids in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = cuts_at_white_space(spec)
        # How the model writes the letters beyond ASCII.
        written = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: written(chr(c))[0][0] for c in range(0xC0, 0x100)}
        # Special strings are looked up before letters are lower-cased.
        self.special = [a["content"].lower() for a in spec.get("added_tokens") or []]
        # Those that may stand inside letters with marks behind.
        self.plain = [x for x in self.special if _MARKED.fullmatch(x)]
        # A full generation becomes the older one; words met again move on.
        self.words = _Words(self._word)
        self.older: dict[bytes, bytes] = {}
        # Letters, or marks, of a word: words with other marks behind have them in common.
        self.runs: dict[bytes, bytes] = {}
        self.older_runs: dict[bytes, bytes] = {}

    def _split(self, data: bytes) -> list[bytes]:
        lower = data.lower()
        return (data if any(x.encode() in lower for x in self.special) else lower).split()

    def _run(self, run: bytes) -> bytes:
        """Ids of one pre-token of letters, lower-cased, or of ASCII marks."""
        found = self.runs.get(run)
        if found is None:
            found = self.older_runs.get(run)
            if found is None:
                whole = run.decode()
                whole = whole if run.isascii() else whole.translate(self.letters)
                found = _packed([t.id for t in self.library.model.tokenize(whole)])
            self.runs[run] = found
        return found

    def _word(self, word: bytes) -> bytes:
        known = self.older.get(word)
        if known is not None:
            return known
        if len(word) <= LONG_WORD:
            letters = word.rstrip(_MARKS)
            # Bytes are letters if they are ASCII ones.
            if letters.isalpha():
                lower, marks = letters.lower(), word[len(letters) :]
            elif simple := _LETTERS.fullmatch(word.decode()):
                lower, marks = (part.encode() for part in (simple[1].lower(), simple[2]))
            else:
                lower = marks = b""
            if lower and not (self.plain and any(x in word.decode().lower() for x in self.plain)):
                return self._run(lower) + (self._run(marks) if marks else b"")
        return _packed(self.library.encode(word.decode(), add_special_tokens=False).ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
            return [_packed(e.ids) for e in encoded]
        if len(self.words) > REMEMBERED:
            self.older, self.words = self.words, _Words(self._word)
        if len(self.runs) > REMEMBERED // 4:
            self.older_runs, self.runs = self.runs, {}
        of = self.words.__getitem__
        return [b"".join(map(of, self._split(t.encode()))) for t in texts]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


class SumOfSquares:
    """Places items into windows of one capacity, one after the other.

    ``levels[h]`` counts the windows filled up to ``h``.  An item goes to the
    level (an empty window counts as level 0) for which the sum of the squared
    counts of partly filled levels becomes least; of equal ones to the fullest.
    """

    # Of a level without windows.
    NONE = 1 << 40

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list] = {}
        # By room left, the fullest level first: by how much the sum grows when a level
        # gets a window (a full one is no longer counted), and when it loses one.
        self.gain = np.ones(capacity + 1, np.int64)
        self.gain[0] = 0
        self.loss = np.full(capacity + 1, self.NONE, np.int64)
        self.loss[capacity] = 0

    def place(self, size: int) -> tuple[list, bool]:
        """The window's item list to append to, and whether it is full then."""
        room = self.capacity - size
        level = room - int(np.argmin(self.gain[: room + 1] + self.loss[size:]))
        if level:
            window = self.open[level].pop()
            self._count(level, -1)
        else:
            window = []
        full = level + size == self.capacity
        if not full:
            self.open.setdefault(level + size, []).append(window)
            self._count(level + size, 1)
        return window, full

    def _count(self, level: int, change: int) -> None:
        n, at = int(self.levels[level]) + change, self.capacity - level
        self.levels[level] = n
        self.gain[at] = 2 * n + 1
        self.loss[at] = 1 - 2 * n if n else self.NONE

    def rest(self) -> Iterator[list]:
        """The windows that are not full, the fullest first."""
        for level in sorted(self.open, reverse=True):
            yield from self.open[level]


def _piece_fields(id_field: T.StructField) -> T.StructType:
    names = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField(id_field.name, id_field.dataType), *(field(n, "bigint") for n in names)]
    return T.StructType([*fields, field("ids", "binary")])


def pack(
    df: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document, with its place in a packed sequence.

    ``id, start, length, doc_tokens, sequence_id, offset, ids``; ``ids`` are the
    piece's token ids as little-endian unsigned 32-bit numbers, ``doc_tokens``
    counts the document's ids with ``end_id`` behind them.

    Each scan task packs its own documents, without a shuffle: a document's
    whole windows are sequences of their own, its rest is placed by
    :class:`SumOfSquares`.  At most the partly filled windows are held in
    memory.  At the task's end the fullest of them stay as they are and are filled
    up with pieces cut from the emptiest; what then is left is cut at powers of
    two, which need no padding.  A sequence
    id holds the task's number above :data:`SEQUENCE_BITS` bits, so that a task
    run again after a loss gives the same rows.

    Null or empty text is the end id alone.  Repeated rows are packed each for
    itself.  An empty table gives no rows; further columns are ignored.
    """
    schema = _piece_fields(df.schema[id_col])
    kinds = [pa.int64()] * 5 + [pa.binary()]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), SumOfSquares(window)
        out = _Rows(TaskContext.get().partitionId())
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for lo, hi in byte_slices(sizes):
                ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                for doc, found in zip(ids, encode(texts.slice(lo, hi - lo).to_pylist()), strict=True):
                    data = found + end
                    n = len(data) // 4
                    whole = n - n % window
                    for start in range(0, whole, window):
                        out.sequence([(doc, start, n, data[4 * start : 4 * (start + window)])])
                    if whole < n:
                        held, full = packer.place(n - whole)
                        held.append((doc, whole, n, data[4 * whole :]))
                        if full:
                            out.sequence(held)
                    if out.bytes > OUT_BYTES:
                        yield out.batch(schema, kinds)
        for sequence in _closed(packer, window):
            out.sequence(sequence)
            if out.bytes > OUT_BYTES:
                yield out.batch(schema, kinds)
        yield out.batch(schema, kinds)

    return df.select(F.col(id_col), text_column(df, text_col).alias("_text")).mapInArrow(run, schema)


# Sequences that one task can number.
SEQUENCE_BITS = 36


class _Rows:
    """Pieces of finished sequences on their way to Spark."""

    def __init__(self, task: int):
        self.next = task << SEQUENCE_BITS
        self.bytes = 0
        self.rows: list[tuple] = []

    def sequence(self, parts: list[tuple]) -> None:
        offset = 0
        for doc, start, total, data in parts:
            length = len(data) // 4
            self.rows.append((doc, start, length, total, self.next, offset, data))
            offset += length
            self.bytes += len(data) + 64
        self.next += 1

    def batch(self, schema: T.StructType, kinds: list) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type

        columns = list(zip(*self.rows)) or [[] for _ in schema]
        types = [to_arrow_type(schema[0].dataType), *kinds]
        self.rows, self.bytes = [], 0
        arrays = [pa.array(c, k) for c, k in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)


def _closed(packer: SumOfSquares, window: int) -> Iterator[list[tuple]]:
    """The partly filled windows as whole ones, then powers of two.

    As many windows as their ids can fill, the fullest, stay as they were placed;
    the pieces of the others are cut to fill them up, and what then is left.
    """
    held = list(packer.rest())
    left = sum(_length(p) for w in held for p in w)
    kept, loose = held[: left // window], held[left // window :]
    pieces = (p for w in reversed(loose) for p in w)
    carry: tuple | None = None

    def filled(sequence: list[tuple], size: int) -> list[tuple]:
        nonlocal carry
        room = size - sum(map(_length, sequence))
        while room:
            doc, start, total, data = carry or next(pieces)
            n = min(room, len(data) // 4)
            sequence.append((doc, start, total, data[: 4 * n]))
            carry = (doc, start + n, total, data[4 * n :]) if 4 * n < len(data) else None
            room -= n
        return sequence

    for sequence in kept:
        yield filled(sequence, window)
    left %= window
    while left:
        size = 1 << (left.bit_length() - 1)
        yield filled([], size)
        left -= size


def _length(piece: tuple) -> int:
    return len(piece[3]) // 4
