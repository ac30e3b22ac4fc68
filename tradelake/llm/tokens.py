"""Token counts: batch encoding in Arrow functions, lengths only."""

from __future__ import annotations

import functools
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import field, per_text, text_column

# Distinct pieces whose length a worker remembers; all are forgotten beyond it.
REMEMBERED = 400_000
# Text per call of the tokenizer.
CALL_BYTES = 1 << 18
# Longer pieces are counted but not remembered.
LONG_PIECE = 64

# A blank inside a run of white space: the fast cut at every blank is unsafe there.
_UNSAFE = re.compile(r"\s \s|  ")
# Safe instead: before a run of white space that ends in a blank.
_CUT = re.compile(r"(?<=\S)(?= \S)")


def cuts_at_blanks(path: str) -> bool:
    """Whether the tokenizer's pre-tokens never reach from a letter over a blank.

    True for byte-level pre-tokenizers with the usual pattern and no normalizer:
    a pre-token there takes one leading blank at most, so a text may be cut
    before any single blank.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
    added = spec.get("added_tokens") or []
    whole = all(not (a["lstrip"] or a["rstrip"] or " " in a["content"]) for a in added)
    return bool(plain and not pre.get("add_prefix_space") and not spec.get("normalizer") and whole)


def pieces(text: str) -> list[str]:
    """Cut before single blanks that follow and precede something else."""
    if _UNSAFE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    out = [" " + word for word in rest]
    if first:
        out.insert(0, first)
    return out


class LengthCounter:
    """Numbers of tokens of texts, as the tokenizer's own library gives them."""

    def __init__(self, path: str):
        self.cut = pieces if cuts_at_blanks(path) else lambda text: [text] if text else []
        self.lengths: dict[str, int] = {}
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self.encode = lambda texts: [
                len(e) for e in library.encode_batch_fast(texts, add_special_tokens=False)
            ]
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(e) for e in model.encode(texts, num_threads=1)]

    def _learn(self, wanted: set[str]) -> dict[str, int]:
        if len(self.lengths) > REMEMBERED:
            self.lengths.clear()
        new = [p for p in wanted if p not in self.lengths]
        long = {}
        start = 0
        while start < len(new):
            end, size = start, 0
            while end < len(new) and (end == start or size < CALL_BYTES):
                size += len(new[end])
                end += 1
            for piece, n in zip(new[start:end], self.encode(new[start:end]), strict=True):
                (self.lengths if len(piece) <= LONG_PIECE else long)[piece] = n
            start = end
        return long

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [self.cut(t) for t in texts]
        long = self._learn(set().union(*cut))
        if not long:
            of = self.lengths.__getitem__
            return [sum(map(of, p)) for p in cut]
        known = self.lengths
        return [sum(known[x] if x in known else long[x] for x in p) for p in cut]


@functools.lru_cache(maxsize=4)
def counter(path: str) -> LengthCounter:
    """One per worker process, kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LengthCounter(path)


def count_tokens(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` per row; no shuffle.

    ``tokenizer`` is the path of a ``.json`` or ``.model`` file that every
    machine has.  Whole texts count, without begin, end or added special tokens;
    special strings inside a text are handled as the library does by default.
    Texts come in batches of about equal bytes.  Where the tokenizer allows
    it, texts are cut at safe blanks, so that a long text needs no more memory
    than a short one and a piece that occurs again is not encoded again.

    Null or empty text: 0 bytes, 0 tokens, not over the limit.  Repeated rows
    count each for itself; an empty table gives no rows; further columns are
    ignored.
    """

    def make():
        def work(texts):
            return [pa.array(counter(tokenizer)(texts), pa.int64())]

        return work

    counted = per_text(
        df.withColumn("_n_bytes", F.octet_length(text_column(df, text_col)).cast("long")),
        [text_col],
        [field("n_tokens", "bigint")],
        make,
        kept=[id_col, "_n_bytes"],
    )
    return counted.select(
        id_col,
        F.col("_n_bytes").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
