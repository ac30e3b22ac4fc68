"""Personal data: patterns, and a skip-chain conditional random field beside them."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import bounded_sample, field, per_text

# Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0
LABELS = 1 + len(KINDS)

# Documents, and bytes of their texts, that the field is trained on.
TRAIN_DOCS = 4000
TRAIN_BYTES = 8 << 20
# Steps of the training, and how far equal labels are favoured before it.
STEPS = 150
PRIOR = 2.0
# Words of a document whose beliefs are computed at once, and further words on either side.
STRETCH = 20_000
OVERLAP = 64
# Digits that words of one number share, and words that one number is written in.
SAME_DIGITS = 7
NUMBER_WORDS = 6
# Rounds of message passing at most, the change at which it ends, and the belief above
# which a span is added.
ROUNDS = 60
CHANGE = 1e-3
BELIEF = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits begins: later in the run it would end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_BEHIND = re.compile(r"\s*(\S*)")
# Words with a digit or an at sign: only they can be personal data of these kinds.
_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the longest name before it that no match holds yet."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = found.end() if found else at + 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            yield m.span()


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns by start, then kind; code points, end exclusive."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [(a, 1, b) for a, b in _ips(text)]
        found += [(a, 2, b) for a, b in _cards(text)]
        if "+" in text:
            found += [(a, 3, b) for a, b in _phones(text)]
    return sorted(found)


def _words(text: str, spans: list[Span]) -> Iterator[tuple[int, int, int]]:
    """Start, end and label of each candidate word; a word in several spans has the first one's."""
    at, open_spans = 0, []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            open_spans.append(spans[at])
            at += 1
        open_spans = [s for s in open_spans if s[2] > start]
        yield start, end, open_spans[0][1] + 1 if open_spans else OUTSIDE


class Sequence:
    """A stretch of a document's candidate words with their edges, features and known labels.

    ``own`` are the words whose beliefs count; those around them are context.
    ``far`` are labels of matches elsewhere in the document that a word resembles.
    """

    __slots__ = ("words", "labels", "chain", "skip", "features", "keys", "own", "far")

    def __init__(self, text: str, spans: list[Span], words=None, own=None, known=None):
        words = list(_words(text, spans)) if words is None else words
        self.words = [(a, b) for a, b, _ in words]
        self.labels = [y for _, _, y in words]
        self.own = own or (0, len(words))
        self.chain = [(i, i + 1) for i in range(len(words) - 1) if _adjoin(text, self.words[i][1], self.words[i + 1][0])]
        self.keys, parts = _alike(text, self.words, self.labels, self.chain)
        # Each word is tied to the last one before it that it resembles: all
        # repetitions are connected by as many edges as words.  The words that make up
        # one number are tied to the number before, not to each other.
        self.skip = []
        last: dict[str, tuple[int | None, int]] = {}
        for i, keys in enumerate(self.keys):
            before = set()
            for key in keys:
                earlier, latest = last.get(key, (None, None))
                if not (latest is not None and latest == i - 1 and key == parts[i] == parts[i - 1]):
                    earlier = latest
                before |= {earlier} - {None}
                last[key] = earlier, i
            self.skip += [(j, i) for j in sorted(before)]
        self.far = []
        if known:
            here = self.matched_keys()
            for i, keys in enumerate(self.keys):
                labels = {known[k] for k in keys if k in known and k not in here}
                if not self.labels[i]:
                    self.far += [(i, y) for y in sorted(labels)]
        self.features = [_features(text, *w) for w in self.words]

    def matched_keys(self) -> dict[str, int]:
        return {k: y for keys, y in zip(self.keys, self.labels) if y for k in keys}


def stretches(text: str, spans: list[Span]) -> Iterator[Sequence]:
    """A document's words, all at once or, of long ones, :data:`STRETCH` at a time.

    Stretches overlap by :data:`OVERLAP` words on either side.  What a word resembles
    among the matches of the whole document is known in every stretch.
    """
    known: dict[str, int] | None = None
    held: list[tuple[int, int, int]] = []
    context = 0
    for word in _words(text, spans):
        held.append(word)
        if len(held) == context + STRETCH + OVERLAP:
            if known is None:
                known = _matches(text, spans)
            yield Sequence(text, spans, held, (context, context + STRETCH), known)
            first = max(0, context + STRETCH - OVERLAP)
            context += STRETCH - first
            held = held[first:]
    if len(held) > context:
        yield Sequence(text, spans, held, (context, len(held)), known)


def _matches(text: str, spans: list[Span]) -> dict[str, int]:
    """Label by key, of the words inside spans."""
    found: dict[str, int] = {}
    run: list[tuple[int, int, int]] = []

    def take() -> None:
        words = [(a, b) for a, b, _ in run]
        labels = [y for _, _, y in run]
        chain = [(i, i + 1) for i in range(len(run) - 1)]
        for keys, y in zip(_alike(text, words, labels, chain)[0], labels):
            found.update(dict.fromkeys(keys, y))
        run.clear()

    for word in _words(text, spans):
        if run and not (word[2] and _adjoin(text, run[-1][1], word[0]) and len(run) < STRETCH):
            take()
        if word[2]:
            run.append(word)
    take()
    return found


def _adjoin(text: str, end: int, start: int) -> bool:
    return start - end <= 2 and text[end:start].isspace()


def _alike(
    text: str, words: list[tuple[int, int]], labels: list[int], chain: list[tuple[int, int]]
) -> tuple[list[list[str]], list[str]]:
    """For each word, what it shares with those that repeat it or resemble it.

    The word without marks around it, the last digits of a long number, the name
    before an at sign; for neighbouring words that make up a number, its digits, which
    are also returned apart.
    """
    keys = []
    parts = [""] * len(words)
    for start, end in words:
        word = text[start:end]
        core = word.strip(".,;:!?()[]{}<>\"'").lower()
        digits = "".join(_DIGIT.findall(word))
        own = ["w" + core] if len(core) >= 5 else []
        own += ["d" + digits[-SAME_DIGITS:]] if len(digits) >= SAME_DIGITS else []
        name = core.partition("@")[0]
        keys.append(own + (["e" + name] if "@" in core and len(name) >= 3 else []))
    linked = {b for _, b in chain}
    start = 0
    for i in range(1, len(words) + 1):
        if i < len(words) and i in linked and labels[i] == labels[i - 1]:
            continue
        if 2 <= i - start <= NUMBER_WORDS:
            digits = "".join(_DIGIT.findall(text[words[start][0] : words[i - 1][1]]))
            if len(digits) >= SAME_DIGITS:
                for j in range(start, i):
                    key = "d" + digits[-SAME_DIGITS:]
                    if key not in keys[j]:
                        keys[j].append(key)
                        parts[j] = key
        start = i
    return keys, parts


def _shape(word: str) -> str:
    out: list[str] = []
    for c in word:
        c = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not (out and out[-1] == c and c in "9a"):
            out.append(c)
    return "".join(out)


def _fits(word: str) -> str:
    """Which kind's own check the word passes, or looks like it but fails."""
    core = word.strip(".,;:!?()[]{}<>\"'")
    digits = "".join(_DIGIT.findall(core))
    if "@" in core:
        return "email" if base_spans(core) else "no email"
    if core.count(".") == 3 and core.replace(".", "").isdigit():
        return "ip" if all(map(_small, core.split("."))) else "no ip"
    if 13 <= len(digits) <= 19:
        return "card" if _luhn(digits) else "no card"
    return ""


def _neighbours(text: str, start: int, end: int) -> tuple[str, str]:
    """The words before and behind a word."""
    a = start
    while a and text[a - 1].isspace():
        a -= 1
    b = a
    while b and not text[b - 1].isspace():
        b -= 1
    behind = _BEHIND.match(text, end)
    return text[b:a], behind.group(1)


def _features(text: str, start: int, end: int) -> list[str]:
    word = text[start:end]
    before, behind = _neighbours(text, start, end)
    digits = len(_DIGIT.findall(word))
    return [
        "bias",
        "shape=" + _shape(word),
        f"first={'9' if word[0].isdigit() else word[0]}",
        f"digits={min(digits, 20)}",
        f"length={min(len(word) // 4, 8)}",
        f"at={'@' in word}",
        f"dots={min(word.count('.'), 4)}",
        f"fits={_fits(word)}",
        f"before={_shape(before)}",
        f"behind={_shape(behind)}",
    ]


class Field:
    """Weights of the skip-chain conditional random field."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.index, self.weights, self.chain, self.skip = index, weights, chain, skip

    @classmethod
    def trained(cls, texts: Iterable[str]) -> Field | None:
        """All potentials together, by pseudo-likelihood on words labelled by the patterns.

        Each word's label is learned from its features and its neighbours' labels.
        Words with a look-alike are learned a second time with their features hidden,
        so that edges must tell the label.  A word that only resembles a match has no
        known label and teaches nothing.
        """
        docs = [d for t in texts for d in stretches(t, base_spans(t))]
        index: dict[str, int] = {}
        rows = [[index.setdefault(f, len(index)) for f in fs] for d in docs for fs in d.features]
        if not rows:
            return None
        labels = np.array([y for d in docs for y in d.labels])
        taught = np.array([bool(y) or matched.isdisjoint(keys) for d in docs for matched in [set(d.matched_keys())] for y, keys in zip(d.labels, d.keys)])
        offsets = np.cumsum([0, *(len(d.words) for d in docs)])
        edges = []
        for name in ("chain", "skip"):
            found = [(at + a, at + b) for d, at in zip(docs, offsets) for a, b in getattr(d, name)]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            edges.append(pairs[taught[pairs].all(axis=1)])
        weights, chain, skip = _fit(np.array(rows, np.int32), labels, taught, edges, len(index))
        return cls(index, weights, chain, skip)

    def beliefs(self, docs: list[Sequence]) -> list[np.ndarray]:
        """Label beliefs of every word by loopy sum-product message passing.

        Words inside base spans keep their label.  All documents are passed at once,
        as parts of one graph that no edge connects.
        """
        sizes = [len(d.words) for d in docs]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        unary = np.zeros((offsets[-1], LABELS))
        for d, at in zip(docs, offsets):
            for i, (features, label) in enumerate(zip(d.features, d.labels)):
                if label:
                    unary[at + i] = -50.0
                    unary[at + i, label] = 0.0
                else:
                    unary[at + i] = self.weights[[self.index[f] for f in features if f in self.index]].sum(axis=0)
            for i, label in d.far:
                unary[at + i] += self.skip[label]
        edges = [(at + a, at + b, k) for d, at in zip(docs, offsets) for k, es in enumerate((d.chain, d.skip)) for a, b in es]
        belief = unary
        if edges:
            u, v, kind = np.array(edges).T
            potential = np.stack([self.chain, self.skip])[kind]
            there, back = np.zeros((len(u), LABELS)), np.zeros((len(u), LABELS))
            for _ in range(ROUNDS):
                belief = unary.copy()
                np.add.at(belief, v, there)
                np.add.at(belief, u, back)
                new_there = _sums((belief[u] - back)[:, :, None] + potential, 1)
                new_back = _sums((belief[v] - there)[:, None, :] + potential, 2)
                change = max(np.abs(new_there - there).max(), np.abs(new_back - back).max())
                there, back = (there + new_there) / 2, (back + new_back) / 2
                if change < CHANGE:
                    break
            belief = unary.copy()
            np.add.at(belief, v, there)
            np.add.at(belief, u, back)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True)) if len(belief) else belief
        belief = belief / belief.sum(axis=1, keepdims=True) if len(belief) else belief
        return [belief[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _sums(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    out = np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)
    return out - out.max(axis=1, keepdims=True)


def _fit(
    rows: np.ndarray, labels: np.ndarray, taught: np.ndarray, edges: list[np.ndarray], n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, chain and skip potentials of greatest pseudo-likelihood under a Gaussian prior.

    ``rows`` are the numbers of each word's features, so memory grows with words alone.
    Words with skip edges come a second time, with one feature that stands for hidden ones.
    """
    linked = np.zeros(len(rows), bool)
    linked[edges[1]] = True
    again = np.flatnonzero(linked & taught)
    known = np.eye(LABELS)[labels]
    parameters = [np.zeros((n + 1, LABELS)), PRIOR * np.eye(LABELS), PRIOR * np.eye(LABELS)]
    centres = [p.copy() for p in parameters]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    total = int(taught.sum()) + len(again)

    def residuals(scores: np.ndarray, truth: np.ndarray) -> np.ndarray:
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return truth - scores / scores.sum(axis=1, keepdims=True)

    for step in range(1, STEPS + 1):
        weights = parameters[0]
        around = np.zeros((len(rows), LABELS))
        for (u, v), potential in zip((e.T for e in edges), parameters[1:]):
            np.add.at(around, v, potential[labels[u]])
            np.add.at(around, u, potential.T[labels[v]])
        scores = around.copy()
        for column in rows.T:
            scores += weights[column]
        seen = residuals(scores, known) * taught[:, None]
        hidden = residuals(around[again] + weights[n], known[again])
        gradients = [np.zeros_like(p) for p in parameters]
        for label in range(LABELS):
            for column in rows.T:
                gradients[0][:, label] += np.bincount(column, seen[:, label], n + 1)
        gradients[0][n] = hidden.sum(axis=0)
        seen[again] += hidden
        for (u, v), gradient in zip((e.T for e in edges), gradients[1:]):
            gradient += known[u].T @ seen[v] + seen[u].T @ known[v]
        gradients[2] = (gradients[2] + gradients[2].T) / 2
        for p, centre, gradient, (mean, square) in zip(parameters, centres, gradients, moments):
            gradient = (gradient - 0.1 * (p - centre)) / total
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            p += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return parameters[0][:n], parameters[1], parameters[2]


def added_spans(text: str, doc: Sequence, belief: np.ndarray, out: list[Span]) -> None:
    """Add to ``out`` spans of neighbouring words believed to be of one kind."""
    best = belief.argmax(axis=1)
    sure = belief[np.arange(len(best)), best] >= BELIEF
    chained = {b for _, b in doc.chain}
    for i in range(*doc.own):
        start, end = doc.words[i]
        label = int(best[i])
        if doc.labels[i] or label == OUTSIDE or not sure[i]:
            continue
        while start < end and text[start] in "([{<\"',;:!?":
            start += 1
        while end > start and text[end - 1] in ")]}>\"',;:!?.":
            end -= 1
        if start == end:
            continue
        if i in chained and out and out[-1][1] == label - 1 and out[-1][2] > doc.words[i - 1][0]:
            out[-1] = (out[-1][0], label - 1, end)
        else:
            out.append((start, label - 1, end))


def _apart(found: list[Span], base: list[Span]) -> list[Span]:
    """Those that overlap no base span."""
    starts = [a for a, _, _ in base]
    reach = [0, *accumulate((b for _, _, b in base), max)]
    return [s for s in found if reach[bisect_left(starts, s[2])] <= s[0]]


def find_spans(texts: list[str], model: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    more: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, Sequence]] = []

    def judge() -> None:
        for (i, doc), belief in zip(held, model.beliefs([d for _, d in held])):
            added_spans(texts[i], doc, belief, more[i])
        held.clear()

    words = 0
    for i, (text, own) in enumerate(zip(texts, base)):
        for doc in stretches(text, own):
            held.append((i, doc))
            words += len(doc.words)
            if words >= STRETCH:
                judge()
                words = 0
    if held:
        judge()
    return [(b, sorted(b + _apart(m, b))) for b, m in zip(base, more)]


SPANS = T.ArrayType(
    T.StructType([field("kind", "string"), field("start", "bigint"), field("end", "bigint")])
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """The field, from a bounded sample: :data:`TRAIN_DOCS`, :data:`TRAIN_BYTES`."""
    return Field.trained(bounded_sample(df, id_col, text_col, TRAIN_DOCS, TRAIN_BYTES))


def find_personal_data(
    df: DataFrame, model: Field | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, base, spans`` per row: lists of (kind, start, end), ascending.

    ``base`` are the patterns' matches, ``spans`` these and what the field adds: words
    that repeat or resemble a match elsewhere in the document and are no match
    themselves.  Positions are code points, ends exclusive.  Without a model
    (nothing to train on) nothing is added.

    Null or empty text has no spans.  Repeated rows count each for itself; an
    empty table gives no rows; further columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        def listed(spans: list[Span]) -> list[dict]:
            return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

        def work(texts):
            found = find_spans(texts, shared.value)
            return [pa.array([listed(s[i]) for s in found], _SPANS) for i in (0, 1)]

        return work

    return per_text(df, [text_col], [field("base", SPANS), field("spans", SPANS)], make, kept=[id_col])


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
