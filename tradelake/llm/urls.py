"""URL filters: a broadcast trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import checkpointed, field, per_text
from tradelake.llm.exact import lower_ascii

# Rules above this size (text bytes) are joined instead of broadcast.  The trie takes up to 50 times as much
# in each Python worker.
BROADCAST_BYTES = 2 << 20

# (verdict, rule): host, then the beginning of the path.
Rule = tuple[str, str]


def split_rule(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return _lower(host), "/" + path


def split_url(url: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    for mark in "#?":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return _lower(host), slash + path


def _lower(text: str) -> str:
    return text.encode().lower().decode()


def build_trie(rules: Iterable[Rule]) -> dict:
    """Node: child by host label; under ``None`` the trie of path segments.

    A path node has its children by segment and, under ``None``, the endings:
    by length and text the beginning that the next segment must have.
    """
    root: dict = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks, not {verdict!r}")
        host, path = split_rule(rule)
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *whole, begun = path.split("/")[1:]
        for segment in whole:
            node = node.setdefault(segment, {})
        endings = node.setdefault(None, {}).setdefault(len(begun), {})
        # Of the same rule given twice, to block wins.
        if endings.get(begun, ("", "allow"))[1] == "allow":
            endings[begun] = (rule, verdict)
    return root


def _longest_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for segment in segments:
        endings = node.get(None)
        if endings:
            for length in sorted(endings, reverse=True):
                found = endings[length].get(segment[:length])
                if found:
                    best = found
                    break
        node = node.get(segment)
        if node is None:
            break
    return best


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the most specific fitting rule: host first, then path."""
    best, node = None, trie
    segments = path.split("/")[1:]
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if None in node and segments:
            best = _longest_path(node[None], segments) or best
    return best


def filter_urls(
    df: DataFrame,
    rules: Iterable[Rule] | DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``id, host, path, rule, verdict`` per row.

    A rule is a host, a slash and the beginning of a path; it fits the host and
    all its subdomains.  Of the fitting rules the one with the longest host
    wins, then the one with the longest path, whether it allows or blocks;
    without one, ``rule`` is null and ``verdict`` is ``default``.

    ``rules`` are pairs (verdict, rule), or a table of two such columns.  Up to
    :data:`BROADCAST_BYTES` they become a trie on the driver that is broadcast;
    no shuffle.  A larger table is joined, see :func:`_join_rules`.

    Null url, or one without ``://``: empty host and path, no rule.  Repeated
    rows are judged each for itself; an empty table gives no rows; further
    columns are ignored.
    """
    if isinstance(rules, DataFrame):
        verdict, rule = rules.columns[:2]
        size = rules.select(F.sum(F.octet_length(F.col(rule).cast("string")))).first()[0] or 0
        if size > BROADCAST_BYTES:
            return _join_rules(df, rules, id_col, url_col, default)
        rules = [(r[0], r[1]) for r in rules.select(verdict, rule).collect()]
    shared = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    def make():
        trie = shared.value

        def work(urls):
            split = [split_url(u) for u in urls]
            found = [match(trie, host, path) or (None, default) for host, path in split]
            return [*(list(c) for c in zip(*split)), *(list(c) for c in zip(*found))]

        return work

    names = ("host", "path", "rule", "verdict")
    return per_text(df, [url_col], [field(n, "string") for n in names], make, kept=[id_col])


def _join_rules(df: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str) -> DataFrame:
    """The same verdicts for rules too many to broadcast.

    A url has one candidate per host suffix and per length of a path that
    some rule of that suffix has; candidates meet rules by equality.
    """
    verdict, rule = rules.columns[:2]
    parts = F.split(F.col(rule), "/", 2)
    tidy = (
        rules.select(
            lower_ascii(parts[0]).alias("_h"),
            F.concat(F.lit("/"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("_p"),
            F.col(rule).alias("_rule"),
            F.col(verdict).alias("_verdict"),
        )
        .groupBy("_h", "_p")
        .agg(F.max(F.struct("_verdict", "_rule")).alias("_best"))
        .withColumn("_n", F.length("_p"))
    )
    lengths = tidy.select("_h", "_n").distinct()
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.regexp_extract(after, r"(?s)^([^?#]*)", 1)
    base = df.select(
        F.col(id_col),
        F.monotonically_increasing_id().alias("_row"),
        lower_ascii(F.regexp_extract(rest, r"(?s)^([^/]*)", 1)).alias("host"),
        F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1).alias("path"),
    )
    base = checkpointed(base)
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))),
    )
    found = (
        base.select("_row", "path", F.explode(suffix).alias("_h"))
        .join(lengths, "_h")
        .where(F.length("path") >= F.col("_n"))
        .select("_row", "_h", "_n", F.expr("substring(path, 1, _n)").alias("_p"))
        .join(tidy.select("_h", "_p", "_best"), ["_h", "_p"])
        .groupBy("_row")
        .agg(F.max_by("_best", F.struct(F.length("_h"), "_n")).alias("_best"))
    )
    return base.join(found, "_row", "left").select(
        id_col,
        "host",
        "path",
        F.col("_best._rule").alias("rule"),
        F.coalesce("_best._verdict", F.lit(default)).alias("verdict"),
    )
