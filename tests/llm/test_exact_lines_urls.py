import hashlib
import os
import random
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from tradelake.llm import common, exact, lines, simhash, urls
from tradelake.llm.common import checkpointed


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_groups_of_copies(docs):
    rng = random.Random(5)
    texts = ["a", "A", "É", "é", "", None, "long " * 30_000, "Long " * 30_000, "b\n", "b"]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(7, "a"), (7, "a"), (None, "é"), (None, "only null")]
    df = docs(*rows).withColumnRenamed("lang", "kept").withColumnRenamed("source", "_run")
    got = exact.group_copies(df, leaf_bits=1, run_bits=3).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(rows)
    assert sorted(map(str, ((r.doc_id, digest[r.text_sha256]) for r in got))) == sorted(str((i, lower(t))) for i, t in rows)
    for r in got:
        ids = groups[digest[r.text_sha256]]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)
    assert exact.group_copies(df.limit(0)).count() == 0
    kept = exact.keep_one(df).collect()
    assert sorted(lower(r.text) for r in kept) == sorted(groups)
    assert all(r.doc_id == max((i for i in groups[lower(r.text)] if i is not None), default=None) for r in kept)
    assert exact.keep_one(df).columns == df.columns
    clash = df.select("doc_id", "text", *(F.lit(c).alias(c) for c in ("_key", "_digest", "_size", "_place", "keep_id")))
    assert exact.keep_one(clash).columns == clash.columns
    assert {r[2:] for r in exact.keep_one(clash).collect()} == {("_key", "_digest", "_size", "_place", "keep_id")}


def test_rows_that_stay_are_not_shuffled(spark, docs, monkeypatch):
    """Keys that go are marked: whole rows are joined with a broadcast bitmap before any is sent."""
    rows = [(i, f"text {i % 90} of some words {i % 90 + 7}") for i in range(100)] + [(99, "text 9 of some words 16")] * 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {}
        for bits in (24, 1):  # one bit marks every row, and changes nothing
            monkeypatch.setattr(common, "MARK_BITS", bits)
            for keep_one in (exact.keep_one, simhash.keep_one):
                kept = keep_one(docs(*rows))
                plan = kept._jdf.queryExecution().sparkPlan().toString()
                assert plan.count("BroadcastHashJoin") >= 2
                found.setdefault(keep_one, []).append(sorted(map(tuple, kept.collect())))
        for once, again in found.values():
            assert once == again and len(once) == len({r[:2] for r in once})
        assert [r[0] for r in found[exact.keep_one][0]] == list(range(10, 100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_runs_are_merged_in_their_order(spark):
    """A merge exchanges stretches of runs once, sorts them, and folds along the sorted rows."""
    rng = random.Random(6)
    rows = [(run, hashlib.sha256(b"%d" % rng.randrange(40)).digest()) for run in range(8) for _ in range(30)]
    runs = spark.createDataFrame(rows, "_run int, _digest binary").select(
        "_run", "_digest", F.lit(1).alias("_size"), F.lit(2).alias("_check"), F.struct(F.rand(3).alias("_id")).alias("_best"), F.lit(1).alias("_n")
    )
    merged = exact._merged(runs, 1, 6)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" in plan and "HashAggregate" not in plan
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_run") == plan.count("Exchange") == 1 and plan.count("Sort [") >= 1
    counts = {}
    for run, digest in rows:
        counts[run >> 1, digest] = counts.get((run >> 1, digest), 0) + 1
    assert {(r["_run"], bytes(r["_digest"])): r["_n"] for r in merged.collect()} == counts


def plain_dedup(rows):
    """Of neighbouring lines that stand together in several places all but the first place go."""
    texts = {i: (t or "").split("\n") for i, t in rows}
    places = {}
    for i in sorted(texts):
        for k, pair in enumerate(zip(texts[i], texts[i][1:])):
            places.setdefault(pair, []).append((i, k))
    stay, go = set(), set()
    for found in places.values():
        if len(found) > 1:
            stay |= {(found[0][0], found[0][1] + d) for d in (0, 1)}
            go |= {(i, k + d) for i, k in found[1:] for d in (0, 1)}
    out = {}
    for i, lines_ in texts.items():
        gone = [(i, k) in go - stay for k in range(len(lines_))]
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(lines_), sum(gone), runs, "\n".join(x for x, g in zip(lines_, gone) if not g))
    return out


def repeated_runs(rows):
    """Runs of neighbouring lines, over 50 words in total, that stand in an earlier text; exact copies left out."""
    seen, met, out = set(), set(), []
    for i, t in sorted(rows):
        if t in met:
            continue
        met.add(t)
        lines_ = t.split("\n")
        known = [pair in seen for pair in zip(lines_, lines_[1:])] + [False]
        start = None
        for k, k_known in enumerate(known):
            if k_known and start is None:
                start = k
            elif not k_known and start is not None:
                if sum(len(x.split()) for x in lines_[start : k + 1]) > 50:
                    out.append((i, lines_[start : k + 1]))
                start = None
        seen.update(zip(lines_, lines_[1:]))
    return out


def test_nine_of_ten_repeated_passages_are_found(spark, read):
    folder = os.path.dirname(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")) + "/sf0.1"
    df = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    kept = {r.doc_id: (r.n_removed_lines, r.text) for r in lines.dedup_lines(df).collect()}
    runs = repeated_runs(rows)
    found = sum("\n".join(run) not in kept[i][1] for i, run in runs)
    assert len(runs) > 100 and found >= 0.9 * len(runs)
    # every line that went still stands somewhere
    there = {x for _, t in kept.values() for x in t.split("\n")}
    assert {x for _, t in rows for x in t.split("\n")} <= there | {""}


def test_lines_against_plain_code(docs):
    rng = random.Random(2)
    pool = [f"line {i} é" for i in range(60)] + [""]
    passage = [f"shared {i}" for i in range(12)]
    rows = [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "\n".join(pool * 60))]
    for i in range(60):
        own = [rng.choice(pool) for _ in range(rng.randint(1, 15))]
        at = rng.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + (passage if i % 3 else []) + own[at:])))
    df = docs(*rows).withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "_key")
    got = {r.doc_id: tuple(r)[1:] for r in lines.dedup_lines(df).collect()}
    assert got == plain_dedup(rows)
    assert sum(v[1] for v in got.values()) > 300
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_texts_are_shuffled_once(spark, docs, monkeypatch):
    """Also where no join is small enough to be broadcast."""
    rows = [(i, f"own {i}\nshared a\nshared b\nend {i}") for i in range(40)]
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpointed(df)

    monkeypatch.setattr(lines, "checkpointed", noted)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = lines.dedup_lines(docs(*rows))
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == plain_dedup(rows) and sum(v[1] for v in got.values()) == 78
    shuffled = r"Exchange hashpartitioning\(_key#[^\n]*\n[^\n]*Project \[concat_ws[^\n]*text#"
    assert len(re.findall(shuffled, "\n".join(plans))) == 1


def test_repeated_and_nameless_rows_of_lines(docs):
    text = "\n".join(f"l{i}" for i in range(30))
    rows = [(4, text), (4, text), (9, "x\n" + text), (None, "y\n" + text), (None, None)]
    got = lines.dedup_lines(docs(*rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == 5
    assert by[4][0] == by[4][1] and by[4][0].n_removed_lines > 0  # the nameless row comes first
    assert by[9][0].n_removed_lines > 0
    assert sorted(r.n_removed_lines for r in by[None]) == [0, 0]


RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "a.example.org/en/"),
    ("block", "Net/"),
    ("allow", "net/x/y"),
    ("allow", "twice.com/"),
    ("block", "twice.com/"),
]
CASES = {
    "https://example.org/es/5": ("example.org", "/es/5", "example.org/es/", "block"),
    "http://m.EXAMPLE.org/en/17?x=/es/": ("m.example.org", "/en/17", "example.org/en/1", "block"),
    "http://a.example.org/en/17": ("a.example.org", "/en/17", "a.example.org/en/", "allow"),
    "http://a.example.org/es/17": ("a.example.org", "/es/17", "example.org/es/", "block"),
    "http://badexample.org/es/1#top": ("badexample.org", "/es/1", "org/", "allow"),
    "http://example.org/es": ("example.org", "/es", "org/", "allow"),
    "http://example.org": ("example.org", "", None, "allow"),
    "http://example.org?/es/": ("example.org", "", None, "allow"),
    "x://q.net/x/yz/": ("q.net", "/x/yz/", "net/x/y", "allow"),
    "x://q.net/x/": ("q.net", "/x/", "Net/", "block"),
    "x://ü.net//x": ("ü.net", "//x", "Net/", "block"),
    "x://twice.com/": ("twice.com", "/", "twice.com/", "block"),
    "x://net./": ("net.", "/", None, "allow"),
    "://y://z": ("y:", "//z", None, "allow"),
    "no scheme.org/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http://h/" + "p/" * 20_000: ("h", "/" + "p/" * 20_000, None, "allow"),
}


@pytest.mark.parametrize("size", [urls.BROADCAST_BYTES, 1])
def test_urls(spark, monkeypatch, size):
    monkeypatch.setattr(urls, "BROADCAST_BYTES", size)
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(CASES)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "verdict string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in urls.filter_urls(pages, rules).collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())
    assert urls.filter_urls(pages.limit(0), rules).count() == 0
    nothing = urls.filter_urls(pages, rules.limit(0), default="block")
    assert nothing.where(F.col("rule").isNull() & (F.col("verdict") == "block")).count() == len(CASES)


@pytest.mark.parametrize("size", [urls.BROADCAST_BYTES, 1])
def test_hosts_beyond_ascii_and_rules_without_a_path(spark, monkeypatch, size):
    monkeypatch.setattr(urls, "BROADCAST_BYTES", size)
    cases = {
        "http://ÜNDER.org/x": ("Ünder.org", "/x", "Ünder.ORG/", "block"),
        "http://ünder.org/x": ("ünder.org", "/x", None, "allow"),
        "http://a.Bare.org/x": ("a.bare.org", "/x", "bare.org", "block"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    rules = spark.createDataFrame([("block", "Ünder.ORG/"), ("block", "bare.org")], "verdict string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in urls.filter_urls(pages, rules).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_rules_must_allow_or_block():
    with pytest.raises(ValueError):
        urls.build_trie([("deny", "org/")])


def test_a_full_trie_fits_a_worker():
    rules, size = [], 0
    while size < urls.BROADCAST_BYTES:
        rules.append(("block", f"host{len(rules)}.example{len(rules) % 977}.org/a{len(rules)}/b"))
        size += len(rules[-1][1])
    tracemalloc.start()
    trie = urls.build_trie(rules)
    assert tracemalloc.get_traced_memory()[0] < 200e6
    tracemalloc.stop()
    assert urls.match(trie, "x.host5.example5.org", "/a5/bc") is not None
