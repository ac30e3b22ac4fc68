"""The pipeline stage by stage against plain code on the whole given table."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from tests.llm.test_decontam_language import plain_hits
from tests.llm.test_exact_lines_urls import lower
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tests.llm.test_tokens_packing import _check_pieces, _ids
from tokenizers import Tokenizer
from tradelake.llm.common import checkpointed, table

ROOT = Path(__file__).resolve().parents[2]


def test_stages(spark, sf_dir, read):
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns

    def step(name, rows):
        out = checkpointed(stages[name](spark, rows, sf_dir))
        return out, {r["doc_id"]: r.asDict() for r in out.collect()} if name != "packing" else out.collect()

    before = {r.doc_id: r.asDict() for r in docs.collect()}
    docs, after = step("language_id", docs)
    assert docs.columns == columns
    assert after == {i: r for i, r in before.items() if any(map(str.isalpha, r["text"] or ""))}

    before = after
    docs, after = step("exact_dedup", docs)
    best = {}
    for i, r in before.items():
        best[lower(r["text"])] = max(i, best.get(lower(r["text"]), i))
    assert docs.columns == columns and after == {i: before[i] for i in best.values()}

    before = after
    docs, after = step("near_dedup", docs)
    groups = plain_groups({i: plain_fingerprint(r["text"]) for i, r in before.items()}, 2)
    assert docs.columns == columns and after == {i: r for i, r in before.items() if groups[i] == i}

    before = after
    docs, after = step("decontamination", docs)
    items = [(str(i), t) for i, t in read("SELECT item_id, text FROM '{d}/benchmark.parquet'")]
    assert docs.columns == columns
    for i, r in before.items():
        n, hit, _ = plain_hits(r["text"], items)
        if not hit:
            assert after[i] == r
        elif i in after:
            assert not plain_hits(after[i]["text"], items)[1]
            assert after[i]["n_chars"] == len(after[i]["text"])
        else:
            assert len(hit) > 0.2 * n

    _, pieces = step("packing", docs)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    _check_pieces([r.asDict() for r in pieces], {i: _ids(library, r["text"]) for i, r in after.items()})


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length", "ids_crc32"} <= set(rows.columns)
    assert rows.count() > 0


def test_odd_rows(spark, sf_dir):
    (item,) = table(spark, sf_dir, "benchmark").limit(1).select("text").collect()[0]
    prose = [f"the {a} went to the {b} and it was there for some time" for a in ("dog", "cat") for b in ("house", "garden")]
    long = " ".join(prose) + " " + " ".join(f"the house {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} was there" for i in range(30_000))
    texts = [*prose, prose[0], prose[0].upper(), long, None, "", "12 34 !?", item]
    rows = [(i, t, None if i % 2 else "en") for i, t in enumerate(texts)]
    rows += [(None, "the dog that has no number was in the garden"), (None, None), rows[6], rows[6]]
    clash = ("_key", "_text", "_id", "_digest", "fingerprint", "keep_id", "lang_pred", "start", "n_words", "ids")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *clash[:-1], None) for r in rows]
    docs = spark.createDataFrame(full, schema)
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert {r[5:] for r in seen[name]} == {(*clash[:-1], None)}
    ids = {name: sorted(str(r["doc_id"]) for r in seen[name]) for name in seen}
    # No letter, no language; repeated rows are still there.
    assert ids["language_id"] == sorted(["0", "1", "2", "3", "4", "5", "6", "6", "6", "10", "None"])
    # Of equal texts the largest identifier; of repeated rows one.
    assert ids["exact_dedup"] == sorted(["1", "2", "3", "5", "6", "10", "None"])
    assert set(ids["near_dedup"]) <= set(ids["exact_dedup"]) and {"6", "10", "None"} <= set(ids["near_dedup"])
    # The item itself goes, nothing else does.
    assert ids["decontamination"] == [i for i in ids["near_dedup"] if i != "10"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    kept = {r["doc_id"]: _ids(library, r["text"]) for r in seen["decontamination"]}
    _check_pieces([r.asDict() for r in seen["packing"]], kept)


def test_an_empty_corpus(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    assert docs.count() == 0


def test_the_rest_works_without_the_text_operators():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('tradelake.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'ohlcv_1h' in e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
