"""The whole pipeline on the given tables and on planted cases, against plain versions of its stages."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from catalogmart.llm import mixing, piece_sampling, toxicity
from catalogmart.llm.queries import PIECES, QUERIES, SQL
from check import compare, open_oracle
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near dedup", "mixing", "piece sampling"]


@pytest.mark.parametrize("key", sorted(SQL))
@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_check_sql(spark, key, folder):
    assert compare(spark, open_oracle(folder), folder, key)[0] == "ok"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, lexicon).collect()}
    rows = [r for r in docs.collect() if scores[r["doc_id"]] < 0.5]
    best = {}
    for r in rows:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    rows = [r for r in rows if best[r["text"]] == r["doc_id"]]
    groups = plain_components([plain_fingerprint(r["text"]) for r in rows])
    least = defaultdict(lambda: 10**9)
    for r, g in zip(rows, groups):
        least[g] = min(least[g], r["doc_id"])
    rows = [r for r, g in zip(rows, groups) if least[g] == r["doc_id"]]
    mixed = mixing.mix(spark.createDataFrame(rows, docs.schema)).collect()
    want = Counter({r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixed if r["size"]})
    out = corpus_pipeline.run(spark, FOLDER)
    got = out.collect()
    assert Counter(r["doc_id"] for r in got) == +want
    text = {r["doc_id"]: r["text"] for r in rows}
    assert all(r["text"] == text[r["doc_id"]] for r in piece_sampling.decode_pieces(out, PIECES).collect())


def test_each_stage_takes_messy_and_empty_tables(spark, messy, nothing):
    for docs in (messy, nothing):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), stage(spark, docs, FOLDER).schema)
            assert docs.columns == columns or name == "piece sampling"


def test_stages_keep_columns_named_like_their_own(spark):
    """Columns with the names that operators use themselves stay what they are."""
    names = ["winner", "digest", "own_digest", "id", "times", "copy", "__winner", "__digest", "__id", "__times"]
    rows = [(k, f"the text number {k % 20} of this table has some words", "en", "ab"[k % 2], None, *range(len(names))) for k in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and {tuple(r[n] for n in names) for r in out.collect()} == {tuple(range(len(names)))}
