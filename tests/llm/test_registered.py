"""The registered queries: oracle parity where SQL can state them, and the pipeline's stages."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from gridpulse.llm import queries  # noqa: E402
from gridpulse.llm.common import table  # noqa: E402
from oracle_compare import compare, duckdb_connection  # noqa: E402
from tests.llm import brute  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_oracle(spark, name):
    r = compare(spark, duckdb_connection(SF), name, SF)
    assert r["columns_match"] and r["types_match"] and r["values_match"], r
    assert r["rows"] == r["oracle_rows"], r


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "jaccard_join", "pii", "packing"]
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}

    clean = stages["toxicity"](spark, docs, SF).cache()
    assert clean.columns == docs.columns
    gone = {r.doc_id for r in docs.join(clean, "doc_id", "left_anti").collect()}
    known = [i for i in gone if i in labels]
    assert known and sum(labels[i] for i in known) >= 0.95 * len(known)
    assert len(gone) <= 0.2 * docs.count()

    rows = [(r.doc_id, r.text) for r in clean.collect()]
    single = stages["exact_dedup"](spark, clean, SF).cache()
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, k, *_ in brute.exact_groups(rows) if i == k)

    rows = [(r.doc_id, r.text) for r in single.collect()]
    apart = stages["jaccard_join"](spark, single, SF).cache()
    assert apart.columns == docs.columns
    assert sorted(r.doc_id for r in apart.collect()) == [i for i, _, c in brute.jaccard(rows, 5, 80) if i == c]

    before = {r.doc_id: r.text for r in apart.collect()}
    redacted = stages["pii"](spark, apart, SF).cache()
    assert redacted.columns == docs.columns
    after = {r.doc_id: r for r in redacted.collect()}
    assert after.keys() == before.keys()
    for i, text in before.items():
        assert after[i].n_chars == len(after[i].text)
        assert not [s for s in brute.pii_spans(after[i].text) if s[0] == "email"]
        if not brute.pii_spans(text):
            assert after[i].text == text

    packed = stages["packing"](spark, redacted, SF).collect()
    assert {r.doc_id for r in packed} == before.keys()


def test_exact_stage_keeps_one_row_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (2, "A"), (2, "A"), (3, "b"), (3, "c"), (4, "b"), (None, "d"), (None, "d"), (None, "a"), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_copies(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "d"), (2, "A"), (3, "c"), (4, "b"), (5, "")]


def test_run_removes_what_its_stages_staged(spark):
    from gridpulse.llm.common import remove_staged, staged_folders

    remove_staged(spark)
    ids = {r.doc_id for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id").collect()}
    left = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in staged_folders()]
    assert ids and left.count("pipeline-pii") == 1 and set(left) <= {"pipeline-pii", "packing", "open-bins"}
    assert remove_staged(spark) == len(left) and not staged_folders()


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
