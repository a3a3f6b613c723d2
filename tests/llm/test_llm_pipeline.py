import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from llm_cases import case_rows, components, frame, words_of  # noqa: E402
from test_llm_lines_mix_pack import brute_lines, exact_tokenizer  # noqa: E402
from test_llm_text_rules import brute_quality  # noqa: E402

import corpus_pipeline  # noqa: E402
from quotelake.llm.mixing import mix_table  # noqa: E402
from quotelake.llm.quality_rules import calibrated  # noqa: E402
from quotelake.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    expected = sorted(map(repr, con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == expected


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    limits = calibrated(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect() if brute_quality(r.text, limits)[-1]]
    rows.sort()
    lined = brute_lines(rows)
    rows = [(d, lined[d, t][1]) for d, t in rows]
    rows = [(d, t) for d, t in rows if words_of(t)]
    rows = [(d, t) for (d, t), (_, n, c) in zip(rows, components(rows)) if d == c or not n]
    left = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == rows
    kept = {r.doc_id for r in mix_table(left).collect() if r.kept}
    tok = exact_tokenizer()
    sizes = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows if d in kept}
    got = corpus_pipeline.run(spark, SF).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == sizes


def test_stages_take_awkward_rows(spark):
    for rows in (case_rows(), []):
        docs = frame(spark, rows)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            out.collect()
            if i < 4:
                assert out.columns == docs.columns and out.schema == docs.schema or out.columns == docs.columns


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None and QUERIES["pipeline"] is corpus_pipeline.run
    assert sum(n.startswith("op") for n in QUERIES) == 13
