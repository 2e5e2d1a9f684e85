"""Registered queries against their SQL, and the pipeline stage by stage."""

import collections

import duckdb
import pytest

import corpus_pipeline
from retail_mart.llm import queries
from retail_mart.llm.common import words
from retail_mart.llm.order_minhash import similarity
from tests.conftest import SF_SMALL
from tests.helpers import frame_rows, oracle_rows


@pytest.mark.parametrize("key", sorted(queries.LLM_ORACLE))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.LLM_QUERIES[key](spark, SF_SMALL)
    cols, want = oracle_rows(con, queries.LLM_ORACLE[key])
    assert sorted(df.columns) == sorted(cols) and frame_rows(df) == want


def test_repeated_turns_stay_rows(spark, tmp_path):
    """Rows of one (conv_id, turn), equal or not, all come back."""
    rows = [(1, 0, "user", "first words here"), (1, 1, "bot", "an answer given"), (1, 1, "bot", "an answer given"), (1, 1, "user", "another answer"),
            (1, 2, "user", "what follows then"), (2, 0, "user", "alone in here"), (2, 2, "bot", "after a gap")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    df = queries.op10_quotes(spark, str(tmp_path))
    cols, want = oracle_rows(con, queries.LLM_ORACLE["op10_quotes"])
    assert len(want) == len(rows) and frame_rows(df) == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = [{r.doc_id: r for r in docs.collect()}]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.cut(stage(spark, frame, SF_SMALL))
        assert frame.columns == docs.columns, name
        kept.append({r.doc_id: r for r in frame.collect()})
        assert all(kept[0][d] == r for d, r in kept[-1].items())
    assert len(kept[1]) == len(kept[0])  # every document here has a language
    w = {d: words(r.text) for d, r in kept[0].items()}
    for d in kept[1].keys() - kept[2].keys():  # a removed document is like one with a smaller id
        assert any(similarity(w[d], w[e]) is not None for e in kept[1] if e < d)
    texts = collections.Counter(r.text for r in kept[2].values())
    assert max(texts.values()) == 1
    last = corpus_pipeline.STAGES[-1][1](spark, frame, SF_SMALL)
    assert last.count() == frame.count() and [r.doc_id for r in last.orderBy("start").collect()] == sorted(r.doc_id for r in frame.collect())


def test_pipeline_of_no_rows(spark):
    none = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0
