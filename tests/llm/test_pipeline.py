"""The corpus pipeline and queries over the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from jobsieve.llm.oracle import ORACLE
from jobsieve.llm.queries import QUERIES

from .test_operators import brute_lines, brute_near

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    found = sorted(str(tuple(r[c] for c in sorted(got.columns))) for r in got.collect())
    if name in ORACLE:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "embeddings", "pages", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        wanted = con.execute(ORACLE[name])
        names = [d[0] for d in wanted.description]
        assert sorted(names) == sorted(got.columns)
        order = [names.index(c) for c in sorted(names)]
        assert found == sorted(str(tuple(r[i] for i in order)) for r in wanted.fetchall())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
            after = {r.doc_id: r.text for r in out.collect()}
        if name == "toxicity":
            assert set(after) <= set(before) and len(after) > 0.6 * len(before)
        elif name == "line_dedup":
            assert after == {i: t for i, t, *_ in brute_lines(list(before.items()))}
        elif name == "near_dedup":
            assert set(after) == {i for i, _, _, kept in brute_near(list(before.items()), 5) if kept}
        elif name == "decontamination":
            assert set(after) <= set(before)
        else:
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(before)
        docs, before = out, after
