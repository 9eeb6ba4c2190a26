"""Each stage on what its predecessor kept; the whole run; queries against SQL."""

import re
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from cropledger.llm import decontaminate, importance
from cropledger.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_columns_and_rows(spark, results):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    before = raw
    for _, after in results[:-1]:
        assert after.schema.names == raw.schema.names
        assert after.exceptAll(before).count() == 0
        before = after


def test_quality_goes_by_the_threshold(spark, results):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    model = importance.fit(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(results[0][1]) == ids(importance.resample(raw, model).where("accepted"))
    good = ids(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"))
    assert len(good & ids(results[0][1])) >= 0.99 * len(good)


def test_exact_and_near_copies_go(results):
    from .test_dart_minhash import bag, similarity

    def norm(text):
        return re.sub("[\x20\x09-\x0d]+", " ", text or "")

    quality, exact, near = (r[1].collect() for r in results[:3])
    first = {}
    for r in sorted(quality, key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert {r.doc_id for r in exact} == set(first.values())
    bags = {r.doc_id: bag(r.text) for r in near}
    assert not [(a, b) for a in bags for b in bags if a < b and bags[a] and similarity(bags[a], bags[b]) >= 0.8]
    lost = [r for r in exact if r.doc_id not in bags]
    everyone = {r.doc_id: bag(r.text) for r in exact}
    assert all(any(k != r.doc_id and similarity(everyone[k], everyone[r.doc_id]) >= 0.8 for k in everyone) for r in lost)


def test_contaminated_go(spark, results):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    near, clean = results[2][1].collect(), ids(results[3][1])
    for r in near:
        text = " ".join(r.text.lower().split())
        held = any(decontaminate.ends(p, text)[0] <= int(0.1 * len(p)) for p in items)
        assert (r.doc_id in clean) == (not held), r.doc_id


def test_run_is_the_stages(spark, results):
    got = corpus_pipeline.run(spark, SF)
    pieces = results[-1][1]
    assert sorted(map(tuple, got.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, pieces.select("doc_id", "start", "length", "ids_crc32").collect())
    )
    assert ids(pieces) == ids(results[3][1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, name):
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want))


def test_one_query_for_each_operator():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 11)] == [1] * 10
