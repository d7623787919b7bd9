"""The registered queries of the subpackage against their SQL, and the pipeline against its stages."""

import hashlib

import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from millrace.llm import queries

NATIVE = ("op3", "op5", "op6", "op7")


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name.startswith(NATIVE):
        assert not [node for node in ("EvalPython", "InPandas", "MapInArrow", "Scan ExistingRDD") if node in plan]
    assert "CartesianProduct" not in plan
    verdict, detail, _ = check.compare(spark, con, name, sf_dir, df)
    assert verdict == ("ok" if name in queries.ORACLES else "rows"), detail
    assert " vs " not in detail, detail


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    frame, seen = docs, [set(texts)]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, sf_dir)
        rows = out.collect()
        seen.append({r["doc_id"] for r in rows})
        assert seen[-1] <= seen[-2]
        frame = spark.createDataFrame(rows, out.schema)
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    assert seen[1] < seen[0] and len(seen[0] - seen[1] - toxic) < 0.1 * len(seen[0])
    assert len({"".join(texts[k].split()) for k in seen[1]}) >= len(seen[2])
    assert seen[4] == seen[3] == seen[5]
    for row in rows:
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "mixing", "SentencePiece"]


def test_pipeline_drops_what_operator_4_rejects(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = queries.op4_toxicity(spark, sf_dir).collect()
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, sf_dir).collect()}
    assert kept == {r["doc_id"] for r in judged if not r["predicted"]}
    assert any(r["predicted"] and r["score"] < 0.5 for r in judged)
