"""The pipeline: each stage against what it must do, on the smallest tables and on awkward ones."""

import sys

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    from tests.llm.test_text_operators import slow_contamination

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        assert after.schema == docs.schema, name
        left = {r["doc_id"] for r in after.collect()}
        gone = [r for r in now.collect() if r["doc_id"] not in left]
        if name == "quality classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            good = {r["doc_id"] for r in labels.where("quality = 1 and toxic = 0").collect()}
            assert len([r for r in gone if r["doc_id"] in good]) <= 0.02 * len(good)
        if name == "exact dedup":
            assert len(left) == now.select("text").distinct().count() and all(now.where(F.col("text") == r["text"]).agg(F.max("doc_id")).first()[0] > r["doc_id"] for r in gone)
        if name == "benchmark decontamination":
            assert {r["doc_id"] for r in gone} == {r["doc_id"] for r in now.collect() if slow_contamination(r["text"], items)[1]}
        now = after
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in now.collect()}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == {r["doc_id"] for r in packed}


def test_stages_take_awkward_rows(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, SF)
        assert out.schema.names == awkward.schema.names and out.count() > 0, name
        assert stage(spark, nothing, SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, SF).count() == 0


def test_queries_equal_sql(spark, tmp_path):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        p = f"{SF}/{f}"
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    for name, sql in queries.ORACLES.items():
        out = str(tmp_path / name)
        queries.QUERIES[name](spark, SF).write.parquet(out)
        mine = f"SELECT * FROM '{out}/*.parquet'"
        kinds = [dict((r[0], r[1]) for r in con.sql(f"DESCRIBE {q}").fetchall()) for q in (mine, sql)]
        assert kinds[0] == kinds[1]
        columns = ", ".join(sorted(kinds[0]))
        assert con.sql(f"SELECT {columns} FROM ({mine}) EXCEPT ALL SELECT {columns} FROM ({sql})").fetchall() == []
        assert con.sql(f"SELECT {columns} FROM ({sql}) EXCEPT ALL SELECT {columns} FROM ({mine})").fetchall() == []


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for p in (root / "tessera").rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "tessera.llm" not in p.read_text(), p
    assert "corpus_pipeline" in sys.modules
