"""The pipeline's stages and the registered queries."""

import duckdb

import corpus_pipeline
from tools.check_oracle import table_rows
from tripmart.llm import decontaminate, exact, simhash
from tripmart.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_registered_names():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES


def test_sql(spark):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    for name, statement in ORACLE_SQL.items():
        table = QUERIES[name](spark, FOLDER)
        got = table_rows(table.columns, [tuple(row) for row in table.collect()])
        result = duck.execute(statement)
        assert got == table_rows([d[0] for d in result.description], result.fetchall())


def test_stages_act_on_what_is_left(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, before, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
            assert after.exceptAll(before).count() == 0, name
        before, last = after, before
    rows = last.collect()
    assert len({exact.UPPER and r.text.lower() for r in rows}) == len(rows) > 50
    assert all(
        r.doc_id == r.component_id for r in simhash.near_components(last).collect()
    )
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontaminate.leaks(last, benchmark).count() == 0
    assert before.count() == len(rows) == corpus_pipeline.run(spark, FOLDER).count()
