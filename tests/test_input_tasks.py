"""Tasks of the input follow its rows, and a view that is read several times is joined once."""

from codeloom.catalog.registry import Tables
from codeloom.sources import survey


def test_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(survey, "TASK_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(5000).coalesce(1)
    assert survey.input_tasks(rows) == max(cores, 50)
    spread = survey.spread_input(rows, "id")
    assert spread.rdd.getNumPartitions() == max(cores, 50)
    assert spread.count() == 5000
    assert survey.spread_input(rows.repartition(64), "id").rdd.getNumPartitions() == 64


def test_tables_joined_by_order_are_dealt_alike(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(survey, "TASK_ROWS", 100)
    spark.range(300).withColumnRenamed("id", "o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2000).withColumnRenamed("id", "l_orderkey").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = Tables(spark, str(tmp_path))
    assert t.orders.rdd.getNumPartitions() == t.lineitem.rdd.getNumPartitions() == max(20, spark.sparkContext.defaultParallelism)


def test_a_kept_view_reads_its_staged_rows(spark, tmp_path):
    spark.range(30).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    t = Tables(spark, str(tmp_path))
    before = t.orders.inputFiles()
    t.keep("orders")
    assert t.orders.count() == 30 and not set(before) & set(t.orders.inputFiles())
