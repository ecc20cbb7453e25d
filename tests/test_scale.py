import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from paperwarden.operators import scale
from paperwarden.sources.documents import normalise_text


def folders(spark):
    return {f for f in os.listdir(scale.shared_folder(spark).removeprefix("file:")) if f.startswith("paperwarden-")}


def test_tables_of_a_temporary_workspace_are_removed(spark):
    before = folders(spark)
    with scale.temporary_workspace(spark):
        table = scale.materialise(spark.range(10))
        assert table.count() == 10 and len(folders(spark)) == len(before) + 1
    assert folders(spark) == before


def test_dropped_and_kept_tables(spark):
    work = scale.Workspace(spark)
    a, b = work.table(spark.range(5)), work.table(spark.range(7).where("id > 99"))
    work.drop(a)
    assert b.count() == 0 and b.columns == ["id"]
    work.close()
    assert not os.path.exists(work.path.removeprefix("file:"))


def test_rows_that_do_not_come_back_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(scale.Workspace, "_proven", set())
    work = scale.Workspace(spark)
    monkeypatch.setattr(type(spark.read), "parquet", lambda reader, path: spark.range(0).select("id"))
    with pytest.raises(OSError, match="3 rows written, 0 found"):
        work.table(spark.range(3))
    monkeypatch.undo()
    work.close()


def test_a_cluster_must_name_a_folder():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: None),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scale.shared_folder(session(master))
    assert os.path.isdir(scale.shared_folder(session("local[4]")))


def test_replacement_signs_of_the_text_stay(spark):
    raw = spark.createDataFrame([(1, bytearray(b"a\xef\xbf\xbdb\r\nc")), (2, bytearray(b"a\xef\xbf\xbdb\xffc\rd"))],
                                "id int, raw binary")
    found = raw.select("id", normalise_text(F.col("raw").cast("string")).alias("text")).collect()
    assert {r.id: r.text for r in found} == {1: "a\ufffdb\nc", 2: "a\ufffdbc\nd"}


def _exchanges(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    found = capsys.readouterr().out.split("\n\n")
    return [part for part in found if re.match(r"\(\d+\) Exchange", part.strip())]


def _without_broadcasts(spark, tmp_path):
    """A folder of small tables of its own, with joins as they are on large ones."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    day = "timestamp'2001-02-03 00:00:00'"
    for name, sql in {
            "lineitem": "select id l_orderkey, id % 3 l_suppkey, id l_partkey, 2.0d l_quantity, 10.0d l_extendedprice, "
                        "0.1d l_discount, 0.05d l_tax from range(20)",
            "orders": f"select id o_orderkey, {day} - make_interval(0, 0, 0, 20 * int(id)) o_orderdate from range(20)",
            "supplier": "select id s_suppkey, concat('Maker ', id) s_name from range(3)",
            "documents": "select id doc_id, concat('green apple tree ', id) text from range(6)"}.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    return before


def test_goods_are_not_shuffled(spark, tmp_path, capsys):
    from fixtures import invoice_tables
    before = _without_broadcasts(spark, tmp_path)
    try:
        docs = invoice_tables.all_documents(spark, str(tmp_path))
        assert not [part for part in _exchanges(docs, capsys) if "goods" in part or "collect_list" in part or "buf" in part]
        assert docs.count() == 20 and invoice_tables.history(spark, str(tmp_path)).count() == 18
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tables_beyond_the_limit_are_shuffled_however_small_their_files(spark, capsys):
    table = scale.materialise(spark.range(1000).selectExpr("id AS key", "repeat('x', 500) AS text"))
    for limit, join in ((1 << 20, "BroadcastHashJoin"), (1 << 19, "SortMergeJoin")):
        spark.range(10_000).withColumnRenamed("id", "key").join(scale.broadcast_if_small(table, limit), "key", "left").explain()
        assert join in capsys.readouterr().out


def test_orders_are_not_broadcast_however_small_their_files(spark, tmp_path, capsys):
    from fixtures import invoice_tables

    spark.range(20).selectExpr("id AS o_orderkey", "TIMESTAMP '2000-05-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2).selectExpr("id AS s_suppkey", "concat('Shop ', id) AS s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(40).selectExpr("id % 20 AS l_orderkey", "id AS l_partkey", "id % 2 AS l_suppkey", "2.0D AS l_quantity", "10.0D AS l_extendedprice",
                               "0.0D AS l_discount", "0.1D AS l_tax").write.parquet(f"{tmp_path}/lineitem.parquet")
    past = invoice_tables.history(spark, str(tmp_path))
    past.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin [l_orderkey" in plan and "BroadcastHashJoin [l_orderkey" not in plan and past.count() == 20
