import json
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.sources.sheets import pack_sheets, prepare_full_refresh, sheet_to_table
from tessera.sources.tables import (JdbcPartition, delete_where, drop_table, keep_unless, read_query,
                                    run_statement, truncate_table, write_table)


def test_jdbc_partitioned_read_plan_needs_bounds():
    # No database may be started here, so JDBC is checked up to the reader
    # options only (see README: JDBC paths are untested in this repo).
    p = JdbcPartition("K", 0, 100, 4)
    assert (p.column, p.lower, p.upper, p.num_partitions) == ("K", 0, 100, 4)
    with pytest.raises(ValueError):
        write_table(None, "t", "bogus", jdbc={})


def test_catalog_delete_keeps_null_predicate_rows(spark):
    name = f"t2_{uuid.uuid4().hex[:6]}"
    spark.createDataFrame([(0.0, "a"), (None, "b"), (1.0, "c")], "k double, s string") \
        .write.mode("overwrite").saveAsTable(name)
    delete_where(spark, name, "k = 0.0")
    assert sorted(r["s"] for r in spark.table(name).collect()) == ["b", "c"]
    truncate_table(spark, name)
    assert spark.table(name).count() == 0
    write_table(spark.createDataFrame([(5.0, "z")], "k double, s string"), name, "append")
    assert run_statement(spark, f"SELECT count(*) FROM {name}").first()[0] == 1
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    df = spark.createDataFrame([(0.0,), (None,), (2.0,)], "k double")
    assert keep_unless(df, F.col("k") == 0.0).count() == 2


def test_sheet_to_table_golden(spark):
    sheet = {"columns": [{"title": "A"}, {"title": "B"}],
             "rows": [{"cells": [{"value": "1"}, {"value": "x"}]},
                      {"cells": [{"value": "two"}, {}]},
                      {"cells": [{"value": "3"}]}]}
    empty = {"columns": [{"title": "A"}], "rows": []}
    df = spark.createDataFrame([(1, json.dumps(sheet)), (2, json.dumps(empty))], "sid int, sheet string")
    out = sheet_to_table(df, "sheet", keep=["sid"]).collect()
    assert [(r["sid"], r["row_index"], r["A"], r["B"]) for r in sorted(out, key=lambda r: r["row_index"])] == \
        [(1, 0, "1", "x"), (1, 1, "two", None), (1, 2, "3", None)]
    dup = {"columns": [{"title": "A"}, {"title": "A"}], "rows": []}
    with pytest.raises(ValueError):
        sheet_to_table(spark.createDataFrame([(json.dumps(dup),)], "sheet string"), "sheet")


def test_pack_and_full_refresh(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (None, "n"), (100, "c")], "k int, v string")
    prep = prepare_full_refresh(df, "k")
    assert [r["k"] for r in prep.collect()] == [None, "9", "10", "100"]
    assert all(f.dataType.typeName() == "string" for f in prep.schema.fields)
    with pytest.raises(ValueError):
        prepare_full_refresh(df.union(df), "k", require_unique=True)
    packed = pack_sheets(df.where("k IS NOT NULL"), F.lit(0), "k", ["k", "v"])
    back = sheet_to_table(packed, "sheet").collect()
    assert [(r["row_index"], r["k"]) for r in back] == [(0, "9"), (1, "10"), (2, "100")]


def test_full_refresh_spreads_a_hot_key(spark):
    # a third of the rows share one key: the sort still uses several tasks
    rows = [(7, f"h{i}") for i in range(3000)] + [(i, f"o{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny data would merge
    try:
        prep = prepare_full_refresh(df, "k")
        sizes = prep.rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 3000
    keys = [int(r["k"]) for r in prep.collect()]
    assert keys == sorted(keys)


def test_catalog_write_modes_present_and_absent(spark):
    name = f"t15_{uuid.uuid4().hex[:6]}"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    write_table(df, name, "fail")  # absent: created
    with pytest.raises(Exception):
        write_table(df, name, "fail")  # present: refused
    write_table(df, name, "append")
    assert spark.table(name).count() == 4
    write_table(df.limit(1), name, "replace")
    assert spark.table(name).count() == 1
    absent = f"t15b_{uuid.uuid4().hex[:6]}"
    write_table(df, absent, "append")  # append to an absent table creates it
    assert spark.table(absent).count() == 2
    with pytest.raises(ValueError):
        write_table(df, name, "upsert")
    drop_table(spark, name)
    drop_table(spark, absent)


def test_remote_statements_need_text_predicates(spark, monkeypatch):
    from tessera.sources import tables
    sent = []
    monkeypatch.setattr(tables, "jdbc_execute", lambda spark, jdbc, stmt: sent.append(stmt))
    with pytest.raises(ValueError):
        tables.delete_where(spark, "t", F.col("k") == 0, jdbc={"url": "jdbc:none:"})
    # a name that is not plain is quoted, so it cannot end the statement
    tables.delete_where(spark, "bad name;", "k = 0", jdbc={"url": "jdbc:none:"})
    assert sent == ['DELETE FROM "bad name;" WHERE k = 0']


def test_write_table_with_index_column(spark):
    name = f"tix_{uuid.uuid4().hex[:6]}"
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    write_table(df, name, "replace", index="index", index_order=["s"])
    assert sorted((r["index"], r["s"]) for r in spark.table(name).collect()) == [(0, "a"), (1, "b"), (2, "c")]
    drop_table(spark, name)


def test_wide_sheet_matches_positions(spark):
    n = 45  # above the direct-lookup threshold
    titles = [{"title": f"T{i}"} for i in range(n)]
    rows = [{"cells": [{"value": f"{r}-{i}"} for i in range(n - (r % 3))]} for r in range(5)]
    df = spark.createDataFrame([(json.dumps({"columns": titles, "rows": rows}),)], "sheet string")
    out = sorted(sheet_to_table(df, "sheet").collect(), key=lambda r: r["row_index"])
    for r in out:
        k = r["row_index"]
        assert [r[f"T{i}"] for i in range(n)] == [f"{k}-{i}" if i < n - (k % 3) else None for i in range(n)]


def test_delete_keeps_the_layout(spark):
    import pytest

    from tessera.sources.tables import delete_where
    spark.sql("DROP TABLE IF EXISTS del_layout")
    spark.sql("CREATE TABLE del_layout (id INT, p STRING) USING ORC PARTITIONED BY (p) TBLPROPERTIES ('mine'='kept')")
    spark.sql("INSERT INTO del_layout VALUES (1,'a'),(2,'a'),(3,'b'),(NULL,'c')")
    delete_where(spark, "del_layout", "id >= 2")
    assert sorted(((r.id, r.p) for r in spark.table("del_layout").collect()), key=str) == [(1, "a"), (None, "c")]
    made = spark.sql("SHOW CREATE TABLE del_layout").first()[0]
    assert "USING ORC" in made and "PARTITIONED BY (p)" in made and "'mine' = 'kept'" in made
    spark.sql("DROP TABLE del_layout")
    # formats whose files do not describe themselves are rewritten whole, by way of <name>__kept
    spark.sql("CREATE TABLE del_layout (id INT, p STRING) USING JSON PARTITIONED BY (p) TBLPROPERTIES ('mine'='kept')")
    spark.sql("INSERT INTO del_layout VALUES (1,'a'),(2,'a'),(3,'b'),(NULL,'c')")
    delete_where(spark, "del_layout", "id >= 2")
    assert sorted(((r.id, r.p) for r in spark.table("del_layout").collect()), key=str) == [(1, "a"), (None, "c")]
    made = spark.sql("SHOW CREATE TABLE del_layout").first()[0]
    assert "USING JSON" in made and "PARTITIONED BY (p)" in made and "'mine' = 'kept'" in made
    spark.sql("CREATE TABLE del_layout__kept (x INT) USING PARQUET")
    with pytest.raises(ValueError, match="__kept"):
        delete_where(spark, "del_layout", "id = 1")
    spark.sql("DROP TABLE del_layout__kept")
    spark.sql("DROP TABLE del_layout")


def test_column_types_hold_for_catalog_tables(spark):
    name = f"t3_{uuid.uuid4().hex[:6]}"
    df = spark.createDataFrame([(1, "2.50")], "k long, v string")
    write_table(df, name, "replace", column_types={"v": "decimal(10,2)", "k": "int"})
    assert [t for _, t in spark.table(name).dtypes] == ["int", "decimal(10,2)"]
    with pytest.raises(ValueError):
        write_table(df, name, "replace", column_types={"other": "int"})
    drop_table(spark, name)


def test_remote_names_that_are_not_plain_are_quoted():
    from tessera.sources.tables import _quote_ident
    assert _quote_ident("dbo.Orders") == "dbo.Orders"
    assert _quote_ident('dbo.my "table') == 'dbo."my ""table"'


def test_sql_query_leaves_session_views_alone(spark):
    from tessera.sources.tables import sql_query
    spark.range(3).createOrReplaceTempView("mine")
    out = sql_query(spark, "SELECT count(*) AS n FROM mine JOIN other USING (id)",
                    views={"mine": spark.range(10), "other": spark.range(7)})
    assert spark.table("mine").count() == 3 and not spark.catalog.tableExists("other")
    assert out.first()["n"] == 7
    with pytest.raises(Exception):
        sql_query(spark, "SELECT nothing FROM mine", views={"mine": spark.range(10)})
    assert spark.table("mine").count() == 3
    spark.catalog.dropTempView("mine")
