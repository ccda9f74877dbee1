import os

import pytest
from pyspark.sql import types as T

from tessera.sources.files import list_files, read_csv, read_json_docs, read_lines, read_many, read_parquet
from tessera.sources.sinks import output_name, write_csv, write_json_docs, write_parquet


def _write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline="") as f:
        f.write(text)


CSV_A = ('id,name,score,flag,day,note\n'
         '1,"Smith, J",1.5,true,2024-01-02,"say ""hi"""\n'
         '2,NA,null,false,2024-01-03,"two\nlines"\n'
         ',x,,TRUE,,\n')


def test_read_csv_types_and_na(spark, tmpdir_path):
    p = f"{tmpdir_path}/a.csv"
    _write(p, CSV_A)
    df = read_csv(spark, p)
    types = {f.name: f.dataType for f in df.schema.fields}
    assert types["id"] == T.LongType() and types["score"] == T.DoubleType()
    assert types["flag"] == T.BooleanType() and types["day"] == T.StringType()
    rows = sorted(df.collect(), key=lambda r: (r["id"] is None, r["id"]))
    assert len(rows) == 3
    assert rows[0]["note"] == 'say "hi"' and rows[1]["note"] == "two\nlines"
    assert rows[1]["name"] is None and rows[1]["score"] is None and rows[2]["id"] is None
    assert rows[2]["flag"] is True


def test_read_many_mixed_headers_and_parquet(spark, tmpdir_path):
    _write(f"{tmpdir_path}/in/a.csv", "k,v\n1,x\n2,y\n")
    _write(f"{tmpdir_path}/in/b.csv", "v,w\nz,3\n")
    spark.createDataFrame([(5, 1.5)], "k long, p double").coalesce(1).write.parquet(f"{tmpdir_path}/pq1")
    spark.createDataFrame([("q",)], "s string").coalesce(1).write.parquet(f"{tmpdir_path}/pq2")
    pq1 = [f for f in os.listdir(f"{tmpdir_path}/pq1") if f.endswith(".parquet")][0]
    pq2 = [f for f in os.listdir(f"{tmpdir_path}/pq2") if f.endswith(".parquet")][0]
    os.rename(f"{tmpdir_path}/pq1/{pq1}", f"{tmpdir_path}/in/c.parquet")
    os.rename(f"{tmpdir_path}/pq2/{pq2}", f"{tmpdir_path}/in/d.parquet.snappy")
    _write(f"{tmpdir_path}/in/e.unknown", "ignored")
    listing = list_files(spark, f"{tmpdir_path}/in")
    df = read_many(spark, listing)
    rows = {tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in df.collect()}
    assert rows == {(("k", 1), ("v", "x")), (("k", 2), ("v", "y")), (("v", "z"), ("w", 3)),
                    (("k", 5), ("p", 1.5)), (("s", "q"),)}
    assert read_many(spark, [f"{tmpdir_path}/in/e.unknown"]).columns == []


def test_list_files_prefix_empty_and_hidden(spark, tmpdir_path):
    root = f"{tmpdir_path}/bucket"
    _write(f"{root}/pre/a.csv", "x\n1\n")
    _write(f"{root}/pre/deep/er/b.txt", "t")
    _write(f"{root}/prefix2/c.txt", "t")
    _write(f"{root}/pre/_hidden.txt", "h")
    _write(f"{root}/pre/empty.txt", "")
    _write(f"{root}/other/d.txt", "t")
    got = {r["path"].split("/bucket/")[1]: r["length"] for r in list_files(spark, root, "pre").collect()}
    assert got == {"pre/a.csv": 4, "pre/deep/er/b.txt": 1, "prefix2/c.txt": 1, "pre/_hidden.txt": 1,
                   "pre/empty.txt": 0}
    quick = {r["path"].split("/bucket/")[1] for r in list_files(spark, root, "pre", include_empty=False).collect()}
    assert "pre/empty.txt" not in quick and "pre/a.csv" in quick


def test_lines_and_json_docs(spark, tmpdir_path):
    _write(f"{tmpdir_path}/l.txt", "a\r\nb\n\nc")
    assert sorted(r[0] for r in read_lines(spark, f"{tmpdir_path}/l.txt").collect()) == ["", "a", "b", "c"]
    with pytest.raises(ValueError):
        read_lines(spark, f"{tmpdir_path}/l.csv")
    _write(f"{tmpdir_path}/d1.dict", '{"a": {"b": [1, 2]}, "n": null, "e": {}}')
    docs = read_json_docs(spark, f"{tmpdir_path}/d1.dict")
    r = docs.selectExpr("variant_get(doc, '$.a.b[1]', 'int') AS v", "path").first()
    assert r["v"] == 2 and r["path"].endswith("d1.dict")


def test_sink_round_trips(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 'q"x', None), (2, "", "b,c")], "id long, s string, t string")
    out = write_csv(df, f"{tmpdir_path}/o/", "report.v1.xlsx")
    assert out.endswith("/o/report.csv")
    back = read_csv(spark, out, na_tokens=())
    assert sorted((r["id"], r["s"], r["t"]) for r in back.collect()) == [(1, 'q"x', None), (2, None, "b,c")]
    pq = write_parquet(df, f"{tmpdir_path}/o/", "tab.parquet")
    assert sorted(tuple(r) for r in read_parquet(spark, pq).collect()) == sorted(tuple(r) for r in df.collect())
    docs = spark.createDataFrame([(1, "x")], "a int, b string").selectExpr("struct(a, b) AS doc")
    jd = write_json_docs(docs, f"{tmpdir_path}/o/", "meta")
    assert jd.endswith("meta.dict")
    assert spark.read.text(jd).first()[0] == '{"a":1,"b":"x"}'
    assert output_name("a.b.c", ".csv") == "a.csv"


def test_manifest_against_real_listing(spark, tmpdir_path):
    from tessera.operators.inventory import check_objects
    root = f"{tmpdir_path}/store"
    _write(f"{root}/a.txt", "x")
    _write(f"{root}/empty.txt", "")
    listing = list_files(spark, root)
    manifest = spark.createDataFrame([(f"file:{root}/a.txt",), (f"file:{root}/empty.txt",),
                                      (f"file:{root}/missing.txt",)], "path string")
    got = {r["path"].rsplit("/", 1)[1]: r["exists"] for r in check_objects(manifest, listing).collect()}
    assert got == {"a.txt": True, "empty.txt": True, "missing.txt": False}


def test_read_many_conflicting_parquet_types(spark, tmpdir_path):
    spark.createDataFrame([(1,)], "k int").coalesce(1).write.parquet(f"{tmpdir_path}/p1.parquet")
    spark.createDataFrame([("x",)], "k string").coalesce(1).write.parquet(f"{tmpdir_path}/p2.parquet")
    df = read_many(spark, [f"{tmpdir_path}/p1.parquet", f"{tmpdir_path}/p2.parquet"])
    assert df.schema["k"].dataType == T.StringType()
    assert sorted(r["k"] for r in df.collect()) == ["1", "x"]


def test_typed_readers(spark, tmpdir_path):
    _write(f"{tmpdir_path}/d.dict", '{"a": 5, "b": "q", "extra": [1]}')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                           T.StructField("missing", T.StringType())])
    r = read_json_docs(spark, f"{tmpdir_path}/d.dict", schema=schema).first()["doc"]
    assert (r["a"], r["b"], r["missing"]) == (5, "q", None)
    _write(f"{tmpdir_path}/t.csv", "a,b\n1,x\nNA,y\nz,w\n")
    typed = read_csv(spark, f"{tmpdir_path}/t.csv",
                     schema=T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]))
    assert sorted((r["a"] is None, r["b"]) for r in typed.collect()) == [(False, "x"), (True, "w"), (True, "y")]


def test_sql_query_with_args_and_views(spark):
    from tessera.sources.tables import sql_query
    df = spark.range(10).withColumnRenamed("id", "k")
    out = sql_query(spark, "SELECT count(*) AS n FROM t WHERE k >= :lo", args={"lo": 7}, views={"t": df})
    assert out.first()["n"] == 3


def test_reference_style_workflow(spark, tmpdir_path):
    """List a prefix, inventory it, read everything readable, write the result."""
    from tessera.operators.inventory import crawl_prefix
    root = f"{tmpdir_path}/bucket"
    _write(f"{root}/exports/2024/a.csv", "id,v\n1,x\n2,y\n")
    _write(f"{root}/exports/2024/b.csv", "id,v\n3,z\n")
    _write(f"{root}/exports/2024/notes.txt", "skip me")
    _write(f"{root}/exports/empty.csv", "")
    _write(f"{root}/other/c.csv", "id,v\n9,q\n")
    levels, paths = crawl_prefix(spark, root, "exports")
    assert levels.columns == ["Level 0", "Level 1", "Level 2", "Size"]
    assert sorted(tuple(r) for r in levels.collect()) == [
        ("exports", "2024", "a.csv", len("id,v\n1,x\n2,y\n")), ("exports", "2024", "b.csv", len("id,v\n3,z\n")),
        ("exports", "2024", "notes.txt", len("skip me"))]
    assert sorted(r[0] for r in paths.collect()) == [
        "exports/2024/a.csv", "exports/2024/b.csv", "exports/2024/notes.txt", "exports/empty.csv"]
    listing = list_files(spark, root, "exports").where("length > 0")
    combined = read_many(spark, listing)
    assert sorted((r["id"], r["v"]) for r in combined.collect()) == [(1, "x"), (2, "y"), (3, "z")]
    out = write_parquet(combined, f"{tmpdir_path}/out/", "combined.v2")
    assert read_parquet(spark, out).count() == 3


def test_read_csv_split_mode(spark, tmpdir_path):
    _write(f"{tmpdir_path}/s.csv", "a,b\n" + "".join(f"{i},x{i}\n" for i in range(1000)))
    df = read_csv(spark, f"{tmpdir_path}/s.csv", multi_line=False)
    assert df.count() == 1000 and df.schema["a"].dataType == T.LongType()


def test_header_grouping(spark, tmpdir_path):
    import tessera.sources.files as files
    _write(f"{tmpdir_path}/h/a b.csv", "id,v\n1,x\n")
    _write(f"{tmpdir_path}/h/c%d.csv", "id,w\n2,y\n")
    _write(f"{tmpdir_path}/h/e.csv", "id,v\n3,z\n")
    _write(f"{tmpdir_path}/h/empty.csv", "")
    paths = [f"{tmpdir_path}/h/{n}" for n in ("a b.csv", "c%d.csv", "e.csv", "empty.csv")]
    assert files._headers(spark, paths) == ["id,v", "id,w", "id,v", ""]
    listing_paths = [r[0] for r in list_files(spark, f"{tmpdir_path}/h").collect()]
    got = dict(zip(listing_paths, files._headers(spark, listing_paths)))
    assert sorted(got.values()) == ["", "id,v", "id,v", "id,w"]
    df = read_many(spark, [p for p in paths if not p.endswith("empty.csv")])
    assert sorted((r["id"], r["v"], r["w"]) for r in df.collect()) == [(1, "x", None), (2, None, "y"), (3, "z", None)]


def test_infer_types_mixed_columns(spark):
    from tessera.sources.files import infer_types
    df = spark.createDataFrame(
        [("1", "1", "true", None, "x", " 7 "), ("2.5", "1e3", "1", None, "1", "8")],
        "a string, b string, c string, d string, e string, f string")
    t = infer_types(df)
    assert t == {"a": T.DoubleType(), "b": T.DoubleType(), "c": T.StringType(), "d": T.StringType(),
                 "e": T.StringType(), "f": T.LongType()}


def test_source_paths_match_listing(spark, tmpdir_path):
    _write(f"{tmpdir_path}/p/a b+c.dict", '{"x": 1}')
    _write(f"{tmpdir_path}/p/l 1.txt", "one\ntwo\n")
    listed = {r["path"] for r in list_files(spark, f"{tmpdir_path}/p").collect()}
    doc_paths = {r["path"] for r in read_json_docs(spark, f"{tmpdir_path}/p/a b+c.dict").collect()}
    line_paths = {r["path"] for r in read_lines(spark, f"{tmpdir_path}/p/l 1.txt", with_path=True).collect()}
    assert doc_paths <= listed and line_paths <= listed


def test_headers_of_relative_paths_beyond_five_thousand_files(spark, tmpdir_path, monkeypatch):
    import tessera.sources.files as files
    _write(f"{tmpdir_path}/csv/a.csv", "x,y\n1,2\n")
    _write(f"{tmpdir_path}/csv/b.csv", "y,x\n10,20\n")
    monkeypatch.chdir(tmpdir_path)
    # the JVM keeps its own working directory, so relative paths go through a link from there
    import os
    rel = os.path.relpath(tmpdir_path, spark._jvm.java.lang.System.getProperty("user.dir"))
    paths = [f"{rel}/csv/a.csv"] * 5001 + [f"{rel}/csv/b.csv"]
    assert files._headers(spark, paths) == ["x,y"] * 5001 + ["y,x"]
    got = read_many(spark, [f"{rel}/csv/a.csv", f"{rel}/csv/b.csv"]).collect()
    assert sorted((r["x"], r["y"]) for r in got) == [(1, 2), (20, 10)]


def test_parquet_schemas_under_one_glob_or_directory(spark, tmpdir_path):
    spark.range(2).selectExpr("id", "1 AS a").write.parquet(f"{tmpdir_path}/pq/one.parquet")
    spark.range(2).selectExpr("id", "2 AS b").write.parquet(f"{tmpdir_path}/pq/two.parquet")
    got = read_many(spark, [f"{tmpdir_path}/pq/*.parquet"])
    assert sorted(got.columns) == ["a", "b", "id"] and got.count() == 4


def test_glob_characters_and_hidden_names_in_listings(spark, tmpdir_path):
    import pytest
    for name in ("a[1]x.csv", "a1y.csv"):
        _write(f"{tmpdir_path}/g/{name}", "id\n1\n")
    listing = list_files(spark, f"{tmpdir_path}/g", "a[1]")
    assert [r["path"].rsplit("/", 1)[1] for r in listing.collect()] == ["a[1]x.csv"]
    assert read_many(spark, listing).count() == 1
    _write(f"{tmpdir_path}/u/_h.csv", "id\n1\n")
    with pytest.raises(ValueError, match="_h.csv"):
        read_many(spark, list_files(spark, f"{tmpdir_path}/u"))


def test_whole_json_documents_and_nulls(spark, tmpdir_path):
    import json

    from tessera.sources.sinks import write_json_docs
    doc = {"a": {"b": [1, 2, None]}, "c": "x\ny"}
    _write(f"{tmpdir_path}/d/one.dict", json.dumps(doc, indent=2))
    rows = read_json_docs(spark, f"{tmpdir_path}/d/one.dict").selectExpr("to_json(doc) AS j").collect()
    assert [json.loads(r.j) for r in rows] == [doc]
    typed = read_json_docs(spark, f"{tmpdir_path}/d/one.dict", T.StructType.fromDDL("c string")).collect()
    assert [r.doc.c for r in typed] == ["x\ny"]
    out = write_json_docs(spark.sql("SELECT struct(0 AS id, CAST(NULL AS INT) AS n) AS doc"), f"{tmpdir_path}/d/", "nulls")
    assert [r.value for r in spark.read.text(out).collect()] == ['{"id":0,"n":null}']


def test_strict_schema(spark, tmpdir_path):
    import pytest
    _write(f"{tmpdir_path}/s/t.csv", "id\n1\nabc\n")
    schema = T.StructType.fromDDL("id bigint")
    assert [r.id for r in read_csv(spark, f"{tmpdir_path}/s/t.csv", schema=schema).collect()] == [1, None]
    with pytest.raises(Exception, match="does not hold a bigint"):
        read_csv(spark, f"{tmpdir_path}/s/t.csv", schema=schema, strict=True).collect()
