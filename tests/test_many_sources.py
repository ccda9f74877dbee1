"""Files of many headers in one plan; listings made by tasks."""
import os

from tessera.sources.files import list_files, read_many, walk_files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


def _rows(df):
    return sorted((tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in df.collect()), key=repr)


def test_many_headers_in_one_plan(spark, tmpdir_path):
    for i in range(60):
        _write(f"{tmpdir_path}/in/f{i}.csv", f'id,"col\n{i}",Name\n{i},{i * 2}.5,"a\n""b"""\n{i + 100},NA,\n\n')
    _write(f"{tmpdir_path}/in/g.csv", "\ufeffname,id\r\nzed,7\r\n")
    _write(f"{tmpdir_path}/in/h.csv", "id\n")
    listing = list_files(spark, f"{tmpdir_path}/in")
    one, many = read_many(spark, listing, one_scan=True), read_many(spark, listing)
    assert len(one.columns) == 62 and {c.lower() for c in one.columns} == {c.lower() for c in many.columns} | {"name"}
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2  # whole records, and those that cross a range
    got = {r["id"]: r for r in one.collect()}
    assert one.count() == 121 and len(got) == 120 and dict(one.dtypes)["id"] == "bigint" and dict(one.dtypes)["col\n3"] == "double"
    name = next(c for c in one.columns if c.lower() == "name")
    assert got[3]["col\n3"] == 6.5 and got[3][name] == 'a\n"b"' and got[103]["col\n3"] is None and got[7][name] in ("zed", 'a\n"b"')


def test_one_scan_equals_one_per_header(spark, tmpdir_path):
    _write(f"{tmpdir_path}/a.csv", "k,v\n1,x\n2,\"y,\nz\"\n3\n")
    _write(f"{tmpdir_path}/b.csv", "v,w\nz,3,extra\n")
    _write(f"{tmpdir_path}/c.csv", "w,k\n2.5,9\n")
    paths = [f"{tmpdir_path}/{n}.csv" for n in "abc"]
    one, many = read_many(spark, paths, one_scan=True), read_many(spark, paths)
    assert _rows(one) == _rows(many) and sorted(one.dtypes) == sorted(many.dtypes)
    assert _rows(read_many(spark, paths, one_scan=True, infer=False)) == _rows(read_many(spark, paths, infer=False))
    _write(f"{tmpdir_path}/empty.csv", "")
    assert read_many(spark, [f"{tmpdir_path}/empty.csv"], one_scan=True).count() == 0


def test_walk_equals_driver_listing(spark, tmpdir_path):
    root = f"{tmpdir_path}/bucket"
    for path, text in (("pre/a.csv", "x\n1\n"), ("pre/deep/er/b é+%.txt", "t"), ("prefix2/c.txt", "tt"), ("pre/_hidden.txt", "h"),
                       ("pre/empty.txt", ""), ("other/d.txt", "d"), ("pre/.dot/e", "e"), ("top.txt", "t")):
        _write(f"{root}/{path}", text)
    os.makedirs(f"{root}/pre/nothing")
    for i in range(300):
        _write(f"{root}/pre/wide/{i}.txt", "w" * i)
    for prefix in ("", "pre", "pre/", "pre/deep", "pre/wide/29", "none", "top"):
        want = sorted((r.path.removeprefix("file:"), r.length, r.modificationTime.replace(microsecond=0)) for r in list_files(spark, root, prefix).collect())
        for base in (root, "file:" + root):
            got = walk_files(spark, base, prefix, tasks=3)
            assert got.columns == ["path", "length", "modificationTime"]
            assert sorted((r.path.removeprefix("file:"), r.length, r.modificationTime.replace(microsecond=0)) for r in got.collect()) == want, prefix


def test_walk_takes_any_lister(spark):
    tree = {"s://b": [("s://b/x", True, 0, None), ("s://b/f", False, 3, 1.5)], "s://b/x": [("s://b/x/g", False, 0, None)]}
    got = {(r.path, r.length) for r in walk_files(spark, "s://b", lister=lambda folder: iter(tree[folder])).collect()}
    assert got == {("s://b/f", 3), ("s://b/x/g", 0)}
