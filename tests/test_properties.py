"""Property tests (hypothesis) for unions and CSV typing."""
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tessera.operators.reshape import union_all_by_name
from tessera.sources.files import read_csv
from tessera.sources.sinks import write_csv

NAMES = ["a", "b", "c", "d"]
TYPES = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


@st.composite
def frames(draw):
    out = []
    for _ in range(draw(st.integers(1, 5))):
        cols = draw(st.lists(st.sampled_from(NAMES), min_size=1, max_size=4, unique=True))
        kinds = [draw(st.sampled_from(sorted(TYPES))) for _ in cols]
        n = draw(st.integers(0, 4))
        out.append((cols, kinds, n))
    return out


def _value(kind, i):
    return {"long": i, "double": i + 0.5, "string": f"s{i}"}[kind]


@settings(max_examples=8, deadline=None)
@given(frames())
def test_union_keeps_every_row_and_all_columns(spark, spec):
    dfs = []
    for cols, kinds, n in spec:
        schema = T.StructType([T.StructField(c, TYPES[k]) for c, k in zip(cols, kinds)])
        dfs.append(spark.createDataFrame([tuple(_value(k, i) for k in kinds) for i in range(n)], schema))
    u = union_all_by_name(dfs)
    assert u.count() == sum(n for _, _, n in spec)
    assert set(u.columns) == {c for cols, _, _ in spec for c in cols}
    for name in u.columns:
        kinds = {k for cols, ks, _ in spec for c, k in zip(cols, ks) if c == name}
        want = ("string" if "string" in kinds and len(kinds) > 1 else
                "double" if "double" in kinds and len(kinds) > 1 else next(iter(kinds)))
        assert u.schema[name].dataType == TYPES[want]


cells = st.one_of(st.integers(-10**12, 10**12).map(str),
                  st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
                  st.text(alphabet="ab ,\"\n'x", min_size=1, max_size=6))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cells, cells), min_size=1, max_size=6))
def test_csv_round_trip_preserves_text(spark, rows):
    import tempfile
    base = tempfile.mkdtemp(prefix="tessera-prop-")
    df = spark.createDataFrame(rows, "x string, y string")
    target = write_csv(df, base + "/", "t")
    back = read_csv(spark, target, na_tokens=(), infer=False)
    assert sorted(tuple(r) for r in back.collect()) == sorted((a, b) for a, b in rows)
    assert os.path.isdir(target)


_TOKENS = {
    "int": st.integers(-10**9, 10**9).map(str),
    "float": st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: f"{f:.3f}"),
    "bool": st.sampled_from(["True", "False", "true", "false", "TRUE", "FALSE"]),
    "text": st.text(alphabet="abcxyz", min_size=1, max_size=5).filter(
        lambda t: t.lower() not in ("nan", "null", "none", "true", "false", "inf")),
}
_NA = st.sampled_from(["", "NA", "null", "NaN", "N/A"])


@st.composite
def csv_tables(draw):
    kinds = draw(st.lists(st.sampled_from(sorted(_TOKENS)), min_size=1, max_size=4))
    n = draw(st.integers(1, 8))
    rows = []
    for _ in range(n):
        rows.append([draw(st.one_of(_TOKENS[k], _NA) if draw(st.booleans()) else _TOKENS[k]) for k in kinds])
    return kinds, rows


@settings(max_examples=12, deadline=None)
@given(csv_tables())
def test_csv_typing_agrees_with_pandas(spark, table):
    import io
    import math
    import tempfile

    import pandas as pd
    kinds, rows = table
    text = ",".join(f"c{i}" for i in range(len(kinds))) + "\n" + "\n".join(",".join(r) for r in rows) + "\n"
    path = tempfile.mkdtemp(prefix="tessera-pd-") + "/t.csv"
    with open(path, "w") as f:
        f.write(text)
    ours = read_csv(spark, path)
    theirs = pd.read_csv(io.StringIO(text))
    for i in range(len(kinds)):
        c = f"c{i}"
        ptype = theirs[c].dtype
        stype = ours.schema[c].dataType
        if theirs[c].isna().all():
            # all missing: pandas says float64, the design keeps STRING
            assert stype == T.StringType(), (c, stype)
        elif ptype.kind == "i":
            assert stype == T.LongType(), (c, ptype, stype)
        elif ptype.kind == "f":
            # pandas turns integers with gaps into floats; this engine keeps BIGINT
            assert stype in (T.DoubleType(), T.LongType()), (c, ptype, stype)
        elif ptype.kind == "b":
            assert stype == T.BooleanType(), (c, ptype, stype)
        else:
            assert stype in (T.StringType(), T.BooleanType()), (c, ptype, stype)
    got = ours.collect()
    for r_idx, r in enumerate(got):
        for i in range(len(kinds)):
            mine, want = r[f"c{i}"], theirs.iloc[r_idx, i]
            if want is None or (isinstance(want, float) and math.isnan(want)):
                assert mine is None
            elif isinstance(mine, bool) or isinstance(mine, str):
                assert str(mine).lower() == str(want).lower()
            else:
                assert abs(float(mine) - float(want)) <= 1e-9 * max(1.0, abs(float(want)))


_path_part = st.text(alphabet="ab.c_-", min_size=0, max_size=4)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s3://", "S3://", ""]),
                          st.lists(_path_part, min_size=1, max_size=4)), min_size=1, max_size=12))
def test_path_rules_match_python(spark, items):
    from pyspark.sql import functions as F

    from tessera.functions.paths import file_format, object_stem, parse_object_path
    from tessera.operators.inventory import crawl_size
    paths = [scheme + "/".join(parts) for scheme, parts in items]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, path string")
    got = {r["i"]: r for r in df.select("i", parse_object_path("path").alias("pp"),
                                        object_stem("path").alias("stem"),
                                        file_format("path").alias("fmt")).collect()}
    for i, p in enumerate(paths):
        rest = p[5:] if p.startswith("s3://") else p
        want = tuple(rest.split("/", 1)) if "/" in rest else (None, None)
        assert tuple(got[i]["pp"]) == want, p
        assert got[i]["stem"] == p.split(".")[0], p
        fmt = ("csv" if p.endswith(".csv") else "parquet" if p.endswith((".parquet", ".pq", ".parquet.snappy"))
               else "json" if p.endswith(".dict") else "text" if p.endswith(".txt") else None)
        assert got[i]["fmt"] == fmt, p
    sizes = spark.createDataFrame([(p, i % 3) for i, p in enumerate(paths)], "path string, length long")
    levels, all_paths = crawl_size(sizes)
    depth = max(len(p.split("/")) for p in paths)
    want_rows = [tuple((p.split("/") + [None] * depth)[:depth]) + (i % 3,)
                 for i, p in enumerate(paths) if i % 3 > 0]
    key = lambda t: tuple("" if v is None else str(v) for v in t)
    assert sorted((tuple(r) for r in levels.collect()), key=key) == sorted(want_rows, key=key)
    assert sorted(r[0] for r in all_paths.collect()) == sorted(paths)
