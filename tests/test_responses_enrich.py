import json

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.nested import json_field, parse_doc, to_json_text
from tessera.functions.paths import location_text
from tessera.operators.enrich import enrich
from tessera.operators.responses import flatten_geocode, flatten_places

GEOCODE = [
    {"formatted_address": "1 Main St", "place_id": "a", "plus_code": {"compound_code": "CC", "global_code": "GG"},
     "geometry": {"location": {"lat": 1.5, "lng": 2.5}}, "address_components": [{"x": 1}],
     "types": ["street_address", "premise"]},
    {"formatted_address": "Town", "place_id": "b", "plus_code": None,
     "geometry": {"location": {"lat": 1.0, "lng": 2.0}}, "address_components": [], "types": None},
]
PLACES = [
    {"name": "Cafe", "plus_code": {"compound_code": "C1", "global_code": "G1"},
     "geometry": {"location": {"lat": 3.0, "lng": 4.0}}, "types": ["cafe", "food"], "icon": "i",
     "photos": [{"h": 1}], "opening_hours": {"open_now": True}},
    {"name": "Park", "geometry": {"location": {"lat": 3.1, "lng": 4.1}}, "types": ["park"], "vicinity": "v"},
]


def test_flatten_geocode_golden(spark):
    df = spark.createDataFrame([(10.0, 20.0, json.dumps(GEOCODE)), (11.0, 21.0, "[]"), (12.0, 22.0, None)],
                               "lat double, long double, response string")
    out = flatten_geocode(df, "response").orderBy("address_rank").collect()
    assert len(out) == 2  # empty and NULL responses add no rows
    r0, r1 = out
    assert (r0["address_rank"], r0["compound_code"], r0["global_code"], r0["gmaps_lat"], r0["gmaps_long"]) == \
        (0, "CC", "GG", 1.5, 2.5)
    assert (r1["address_rank"], r1["compound_code"], r1["global_code"]) == (1, None, None)
    assert (r0["premise"], r0["street_address"], r1["premise"], r1["street_address"]) == (1, 1, 0, 0)
    assert r0["lat"] == 10.0 and r0["formatted_address"] == "1 Main St"
    cols = set(out[0].asDict())
    assert not cols & {"plus_code", "geometry", "address_components", "types"}


def test_flatten_places_golden(spark):
    df = spark.createDataFrame([(10.0, 20.0, json.dumps(PLACES)), (11.0, 21.0, "[]")],
                               "centroid_latitude double, centroid_longitude double, response string")
    out = flatten_places(df, "response", "centroid_latitude", "centroid_longitude",
                         vocabulary=["cafe", "food", "park"]).orderBy("name").collect()
    assert [(r["name"], r["centroid_lat"], r["places_lat"], r["compound_code"], r["cafe"], r["park"])
            for r in out] == [("Cafe", 10.0, 3.0, "C1", 1, 0), ("Park", 10.0, 3.1, None, 0, 1)]
    assert out[1]["vicinity"] == "v"
    assert not set(out[0].asDict()) & {"photos", "icon", "opening_hours", "types", "geometry", "plus_code"}


CALLS = None


def test_enrich_one_call_per_key_and_failures(spark):
    acc = spark.sparkContext.accumulator(0)

    def service(rec):
        acc.add(1)
        if rec["k"] == "bad":
            raise RuntimeError("boom")
        return {"v": (rec["k"] or "none").upper()}

    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad"), (4, None), (5, "b")], "id int, k string")
    obs = Observation("lookup")
    out = enrich(df, ["k"], service, T.StructType([T.StructField("v", T.StringType())]), observation=obs)
    rows = {r["id"]: (r["v"], r["error"]) for r in out.collect()}
    assert acc.value == 4  # a, bad, NULL, b
    assert rows[1] == ("A", None) and rows[2] == ("A", None) and rows[4] == ("NONE", None)
    assert rows[3][0] is None and rows[3][1].startswith("RuntimeError")
    assert obs.get["skipped"] == 1 and obs.get["rows"] == 5
    # the lookup is checkpointed: recomputing the result calls nothing again
    out.count()
    assert acc.value == 4


def test_small_functions(spark):
    df = spark.createDataFrame([('{"a": {"b": 7}, "c": [1, 2]}', 1.5, -2.25)], "j string, la double, lo double")
    r = df.select(json_field(parse_doc("j"), "$.a.b", "int").alias("b"),
                  to_json_text(F.struct(F.lit(1).alias("x"))).alias("t"),
                  location_text("la", "lo").alias("loc")).first()
    assert (r["b"], r["t"], r["loc"]) == (7, '{"x":1}', "1.5,-2.25")


def test_join_distinct_splits_a_hot_key(spark):
    from tessera.operators.skew import join_distinct
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(3000)] + [(-1, None)] * 50,
                                "id int, k string")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), (None, 3)], "k string, v int")
    out = join_distinct(big, small, ["k"], "left", null_safe=True, hot_rows=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan
    rows = out.collect()
    assert len(rows) == 3050
    got = {}
    for r in rows:
        got[r["v"]] = got.get(r["v"], 0) + 1
    assert got == {1: 2000, 2: 1, None: 999, 3: 50}
    strict = join_distinct(big, small, ["k"], "inner", hot_rows=100).count()
    assert strict == 2001


def test_enrich_retries_transient_failures(spark):
    class Flaky:
        def __init__(self):
            self.seen = set()

    def service(client, rec):
        if rec["k"] not in client.seen:  # first call per key fails
            client.seen.add(rec["k"])
            raise TimeoutError("try again")
        return {"v": rec["k"] * 2}

    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    schema = T.StructType([T.StructField("v", T.IntegerType())])
    ok = enrich(df, ["k"], service, schema, client_factory=Flaky, retries=1, backoff_s=0.01).collect()
    assert sorted((r["k"], r["v"], r["error"]) for r in ok) == [(1, 2, None), (2, 4, None), (2, 4, None)]
    failed = enrich(df, ["k"], service, schema, client_factory=Flaky).collect()
    assert all(r["error"].startswith("TimeoutError") for r in failed)


def test_enrich_is_exact_and_parallel(spark):
    big = 9007199254740993
    long_text = "x" * 2000

    def service(rec):
        from pyspark import TaskContext
        if rec["k"] == 5:
            raise ValueError(long_text)
        return {"v": None if rec["k"] is None else rec["k"], "t": str(rec["k"]), "p": TaskContext.get().partitionId()}

    keys = [big, 7, None, 5, *range(100, 400)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    got = {r.k: r for r in enrich(frame, ["k"], service, T.StructType.fromDDL("v long, t string, p int"), partitions=6).collect()}
    assert (got[big].v, got[big].t) == (big, str(big)) and got[7].t == "7" and got[None].t == "None"
    assert got[5].v is None and got[5].error == f"ValueError: {long_text}"
    assert len({r.p for r in got.values() if r.p is not None}) > 1


def test_json_responses_keep_every_field(spark):
    from tessera.operators.responses import malformed_responses
    places = [dict(PLACES[0], rating=4.5, user_ratings_total=7, business_status="OPEN"), dict(PLACES[1], rating=3)]
    df = spark.createDataFrame([(1.0, 2.0, json.dumps(places)), (1.0, 2.0, "{broken")], "la double, lo double, response string")
    for frame in (df, df.selectExpr("la", "lo", "try_parse_json(response) AS response")):
        rows = sorted(flatten_places(frame, "response", "la", "lo").collect(), key=lambda r: r["name"])
        assert [(r["name"], r["rating"], r["user_ratings_total"], r["business_status"]) for r in rows] == [
            ("Cafe", 4.5, 7, "OPEN"), ("Park", 3.0, None, None)]
        assert rows[0]["places_lat"] == 3.0 and rows[0]["global_code"] == "G1"
    assert malformed_responses(df, "response") == 1
