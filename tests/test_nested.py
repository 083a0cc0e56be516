"""Flatten (N1/N2) and the page reader (A4/A5) on tiny documents."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.nested import array_sizes, flatten
from tessera.sources.files import read_pages

DOC_SCHEMA = ("id string, sales struct<public:struct<startDateTime:string>,"
              "presales:array<struct<name:string>>>, priceRanges array<struct<min:double,max:double>>,"
              "_embedded struct<venues:array<struct<name:string,city:struct<name:string>>>,"
              "attractions:array<struct<name:string>>>")


def _docs(spark):
    data = [
        ("e1", {"public": {"startDateTime": "2024-01-01"}, "presales": [{"name": "p0"}, {"name": "p1"}]},
         [{"min": 1.0, "max": 2.0}], {"venues": [{"name": "v", "city": {"name": "c"}}],
                                      "attractions": [{"name": f"a{i}"} for i in range(12)]}),
        ("e2", {"public": None, "presales": []}, None, {"venues": [], "attractions": []}),
    ]
    return spark.createDataFrame(data, DOC_SCHEMA)


def test_flatten_names_positions_and_nulls(spark):
    df = _docs(spark)
    sizes = array_sizes(df, ["sales", "priceRanges", "_embedded"])
    assert sizes[("sales", "presales")] == 2 and sizes[("_embedded", "attractions")] == 12
    flat = flatten(df, ["sales", "priceRanges", "_embedded"])
    cols = flat.columns
    assert cols[:4] == ["id", "public_startDateTime", "presales_0_name", "presales_1_name"]
    assert {"0_min", "0_max", "venues_0_name", "venues_0_city_name", "attractions_11_name"} <= set(cols)
    r2 = flat.filter(F.col("id") == "e2").first()
    assert r2["presales_0_name"] is None and r2["0_min"] is None and r2["attractions_11_name"] is None


def test_flatten_prefix_caps_and_duplicates(spark):
    df = _docs(spark)
    capped = flatten(df, ["_embedded"], nested_positions=2)
    assert "attractions_1_name" in capped.columns and "attractions_2_name" not in capped.columns
    pre = flatten(df, ["sales"], prefix=True)
    assert "sales_public_startDateTime" in pre.columns
    clash = df.withColumn("dup", F.struct(F.lit(1).alias("id")))
    with pytest.raises(ValueError):
        flatten(clash, ["dup"])


def test_read_pages_stop_rule_and_missing_keys(spark, tmp_path):
    pages = [
        {"page": {"number": 0, "totalPages": 2}, "_embedded": {"events": [{"id": "a", "name": "A"}, {"id": "b"}]}},
        {"page": {"number": 1, "totalPages": 2}, "_embedded": {"events": [{"id": "c", "name": "C"}]}},
        {"page": {"number": 2, "totalPages": 2}, "_embedded": {"events": [{"id": "never"}]}},
        {"fault": "no page"},
    ]
    path = tmp_path / "pages"
    os.makedirs(path)
    with open(path / "part-0.json", "w") as fh:
        fh.write("\n".join(json.dumps(p) for p in pages))
    schema = "page struct<number:int,totalPages:int>, _embedded struct<events:array<struct<id:string,name:string>>>"
    ev = read_pages(spark, str(path), schema)
    got = sorted((r.id, r.name) for r in ev.collect())
    assert got == [("a", "A"), ("b", None), ("c", "C")]


def test_flatten_top_level_cap(spark):
    capped = flatten(_docs(spark), ["priceRanges", "sales"], top_positions=1, nested_positions=1)
    assert "0_min" in capped.columns and "presales_1_name" not in capped.columns


def test_flatten_arrays_inside_arrays(spark):
    schema = "id int, sales struct<presales:array<struct<name:string,tags:array<string>>>>"
    data = [(1, {"presales": [{"name": "a", "tags": ["x"]}, {"name": "b", "tags": ["y", "z", "w"]}]}),
            (2, {"presales": [{"name": "c", "tags": []}]})]
    df = spark.createDataFrame(data, schema)
    sizes = array_sizes(df, ["sales"])
    assert sizes[("sales", "presales")] == 2 and sizes[("sales", "presales", "[]", "tags")] == 3
    flat = flatten(df, ["sales"])
    assert flat.columns == ["id", "presales_0_name", "presales_0_tags_0", "presales_0_tags_1", "presales_0_tags_2",
                            "presales_1_name", "presales_1_tags_0", "presales_1_tags_1", "presales_1_tags_2"]
    r1 = flat.filter("id = 1").first()
    assert (r1.presales_1_tags_2, r1.presales_0_tags_1) == ("w", None)


def _land(path, docs):
    os.makedirs(path)
    for i, part in enumerate((docs[::2], docs[1::2])):  # keys differ from file to file
        with open(path / f"part-{i}.json", "w") as fh:
            fh.write("\n".join(json.dumps(d) for d in part))


OPEN = [
    {"page": {"number": 0, "totalPages": 3}, "_embedded": {"events": [
        {"id": "a", "price": 1, "open": {"k-1": {"x": 1.5}, "k.2": True}, "tags": ["t"]}, {"id": "b", "price": 2.25, "code": 7}]}},
    {"page": {"number": 1, "totalPages": 3}, "_embedded": {"events": [
        {"id": "c", "open": {"k`3": None, "a b": "s"}, "code": "seven", "tags": ["u", "v"]}, {"extra": {"deep": {"er": "!"}}}]}},
    {"page": {"number": 2, "totalPages": 3}, "_embedded": {"events": []}},
    {"page": {"number": 3, "totalPages": 3}, "_embedded": {"events": [{"never": 1}]}},
    {"fault": {"never": 2}},
]


def test_pages_without_a_schema_keep_every_key_A5(spark, tmp_path):
    _land(tmp_path / "pages", OPEN)
    ev = read_pages(spark, str(tmp_path / "pages"))
    assert set(ev.columns) == {"id", "price", "open", "tags", "code", "extra"}
    flat = flatten(ev, ["open", "extra", "tags", "code"])
    got = {r["id"]: r.asDict() for r in flat.collect()}
    none = dict.fromkeys(["id", "price", "k-1_x", "k.2", "k`3", "a b", "deep_er", "0", "1", "code"])
    number = {k: float(v["price"]) for k, v in got.items() if v["price"] is not None}
    assert number == {"a": 1.0, "b": 2.25}
    got = {k: {c: v for c, v in r.items() if c != "price"} for k, r in got.items()}
    want = {"a": {"id": "a", "k-1_x": got["a"]["k-1_x"], "k.2": True, "0": "t"}, "b": {"id": "b", "code": "7"},
            "c": {"id": "c", "a b": "s", "code": "seven", "0": "u", "1": "v"}, None: {"deep_er": "!"}}
    none.pop("price")
    assert got == {k: none | v for k, v in want.items()} and float(got["a"]["k-1_x"]) == 1.5


def test_pages_without_events(spark, tmp_path):
    _land(tmp_path / "pages", OPEN[2:])
    assert read_pages(spark, str(tmp_path / "pages")).count() == 0


def test_flatten_maps_and_variants_by_their_keys_N1(spark):
    df = spark.createDataFrame([(1, {"a": {"x": 1}, "b": {"y": 2}}, [{"k": 1.0}, {"l": 2.0}]), (2, {"c": {"x": 3}}, None), (3, None, [])],
                               "id int, m map<string, map<string, int>>, l array<map<string, double>>")
    flat = flatten(df, ["m", "l"])
    assert flat.columns == ["id", "a_x", "b_y", "c_x", "0_k", "0_l", "1_k", "1_l"]
    assert sorted(tuple(r) for r in flat.collect()) == [(1, 1, 2, None, 1.0, None, None, 2.0), (2, None, None, 3, *[None] * 4), (3, *[None] * 7)]
    v = df.select("id", F.to_variant_object("m").alias("m"))
    assert flatten(v, ["m"]).columns == ["id", "a_x", "b_y", "c_x"]
    # one aggregation finds the keys, one projection reads them: no shuffle in the plan
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_keys_that_differ_in_case_only_are_refused(spark):
    df = spark.createDataFrame([({"a": 1, "A": 2},)], "m map<string, int>")
    with pytest.raises(ValueError, match="case"):
        flatten(df, ["m"])
