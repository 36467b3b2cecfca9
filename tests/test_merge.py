"""Deep merge of whole documents against a dictionary merge written for the test, and the published recommendation examples."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions import merge as mg
from fleetlens.operators.jobs import recommended_definition
from fleetlens.operators.recommend import parsed_patches, templated

BASE = {"a": 1, "s": {"x": 1, "y": "b", "z": {"q": 5}}, "m": {"k": "v", "k2": "w"}, "l": [1], "n": "old"}


def merged(base, patch):
    out = dict(base)
    for key, value in patch.items():
        old = out.get(key)
        if isinstance(old, dict) and isinstance(value, dict):
            out[key] = merged(old, value)
        elif isinstance(old, list) and isinstance(value, list):
            out[key] = old + value
        else:
            out[key] = value
    return out


def run(spark, pairs):
    """Merge (base, patch) pairs in one table, as deep as its deepest patch."""
    rows = [(k, json.dumps(a), None if b is None else json.dumps(b)) for k, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "k int, base string, text string")
    df, depth = parsed_patches(df, "text", "patch")
    df = df.select("k", F.parse_json("base").alias("base"), "patch")
    got = df.select("k", F.to_json(mg.merge_documents(F.col("base"), F.col("patch"), depth)).alias("m")).orderBy("k").collect()
    return [None if r.m is None else json.loads(r.m) for r in got]


FIXED = [
    (BASE, {}), (BASE, {"a": 2, "s": {"y": None, "z": {"q": 9}}, "m": {"k": None, "n:x": "1"}, "l": [2, 3]}),
    (BASE, {"a": None, "s": None, "m": None, "l": None}), (BASE, {"n": "new", "s": {"x": 4}}), ({}, {"s": {"x": 3}, "l": []}),
    (BASE, {"s": 5, "a": {"now": "an object"}, "l": {"k": 1}, "m": [1]}), ({"a": None}, {"a": {"b": 1}}),
    ({"a": 1, "u": {"x": [1], "y": {"deep": {"er": 1}}}}, {"u": {"x": [2, {"z": None}], "y": {"deep": {"new": 2}}}, "p": {"q": 1}}),
    ({"we`ird": {"<k>": {"a": 1}}}, {"we`ird": {"<k>": {"b": [1]}}}),
]


def test_merge_matches_dictionaries(spark):
    assert run(spark, FIXED) == [merged(a, b) for a, b in FIXED]


def test_no_patch_changes_nothing(spark):
    assert run(spark, [(BASE, None), ({}, None)]) == [BASE, {}]


leaf = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.text(alphabet="ab<>`\"é", max_size=3))
document = st.dictionaries(st.sampled_from(["a", "b", "c<", "d`"]), st.recursive(
    leaf, lambda x: st.one_of(st.lists(x, max_size=2), st.dictionaries(st.sampled_from(["a", "b", ">", "e"]), x, max_size=3)), max_leaves=8), max_size=3)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(document, document), min_size=1, max_size=20))
def test_merge_matches_dictionaries_on_any_documents(spark, pairs):
    assert run(spark, pairs) == [merged(a, b) for a, b in pairs]


def chain(depth, leaf_):
    out = leaf_
    for _ in range(depth):
        out = {"k": out}
    return out


def test_depth_follows_the_patches(spark):
    """Far deeper than any fixed number of levels; keys of the base survive at the bottom."""
    base, patch = chain(40, {"old": 1}), chain(40, {"new": 2})
    assert run(spark, [(base, patch), (BASE, {"a": 3})]) == [chain(40, {"old": 1, "new": 2}), merged(BASE, {"a": 3})]


def test_patches_too_deep_are_errors(spark, monkeypatch):
    monkeypatch.setattr(mg, "MOST_NESTED", 3)
    monkeypatch.setattr("fleetlens.operators.recommend.MOST_NESTED", 3)
    rows = spark.createDataFrame([("p", json.dumps(chain(5, 1))), ("q", '{"k":{"b":2}}')], "project_id string, template string")
    bases = spark.createDataFrame([("p", '{"k":{"a":1}}'), ("q", '{"k":{"a":1}}'), ("r", '{"k":1}')], "project_id string, t string")
    got = templated(bases.select("project_id", F.parse_json("t").alias("d")), "d", rows)
    got = {r.project_id: (r.m, r.template_error) for r in got.select("project_id", F.to_json("d").alias("m"), "template_error").collect()}
    assert got == {"p": (None, "Document nests too deeply"), "q": ('{"k":{"a":1,"b":2}}', None), "r": ('{"k":1}', None)}


def test_nesting(spark):
    texts = ["1", "{}", "[]", '{"a":[1,[2]],"b":{"c<<":1}}', '{"<<<<":1}', '[{"a":{"b":{}}}]']
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", F.parse_json("t").alias("v"))
    got = [r.n for r in df.select("k", mg.nesting(F.col("v")).alias("n")).orderBy("k").collect()]
    # Arrays of unlike items count as one level.
    assert got == [0, 1, 1, 2, 1, 4]
    assert mg.patch_depth(df, "v") == 4 and mg.patch_depth(df.limit(0), "v") == 0


def test_members_are_set_and_removed(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"c":2},"d":null}',), ("[1]",), ("null",)], "t string").select(F.parse_json("t").alias("v"))
    got = df.select(
        F.to_json(mg.with_keys(F.col("v"), a=mg.scalar(F.lit("x")), b=F.lit(None).cast("variant"), e=F.parse_json(F.lit("[1]")))).alias("w"),
        F.to_json(mg.without_keys(F.col("v"), "a", "none")).alias("o"), mg.is_blank_object(F.col("v")).alias("blank"),
        F.to_json(mg.object_of(k=mg.scalar(F.lit(5)), none=F.lit(None).cast("variant"))).alias("n"),
        F.to_json(mg.array_of(mg.items(F.col("v")))).alias("items")).collect()
    assert json.loads(got[0].w) == {"a": "x", "d": None, "e": [1]} and json.loads(got[0].o) == {"b": {"c": 2}, "d": None}
    assert [(r.blank, r.o, r.items) for r in got[1:]] == [(True, "[1]", "[1]"), (True, "null", None)] and got[0].n == '{"k":5}'


CASES = {
    "aws": (
        {"cluster_id": "c1", "aws_attributes": {"zone_id": "us-west-2c", "first_on_demand": 1, "ebs_volume_count": 0,
                                                "availability": "SPOT_WITH_FALLBACK", "spot_bid_price_percent": 100},
         "node_type_id": "i3.xlarge", "driver_node_type_id": "i3.xlarge", "num_workers": 30,
         "autoscale": {"min_workers": 1, "max_workers": 40}, "instance_source": {"node_type_id": "i3.xlarge"}},
        {"node_type_id": "i6.xlarge", "driver_node_type_id": "i6.xlarge", "num_workers": 20,
         "custom_tags": {"sync:project-id": "p", "sync:run-id": "r"}, "spark_conf": {"spark.x.product": "y"},
         "runtime_engine": "PHOTON",
         "aws_attributes": {"first_on_demand": 1, "availability": "SPOT_WITH_FALLBACK", "spot_bid_price_percent": 100}},
    ),
    "azure": (
        {"cluster_id": "c2", "azure_attributes": {"first_on_demand": 6, "availability": "SPOT_WITH_FALLBACK_AZURE",
                                                  "spot_bid_max_price": 100.0},
         "node_type_id": "Standard_DS5_v2", "num_workers": 30, "spark_context_id": 8637481617925571639},
        {"node_type_id": "Standard_D4s_v3", "num_workers": 5, "runtime_engine": "STANDARD",
         "azure_attributes": {"availability": "SPOT_WITH_FALLBACK_AZURE", "first_on_demand": 7,
                              "spot_bid_max_price": 100.0}},
    ),
}


@pytest.mark.parametrize("cloud", CASES)
def test_recommended_definitions(spark, cloud):
    base, patch = CASES[cloud]
    df = spark.createDataFrame([(json.dumps(base), json.dumps(patch))], "b string, p string").select(
        F.parse_json("b").alias("b"), mg.parse_patch(F.col("p")).alias("p"))
    got = df.select(F.to_json(recommended_definition(F.col("b"), F.col("p"), mg.patch_depth(df, "p")))).first()[0]
    old = {k: v for k, v in base.items() if k not in ("num_workers", "autoscale")}
    assert json.loads(got) == merged(old, patch)
