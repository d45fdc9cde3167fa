"""JSON edge cases, format names, encoding."""

import json

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from docstream.functions.codecs import codec, encode_bytes, encoder
from docstream.operators import documents
from docstream.schema import RECORD_LOG

OK, BAD, REJECT = None, "decode_error", "reject_error"

# value, outcome under `a int, b string`, outcome undeclared
EDGES = [
    ('{"a":1,"b":"x"}', OK, OK),
    ('{"a":1', BAD, BAD),
    ("null", BAD, BAD),
    ("[1,2]", BAD, BAD),
    ('{"a":1} junk', OK, OK),
    ('{"a":NaN}', BAD, BAD),
    ('{"a":1,"a":2}', OK, OK),
    ('"s"', BAD, BAD),
    (None, BAD, BAD),
    ('{"a":1.5}', REJECT, OK),
    ('{"a":12345678901234567890}', REJECT, OK),
    ("{}", OK, OK),
    ("{'a':1}", BAD, BAD),
    ("", BAD, BAD),
    ("   ", BAD, BAD),
    (' \n\t{"a":1}', OK, OK),
    ("1", BAD, BAD),
    ("true", BAD, BAD),
    ('{"b":null}', OK, OK),
    ('{"a":{"c":1}}', REJECT, OK),
    ('[{"a":1}]', BAD, BAD),
]


def log_of(spark, values):
    data = [("t", 0, i, f"k{i}", v, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, RECORD_LOG)


@pytest.mark.parametrize("fmt,schema,column", [("json", "a int, b string", 1), ("variant", None, 2)])
def test_edges(spark, fmt, schema, column):
    log = log_of(spark, [e[0] for e in EDGES])
    found = {
        r["offset"]: r["error_class"] for r in documents.classify(log, fmt, schema).collect()
    }
    wrong = [(EDGES[i][0], c) for i, c in found.items() if c != EDGES[i][column]]
    assert not wrong


def test_last_repeated_field_wins(spark):
    log = log_of(spark, ['{"a":1,"a":2}'])
    typed = documents.decode(log, "json", "a int").select("doc.a").first()[0]
    free = documents.decode(log, "variant").select(F.variant_get("doc", "$.a", "int")).first()[0]
    assert (typed, free) == (2, 2)


def test_repeated_field_is_set_aside_when_the_session_forbids_it(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        log = log_of(spark, ['{"a":1,"a":2}', '{"a":1}'])
        bad = documents.rejected(documents.classify(log, "variant"))
        assert rows(bad, "offset", "error_class", "error_detail") == [(0, REJECT, "repeated field")]
        flat = documents.flatten_fields(log, "offset")
        assert rows(flat) == [(0, "a", "2"), (1, "a", "1")]
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def test_undeclared_json_is_variant(spark):
    doc = documents.decode(log_of(spark, ['{"a":[1,{"b":null}]}']), "json")
    assert doc.schema["doc"].dataType.typeName() == "variant"
    assert json.loads(doc.select(F.to_json("doc")).first()[0]) == {"a": [1, {"b": None}]}


def test_details(spark):
    log = log_of(spark, [None, "[]", '{"a":"x"}'])
    found = documents.classify(log, "json", "a int").orderBy("offset").select("error_detail")
    assert [r[0] for r in found.collect()] == [
        "tombstone",
        "not a JSON object",
        "field does not fit the schema",
    ]


def test_raw_keeps_any_text(spark):
    log = log_of(spark, ["not json", None])
    assert rows(documents.decode(log, "raw"), "doc.text") == [("not json",)]
    assert rows(documents.rejected(documents.classify(log, "raw")), "error_detail") == [("tombstone",)]


@pytest.mark.parametrize("name", ["JSON", "Variant", "raw"])
def test_names_ignore_case(spark, name):
    assert codec(name, "a int") and encoder(name)


@pytest.mark.parametrize("build", [codec, encoder])
def test_unknown_name(spark, build):
    with pytest.raises(ValueError, match="Unknown format"):
        build("avro")


def test_bytes_are_utf8(spark):
    df = spark.createDataFrame([("é",)], "t string")
    encoded = df.select(encode_bytes("json", F.struct("t"))).first()[0]
    assert bytes(encoded) == '{"t":"é"}'.encode()


def test_value_is_parsed_once(spark, tmp_path):
    log_of(spark, ['{"a":1}']).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    kept = documents.decode(log, "json", "a int, b string").select("key", "doc.a")
    plan = plan_of(kept)
    assert plan.count("from_json") == 1
    assert "ReadSchema: struct<key:string,value:string>" in plan


def test_flatten(spark):
    log = log_of(spark, ['{"a":1,"b":{"c":[1]},"d":null,"e":"x"}', "[1]", None])
    assert rows(documents.flatten_fields(log, "offset")) == [
        (0, "a", "1"),
        (0, "b", '{"c":[1]}'),
        (0, "d", None),
        (0, "e", "x"),
    ]


def test_field_profile(spark):
    log = log_of(spark, ['{"a":1,"b":"x"}', '{"a":1.5}', '{"a":null,"b":{"c":1},"d":[1],"e":true}', "bad"])
    assert rows(documents.field_profile(log)) == [
        ("a", "integer", 1),
        ("a", "null", 1),
        ("a", "number", 1),
        ("b", "object", 1),
        ("b", "string", 1),
        ("d", "array", 1),
        ("e", "boolean", 1),
    ]


def test_key_mismatches(spark):
    log = log_of(spark, ['{"id":"k0"}', '{"id":"other"}', '{"a":1}'])
    decoded = documents.decode(log, "json", "id string")
    assert rows(documents.key_mismatches(decoded), "key", "doc_id") == [("k1", "other"), ("k2", None)]


def test_normalise_keeps_names_and_values(spark):
    log = log_of(spark, ['{"a":1,"key":"inner"}'])
    schema = "a int, key string"
    flat = documents.normalise(documents.decode(log, "json", schema), schema)
    assert flat.select("a", "key", "doc_key").first() == (1, "k0", "inner")
