from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from feedquality import ConfigError, TableModel
from feedquality.functions.columns import field_type, match_key, parse_type, same_type
from feedquality.plans.queries import PURCHASE_MODEL, USER_MODEL


def test_model_types_and_required_paths(spark):
    users = TableModel.from_json(USER_MODEL, "users")
    assert users.schema["user_address"].dataType.simpleString() == "struct<city:string,state:string>"
    assert users.required == ("user_id", "user_name", "user_address", "user_address.city", "user_address.state")
    assert users.required_columns(nested=False) == ["user_id", "user_name", "user_address"]
    assert TableModel.from_json(PURCHASE_MODEL).schema["Quantity"].dataType == T.LongType()


def test_model_from_file_and_mapping_agree(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps(USER_MODEL))
    assert TableModel.from_json(path, "users") == TableModel.from_json(USER_MODEL, "users")


def test_required_may_be_a_boolean(spark):
    assert TableModel.from_json({"schema": {"a": {"type": "int", "required": True}}}).required == ("a",)


@pytest.mark.parametrize("config", [
    {}, {"schema": {"a": {}}}, {"schema": {"a": "int"}}, {"schema": {"a": {"type": "int", "required": "yes"}}},
])
def test_unusable_models_are_refused(spark, config):
    with pytest.raises(ConfigError):
        TableModel.from_json(config)


def test_type_vocabularies(spark):
    assert parse_type("bigint") == parse_type("LongType") == parse_type("LongType()") == T.LongType()
    assert parse_type("array<struct<a:int>>").simpleString() == "array<struct<a:int>>"
    for bad in ("NoSuchType", "ArrayType"):
        with pytest.raises(ConfigError):
            parse_type(bad)


def test_same_type_ignores_nullability_and_sees_field_order(spark):
    a = T.StructType([T.StructField("x", T.IntegerType(), False), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    assert same_type(a, b)
    assert not same_type(a, T.StructType(list(reversed(b.fields))))


def test_field_type_follows_structs_and_prefers_exact_names(spark):
    schema = T.StructType.fromDDL("a struct<b:int>, `a.b` string")
    assert field_type(schema, "a.b") == T.StringType()
    assert field_type(schema, "a") == T.StructType.fromDDL("b int")
    assert field_type(schema, "a.c") is None
    assert field_type(schema, "A") is None


def test_match_key_separates_values(spark):
    df = spark.sql("select * from values (named_struct('a', 1, 'b', cast(null as int))),"
                   " (named_struct('a', cast(null as int), 'b', 1)), (null) as t(s)")
    keys = [r[0] for r in df.select(match_key(df.s, df.schema["s"].dataType)).collect()]
    assert keys[2] is None and len({bytes(k) for k in keys[:2]}) == 2 and len(keys[0]) == 32
