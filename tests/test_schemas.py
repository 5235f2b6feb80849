"""The schema compiler: keywords against plain Python, references, refusals, defaults."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.operators.constraints import check_records
from folioforge.operators.schemas import SchemaError, SchemaSet

VALUES = [None, True, False, 0, 1, 1.0, 1.5, -2, 7, "", "a", "ab", "abc", "b\n", [], [1], [1, 1], [1, "1"], ["a", "b", "c"], {}, {"a": 1}, {"a": "x", "b": 2}, {"b": None}, {"x1": 1, "c": True}, {"a": {"a": 1}}]
SCHEMAS = [
    {"type": "integer"}, {"type": "number"}, {"type": ["string", "null"]}, {"enum": [1, "a", None, [1], {"a": 1}]}, {"const": 1}, {"const": {"a": 1}}, {"minimum": 1}, {"exclusiveMinimum": 1}, {"maximum": 1}, {"exclusiveMaximum": 1},
    {"multipleOf": 0.5}, {"multipleOf": 2}, {"minLength": 2}, {"maxLength": 1}, {"pattern": "^[a$]"}, {"pattern": "b$"}, {"minItems": 2}, {"maxItems": 1}, {"uniqueItems": True}, {"items": {"type": "string"}}, {"items": False},
    {"properties": {"a": {"type": "integer"}}}, {"required": ["a", "b"]}, {"additionalProperties": False, "properties": {"a": True}}, {"additionalProperties": {"type": "integer"}, "properties": {"a": {}}}, {"patternProperties": {"^x": {"type": "string"}}, "additionalProperties": False},
    {"minProperties": 1}, {"maxProperties": 1}, {"anyOf": [{"type": "string"}, {"minimum": 1, "type": "number"}]}, {"oneOf": [{"type": "number"}, {"minimum": 1}]}, {"not": {"type": "object"}}, {"allOf": [{"type": "string"}, {"minLength": 1}]},
    {"if": {"type": "string"}, "then": {"minLength": 1}, "else": {"type": "number"}}, {"if": {"type": "object"}, "then": {"required": ["a"]}}, {"anyOf": [{"type": "string", "minLength": 2}, {"type": "null"}]}, False, True,
    {"$defs": {"n": {"type": "integer"}}, "properties": {"a": {"$ref": "#/$defs/n", "minimum": 2}}}, {"properties": {"a": {"properties": {"a": {"const": 2}}}}},
]


def same(a, b):
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    return a == b and (type(a) is type(b) or (isinstance(a, (int, float)) and isinstance(b, (int, float))))


def valid(v, s, root):
    """The keywords in plain Python."""
    import re

    if isinstance(s, bool):
        return s
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    kinds = {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None, "number": number, "integer": number and v == int(v)}
    ok = []
    if "$ref" in s:
        ok.append(valid(v, root["$defs"][s["$ref"].rsplit("/", 1)[-1]], root))
    if "type" in s:
        ok.append(any(kinds[t] for t in ([s["type"]] if isinstance(s["type"], str) else s["type"])))
    ok += [any(same(v, e) for e in s["enum"])] if "enum" in s else []
    ok += [same(v, s["const"])] if "const" in s else []
    if number:
        ok += [v >= s.get("minimum", v), v <= s.get("maximum", v), "exclusiveMinimum" not in s or v > s["exclusiveMinimum"], "exclusiveMaximum" not in s or v < s["exclusiveMaximum"], "multipleOf" not in s or v % s["multipleOf"] == 0]
    if isinstance(v, str):
        ok += [len(v) >= s.get("minLength", 0), len(v) <= s.get("maxLength", 99), "pattern" not in s or bool(re.search(s["pattern"].replace("b$", r"b\Z"), v))]
    if isinstance(v, list):
        ok += [len(v) >= s.get("minItems", 0), len(v) <= s.get("maxItems", 99), not s.get("uniqueItems") or all(not same(a, b) for i, a in enumerate(v) for b in v[:i]), all(valid(x, s.get("items", True), root) for x in v)]
    if isinstance(v, dict):
        ok += [set(s.get("required", [])) <= set(v), len(v) >= s.get("minProperties", 0), len(v) <= s.get("maxProperties", 99)]
        for k, x in v.items():
            own = [s["properties"][k]] if k in s.get("properties", {}) else []
            own += [n for p, n in s.get("patternProperties", {}).items() if re.search(p, k)]
            ok += [valid(x, n, root) for n in own or [s.get("additionalProperties", True)]]
    ok += [all(valid(v, n, root) for n in s.get("allOf", [])), "anyOf" not in s or any(valid(v, n, root) for n in s["anyOf"]), "oneOf" not in s or sum(valid(v, n, root) for n in s["oneOf"]) == 1, "not" not in s or not valid(v, s["not"], root)]
    if "if" in s:
        ok.append(valid(v, s.get("then" if valid(v, s["if"], root) else "else", True), root))
    return all(ok)


def test_keywords_equal_plain_python(spark):
    rows = spark.createDataFrame([(str(i), json.dumps(v)) for i, v in enumerate(VALUES)], "key string, json string").cache()
    for s in SCHEMAS:
        shape = SchemaSet({"s": json.dumps(s)}).compile("s")
        bad = {int(r["key"]) for r in check_records(rows, shape).collect()}
        assert bad == {i for i, v in enumerate(VALUES) if not valid(v, s, s)}, s


def test_references(spark):
    files = {"a.json": {"properties": {"x": {"$ref": "https://h/schemas/b.json#/$defs/a~1b"}, "y": {"$ref": "b.json"}}}, "b.json": {"$defs": {"a/b": {"$ref": "#/$defs/n"}, "n": {"type": "integer"}}, "type": "string"}}
    shape = SchemaSet({k: json.dumps(v) for k, v in files.items()}).compile("a.json")
    rows = spark.createDataFrame([("1", '{"x":1,"y":"s"}'), ("2", '{"x":"1"}'), ("3", '{"y":1}'), ("4", "{")], "key string, json string")
    assert sorted(tuple(r) for r in check_records(rows, shape).collect()) == [("2", "x", "type"), ("3", "y", "type"), ("4", "", "json")]


@pytest.mark.parametrize(
    ("files", "word"),
    [
        ({"a": {"$ref": "#"}}, "themselves"), ({"a": {"properties": {"n": {"$ref": "#"}}}}, "themselves"), ({"a": {"items": {"$ref": "b"}}, "b": {"anyOf": [{"$ref": "a"}, {"type": "string"}]}}, "a#"),
        ({"a": {"$ref": "c.json"}}, "not there"), ({"a": {"$ref": "#/$defs/no"}}, "nowhere"), ({"a": {"contains": {}}}, "unsupported keyword contains"), ({"a": {"type": "text"}}, "unknown type"), ({"a": {"properties": {"it's": {"type": "string"}}}}, "quote"),
    ],
)
def test_refusals(spark, files, word):
    with pytest.raises(SchemaError, match=word):
        shape = SchemaSet({k: json.dumps(v) for k, v in files.items()}).compile("a")
        check_records(spark.createDataFrame([("1", "{}")], "key string, json string"), shape)
    with pytest.raises(SchemaError, match="not JSON"):
        SchemaSet({"a": "{"})


def test_defaults_at_any_depth(spark):
    files = SchemaSet({"a": json.dumps({"type": "object", "properties": {"n": {"type": "integer", "default": 3}, "list": {"type": "array", "items": {"$ref": "#/$defs/i"}}, "any": {}, "o": {"type": "object", "default": {}, "properties": {"s": {"type": "string", "default": "z"}}}}, "$defs": {"i": {"type": "object", "properties": {"required": {"type": "boolean", "default": True}}}}})})
    rows = spark.createDataFrame([(1, '{"list":[{},{"required":false}],"any":{"k":1}}'), (2, '{"n":"x","o":{"s":"y"}}'), (3, "[]"), (4, "{")], "key int, json string")
    got = {r["key"]: r for r in files.typed(rows, "a").select("key", "record.n", F.col("record.list.required").alias("r"), "record.o.s").collect()}
    assert got[1]["n"] == 3 and got[1]["r"] == [True, False] and got[1]["s"] == "z"
    assert got[2]["n"] is None and got[2]["r"] is None and got[2]["s"] == "y"
    assert got[3]["n"] is None and got[4]["n"] is None
