"""Queries over JSON Schema files: the engine's shapes as files, a schema of another model, defaults, and faults of schema files."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from folioforge.operators import constraints, schemas
from folioforge.project_queries import _SHAPES_SQL, _spread, planted_records
from folioforge.queries import _table
from folioforge.registry import query
from folioforge.sources import records
from folioforge.sources.shared import fresh_path


def _written_schemas(spark, files: dict[str, str]) -> schemas.SchemaSet:
    """Schema files written to a folder, and read from it."""
    root = fresh_path(spark, "schemas")
    rows = spark.createDataFrame([("schemas", name, text.encode()) for name, text in files.items()], "project_id string, path string, content binary")
    records.write_projects(rows, root)
    return schemas.read_schemas(spark, root)


@query(_SHAPES_SQL)
def schema_shapes(spark, sf):
    """The records of record_shapes, held against the same shapes as schema files that refer to a common one."""
    files = _written_schemas(spark, schemas.schema_files(constraints.SHAPES, constraints.COMMON))
    out = None
    for kind, planted in planted_records(spark, sf):
        found = constraints.check_records(planted, files.compile(f"{kind}.schema.json"))
        rows = found.groupBy(F.lit(kind).alias("kind"), "path", "rule").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("key").cast("bigint")).alias("keys"))
        out = rows if out is None else out.unionByName(rows)
    return out


#: A model of another domain.
_ORDER_FILES = {
    "order.json": {
        "$schema": "https://json-schema.org/draft/2020-12/schema", "type": "object", "additionalProperties": False, "required": ["id", "state", "price", "buyer"], "maxProperties": 8,
        "properties": {
            "id": {"type": "integer", "minimum": 1}, "state": {"enum": ["O", "F", "P"]}, "price": {"type": "number", "exclusiveMaximum": 400000}, "currency": {"type": "string", "default": "EUR", "minLength": 3, "maxLength": 3},
            "buyer": {"$ref": "parts.json#/$defs/buyer"}, "closed": {"type": ["string", "null"], "pattern": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}, "lines": {"type": "array", "maxItems": 2, "items": {"$ref": "parts.json#/$defs/line"}, "default": []},
            "notes": {"type": "object", "patternProperties": {"^n[0-9]+$": {"type": "string"}}, "additionalProperties": {"type": "boolean"}},
        },
        "if": {"properties": {"state": {"const": "F"}}}, "then": {"required": ["closed"]}, "else": {"not": {"required": ["closed"]}},
        "anyOf": [{"properties": {"price": {"minimum": 2000}}}, {"required": ["lines"]}],
    },
    "parts.json": {"$defs": {
        "money": {"type": "number", "multipleOf": 0.5}, "buyer": {"type": "object", "required": ["code"], "properties": {"code": {"type": "string", "pattern": "^C-[1-9]"}, "kind": {"enum": ["a", 2, None, True], "default": "a"}}},
        "line": {"allOf": [{"type": "object"}, {"properties": {"amount": {"$ref": "#/$defs/money"}}}], "oneOf": [{"required": ["amount"]}, {"required": ["free"]}]},
    }},
}
_ORDER = """SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p, o_custkey AS c, o_orderkey % 3 AS closed, o_orderkey % 5 AS lines, o_orderkey % 7 AS kind, o_orderkey % 11 AS notes FROM {orders}"""


def _orders(spark, sf):
    """key, json: a record an order."""
    o = _spread(spark.sql(_ORDER.format(orders="{o}"), o=_table(spark, sf, "orders")))
    part = lambda c, *cases: F.coalesce(*[F.when(F.col(c) == i, F.lit(text)) for i, text in enumerate(cases)], F.lit(""))
    record = F.concat(
        F.lit('{"id":'), (F.col("k") % 1000).cast("string"), F.lit(',"state":"'), "s", F.lit('","price":'), F.col("p").cast("string"), part("closed", ',"closed":"1995-01-02"', ',"closed":"soon"'),
        part("lines", "", ',"lines":[{"amount":1.5},{"free":true}]', ',"lines":[{"amount":1.25},{"amount":1,"free":0},{}]', ',"lines":[3,3]', ',"lines":{}'),
        part("notes", ',"notes":{"n1":"x","other":true}', ',"notes":{"n1":1,"other":"x"}', ',"more":1', ',"currency":"EURO"'),
        F.lit(',"buyer":{"code":"C-'), (F.col("c") % 10).cast("string"), F.lit('"'), part("kind", ',"kind":"a"', ',"kind":2', ',"kind":null', ',"kind":true', ',"kind":"b"', ',"kind":false'), F.lit("}}"),
    )
    return o.select(F.col("k").cast("string").alias("key"), record.alias("json"))


@query(f"""WITH o AS ({_ORDER.format(orders="orders")}),
v(k, path, rule) AS (
  SELECT k, 'id', 'minimum' FROM o WHERE k % 1000 = 0
  UNION ALL SELECT k, 'state', 'enum' FROM o WHERE s NOT IN ('O', 'F', 'P')
  UNION ALL SELECT k, 'price', 'exclusiveMaximum' FROM o WHERE p >= 400000
  UNION ALL SELECT k, 'closed', 'pattern' FROM o WHERE closed = 1
  UNION ALL SELECT k, '', 'required' FROM o WHERE s = 'F' AND closed = 2
  UNION ALL SELECT k, '', 'not' FROM o WHERE s <> 'F' AND closed <> 2
  UNION ALL SELECT k, '', 'anyOf' FROM o WHERE p < 2000 AND lines = 0
  UNION ALL SELECT k, 'lines', 'maxItems' FROM o WHERE lines = 2
  UNION ALL SELECT k, 'lines[].amount', 'multipleOf' FROM o WHERE lines = 2
  UNION ALL SELECT k, 'lines[]', 'oneOf' FROM o WHERE lines IN (2, 3)
  UNION ALL SELECT k, 'lines[]', 'type' FROM o WHERE lines = 3
  UNION ALL SELECT k, 'lines', 'type' FROM o WHERE lines = 4
  UNION ALL SELECT k, 'notes.{{^n[0-9]+$}}', 'type' FROM o WHERE notes = 1
  UNION ALL SELECT k, 'notes.*', 'type' FROM o WHERE notes = 1
  UNION ALL SELECT k, '', 'additionalProperties' FROM o WHERE notes = 2
  UNION ALL SELECT k, 'currency', 'maxLength' FROM o WHERE notes = 3
  UNION ALL SELECT k, 'buyer.code', 'pattern' FROM o WHERE c % 10 = 0
  UNION ALL SELECT k, 'buyer.kind', 'enum' FROM o WHERE kind IN (4, 5))
SELECT path, rule, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys FROM v GROUP BY path, rule""")
def schema_rules(spark, sf):
    """Orders as records, held against schemas that the library has never seen: alternatives, conditions, patterns of keys, references across files."""
    shape = _written_schemas(spark, {name: json.dumps(body) for name, body in _ORDER_FILES.items()}).compile("order.json")
    found = constraints.check_records(_orders(spark, sf), shape)
    return found.groupBy("path", "rule").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("key").cast("bigint")).alias("keys"))


@query(f"""WITH o AS ({_ORDER.format(orders="orders")})
SELECT CAST(k AS VARCHAR) AS key, k % 1000 AS id, s AS state, CASE WHEN notes = 3 THEN 'EURO' ELSE 'EUR' END AS currency, concat('C-', c % 10) AS code, CASE kind WHEN 0 THEN '"a"' WHEN 1 THEN '2' WHEN 2 THEN 'null' WHEN 3 THEN 'true' WHEN 4 THEN '"b"' WHEN 5 THEN 'false' ELSE '"a"' END AS kind,
  CASE lines WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 2 END AS n_lines, CASE closed WHEN 0 THEN '1995-01-02' WHEN 1 THEN 'soon' END AS closed FROM o""")
def schema_defaults(spark, sf):
    """The same records as typed columns, with defaults where keys are absent."""
    files = schemas.SchemaSet({name: json.dumps(body) for name, body in _ORDER_FILES.items()})
    r = files.typed(_orders(spark, sf), "order.json")
    return r.select("key", "record.id", "record.state", "record.currency", "record.buyer.code", F.to_json("record.buyer.kind").alias("kind"), F.size("record.lines").alias("n_lines"), "record.closed").withColumn("n_lines", F.when(F.col("n_lines") >= 0, F.col("n_lines")))


@query("""SELECT concat('p', p_partkey, '.json') AS name, unnest(CASE p_partkey % 6 WHEN 0 THEN ['/properties/a/items minLength minimum'] WHEN 1 THEN ['/allOf/0/then required uniqueItems'] WHEN 2 THEN [' type anyOf'] WHEN 3 THEN ['/$defs/x additionalProperties type', '/$defs/x/additionalProperties  type'] ELSE [] END) AS message FROM part""")
def schema_keywords(spark, sf):
    """Schema files, one a part, with keywords that no schema may have, at any depth; what only looks like a schema (a const, an example) is left alone."""
    bodies = ['{"properties":{"a":{"items":{"minLength":-1}}}}', '{"allOf":[{"if":true,"then":{"required":["b","b"]}}]}', '{"type":"text"}', '{"$defs":{"x":{"additionalProperties":7}}}', '{"const":{"minLength":-1},"examples":[{"type":"text"}],"properties":{"type":{"type":"string"}}}', '{"type":["string","null"],"enum":[1]}']
    k = F.col("p_partkey")
    docs = _table(spark, sf, "part").select(F.concat(F.lit("p"), k, F.lit(".json")).alias("name"), F.element_at(F.array(*map(F.lit, bodies)), (k % 6 + 1).cast("int")).alias("json"))
    return records.lint_schemas(docs).where("check_id = 'L4'").select("name", F.substring("message", len("not a schema: ") + 1, 1000).alias("message"))
