"""JSON Schema files compiled to columns over JSON records.

A set of schema files is read as a graph of references; a schema is compiled to one column that gives
the violations (path, rule) of a record, a rule being the keyword that is not met, and to a typed
column that fills in defaults. Nothing is interpreted a row: a schema becomes SQL once.

Supported are the Draft 2020-12 keywords of KEYWORDS and ANNOTATIONS; any other is refused, as are
references that lead nowhere and those that lead back to themselves, which no finite column holds.
A keyword looks only at values of its own type. `anyOf` of a schema and null means that null is
allowed: the schema's own violations are reported. Other alternatives report their keyword. A
condition (`if`) reports what its branch violates; where the schema that holds it has a title, the
title is the rule and its own path the place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any as Json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.constraints import _NONE, Any, Bool, Enum, List, Number, OrNull, Record, Shape, Str, _names, _quoted, _violated, check_records

KEYWORDS = (
    "$ref", "type", "enum", "const", "properties", "patternProperties", "additionalProperties", "required", "minProperties", "maxProperties", "items", "minItems", "maxItems", "uniqueItems",
    "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "allOf", "anyOf", "oneOf", "not", "if", "then", "else",
)
ANNOTATIONS = ("$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format")
_NUMERIC = "('BIGINT', 'DECIMAL', 'DOUBLE')"
_TYPES = {"object": "'OBJECT'", "array": "'ARRAY'", "string": "'STRING'", "boolean": "'BOOLEAN'", "null": "'VOID'"}


class SchemaError(ValueError):
    pass


def _double(n: str) -> str:
    return f"try_variant_get({n}.v, '$', 'double')"


def _text(n: str) -> str:
    return f"try_variant_get({n}.v, '$', 'string')"


def _elements(n: str) -> str:
    return f"try_variant_get({n}.v, '$', 'array<variant>')"


def _members(n: str) -> str:
    return f"try_variant_get({n}.v, '$', 'map<string, variant>')"


def _step(name: str) -> str:
    if "'" in name or "\\" in name:
        raise SchemaError(f"property name with a quote: {name}")
    return f"$[\\'{name}\\']"


def _java(pattern: str) -> str:
    """A pattern whose ^ and $ mean the ends of the text."""
    out, inside, k = [], False, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            out.append(pattern[k : k + 2])
            k += 2
            continue
        inside = (inside or c == "[") and not (inside and c == "]")
        out.append({"^": r"\A", "$": r"\z"}.get(c, c) if not inside else c)
        k += 1
    return "".join(out)


def _is_type(n: str, name: str) -> str:
    if name in _TYPES:
        return f"{n}.t = {_TYPES[name]}"
    if name not in ("number", "integer"):
        raise SchemaError(f"unknown type {name}")
    return f"{n}.t IN {_NUMERIC}" + (f" AND {_double(n)} = floor({_double(n)})" if name == "integer" else "")


def _equals(n: str, value: Json) -> str:
    if value is None:
        return f"{n}.t = 'VOID'"
    if isinstance(value, bool):
        return f"({n}.t = 'BOOLEAN' AND try_variant_get({n}.v, '$', 'boolean') = {str(value).lower()})"
    if isinstance(value, (int, float)):
        return f"({n}.t IN {_NUMERIC} AND {_double(n)} = {value!r}D)"
    if isinstance(value, str):
        return f"({n}.t = 'STRING' AND {_text(n)} = {_quoted(value)})"
    return f"to_json({n}.v) = to_json(parse_json({_quoted(json.dumps(value, ensure_ascii=False))}))"


@dataclass
class Node(Shape):
    """One schema with its subschemas compiled."""

    own: dict[str, Json]
    properties: dict[str, Shape] = field(default_factory=dict)
    patterns: dict[str, Shape] = field(default_factory=dict)
    more: Shape | None = None
    items: Shape | None = None
    also: list[Shape] = field(default_factory=list)  # $ref beside other keywords, and allOf
    choices: dict[str, list[Shape]] = field(default_factory=dict)  # anyOf, oneOf, not
    condition: tuple[Shape, Shape | None, Shape | None] | None = None

    def valid(self, shape: Shape, n: str) -> str:
        return f"size({shape.body(n, '')}) = 0"

    def rules(self, n, path):
        out, own = [], self.own
        add = lambda rule, sql: out.append((path, rule, sql))
        if "type" in own:
            names = own["type"] if isinstance(own["type"], list) else [own["type"]]
            add("type", " OR ".join(f"({_is_type(n, t)})" for t in names))
        if "enum" in own:
            add("enum", " OR ".join(_equals(n, v) for v in own["enum"]) or "false")
        if "const" in own:
            add("const", _equals(n, own["const"]))
        for rule, test in (("pattern", lambda v: f"{_text(n)} rlike {_quoted(_java(v))}"), ("minLength", lambda v: f"length({_text(n)}) >= {int(v)}"), ("maxLength", lambda v: f"length({_text(n)}) <= {int(v)}")):
            if rule in own:
                add(rule, f"{n}.t <> 'STRING' OR {test(own[rule])}")
        for rule, sign in (("minimum", ">="), ("maximum", "<="), ("exclusiveMinimum", ">"), ("exclusiveMaximum", "<")):
            if rule in own:
                add(rule, f"{n}.t NOT IN {_NUMERIC} OR {_double(n)} {sign} {own[rule]!r}D")
        if "multipleOf" in own:
            add("multipleOf", f"{n}.t NOT IN {_NUMERIC} OR {_double(n)} / {own['multipleOf']!r}D = round({_double(n)} / {own['multipleOf']!r}D)")
        not_list, not_object = f"{n}.t <> 'ARRAY'", f"{n}.t <> 'OBJECT'"
        if own.get("minItems"):
            add("minItems", f"{not_list} OR size({_elements(n)}) >= {int(own['minItems'])}")
        if "maxItems" in own:
            add("maxItems", f"{not_list} OR size({_elements(n)}) <= {int(own['maxItems'])}")
        if own.get("uniqueItems"):
            add("uniqueItems", f"{not_list} OR size(array_distinct(transform({_elements(n)}, u -> to_json(u)))) = size({_elements(n)})")
        keys = f"{n}.k"
        listed = lambda names: f"cast(array({', '.join(map(_quoted, names))}) as array<string>)"
        if own.get("additionalProperties") is False:
            rest = f"array_except({keys}, {listed(self.properties)})"
            for p in self.patterns:
                rest = f"filter({rest}, k -> NOT k rlike {_quoted(_java(p))})"
            add("additionalProperties", f"{not_object} OR size({rest}) = 0")
        if own.get("required"):
            add("required", f"{not_object} OR size(array_except({listed(own['required'])}, {keys})) = 0")
        if "minProperties" in own:
            add("minProperties", f"{not_object} OR size({keys}) >= {int(own['minProperties'])}")
        if "maxProperties" in own:
            add("maxProperties", f"{not_object} OR size({keys}) <= {int(own['maxProperties'])}")
        for rule, shapes in self.choices.items():
            hits = " + ".join(f"cast({self.valid(s, n)} as int)" for s in shapes)
            add(rule, {"anyOf": f"{hits} >= 1", "oneOf": f"{hits} = 1", "not": f"{hits} = 0"}[rule])
        if self.condition and "title" in own:
            add(own["title"], self._branch(n, lambda s: self.valid(s, n), "true"))
        return out

    def _branch(self, n: str, of: object, none: str) -> str:
        test, then, otherwise = self.condition
        return f"CASE WHEN {self.valid(test, n)} THEN {of(then) if then else none} ELSE {of(otherwise) if otherwise else none} END"

    def below(self, n, path):
        out = [shape.violations(f"try_variant_get({n}.v, '{_step(name)}', 'variant')", f"{path}.{name}" if path else name) for name, shape in self.properties.items() if not isinstance(shape, Any)]
        rest = [(f"k rlike {_quoted(_java(p))}", shape, f"{{{p}}}") for p, shape in self.patterns.items()]
        if self.more is not None:
            named = [f"k = {_quoted(name)}" for name in self.properties] + [f"k rlike {_quoted(_java(p))}" for p in self.patterns]
            rest.append((f"NOT ({' OR '.join(named) or 'false'})", self.more, "*"))
        for test, shape, name in rest:
            x = f"x{next(_names)}"
            out.append(f"CASE WHEN {n}.t = 'OBJECT' THEN array_distinct(flatten(transform(map_values(map_filter({_members(n)}, (k, y) -> {test})), {x} -> {shape.violations(x, f'{path}.{name}' if path else name)}))) ELSE {_NONE} END")
        if self.items is not None and not isinstance(self.items, Any):
            x = f"x{next(_names)}"
            out.append(f"CASE WHEN {n}.t = 'ARRAY' THEN array_distinct(flatten(transform({_elements(n)}, {x} -> {self.items.violations(x, f'{path}[]')}))) ELSE {_NONE} END")
        out += [shape.body(n, path) for shape in self.also]
        if self.condition and "title" not in self.own:
            out.append(self._branch(n, lambda s: s.body(n, path), _NONE))
        return out


@dataclass
class Never(Shape):
    def rules(self, n, path):
        return [(path, "false", "false")]


class SchemaSet:
    """Schema files by name."""

    def __init__(self, documents: dict[str, str]):
        try:
            self.documents = {name: json.loads(text) for name, text in documents.items()}
        except ValueError as e:
            raise SchemaError(f"a schema file is not JSON: {e}") from None

    def resolve(self, ref: str, file: str) -> tuple[str, str, Json]:
        """File, pointer and schema that a reference of a file means."""
        name, _, pointer = ref.partition("#")
        name = name.rsplit("/", 1)[-1] or file
        if name not in self.documents:
            raise SchemaError(f"{file}: {ref} names a file that is not there")
        node = self.documents[name]
        for part in pointer.split("/")[1:]:
            part = part.replace("~1", "/").replace("~0", "~")
            try:
                node = node[int(part)] if isinstance(node, list) else node[part]
            except (KeyError, IndexError, ValueError, TypeError):
                raise SchemaError(f"{file}: {ref} leads nowhere") from None
        return name, pointer, node

    def compile(self, name: str) -> Shape:
        """The shape of a file's schema; give it to check_records."""
        _, _, node = self.resolve(name, name)
        return self._shape(node, name, ((name, ""),))

    def _shape(self, node: Json, file: str, trail: tuple[tuple[str, str], ...]) -> Shape:
        if node is True or node == {}:
            return Any()
        if node is False:
            return Never()
        if not isinstance(node, dict):
            raise SchemaError(f"{file}: a schema is an object or a truth value, not {node!r}")
        if unknown := sorted(set(node) - set(KEYWORDS) - set(ANNOTATIONS)):
            raise SchemaError(f"{file}: unsupported keyword {', '.join(unknown)}")
        sub = lambda n: self._shape(n, file, trail)
        also = [sub(n) for n in node.get("allOf", [])]
        if "$ref" in node:
            target, pointer, schema = self.resolve(node["$ref"], file)
            if (target, pointer) in trail:
                loop = [*trail[trail.index((target, pointer)) :], (target, pointer)]
                raise SchemaError("references lead back to themselves: " + " -> ".join(f"{f}#{p}" for f, p in loop))
            meant = self._shape(schema, target, (*trail, (target, pointer)))
            if not set(node) - {"$ref"} - set(ANNOTATIONS):
                return meant
            also.insert(0, meant)
        choices = {k: [sub(n) for n in node[k]] for k in ("anyOf", "oneOf") if k in node} | ({"not": [sub(node["not"])]} if "not" in node else {})
        if set(node) - set(ANNOTATIONS) == {"anyOf"} and len(node["anyOf"]) == 2 and {"type": "null"} in node["anyOf"]:
            return OrNull(sub(next(n for n in node["anyOf"] if n != {"type": "null"})))
        more = node.get("additionalProperties")
        return Node(
            node, {k: sub(n) for k, n in node.get("properties", {}).items()}, {k: sub(n) for k, n in node.get("patternProperties", {}).items()}, sub(more) if isinstance(more, dict) else None,
            sub(node["items"]) if "items" in node else None, also, choices, (sub(node["if"]), *[sub(node[k]) if k in node else None for k in ("then", "else")]) if "if" in node else None,
        )

    def typed(self, records: DataFrame, name: str, *, json: str = "json", into: str = "record") -> DataFrame:
        """records with their JSON as a typed column: structs, arrays and scalars as the schema declares them, absent keys at their defaults.

        A value of another type than declared is null; check_records says where. A part without a declared type stays a VARIANT.
        """
        parsed = records.withColumn(into, F.expr(f"try_parse_json(`{json}`)"))
        return parsed.withColumn(into, F.expr(self._typed(self.documents[name], name, f"`{into}`", ((name, ""),))))

    def _typed(self, node: Json, file: str, v: str, trail: tuple) -> str:
        while isinstance(node, dict) and "$ref" in node:
            file, pointer, target = self.resolve(node["$ref"], file)
            if (file, pointer) in trail:
                raise SchemaError("references lead back to themselves")
            trail, node = (*trail, (file, pointer)), {**target, **{k: x for k, x in node.items() if k != "$ref"}}
        if not isinstance(node, dict):
            return v
        if "anyOf" in node and len(own := [n for n in node["anyOf"] if n != {"type": "null"}]) == 1:
            node = {**own[0], **{k: x for k, x in node.items() if k != "anyOf"}}
            return self._typed(node, file, v, trail)
        kinds = [t for t in (node["type"] if isinstance(node.get("type"), list) else [node.get("type")]) if t != "null"]
        kind = kinds[0] if len(kinds) == 1 else None
        if "default" in node:
            v = f"coalesce({v}, parse_json({_quoted(json.dumps(node['default'], ensure_ascii=False))}))"
        if kind == "object" and node.get("properties"):
            x = f"o{next(_names)}"
            fields = ", ".join(f"{_quoted(k)}, {self._typed(n, file, f"try_variant_get({x}, '{_step(k)}', 'variant')", trail)}" for k, n in node["properties"].items())
            return f"transform(array({v}), {x} -> CASE WHEN schema_of_variant({x}) LIKE 'OBJECT%' THEN named_struct({fields}) END)[0]"
        if kind == "array":
            x = f"e{next(_names)}"
            return f"transform(try_variant_get({v}, '$', 'array<variant>'), {x} -> {self._typed(node.get('items', True), file, x, trail)})"
        simple = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}.get(kind or "")
        if simple is None and ("const" in node or "enum" in node) and all(isinstance(x, str) for x in [node.get("const", ""), *node.get("enum", [])]):
            simple = "string"
        return f"try_variant_get({v}, '$', '{simple}')" if simple else v


def read_schemas(spark: SparkSession, path: str) -> SchemaSet:
    """The schema files of a folder. They are few and small, and the driver compiles them."""
    from folioforge.sources.records import read_documents

    return SchemaSet({r["name"]: r["json"] for r in read_documents(spark, path).collect()})


#: Shapes that files share, by the name of their definition.
_COMMON = "common.schema.json"


def schema_files(shapes: dict[str, Shape], common: dict[str, Shape]) -> dict[str, str]:
    """Shapes written as JSON Schema files, a file a shape; those in `common` are definitions of one file that the others refer to."""

    def of(shape: Shape, top: bool = False) -> dict:
        if not top:
            for name, known in common.items():
                if shape == known:
                    return {"$ref": f"{_COMMON}#/$defs/{name}"}
        match shape:
            case Enum(values):
                return {"const": values[0]} if len(values) == 1 else {"enum": list(values)}
            case Str(pattern, least):
                return {"type": "string"} | ({"pattern": f"^(?:{pattern})$"} if pattern else {}) | ({"minLength": least} if least else {})
            case Number(low, high, whole):
                return {"type": "integer" if whole else "number"} | ({"minimum": low} if low is not None else {}) | ({"maximum": high} if high is not None else {})
            case Bool():
                return {"type": "boolean"}
            case OrNull(inner):
                return {"type": ["string", "null"]} if inner == Str() else {"anyOf": [of(inner), {"type": "null"}]}
            case List(items, least, unique):
                return {"type": "array", "items": of(items)} | ({"minItems": least} if least else {}) | ({"uniqueItems": True} if unique else {})
            case Record():
                out = {"type": "object", "additionalProperties": False, "properties": {k: of(s) for k, s in shape.fields.items()}}
                needed = [k for k in shape.fields if k not in shape.optional]
                return out | ({"required": needed} if needed else {}) | ({"allOf": [dict(c) for c in shape.conditions]} if shape.conditions else {})
        return {}

    draft = {"$schema": "https://json-schema.org/draft/2020-12/schema"}
    files = {f"{name}.schema.json": draft | of(shape, top=True) for name, shape in shapes.items()}
    files[_COMMON] = draft | {"$defs": {name: of(shape, top=True) for name, shape in common.items()}}
    return {name: json.dumps(body, ensure_ascii=False) for name, body in files.items()}


# -- schema files against what a schema may be (L4) ---------------------------------------------

_COUNT, _NAMES, _SCHEMA, _MAP, _LIST = {"type": "integer", "minimum": 0}, {"type": "array", "items": {"type": "string"}, "uniqueItems": True}, {"type": ["object", "boolean"]}, {"type": "object", "additionalProperties": {"type": ["object", "boolean"]}}, {"type": "array", "minItems": 1, "items": {"type": ["object", "boolean"]}}
_KIND = {"enum": ["object", "array", "string", "number", "integer", "boolean", "null"]}
#: What a schema's own keywords may hold. Subschemas are looked at where they stand, so this needs no reference to itself.
META = {
    "$defs": {"kind": _KIND}, "type": ["object", "boolean"],
    "properties": {
        "$ref": {"type": "string"}, "$id": {"type": "string"}, "$schema": {"type": "string"}, "$comment": {"type": "string"}, "$defs": _MAP, "title": {"type": "string"}, "description": {"type": "string"},
        "type": {"anyOf": [{"$ref": "#/$defs/kind"}, {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"$ref": "#/$defs/kind"}}]}, "enum": {"type": "array"},
        "properties": _MAP, "patternProperties": _MAP, "additionalProperties": _SCHEMA, "required": _NAMES, "minProperties": _COUNT, "maxProperties": _COUNT, "items": _SCHEMA, "minItems": _COUNT, "maxItems": _COUNT, "uniqueItems": {"type": "boolean"},
        "minLength": _COUNT, "maxLength": _COUNT, "pattern": {"type": "string"}, "minimum": {"type": "number"}, "maximum": {"type": "number"}, "exclusiveMinimum": {"type": "number"}, "exclusiveMaximum": {"type": "number"}, "multipleOf": {"type": "number", "exclusiveMinimum": 0},
        "allOf": _LIST, "anyOf": _LIST, "oneOf": _LIST, "not": _SCHEMA, "if": _SCHEMA, "then": _SCHEMA, "else": _SCHEMA,
    },
}
#: Keywords that hold a schema, several by name, several in a row.
HOLD_ONE, HOLD_NAMED, HOLD_LISTED = ("additionalProperties", "items", "not", "if", "then", "else"), ("$defs", "properties", "patternProperties"), ("allOf", "anyOf", "oneOf")


def schema_faults(schemas: DataFrame) -> DataFrame:
    """L4: schemas (name, path, value: each schema of the files, where it stands): name, at, path and keyword of what no schema may hold."""
    meta = SchemaSet({"meta": json.dumps(META)}).compile("meta")
    found = check_records(schemas.select(F.struct("name", "path").alias("key"), F.to_json("value").alias("json")), meta)
    return found.select("key.name", F.col("key.path").alias("at"), "path", "rule")
