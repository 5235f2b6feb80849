"""Record shapes as data, compiled to one column over JSON records held as VARIANT.

A shape is built from the small classes below. Each compiles to SQL that gives the array of (path,
rule) that a value violates; every node of a record is taken out of its parent and typed once, and
all its rules look at that. A rule is violated only where its predicate is false. Keys are told
apart from nulls: a required key may hold null if its shape allows it, and an absent optional key is
not looked at. Elements of an array report a rule once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_names = count()
_NONE = "cast(array() as array<struct<path: string, rule: string>>)"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _string(n: str) -> str:
    return f"try_variant_get({n}.v, '$', 'string')"


def _violated(rules: list[tuple[str, str, str]]) -> str:
    """rules: path, rule, predicate."""
    each = [f"CASE WHEN NOT coalesce({sql}, true) THEN named_struct('path', {_quoted(path)}, 'rule', {_quoted(rule)}) END" for path, rule, sql in rules]
    return f"filter(array({', '.join(each)}), r -> r IS NOT NULL)" if each else _NONE


class Shape:
    def rules(self, n: str, path: str) -> list[tuple[str, str, str]]:
        """n: SQL of a node: its value v, a variant, its type t, and its keys k where it is an object."""
        return []

    def below(self, n: str, path: str) -> list[str]:
        """Arrays of the violations of what the node holds."""
        return []

    def body(self, n: str, path: str) -> str:
        parts = [_violated(self.rules(n, path)), *self.below(n, path)]
        return f"flatten(array({', '.join(parts)}))" if len(parts) > 1 else parts[0]

    def violations(self, value: str, path: str) -> str:
        """value: SQL of a variant; null gives none."""
        v, m, n = (f"{c}{next(_names)}" for c in "vmn")
        # The schema of an object or an array is that of all it holds, so they are told by a cast; it also gives an object's keys, once.
        kind = f"CASE WHEN {m} IS NOT NULL THEN 'OBJECT' WHEN try_variant_get({v}, '$', 'array<variant>') IS NOT NULL THEN 'ARRAY' ELSE substring_index(schema_of_variant({v}), '(', 1) END"
        node = f"transform(array({value}), {v} -> transform(array(try_variant_get({v}, '$', 'map<string, variant>')), {m} -> named_struct('v', {v}, 't', {kind}, 'k', map_keys({m})))[0])"
        return f"transform({node}, {n} -> CASE WHEN {n}.v IS NULL THEN {_NONE} ELSE {self.body(n, path)} END)[0]"


@dataclass
class Any(Shape):
    pass


@dataclass
class Str(Shape):
    pattern: str | None = None
    least: int = 0

    def rules(self, n, path):
        out = [(path, "type", f"{n}.t = 'STRING'")]
        if self.pattern:
            out.append((path, "pattern", f"{n}.t <> 'STRING' OR {_string(n)} rlike {_quoted(rf'\A(?:{self.pattern})\z')}"))
        if self.least:
            out.append((path, "minLength", f"{n}.t <> 'STRING' OR length({_string(n)}) >= {self.least}"))
        return out


@dataclass
class Enum(Shape):
    values: tuple[str, ...]

    def rules(self, n, path):
        return [(path, "enum" if len(self.values) > 1 else "const", f"{n}.t = 'STRING' AND {_string(n)} IN ({', '.join(map(_quoted, self.values))})")]


@dataclass
class Number(Shape):
    low: float | None = None
    high: float | None = None
    whole: bool = False

    def rules(self, n, path):
        numeric = f"{n}.t IN ('BIGINT', 'DECIMAL', 'DOUBLE')"
        value = f"try_variant_get({n}.v, '$', 'double')"
        out = [(path, "type", f"{numeric} AND {value} = floor({value})" if self.whole else numeric)]
        if self.low is not None:
            out.append((path, "minimum", f"NOT {numeric} OR {value} >= {self.low}"))
        if self.high is not None:
            out.append((path, "maximum", f"NOT {numeric} OR {value} <= {self.high}"))
        return out


@dataclass
class Bool(Shape):
    def rules(self, n, path):
        return [(path, "type", f"{n}.t = 'BOOLEAN'")]


@dataclass
class OrNull(Shape):
    shape: Shape

    def body(self, n, path):
        return f"CASE WHEN is_variant_null({n}.v) THEN {_NONE} ELSE {self.shape.body(n, path)} END"


@dataclass
class List(Shape):
    items: Shape
    least: int = 0
    unique: bool = False

    def _elements(self, n: str) -> str:
        return f"try_variant_get({n}.v, '$', 'array<variant>')"

    def rules(self, n, path):
        is_list = f"{n}.t = 'ARRAY'"
        out = [(path, "type", is_list)]
        if self.least:
            out.append((path, "minItems", f"NOT {is_list} OR size({self._elements(n)}) >= {self.least}"))
        if self.unique:
            out.append((path, "uniqueItems", f"NOT {is_list} OR size(array_distinct(transform({self._elements(n)}, u -> to_json(u)))) = size({self._elements(n)})"))
        return out

    def below(self, n, path):
        if isinstance(self.items, Any):
            return []
        x = f"x{next(_names)}"
        return [f"CASE WHEN {n}.t = 'ARRAY' THEN array_distinct(flatten(transform({self._elements(n)}, {x} -> {self.items.violations(x, f'{path}[]')}))) ELSE {_NONE} END"]


@dataclass
class Record(Shape):
    """A closed object. optional: keys that may be absent."""

    fields: dict[str, Shape]
    optional: frozenset[str] = frozenset()
    extra: tuple[tuple[str, str, str], ...] = field(default=())
    conditions: tuple[dict, ...] = field(default=())  # extra, as JSON Schema states it

    def rules(self, n, path):
        is_object = f"{n}.t = 'OBJECT'"
        keys = f"{n}.k"
        listed = lambda names: f"array({', '.join(map(_quoted, names))})"
        needed = [k for k in self.fields if k not in self.optional]
        out = [(path, "type", is_object), (path, "additionalProperties", f"NOT {is_object} OR size(array_except({keys}, {listed(self.fields)})) = 0")]
        if needed:
            out.append((path, "required", f"NOT {is_object} OR size(array_except({listed(needed)}, {keys})) = 0"))
        return out + [(path, rule, sql.format(v=f"{n}.v")) for _, rule, sql in self.extra]

    def below(self, n, path):
        return [shape.violations(f"try_variant_get({n}.v, '$.{name}', 'variant')", f"{path}.{name}" if path else name) for name, shape in self.fields.items() if not isinstance(shape, Any)]


# Identifiers, enumerations and formats of the records.
UNIT_ID, CHAPTER_ID, SCENE_ID, BEAT_ID = "P[0-9]{2,}-U[0-9]{4}", "P[0-9]{2,}", "P[0-9]{2,}-S[0-9]{3}", "P[0-9]{2,}-S[0-9]{3}-B[0-9]{3}"
CHARACTER_ID, LOCATION_ID, APPEARANCE_ID = "CHAR-[0-9]{4}", "LOC-[0-9]{4}", "APP-P[0-9]{2,}-[0-9]{4}"
PROJECT_ID, SHA, SEMVER, MODULE_ID = "PRJ-[a-z0-9][a-z0-9-]{0,62}", "[a-f0-9]{64}", "[0-9]+[.][0-9]+[.][0-9]+", "[a-z][a-z0-9-]{1,62}"
STATUSES = ("explicit", "inferred", "conflict", "unknown")
STATES = ("ingested", "structured", "rendered", "validated")
TEXT_TYPES = ("chapter_heading", "action", "narration", "dialogue", "inner_thought", "voice_over", "letter", "other", "unknown")
TIMES = ("day", "night", "dawn", "morning", "noon", "afternoon", "dusk", "continuous", "unknown")
LAYERS = ("present", "flashback", "dream", "imagined", "unknown")
CHANGES = ("opening", "goal", "conflict", "revelation", "emotion", "power_shift", "character_entry", "action", "other")
APPEARANCE_TYPES = ("physical", "dialogue", "flashback", "dream", "mentioned", "unknown")
FORMATS = ("json", "jsonl", "markdown", "csv", "html", "pdf", "image", "other")
PROFILE_FIELDS = ("age", "gender", "race", "identity", "appearance", "hair", "body_type", "special_marks", "clothing", "personality")

_VERSION, _TEXT, _SOME = Enum(("2.0.0",)), Str(), Str(least=1)
_EVIDENCE = Record({"source_unit_id": Str(UNIT_ID), "quote": _SOME, "note": _TEXT}, frozenset(["note"]))
_UNITS = List(Str(UNIT_ID), 1, True)
_BEAT = Record({"beat_id": Str(BEAT_ID), "ordinal": Number(1, whole=True), "summary_zh": _SOME, "change_type": Enum(CHANGES), "source_unit_ids": _UNITS})
_SCENE = Record(
    {
        "scene_id": Str(SCENE_ID), "ordinal": Number(1, whole=True), "int_ext": Enum(("INT", "EXT", "INT_EXT", "unknown")), "location_id": OrNull(Str(LOCATION_ID)),
        "location_name": OrNull(_TEXT), "parent_location": OrNull(_TEXT), "sub_location": OrNull(_TEXT), "time_of_day": Enum(TIMES), "reality_layer": Enum(LAYERS),
        "source_unit_ids": _UNITS, "evidence": List(_EVIDENCE, 1), "beats": List(_BEAT),
    },
    frozenset(["location_name", "parent_location", "sub_location", "reality_layer"]),
)
_UNKNOWN = "try_variant_get({v}, '$.status', 'string') = 'unknown'"
_CELL = Record(
    {"value": Any(), "status": Enum(STATUSES), "confidence": Number(0, 1), "evidence": List(_EVIDENCE), "notes": _TEXT},
    frozenset(["notes"]),
    (("", "unknown is null, all else has evidence", f"CASE WHEN coalesce({_UNKNOWN}, true) THEN try_variant_get({{v}}, '$.value', 'variant') IS NULL OR is_variant_null(try_variant_get({{v}}, '$.value', 'variant')) ELSE size(try_variant_get({{v}}, '$.evidence', 'array<variant>')) >= 1 END"),),
    ({"title": "unknown is null, all else has evidence", "if": {"properties": {"status": {"const": "unknown"}}}, "then": {"properties": {"value": {"type": "null"}}}, "else": {"properties": {"evidence": {"minItems": 1}}}},),
)

SHAPES: dict[str, Shape] = {
    "project": Record({
        "schema_version": _VERSION, "project_id": Str(PROJECT_ID), "title": _SOME, "pipeline_version": Str(SEMVER), "state": Enum(STATES), "source_manifest": Enum(("source/manifest.json",)),
        "artifacts": List(Record({"artifact_type": _SOME, "path": _SOME, "schema_version": _SOME, "sha256": Str(SHA)})),
    }),
    "source_manifest": Record({
        "schema_version": _VERSION, "project_id": Str(PROJECT_ID),
        "source": Record({"filename": _SOME, "format": Enum(("txt", "md", "docx")), "encoding": _SOME, "copy_path": Str("source/original[.]input[.][A-Za-z0-9]+"), "byte_length": Number(0, whole=True), "sha256": Str(SHA), "warnings": List(_TEXT)}),
        "canonical": Record({"path": Enum(("source/original.txt",)), "encoding": Enum(("utf-8",)), "character_length": Number(1, whole=True), "byte_length": Number(1, whole=True), "sha256": Str(SHA), "rule": _SOME}),
        "chapter_detection": Record({"method": Enum(("anchored-heading-v1",)), "status": Enum(("detected", "single_chapter_review", "detected_with_preamble")), "warnings": List(_TEXT)}),
        "chapters": List(Record({
            "chapter_id": Str(CHAPTER_ID), "ordinal": Number(0, whole=True), "heading": OrNull(_TEXT), "source_label": OrNull(_TEXT), "source_start": Number(0, whole=True), "source_end": Number(1, whole=True),
            "character_length": Number(1, whole=True), "sha256": Str(SHA), "source_path": Str("source/chapters/p[0-9]{2,}[.]txt"), "units_path": Str("data/units/p[0-9]{2,}[.]units[.]jsonl"), "unit_count": Number(1, whole=True),
        }), 1),
    }),
    "source_unit": Record({
        "schema_version": _VERSION, "unit_id": Str(UNIT_ID), "chapter_id": Str(CHAPTER_ID), "ordinal": Number(1, whole=True), "source_text": _TEXT, "source_sha256": Str(SHA),
        "translation": Record({"zh_cn": OrNull(_TEXT), "status": Enum(("pending", "translated", "reviewed"))}),
        "classification": Record({"text_type": Enum(TEXT_TYPES), "speaker_character_id": OrNull(Str(CHARACTER_ID)), "speaker_label": OrNull(_TEXT), "status": Enum(STATUSES), "confidence": Number(0, 1), "evidence": List(_EVIDENCE)}, frozenset(["speaker_character_id", "speaker_label"])),
    }),
    "chapter_analysis": Record({"schema_version": _VERSION, "chapter_id": Str(CHAPTER_ID), "source_sha256": Str(SHA), "source_unit_ids": _UNITS, "scenes": List(_SCENE)}),
    "character": Record({
        "schema_version": _VERSION, "character_id": Str(CHARACTER_ID), "canonical_name": _SOME, "chinese_name": OrNull(_TEXT), "aliases": List(_SOME, unique=True), "character_type": Enum(("named", "role", "crowd", "unknown")),
        "importance": Enum(("major", "candidate_major", "supporting", "minor", "unknown")), "first_appearance_id": OrNull(Str(APPEARANCE_ID)), "evidence": List(_EVIDENCE),
    }, frozenset(["first_appearance_id"])),
    "appearance": Record({
        "schema_version": _VERSION, "appearance_id": Str(APPEARANCE_ID), "character_id": Str(CHARACTER_ID), "chapter_id": Str(CHAPTER_ID), "scene_id": OrNull(Str(SCENE_ID)), "appearance_type": Enum(APPEARANCE_TYPES),
        "has_dialogue": Bool(), "source_unit_ids": _UNITS, "evidence": List(_EVIDENCE, 1),
    }),
    "character_profile": Record({"schema_version": _VERSION, "character_id": Str(CHARACTER_ID), "fields": Record({k: _CELL for k in PROFILE_FIELDS})}),
    "extension": Record({
        "manifest_version": Enum(("1.0.0",)), "module_id": Str(MODULE_ID), "module_version": Str(SEMVER), "display_name": _SOME, "description": _TEXT,
        "consumes": List(Record({"data_type": _SOME, "version_range": _SOME, "required": Bool()}, frozenset(["required"])), 1), "produces": List(Record({"artifact_type": _SOME, "format": Enum(FORMATS)}), 1),
        "output_namespace": Str(f"extensions/{MODULE_ID}/"), "entrypoint": OrNull(_TEXT), "config_schema": OrNull(_TEXT),
    }, frozenset(["description", "entrypoint", "config_schema"])),
}


#: What several shapes share.
COMMON: dict[str, Shape] = {
    "unit_id": Str(UNIT_ID), "chapter_id": Str(CHAPTER_ID), "scene_id": Str(SCENE_ID), "character_id": Str(CHARACTER_ID), "sha256": Str(SHA), "status": Enum(STATUSES), "confidence": Number(0, 1),
    "evidence": _EVIDENCE, "unit_ids": _UNITS, "profile_field": _CELL,
}


def check_records(records: DataFrame, shape: Shape | str, *, key: str = "key", json: str = "json") -> DataFrame:
    """records: a key and a JSON text. Returns violations (key, path, rule); text that is no JSON violates "json"."""
    shape = SHAPES[shape] if isinstance(shape, str) else shape
    parsed = records.select(F.col(key).alias("key"), F.expr(f"try_parse_json(`{json}`)").alias("v"))
    bad = F.expr(f"CASE WHEN v IS NULL THEN array(named_struct('path', '', 'rule', 'json')) ELSE {shape.violations('v', '')} END")
    return parsed.select("key", F.explode(bad).alias("x")).select("key", "x.path", "x.rule")
