"""Column functions on texts: lines, headings, identifiers, slugs, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Versions, line ends, heading forms.
SCHEMA_VERSION = "2.0.0"
PIPELINE_VERSION = "2.0.0"
LINE_ENDS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
#: All other characters. Most are in the first range, which is looked at first: a negated class would look at every line end for each.
_INNER = r"[\x1f-\x{84}[\x00-\x09\x0e-\x1b\x{86}-\x{2027}\x{202a}-\x{10ffff}]]"
LINE = rf"{_INNER}*(?:\r\n|[{LINE_ENDS}])|{_INNER}+"
_SPACE = r"[\s\x1c-\x1f]"
CHAPTER = rf"(?isU)\A{_SPACE}*chapter{_SPACE}+([0-9]+|[ivxlcdm]+|[a-z]+(?:-[a-z]+)*)(?![\p{{L}}\p{{N}}_]).*\z"
SPECIAL = rf"(?isU)\A{_SPACE}*(prologue|epilogue)(?:{_SPACE}*[:.\-\x{{2014}}].*)?{_SPACE}*\z"
HEAD = rf"(?isU)\A{_SPACE}*(?:chapter|prologue|epilogue)"
_OUTER_SPACE = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"


def lines(text: Column) -> Column:
    """Physical lines with their ends; the text is their concatenation."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(0))


def _candidate(line: Column) -> Column:
    return F.regexp_replace(line, r"[\r\n]+\z", "")


def heading_label(line: Column) -> Column:
    """The label of a heading line, else null. Special headings are tried first. All other lines are passed over by their first word."""
    c = _candidate(line)
    return F.when(~line.rlike(HEAD), None).when(c.rlike(SPECIAL), F.regexp_extract(c, SPECIAL, 1)).when(c.rlike(CHAPTER), F.regexp_extract(c, CHAPTER, 1))


def heading_text(line: Column) -> Column:
    return F.regexp_replace(_candidate(line), _OUTER_SPACE, "")


def chapter_id(ordinal: Column) -> Column:
    return F.format_string("P%02d", ordinal)


def unit_id(chapter: Column, ordinal: Column) -> Column:
    return F.format_string("%s-U%04d", chapter, ordinal)


def numbered(prefix: str, ordinal: Column, width: int = 4) -> Column:
    """CHAR-0001, LOC-0001 and the like."""
    return F.format_string(f"{prefix}-%0{width}d", ordinal)


def scene_id(chapter: Column, ordinal: Column) -> Column:
    return F.format_string("%s-S%03d", chapter, ordinal)


def beat_id(scene: Column, ordinal: Column) -> Column:
    return F.format_string("%s-B%03d", scene, ordinal)


def appearance_id(chapter: Column, ordinal: Column) -> Column:
    return F.format_string("APP-%s-%04d", chapter, ordinal)


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def slug(title: Column, source_digest: Column) -> Column:
    """Lower-case letters and digits joined by hyphens, 63 at most; the digest's beginning where nothing is left."""
    plain = F.btrim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.rtrim(F.substring(F.coalesce(F.nullif(plain, F.lit("")), F.left(source_digest, F.lit(12))), 1, 63), F.lit("-"))


def suffix(filename: Column) -> Column:
    return F.lower(F.regexp_extract(filename, r"[^/](\.[^./]+)\z", 1))


def stem(filename: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(filename, r"([^/]*)\z", 1), r"(?<=.)\.[^./]+\z", "")


def piece(text: Column, start: Column, end: Column) -> Column:
    """Code points start to end, counted from 0."""
    return F.substring(text, start.cast("int") + 1, (end - start).cast("int"))


def gathered(parts: Column, order: Column) -> Column:
    """Aggregate: an array of structs of o and p, the parts in order."""
    return F.sort_array(F.collect_list(F.struct(order.alias("o"), parts.alias("p"))))


def joined(parts: Column, order: Column) -> Column:
    """Aggregate: the parts' concatenation in order."""
    return F.array_join(F.transform(gathered(parts, order), lambda x: x["p"]), "")


def json_string(text: Column) -> Column:
    """A JSON string as strict writers give it: control characters escaped (short forms, else four lower-case digits), all else as it is."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    rare = out
    for code in range(32):
        rare = F.replace(rare, F.lit(chr(code)), F.lit({8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}.get(code, f"\\u{code:04x}")))
    common = F.replace(F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    return F.when(text.isNull(), "null").otherwise(F.concat(F.lit('"'), F.when(text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), rare).otherwise(common), F.lit('"')))


def json_object(fields: dict[str, Column], depth: int = 0) -> Column:
    """An object of JSON values, a key a line, indented by two spaces a level."""
    parts = [F.lit("{")]
    for k, (name, value) in enumerate(fields.items()):
        parts += [F.lit(f"{',' if k else ''}\n{'  ' * (depth + 1)}\"{name}\": "), value]
    return F.concat(*parts, F.lit(f"\n{'  ' * depth}}}"))


def json_array(values: Column, depth: int = 0) -> Column:
    """An array of JSON values, an element a line."""
    inner = "  " * (depth + 1)
    return F.when(F.size(values) == 0, "[]").otherwise(F.concat(F.lit(f"[\n{inner}"), F.array_join(values, f",\n{inner}"), F.lit(f"\n{'  ' * depth}]")))
