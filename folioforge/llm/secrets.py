"""Secrets, and multipart credentials linked by an interval join, in DataFrame operations only.

Base spans, leftmost and not overlapping within a kind: "assign" (a keyword, an assignment sign and
a value of 8 characters at least), "access" (AKIA..., 16 at least) and "hex" (32 digits at least).

Weak candidates say nothing alone: user or key identifiers ("id"), endpoints ("endpoint") and
mixed strings of 20 characters or more ("secret"). Parts of one document are linked when their
starts are at most SCOPE code points apart. A weak secret is reported when an identifier (or a base
access key) or an endpoint is in its scope, a weak identifier or endpoint when a secret (weak, or a
base assign or hex span) is. Weak spans that lie within a base span are dropped. Parts are counted
by bins of SCOPE before they are joined, so that each part meets at most three rows of each kind,
however many parts a document has.

Nulls and empty texts have no spans. Repeated rows have a row each. Empty tables give empty
results. Offsets are code points, ends exclusive. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.session import written

SCOPE = 400

# Fixed patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

WEAK_ID = r"""(?i)(?<![A-Za-z0-9])(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}"""
WEAK_ENDPOINT = r"""(?i)https?://[A-Za-z0-9.-]{4,}(?::\d+)?[^\s"'<>]*"""
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"

#: In the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "id", "endpoint", "secret")


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_names = count()


def _let(value: str, body: Callable[[str], str]) -> str:
    """body(name of value), with value computed once."""
    name = f"v{next(_names)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def _placed(matches: str) -> str:
    """Starts and ends of matches (structs of the length before it, its own, and g), summed up in blocks of the square
    root of their number: arrays grow by one only within a block, so many matches in one text cost little more than their number.
    """
    total = "aggregate({b}, 0L, (t, x) -> t + x.a + x.l)"
    grown = "aggregate({b}, named_struct('at', {s}, 'out', cast(array() as array<struct<s: bigint, e: bigint, g: string>>)), (acc, x) -> named_struct('at', acc.at + x.a + x.l, 'out', array_append(acc.out, named_struct('s', acc.at + x.a, 'e', acc.at + x.a + x.l, 'g', x.g))), acc -> acc.out)"

    def blocks(m: str) -> str:
        size = f"cast(ceil(sqrt(size({m}))) as int)"
        return f"transform(sequence(0, (size({m}) - 1) div {size}), i -> slice({m}, cast(i * {size} as int) + 1, {size}))"

    def joined(b: str) -> str:
        starts = f"aggregate({b}, named_struct('at', 0L, 'out', cast(array() as array<bigint>)), (acc, x) -> named_struct('at', acc.at + {total.format(b='x')}, 'out', array_append(acc.out, acc.at)), acc -> acc.out)"
        return f"flatten(zip_with({b}, {starts}, (x, y) -> {grown.format(b='x', s='y')}))"

    return _let(matches, lambda m: _let(blocks(m), joined))


def _spans(text: str, pattern: str, kind: str, keep: str = "true", group: int = 0) -> Column:
    """Spans of all matches. keep: on g, the match or its group. A text is scanned once, and once more where it has matches."""
    value = f"regexp_extract(x, {_quoted(pattern)}, {group})" if group else "x"
    none = "cast(array() as array<struct<s: bigint, k: int, e: bigint>>)"

    def found(m: str) -> str:
        pieces = f"slice(split({text}, {_quoted(pattern)}, -1), 1, size({m}))"
        lengths = f"zip_with({pieces}, {m}, (p, x) -> named_struct('a', cast(length(p) as bigint), 'l', cast(length(x) as bigint), 'g', {value}))"
        kept = f"transform(filter({_placed(lengths)}, x -> {keep.replace('$g', 'x.g')}), x -> named_struct('s', x.s, 'k', {KINDS.index(kind)}, 'e', x.e))"
        return f"case when size({m}) > 0 then {kept} else {none} end"

    return F.expr(_let(f"regexp_extract_all({text}, {_quoted(pattern)}, 0)", found))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def _outside(parts: DataFrame) -> DataFrame:
    """Parts (row, s, k, e) without the weak ones that lie within a base span: a sweep over the starts that keeps the furthest end of the base spans so far."""
    sweep = Window.partitionBy("row").orderBy("s", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at one start base spans come first
    reach = F.max(F.when(F.col("k") < 3, F.col("e"))).over(sweep)
    return parts.withColumn("reach", reach).where((F.col("k") < 3) | F.coalesce(F.col("reach") < F.col("e"), F.lit(True))).drop("reach")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak parts (row, k, s, e) that have a complementary part in scope."""
    ids, secrets = F.col("k").isin(1, 3, 4), F.col("k").isin(0, 2, 5)
    sides = parts.withColumn("side", F.when(secrets, 0).otherwise(1)).withColumn("bin", F.floor(F.col("s") / scope))
    bins = sides.groupBy("row", "bin", "side").agg(F.min("s").alias("low"), F.max("s").alias("high"))
    near = bins.select("row", (1 - F.col("side")).alias("side"), "low", "high", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    weak = sides.where("k >= 3")
    within = (F.col("high") >= F.col("s") - scope) & (F.col("low") <= F.col("s") + scope)
    return weak.join(near, ["row", "side", "bin"]).where(within).select("row", "k", "s", "e").distinct()


def find_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, n_linked, spans (kind:start:end, comma-joined)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("t"))
    mixed = "$g rlike '[0-9]' and $g rlike '[a-z]' and $g rlike '[A-Z]'"
    found = written(
        rows.select(
            "row", "doc_id",
            _spans("t", ASSIGN, "assign", "length($g) >= 8", 2).alias("assign"),
            _spans("t", ACCESS, "access", "length($g) >= 16").alias("access"),
            _spans("t", HEX, "hex").alias("hex"),
            F.concat(_spans("t", WEAK_ID, "id"), _spans("t", WEAK_ENDPOINT, "endpoint"), _spans("t", WEAK_SECRET, "secret", mixed)).alias("weak"),
        ),
        "secrets",
    )
    base = F.concat("assign", "access", "hex")
    parts = found.where("size(weak) > 0").select("row", F.inline(F.concat(base, "weak")))
    linked = _linked(_outside(parts), scope).groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("linked"))
    every = found.join(linked, "row", "left").withColumn("linked", F.coalesce("linked", F.expr("cast(array() as array<struct<s: bigint, k: int, e: bigint>>)")))
    return every.select(
        F.col("doc_id").alias(doc_id),
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        F.size("linked").cast("long").alias("n_linked"),
        _listed(F.concat(base, "linked")).alias("spans"),
    )
