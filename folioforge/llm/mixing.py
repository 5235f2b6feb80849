"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are counted in words and summed into cells of source, language and topic before the
shuffle. Raking scales the cells' words to the target share of each source, then of each language,
then of each topic, for a fixed number of rounds. Targets are the cells' own marginals raised to
`alpha` and scaled to sum to one (smaller shares gain), unless a table of targets is given.

Texts are read once: each document's words, source, language, topic and draw are written with the
columns that are asked for, and the cells and the result come from that table. After the rounds the
largest distance of a marginal share from its target is measured; over TOLERANCE it is a warning.

A cell's calibrated probability is min(1, scale * raked / counted words), with the scale that makes
the expected words `fraction` of all. Cells that reach 1 give all they have, and the others share
what is left. A document is drawn when a number from the md5 of its id, even over [0, 1), is below
its cell's probability, so the same documents are drawn wherever and however often it runs.

Topics are forms of text unless a column is given: table (bars), marked (runs of signs), shouted
(capitals), note (under 50 words), long (2000 words or more), article (all others).

Nulls: a null text has no words; a null source, language or topic is a value of its own; a null id
draws by its text. Values without words keep probability 0, except where no document has words: then
all is 0. Repeated rows have the same fate. An empty table gives an empty result. Columns of the
documents with clashing names are not disturbed: the cells' columns are joined under other names.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.session import discard, written

ALPHA = 0.7
FRACTION = 0.8
ROUNDS = 20
#: Distance of a marginal share from its target that is worth a warning.
TOLERANCE = 0.001
#: Rounds of raking in one task after which the lineage is cut.
ROUNDS_A_STEP = 5
#: Rows up to which the table of cells is raked in one task, and broadcast.
SMALL_CELLS = 100_000
DIMENSIONS = ("source", "lang", "topic")


def words_of(text: str) -> Column:
    """Runs of other characters than ASCII white space."""
    return F.expr(f"cast(size(array_remove(split(coalesce(`{text}`, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), '')) as bigint)")


def topic_of(text: str, n_words: Column) -> Column:
    """The form of a text."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = F.length(t)
    bars = size - F.length(F.replace(t, F.lit("|"), F.lit("")))
    plain = t
    for sign in "*#$%&":
        plain = F.replace(plain, F.lit(sign), F.lit(""))
    signs = size - F.length(plain)
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    return F.when(bars * 5 > n_words, "table").when(signs > n_words, "marked").when(capitals * 2 > size, "shouted").when(n_words < 50, "note").when(n_words >= 2000, "long").otherwise("article")


def counted(docs: DataFrame, *, text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None) -> DataFrame:
    """docs and the columns __words, __source, __lang, __topic."""
    out = docs.withColumn("__words", words_of(text))
    kind = F.col(f"`{topic}`") if topic else topic_of(text, F.col("__words"))
    return out.withColumns({"__source": F.col(f"`{source}`").cast("string"), "__lang": F.col(f"`{lang}`").cast("string"), "__topic": kind.cast("string")})


def _targets(cells: DataFrame, dim: str, alpha: float, given: DataFrame | None) -> DataFrame:
    """(value, share); given: a table (value, weight)."""
    if given is not None:
        raw = given.select(F.col("value").cast("string").alias("value"), F.col("weight").cast("double").alias("raw"))
        raw = raw.join(cells.where("words > 0").select(F.col(dim).alias("have")).distinct(), F.col("value").eqNullSafe(F.col("have")), "left_semi")
    else:
        raw = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("words").alias("n")).select("value", F.when(F.col("n") > 0, F.pow(F.col("n").cast("double"), F.lit(alpha))).otherwise(0.0).alias("raw"))
    total = raw.agg(F.sum("raw")).first()[0] or 1e-300
    return raw.select("value", (F.col("raw") / F.lit(max(total, 1e-300))).alias("share"))


def _scaled(cells: DataFrame, dim: str, total: float, one_task: bool, spent: list[DataFrame]) -> DataFrame:
    """raked, scaled to the target share of each of the dimension's values. spent: gets tables to delete after the rounds."""
    if one_task:
        out = cells.withColumn("have", F.sum("raked").over(Window.partitionBy(dim)))
    else:  # sums are combined before the shuffle, so a value that most cells share is no task of its own
        sums = written(cells.groupBy(F.col(dim).alias("value")).agg(F.sum("raked").alias("have")), "sums")  # else each step would hold the plan before it twice
        spent.append(sums)
        out = cells.join(sums, F.col(dim).eqNullSafe(F.col("value"))).drop("value")
    scaled = F.when(F.col("have") > 0, F.col("raked") * F.col(f"to_{dim}") * F.lit(total) / F.col("have")).otherwise(F.col("raked"))
    return out.withColumn("raked", scaled).drop("have")


def marginal_error(raked: DataFrame) -> float:
    """The largest distance of a marginal share from its target. raked: with the columns to_<dimension>."""
    total = raked.agg(F.sum("words")).first()[0] or 0
    if not total:
        return 0.0
    apart = [raked.groupBy(dim).agg(F.abs(F.sum("raked") / F.lit(float(total)) - F.first(f"to_{dim}")).alias("apart")).select("apart") for dim in DIMENSIONS]
    return apart[0].unionByName(apart[1]).unionByName(apart[2]).agg(F.max("apart")).first()[0] or 0.0


def rake(cells: DataFrame, *, alpha: float = ALPHA, rounds: int = ROUNDS, targets: dict[str, DataFrame] | None = None, small_cells: int = SMALL_CELLS) -> DataFrame:
    """cells: source, lang, topic, words. Adds raked, whose marginals have the target shares of all words."""
    targets = targets or {}
    one_task = cells.count() <= small_cells
    total = float(cells.agg(F.sum("words")).first()[0] or 0)
    for dim in DIMENSIONS:
        want = _targets(cells, dim, alpha, targets.get(dim))
        cells = cells.join(want, F.col(dim).eqNullSafe(F.col("value")), "left").drop("value").withColumn(f"to_{dim}", F.coalesce("share", F.lit(0.0))).drop("share")
    cells = cells.withColumn("raked", F.col("words").cast("double"))
    step, spent = ROUNDS_A_STEP if one_task else 1, []
    for start in range(0, rounds, step):
        cells = written(cells.coalesce(1) if one_task else cells, "raked")
        spent.append(cells)
        cells = cells.coalesce(1) if one_task else cells
        for _ in range(min(step, rounds - start)):
            for dim in DIMENSIONS:
                cells = _scaled(cells, dim, total, one_task, spent)
    cells = written(cells, "raked")
    discard(*spent)
    if (error := marginal_error(cells)) > TOLERANCE:
        warnings.warn(f"raking stopped after {rounds} rounds with a marginal {error:.2g} from its target", stacklevel=2)
    return cells.drop(*[f"to_{d}" for d in DIMENSIONS])


def calibrate(raked: DataFrame, fraction: float) -> DataFrame:
    """Adds ratio (raked / words) and probability. The scale is settled by filling up: each pass fixes
    the cells that reach 1 and spreads the rest over the others, from grouped sums alone.
    """
    cells = raked.withColumn("ratio", F.when(F.col("words") > 0, F.col("raked") / F.col("words")).otherwise(0.0))
    goal = fraction * (raked.agg(F.sum("words")).first()[0] or 0)
    scale = 0.0
    for _ in range(50):
        full = F.lit(scale) * F.col("ratio") >= 1
        row = cells.agg(F.sum(F.when(full, F.col("words")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("raked"))).alias("open")).first()
        if not row["open"]:
            break
        now = max(scale, (goal - row["full"]) / row["open"])
        if now <= scale * (1 + 1e-12):
            break
        scale = now
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(scale) * F.col("ratio")))


def mixture(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, fraction: float = FRACTION, alpha: float = ALPHA, rounds: int = ROUNDS, targets: dict[str, DataFrame] | None = None, seed: str = "mix", small_cells: int = SMALL_CELLS, **columns) -> DataFrame:
    """The columns to keep of docs (all, unless listed) and __words, __source, __lang, __topic, __ratio, __probability, __sampled."""
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    even = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), name).cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)
    kept = docs.columns if keep is None else keep
    rows = counted(docs, text=text, **columns).select(*[F.col(f"`{c}`") for c in kept], "__words", *[f"__{d}" for d in DIMENSIONS], even.alias("__even"))
    rows = written(rows, "counted")
    cells = written(rows.groupBy(*[F.col(f"__{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("__words").alias("words"), F.count(F.lit(1)).alias("docs")), "cells")
    found = written(calibrate(rake(cells, alpha=alpha, rounds=rounds, targets=targets, small_cells=small_cells), fraction), "cells")
    named = found.select(*[F.col(d).alias(f"__cell_{d}") for d in DIMENSIONS], F.col("ratio").alias("__ratio"), F.col("probability").alias("__probability"))
    named = F.broadcast(named) if found.count() <= small_cells else named
    same = [F.col(f"__{d}").eqNullSafe(F.col(f"__cell_{d}")) for d in DIMENSIONS]
    out = rows.join(named, same[0] & same[1] & same[2]).drop(*[f"__cell_{d}" for d in DIMENSIONS])
    return out.withColumn("__sampled", F.col("__even") < F.col("__probability")).drop("__even")


def weights(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: doc_id, source, lang, topic, n_words, weight, probability, sampled."""
    got = mixture(docs, doc_id=doc_id, keep=[doc_id], **options)
    return got.select(F.col(f"`{doc_id}`").alias(doc_id), *[F.col(f"__{d}").alias(d) for d in DIMENSIONS], F.col("__words").alias("n_words"), F.round("__ratio", 6).alias("weight"), F.round("__probability", 6).alias("probability"), F.col("__sampled").alias("sampled"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents drawn, with the same columns."""
    return mixture(docs, **options).where("__sampled").select(*[F.col(f"`{c}`") for c in docs.columns])
