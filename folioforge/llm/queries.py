"""The operators over the driver's tables, with production parameters, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.session import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.decontaminate import findings

    return findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[t : t + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS t FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, t, array_to_string(w[t : t + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS t FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.t, d.n, i.item_id FROM doc_windows d JOIN item_windows i USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(t, t + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS item_ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(array_to_string(item_ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=4).drop("class_id")


OP2_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[t : t + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS t FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM both_have JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y WHERE 100 * c >= 80 * (sx.n + sy.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
FROM docs d JOIN reach ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, n
"""


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from folioforge.llm.tokenfiles import read_tokens, write_tokens

    return read_tokens(spark, write_tokens(table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json")))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.htmltree import extract

    return extract(table(spark, sf_dir, "pages"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.repeats import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM docs),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, n - 50)) AS i FROM sized WHERE n >= 50)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS low FROM strings) WHERE doc_id > low),
runs AS (
  SELECT doc_id, min(i) AS b, max(i) + 50 AS e FROM (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM (
      SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM hits))
  GROUP BY doc_id, r),
gone AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(e - b) AS BIGINT) AS n_removed, list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es FROM runs GROUP BY doc_id)
SELECT s.doc_id, s.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN bs IS NULL THEN h ELSE array_to_string(list_transform(generate_series(1, len(bs) + 1),
    lambda k: substr(h, 2 * (CASE WHEN k = 1 THEN 0 ELSE es[k - 1] END) + 1, 2 * ((CASE WHEN k > len(bs) THEN s.n ELSE bs[k] END) - (CASE WHEN k = 1 THEN 0 ELSE es[k - 1] END)))), '') END)) AS kept_sha256
FROM sized s LEFT JOIN gone USING (doc_id)
"""


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.pii import KINDS, pseudonymize

    return pseudonymize(table(spark, sf_dir, "documents"), key="folioforge").select("doc_id", *[f"n_{k}" for k in KINDS], "text")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.mixing import weights

    return weights(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE counts AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words FROM documents),
docs AS (
  SELECT doc_id, source, lang, n_words,
    CASE WHEN (length(t) - length(translate(t, '|', ''))) * 5 > n_words THEN 'table' WHEN length(t) - length(translate(t, '*#$%&', '')) > n_words THEN 'marked'
      WHEN (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) * 2 > length(t) THEN 'shouted' WHEN n_words < 50 THEN 'note' WHEN n_words >= 2000 THEN 'long' ELSE 'article' END AS topic
  FROM counts),
cells AS (SELECT source, lang, topic, CAST(sum(n_words) AS DOUBLE) AS words FROM docs GROUP BY ALL),
total AS (SELECT sum(words) AS n FROM cells),
to_source AS (SELECT source, r / sum(r) OVER () AS ts FROM (SELECT source, pow(sum(words), 0.7) AS r FROM cells GROUP BY source)),
to_lang AS (SELECT lang, r / sum(r) OVER () AS tl FROM (SELECT lang, pow(sum(words), 0.7) AS r FROM cells GROUP BY lang)),
to_topic AS (SELECT topic, r / sum(r) OVER () AS tt FROM (SELECT topic, pow(sum(words), 0.7) AS r FROM cells GROUP BY topic)),
start AS (SELECT source, lang, topic, words, n, ts, tl, tt FROM cells JOIN to_source USING (source) JOIN to_lang USING (lang) JOIN to_topic USING (topic) CROSS JOIN total),
rounds AS (
  SELECT 0 AS i, source, lang, topic, words, n, ts, tl, tt, words AS w FROM start
  UNION ALL
  SELECT i + 1, source, lang, topic, words, n, ts, tl, tt, w * tt * n / sum(w) OVER (PARTITION BY topic) FROM (
    SELECT * REPLACE (w * tl * n / sum(w) OVER (PARTITION BY lang) AS w) FROM (
      SELECT * REPLACE (w * ts * n / sum(w) OVER (PARTITION BY source) AS w) FROM rounds WHERE i < 20))),
raked AS (SELECT source, lang, topic, words, w, w / words AS ratio, n FROM rounds WHERE i = 20),
fill AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS s
  UNION ALL
  SELECT k + 1, (SELECT greatest(f.s, (0.8 * max(n) - sum(CASE WHEN f.s * ratio >= 1 THEN words ELSE 0 END)) / sum(CASE WHEN f.s * ratio >= 1 THEN 0 ELSE w END)) FROM raked) FROM fill f WHERE k < 50),
scale AS (SELECT max(s) AS s FROM fill)
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_words, round(ratio, 6) AS weight, round(least(1.0, s * ratio), 6) AS probability,
  CAST(('0x' || substr(md5('mix:' || CAST(d.doc_id AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 < least(1.0, s * ratio) AS sampled
FROM docs d JOIN raked USING (source, lang, topic) CROSS JOIN scale
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: rows dropped, emptied, cut, repeated or given to the user by the checksum of their key. A null is one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), F.explode(copies).alias("copy"))
    return rows.drop("copy")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.conversations import repair

    return repair(damaged_conversations(table(spark, sf_dir, "conversations")), present="present")


# States: 0 nothing, 1 a system turn, 2 a user turn, 3 an assistant turn before. ins: what may be inserted; acts: what may be done with a row.
OP11_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k FROM conversations),
keyed AS (SELECT src.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 20 AS d FROM src, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE d <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
    NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before
  FROM numbered),
facts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n
  FROM judged GROUP BY conv_id),
ins(st, st2, cost, letters, lines) AS (VALUES (0, 0, 0, '', ''), (0, 2, 3, 'I', E'user:
'), (0, 3, 6, 'II', E'user:
assistant:
'), (1, 1, 0, '', ''), (1, 2, 3, 'I', E'user:
'), (1, 3, 6, 'II', E'user:
assistant:
'),
  (2, 2, 0, '', ''), (2, 3, 3, 'I', E'assistant:
'), (3, 3, 0, '', ''), (3, 2, 3, 'I', E'user:
')),
acts(st, letter, initial, st2, cost) AS (VALUES (0, 'D', NULL, 0, 4), (1, 'D', NULL, 1, 4), (2, 'D', NULL, 2, 4), (3, 'D', NULL, 3, 4), (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
  (0, 'R', NULL, 2, 3), (1, 'R', NULL, 2, 3), (2, 'R', NULL, 3, 3), (3, 'R', NULL, 2, 3)),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, 0 AS st, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, k, st, min({'cost': cost, 'audit': audit, 'lines': lines}) FROM (
    SELECT r.conv_id, r.k, a.st2 AS st, s.best.cost + i.cost + a.cost + CASE WHEN a.letter <> 'D' AND r.cut THEN 3 ELSE 0 END AS cost, s.best.audit || i.letters || a.letter AS audit,
      s.best.lines || i.lines || CASE a.letter WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text || chr(10) ELSE CASE a.st2 WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || r.text || chr(10) END AS lines
    FROM steps s JOIN judged r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.k = s.k + 1 JOIN ins i ON i.st = s.st JOIN acts a ON a.st = i.st2 AND (a.letter = 'D' OR NOT (r.blank OR r.again)) AND (a.letter <> 'K' OR a.initial = r.initial))
  GROUP BY conv_id, k, st),
ends AS (
  SELECT s.conv_id, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal, min({'cost': s.best.cost + i.cost, 'audit': s.best.audit || i.letters, 'lines': s.best.lines || i.lines}) AS b
  FROM steps s LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM s.conv_id JOIN ins i ON i.st = s.st AND i.st2 IN (0, 3) WHERE s.k = coalesce(f.n, 0) GROUP BY ALL)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.cost AS BIGINT) AS cost, b.audit AS audit,
  sha256(CASE WHEN b.lines = '' THEN '' ELSE left(b.lines, length(b.lines) - 1) END) AS repaired_sha256
FROM ends
"""


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioforge.llm.language import identify

    return identify(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from folioforge.llm.alignment import align

    return align(table(spark, sf_dir, "documents"), byte_level=public_tokenizers.path("byte_bpe_50k.json"), pieces=public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_token_files": op3_token_files,
    "op4_html_text": op4_html_text,
    "op5_repeats": op5_repeats,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_fingerprints": op7_fingerprints,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_conversations": op11_conversations,
    "op12_language": op12_language,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op2_near_duplicates": OP2_SQL, "op5_repeats": OP5_SQL, "op8_mixing": OP8_SQL, "op11_conversations": OP11_SQL}
