"""Queries opN_<name> on the given tables, and their SQL where it can express them."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, byte_bpe, chat_format, decontaminate, language_id, lexical_search, license_scan, line_dedup, quality_classifier, quality_rules, secret_scan, simhash
from ._common import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES if r.base]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base_spans = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(secret_scan.spans_text(base_spans).cast("binary"), 256).alias("base_sha256"), secret_scan.spans_text(F.col("spans")).alias("spans"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _op1_sql() -> str:
    """Spans of every rule: matches and the pieces between them give the positions."""
    parts = []
    for k, rule in enumerate(secret_scan.RULES):
        pattern = re.sub(r"\(\?i:(.*?)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")", rule.pattern).replace("'", "''")
        parts.append(f"SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, {rule.at_least} AS least, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {rule.group}) AS grp FROM docs")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({" UNION ALL ".join(parts)}),
spans AS (
  SELECT doc_id, k, kind, base, starts, starts + length(found[i]) AS ends FROM (
    SELECT *, CAST(list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0) AS BIGINT) AS starts
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches)
  ) WHERE length(grp[i]) >= least
)
SELECT docs.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || starts || ':' || ends, ',' ORDER BY starts, k) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || starts || ':' || ends, ',' ORDER BY starts, k), '') AS spans
FROM docs LEFT JOIN spans USING (doc_id) GROUP BY docs.doc_id"""


OP2_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS x FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.x = bw.x AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hit GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


OP5_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key, max(doc_id) AS home FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT keyed.*, home IS NOT NULL AND home <> doc_id AS falls FROM keyed LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (falls) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT falls), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def _op9_sql() -> str:
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in license_scan.PHRASES)
    names = ["[" + ", ".join("[" + ", ".join(f"'{w.decode()}'" for w in sorted(any_of)) + "]" for any_of in license_scan.naming_words(t[2])) + "]" for t in license_scan.TEMPLATES]
    templates = ", ".join(f"({k}, '{label}', '{text}', CAST({named} AS VARCHAR[][]))" for k, ((label, text, _), named) in enumerate(zip(license_scan.TEMPLATES, names, strict=True)))
    return f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t, {_WORDS} AS w FROM documents),
p AS (SELECT string_split(phrase, ' ') AS x, label FROM (VALUES {phrases}) v(phrase, label)),
places AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, x, label, unnest(range(1, len(w) - len(x) + 2)) AS i FROM d, p) WHERE w[i:i + len(x) - 1] = x),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY 1),
tw AS (SELECT k, label, names, {_WORDS} AS y FROM (VALUES {templates}) v(k, label, text, names)),
tm AS (SELECT k, label, names, list_distinct(y) AS x, len(y) + len(list_distinct(y)) - CAST(ceil({license_scan.THRESHOLD} * len(list_distinct(y)) - 1e-9) AS BIGINT) AS reach FROM tw),
parts AS (SELECT doc_id, {_WORDS} AS y FROM (SELECT doc_id, unnest(string_split(t, chr(10) || chr(10))) AS text FROM d)),
near AS (SELECT doc_id, y, tm.* FROM parts, tm WHERE len(list_intersect(list_distinct(y), x)) >= {license_scan.THRESHOLD} * len(x)),
runs AS (SELECT doc_id, label, names, x, list_distinct(y[i:i + reach - 1]) AS own FROM (SELECT *, unnest(range(1, greatest(len(y) - reach, 0) + 2)) AS i FROM near)),
found AS (SELECT doc_id, label, CAST(len(list_intersect(own, x)) AS DOUBLE) / len(x) AS share FROM runs WHERE len(list_intersect(own, x)) >= {license_scan.THRESHOLD} * len(x) AND len([n FOR n IN names IF NOT list_has_any(own, n)]) = 0),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM found) GROUP BY 1),
best AS (SELECT doc_id, max(share) AS share FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The file of a public tokenizer; TOKENIZER_DIR overrides the installed folder."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(_table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", F.floor(F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    filters = language_id.fit(docs.where(F.coalesce(crc_mod(F.col("doc_id"), 3), F.lit(1)) != 1))
    found = language_id.predict(docs, filters)
    return found.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.lit("<|im_end|><|im_start|>assistant ok")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), told.alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(own)
    chats = chat_format.format_chats(chat_format.reply_chain(turns))
    back, loss = chat_format.read_turns(F.col("formatted")), chat_format.loss_text(F.col("segments"))
    read = chats.select("conv_id", "formatted", back.alias("turns"), loss.alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_labels(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(True))
    model = quality_classifier.fit(docs.select("doc_id", "text"), labels.where(~held_out))
    found = quality_classifier.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality_classifier.CUT).cast("int").alias("predicted"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer, pieces = byte_bpe.ByteBPE.from_json(tokenizer_path("byte_bpe_50k.json")), alignment.Pieces.from_file(tokenizer_path("piece_bpe_32k.model"))
    return alignment.alignment_counts(_table(spark, sf_dir, "documents"), tokenizer, pieces)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.ByteBPE.from_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    out = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents"), ranks), ranks)
    told = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(told.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
size AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
q AS (SELECT k, any_value(item_id) AS item_id, t, count(*) AS often FROM (SELECT row_number() OVER () AS k, item_id, unnest({_WORDS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY k, t),
own AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM own, size GROUP BY t),
length AS (SELECT row, doc_id, 100 - 25 + ((25 * len(w) * n_docs) // n_terms) AS m FROM d, size),
scores AS (SELECT k, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, row, CAST(sum(often * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN own USING (t) JOIN weights USING (t) JOIN length USING (row) GROUP BY k, row)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= {lexical_search.TOP}"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_decontaminate": op2_decontaminate,
        "op3_simhash": op3_simhash,
        "op4_bpe": op4_bpe,
        "op5_line_dedup": op5_line_dedup,
        "op6_quality_rules": op6_quality_rules,
        "op7_language_id": op7_language_id,
        "op8_chat_format": op8_chat_format,
        "op9_license_scan": op9_license_scan,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_alignment": op11_alignment,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": _op1_sql(),
        "op2_decontaminate": OP2_SQL,
        "op5_line_dedup": OP5_SQL,
        "op8_chat_format": OP8_SQL,
        "op9_license_scan": _op9_sql(),
        "op13_lexical_search": OP13_SQL,
    }
