"""The registered queries ``opN_<name>`` and their DuckDB SQL.

Each is a thin reading of an operator's result over its whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm import ann, exact_dedup, html_text, language_id, line_dedup, packing, quality, secret_scan, sentencepiece_codec, simhash

#: Where the vocabulary files are; operators take the paths as parameters.
SENTENCEPIECE_MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.code(_read(spark, sf_dir, "documents"), SENTENCEPIECE_MODEL)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.LineIndex.build(docs).apply(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.ledger(spark))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.learn(docs, _read(spark, sf_dir, "labels"), _remainder(5) != 0)
    scored = quality.classify(docs, net)
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), BYTE_BPE)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = language_id.learn(docs.where(_remainder(4) != 2))
    return language_id.predict(docs.select("doc_id", "text"), learned).select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_line_dedup": op2_line_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_ann": op4_ann,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "op9_html_text": op9_html_text,
    "op10_exact_dedup": op10_exact_dedup,
}

_WHITE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_ASSIGN = rf"""({_WORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _sql_spans(kind: str, pattern: str, group: int, least: int) -> str:
    """DuckDB: list of {s, k, e} from the pieces between matches and the matches."""
    order = ("assign", "access", "hex").index(kind)
    return f"""
      SELECT doc_id, list({{'s': s, 'k': {order}, 'e': e, 'kind': '{kind}'}}) AS found FROM (
        SELECT doc_id, s, e FROM (
          SELECT doc_id, pos, judged, sum(gap + size) OVER w - size AS s, sum(gap + size) OVER w AS e FROM (
            SELECT doc_id, generate_subscripts(whole, 1) AS pos, unnest(list_transform(whole, lambda x: length(x))) AS size,
                   unnest(list_transform(judged, lambda x: length(x))) AS judged, unnest(list_transform(gaps[:len(whole)], lambda x: length(x))) AS gap
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {group}) AS judged,
                         regexp_split_to_array(text, '{pattern}') AS gaps
                  FROM t WHERE regexp_matches(text, '{pattern}')))
          WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
        WHERE judged >= {least})
      GROUP BY doc_id"""


ORACLES = {
    "op2_line_dedup": f"""
      WITH lines AS (
        SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
      keyed AS (SELECT doc_id, pos, line, translate(trim(line, {_WHITE}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
      gone AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
      judged AS (SELECT doc_id, pos, line, last IS NOT NULL AND doc_id <> last AS lost FROM keyed LEFT JOIN gone USING (k))
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
      FROM judged GROUP BY doc_id""",
    "op3_secret_scan": f"""
      WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
      found AS ({_sql_spans("assign", _ASSIGN, 2, 6)} UNION ALL {_sql_spans("access", "AKIA[A-Z0-9]{16,}", 0, 20)} UNION ALL {_sql_spans("hex", "[0-9a-f]{24,}", 0, 24)}),
      whole AS (SELECT doc_id, list_sort(flatten(list(found))) AS found FROM found GROUP BY doc_id),
      told AS (SELECT t.doc_id, coalesce(found, []) AS found, coalesce(array_to_string(list_transform(found, lambda x: concat(x.kind, ':', x.s::BIGINT, ':', x.e::BIGINT)), ','), '') AS spans
               FROM t LEFT JOIN whole USING (doc_id))
      SELECT doc_id, len(list_filter(found, lambda x: x.kind = 'assign'))::BIGINT AS n_assign, len(list_filter(found, lambda x: x.kind = 'access'))::BIGINT AS n_access,
             len(list_filter(found, lambda x: x.kind = 'hex'))::BIGINT AS n_hex, sha256(spans) AS base_sha256, spans FROM told""",
    "op4_ann": """
      WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
      s AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v),
      r AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (c.n * q.n) AS score FROM s q JOIN s c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
      SELECT query_id, rank::INT AS rank, vec_id, score
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM r) WHERE rank <= 5""",
    "op10_exact_dedup": r"""
      WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
      g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
      SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
}
