"""Text, JSON and lexical queries over documents, conversations, events and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as js
from ..functions import text
from ..operators import quality
from .registry import query, table


@query(r"""
SELECT conv_id, turn, CASE WHEN regexp_matches(t, '\b(error|fatal|failed|failure|exception)\b') THEN 'error' WHEN regexp_matches(t, '\b(warn|warning|retry|degraded)\b') THEN 'warning'
 WHEN regexp_matches(t, '\b(ok|passed|success|succeeded|complete|completed)\b') THEN 'success' WHEN regexp_matches(t, '\b(info|debug|trace|running|started|start)\b') THEN 'info' END AS severity
FROM (SELECT conv_id, turn, lower(role || ' ' || coalesce(text, '')) AS t FROM conversations)""")
def f27_severity(spark: SparkSession, sf: str) -> DataFrame:
    """The severity of a line by its words."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", text.severity(F.concat("role", F.lit(" "), F.coalesce("text", F.lit("")))).alias("severity"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' ELSE 'info' END AS category FROM events""")
def f28_event_category(spark: SparkSession, sf: str) -> DataFrame:
    """Categories of structured events."""
    level = F.when(F.col("event_type") == "purchase", "success").otherwise(F.coalesce(text.severity("event_type"), F.lit("info")))
    return table(spark, sf, "events").select("event_id", text.event_category("event_type", level).alias("category"))


@query(r"""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def x01_json_path(spark: SparkSession, sf: str) -> DataFrame:
    """A value at a path of an open payload."""
    return table(spark, sf, "events").select("event_id", js.at_path("props", "k", "bigint").alias("k"))


@query("""
WITH f AS (
  SELECT event_id, 1 AS n, '/a' AS pointer, 'number' AS kind, NULL::INTEGER AS token, user_id::VARCHAR AS exact, user_id::DOUBLE AS value FROM events
  UNION ALL SELECT event_id, 2 + i, '/b/' || i, 'number', NULL, (event_id + i)::VARCHAR, (event_id + i)::DOUBLE FROM events, range(12) r(i)
  UNION ALL SELECT event_id, 14, '/c~1d', 'string_token', 1, '-' || user_id || '%', -user_id::DOUBLE FROM events
  UNION ALL SELECT event_id, 15, '/c~1d', 'string_token', 2, event_id || 'e1', event_id * 10.0 FROM events
  UNION ALL SELECT event_id, 16, '/c~1d', 'string_token', 3, '.5', 0.5 FROM events
  UNION ALL SELECT event_id, 17, '/z/k', 'number', NULL, json_extract_string(props, '$.k'), json_extract_string(props, '$.k')::DOUBLE FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL)
SELECT event_id, 'Q' || CASE WHEN q < 10000 THEN lpad(q::VARCHAR, 4, '0') ELSE q::VARCHAR END AS fact_id, pointer, kind, token, exact, value FROM (SELECT *, row_number() OVER (ORDER BY event_id, n) AS q FROM f)""")
def x05_number_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every number of JSON texts with its pointer, numbered over all rows: lists of more than ten, several numbers a string."""
    e = table(spark, sf, "events")
    said = F.concat(F.lit("x1 -"), "user_id", F.lit("% of "), "event_id", F.lit("e1, v2 (.5) 3rd"))
    text = F.concat(
        F.lit('{"z": '), F.coalesce("props", F.lit("null")), F.lit(', "c/d": '), F.to_json(F.array(said)).substr(F.lit(2), F.length(said) + 2), F.lit(', "b": ['),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: (F.col("event_id") + i).cast("string")), ","), F.lit('], "a": '), F.col("user_id").cast("string"), F.lit("}"),
    )
    return js.number_facts(e.select("event_id", text.alias("j")), "event_id", "j").withColumnRenamed("id", "event_id")


@query(r"""
SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages""")
def f31_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of addresses."""
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", F.regexp_extract(u, "^([a-z]+)://", 1).alias("scheme"), F.regexp_extract(u, "^[a-z]+://([^/?#:]*)", 1).alias("host"), F.regexp_extract(u, "^[a-z]+://[^/?#]*([^?#]*)", 1).alias("path"))


TOKENS_SQL = r"list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'), lambda t: len(t) > 2 AND t NOT IN ('and', 'are', 'for', 'from', 'into', 'not', 'other', 'the', 'with', 'without'))"


@query(f"""
SELECT item_id, list_sort(list_distinct({TOKENS_SQL})) AS tokens FROM benchmark""")
def f19_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct words without stop words."""
    return table(spark, sf, "benchmark").select("item_id", F.array_sort(text.tokens(F.coalesce("text", F.lit("")))).alias("tokens"))


@query(f"""
WITH b AS (SELECT item_id, unnest(list_distinct({TOKENS_SQL})) AS t FROM benchmark), n AS (SELECT item_id, count(*) AS nb FROM b GROUP BY 1),
c AS (SELECT conv_id, turn, unnest(list_distinct({TOKENS_SQL})) AS t FROM conversations), m AS (SELECT conv_id, turn, count(*) AS nc FROM c GROUP BY ALL),
s AS (SELECT conv_id, turn, item_id, count(*) AS k FROM b JOIN c USING (t) GROUP BY ALL)
SELECT conv_id, turn, item_id, round(0.6 * k / nb + 0.4 * k / nc + CASE WHEN k >= 2 THEN 0.1 ELSE 0 END, 4) AS score FROM s JOIN n USING (item_id) JOIN m USING (conv_id, turn)
WHERE k >= 2 AND 0.6 * k / nb + 0.4 * k / nc + CASE WHEN k >= 2 THEN 0.1 ELSE 0 END >= 0.2""")
def j25_lexical_join(spark: SparkSession, sf: str) -> DataFrame:
    """Texts joined to terms by the overlap of their words: candidates by each term's rarest words, then whole texts."""
    from ..operators.textjoin import sharing

    of = lambda name, k, *keys: table(spark, sf, name).select(F.struct(*keys).alias(k), text.tokens(F.coalesce("text", F.lit(""))).alias("tokens")).filter(F.size("tokens") > 0)
    b, c = of("benchmark", "_r", "item_id"), of("conversations", "_l", "conv_id", "turn")
    pairs = sharing(c, b, 0.2, 2).join(c, "_l").join(b.withColumnRenamed("tokens", "term"), "_r")
    both = F.size(F.array_intersect("tokens", "term"))
    score = both * 0.6 / F.size("term") + both * 0.4 / F.size("tokens") + F.when(both >= 2, 0.1).otherwise(0.0)
    return pairs.filter((both >= 2) & (score >= 0.2)).select("_l.conv_id", "_l.turn", "_r.item_id", F.round(score, 4).alias("score"))


@query("""
WITH q AS (SELECT item_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS q FROM benchmark),
d AS (SELECT item_id AS doc, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS t FROM benchmark)
SELECT q.item_id, d.doc FROM q JOIN d ON list_bool_and(list_transform(list_filter(string_split(q.q, ' '), lambda x: x <> ''), lambda x: contains(d.t, x)))""")
def p18_all_words_search(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that hold every word of a query, also within words, by the query's rarest word."""
    from ..operators.textjoin import holding_all_words

    b = table(spark, sf, "benchmark")
    return holding_all_words(b.select(F.col("item_id").alias("doc"), "text"), b.select("item_id", F.col("text").alias("q")), "text", "q").select("item_id", "doc")


@query("""
SELECT rule, count(*) AS n FROM (SELECT 'documents.without_tokens.text' AS rule, doc_id FROM documents WHERE contains(lower(text), 'password') OR contains(lower(text), 'secret')) GROUP BY 1""")
def p55_forbidden_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with forbidden words."""
    t = quality.Table(table(spark, sf, "documents"), "documents", "doc_id")
    return t.without_tokens("text", ["password", "secret"]).groupBy("rule").agg(F.count("*").alias("n"))


@query(r"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words, length(text) AS chars, sha256(text) AS sha256 FROM documents""")
def a56_text_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Words, lengths and digests of whole texts."""
    return table(spark, sf, "documents").select("doc_id", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long").alias("words"), F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("sha256"))


@query("""
SELECT source, lang, count(*) AS n, sum(length(text))::BIGINT AS chars, max(length(text)) AS longest FROM documents GROUP BY ALL""")
def a58_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by source and language."""
    n = F.length("text").cast("long")
    return table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum(n).alias("chars"), F.max(n).alias("longest"))
