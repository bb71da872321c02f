"""The tables that stand in for stored documents, and the plans from them to the chunk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import Limits
from ..operators import gold, staging
from ..scratch import written

#: Second 0 of the load; a document is one second later for each doc_id.
LOADED = 1_704_067_200
#: Baselines that a language stands for; the others have none.
BASELINES_OF = {"en": ["low", "moderate", "high"], "de": ["moderate", "high"], "fr": ["high"]}

#: Metadata of every hundredth control, which can't be read.
BROKEN = '{"title": "cut off'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bronze(rows: DataFrame, doc_type: str, source_id: Column, text: Column, metadata: Column, number: Column) -> DataFrame:
    return rows.select(
        F.concat(F.lit(doc_type + ":"), source_id).alias("ingestion_id"), F.lit(doc_type).alias("doc_type"), source_id.alias("source_id"), text.alias("raw_text"),
        metadata.alias("metadata"), F.timestamp_seconds(F.lit(LOADED) + number).alias("ingested_at"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notices (one long section and a short one that is not indexed) and as controls; conversations as
    notices with routine uses (a turn each; what others answer has a sub-item;
    every fifth conversation declares one more than it has, and every hundredth control can't be read)."""
    docs, turns = table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations")
    key = F.col("doc_id").cast("string")

    def section(name: str, heading: str, ordinal: int, text: Column) -> Column:
        return F.struct(F.lit(name).alias("section_key"), F.lit(heading).alias("heading"), F.lit(ordinal).alias("ordinal"), text.alias("text"), F.length(text).alias("char_count"))

    notice = F.struct(
        F.concat(F.lit("doc "), key).alias("title"), F.col("source").alias("agency"), F.sha2("text", 256).alias("content_sha256"), F.lit(2).alias("section_count"),
        F.array(section("purpose", "Purpose", 0, F.col("text")), section("system_name", "System name", 1, F.col("source"))).alias("sections"),
    )
    baselines = F.coalesce(*(F.when(F.col("lang") == k, F.array(*map(F.lit, v))) for k, v in BASELINES_OF.items()))
    control = F.struct(
        F.concat(F.lit("control "), key).alias("title"), F.concat(F.lit("c-"), key).alias("control_id"), F.upper("lang").alias("family_id"), F.col("source").alias("family"),
        (F.col("lang") != "en").alias("is_enhancement"), F.when(F.col("lang") != "en", F.lit("C-0")).alias("parent_control"), baselines.alias("baselines"),
    )
    subitems = F.when(F.col("role") != "user", F.array(F.struct(F.col("role").alias("label"), F.col("text").alias("text"))))
    use = F.struct(F.col("turn").cast("string").alias("label"), F.col("text").alias("text"), F.length("text").alias("char_count"), subitems.alias("subitems"))
    talks = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", use.alias("use")))).alias("uses")).withColumn("uses", F.transform("uses", lambda x: x["use"]))
    talk = F.struct(F.concat(F.lit("talk "), F.col("conv_id").cast("string")).alias("title"), (F.size("uses") + F.when(F.col("conv_id") % 5 == 0, 1).otherwise(0)).alias("routine_use_count"), F.col("uses").alias("routine_uses"))
    return (
        _bronze(docs, "sorn", key, F.col("text"), F.to_json(notice), F.col("doc_id"))
        .unionByName(_bronze(docs, "nist_control", key, F.col("text"), F.when(F.col("doc_id") % 100 == 99, BROKEN).otherwise(F.to_json(control)), F.col("doc_id")))
        .unionByName(_bronze(talks, "sorn", F.concat(F.lit("t"), F.col("conv_id").cast("string")), F.array_join("uses.text", "\n"), F.to_json(talk), F.col("conv_id")))
    )


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """bronze, notices, controls, sections and uses; the staged rows are written once for the branches that read them."""
    stored = bronze(spark, sf_dir)
    notices, controls = written(staging.stage_notices(stored), "staged_notices"), written(staging.stage_controls(stored), "staged_controls")
    return {"bronze": stored, "notices": notices, "controls": controls, "sections": staging.sections(notices), "uses": staging.routine_uses(notices)}


def chunks(spark: SparkSession, sf_dir: str, limits: Limits = Limits()) -> DataFrame:
    s = staged(spark, sf_dir)
    return gold.document_chunks(s["sections"], s["uses"], s["controls"], limits)


def parts_sql(name: str, source: str) -> str:
    """CTE ``name``(k, part_no, total_parts, part_text) with the parts of ``source``(k, t), for comparison in DuckDB."""
    return rf"""
{name}_lines AS (SELECT k, i - 1 AS lp, l FROM (SELECT k, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM {source}) WHERE length(trim(l, ' ')) > 0),
{name}_sents AS (SELECT k, lp, j - 1 AS sp, s FROM (SELECT k, lp, unnest(x) AS s, generate_subscripts(x, 1) AS j FROM (
  SELECT k, lp, string_split(regexp_replace(l, '([a-z0-9)\]][.?!])\s+', '\1' || chr(1), 'g'), chr(1)) AS x FROM {name}_lines)) WHERE length(trim(s, ' ')) > 0),
{name}_atoms AS (SELECT k, lp, sp, p, CASE WHEN sp = 0 AND p = 0 AND lp > 0 THEN chr(10) ELSE ' ' END || substring(s, CAST(p * 1200 + 1 AS BIGINT), 1200) AS a
  FROM (SELECT k, lp, sp, s, unnest(range(0, (length(s) - 1) // 1200 + 1)) AS p FROM {name}_sents)),
{name}_packed AS (SELECT k, list_reduce(list_transform(list(a ORDER BY lp, sp, p), lambda x, i: {{'parts': []::VARCHAR[], 'cur': CASE WHEN i = 1 THEN substring(x, 2) ELSE x END}}),
  lambda acc, x: CASE WHEN length(acc.cur) + length(x.cur) <= 1200 THEN {{'parts': acc.parts, 'cur': acc.cur || x.cur}} ELSE {{'parts': list_append(acc.parts, acc.cur), 'cur': substring(x.cur, 2)}} END) AS r
  FROM {name}_atoms GROUP BY k),
{name}_rows AS (SELECT k, unnest(ps) AS part, generate_subscripts(ps, 1) - 1 AS part_no, len(ps) AS total_parts FROM (SELECT k, list_append(r.parts, r.cur) AS ps FROM {name}_packed)),
{name}_lag AS (SELECT *, right(lag(part) OVER (PARTITION BY k ORDER BY part_no), 200) AS tail FROM {name}_rows),
{name} AS (SELECT k, CAST(part_no AS INTEGER) AS part_no, CAST(total_parts AS INTEGER) AS total_parts,
  CASE WHEN tail IS NULL THEN part ELSE CASE WHEN instr(tail, ' ') > 0 THEN substring(tail, instr(tail, ' ') + 1) ELSE tail END || chr(10) || part END AS part_text FROM {name}_lag)"""


_TITLE = "'doc ' || doc_id || ' (' || coalesce(source, 'Unknown agency') || ')'"
#: CTEs up to ``chunks``: what ``chunks()`` returns, from the tables themselves.
CHUNKS_SQL = f"""
docs AS (SELECT CAST(doc_id AS VARCHAR) AS id, *, {_TITLE} || chr(10) || chr(10) || 'Purpose' || chr(10) || chr(10) || text AS whole FROM documents WHERE length(trim(text, ' ')) > 0),
sec_src AS (SELECT id AS k, text AS t FROM docs WHERE length(whole) > 2000),
ctl_src AS (SELECT id AS k, text AS t FROM docs WHERE length(text) > 2000 AND doc_id % 100 <> 99),
turns AS (SELECT 't' || conv_id AS id, CAST(turn AS VARCHAR) AS label, 'talk ' || conv_id AS title, CASE WHEN role <> 'user' THEN text || chr(10) || role || ' ' || text ELSE text END AS full_text, conv_id
  FROM conversations WHERE length(trim(text, ' ')) > 0),
uses AS (SELECT *, title || ' (Unknown agency)' || chr(10) || chr(10) || 'Routine Use ' || label || chr(10) || chr(10) || full_text AS whole FROM turns),
use_src AS (SELECT id || '|' || label AS k, full_text AS t FROM uses WHERE length(whole) > 2000),
{parts_sql("sec_parts", "sec_src")},
{parts_sql("ctl_parts", "ctl_src")},
{parts_sql("use_parts", "use_src")},
chunks AS (
  SELECT 'sorn:' || id || ':sec:purpose' AS chunk_id, 'sorn' AS doc_type, 'section' AS chunk_type, CASE WHEN length(whole) > 2000 THEN 'oversized_whole' ELSE 'standard' END AS chunk_strategy,
    id AS source_id, 'purpose' AS section_key, 'doc ' || doc_id AS document_title, whole AS chunk_text, 'Purpose' AS chunk_label, 0 AS ordinal, source AS agency, NULL AS family, NULL::VARCHAR[] AS baselines, sha256(text) AS content_sha256, doc_id AS n
  FROM docs
  UNION ALL
  SELECT 'sorn:' || id || ':sec:purpose:p' || part_no, 'sorn', 'section', 'sub_split', id, 'purpose', 'doc ' || doc_id,
    {_TITLE} || chr(10) || chr(10) || 'Purpose (part ' || (part_no + 1) || ' of ' || total_parts || ')' || chr(10) || chr(10) || part_text,
    'Purpose (part ' || (part_no + 1) || ' of ' || total_parts || ')', 0, source, NULL, NULL, sha256(text), doc_id
  FROM sec_parts JOIN docs ON k = id
  UNION ALL
  SELECT 'sorn:' || id || ':ru:' || label, 'sorn', 'routine_use', 'standard', id, 'routine_uses', title, whole, 'Routine Use ' || label, NULL, NULL, NULL, NULL, NULL, conv_id FROM uses WHERE length(whole) <= 2000
  UNION ALL
  SELECT 'sorn:' || id || ':ru:' || label || ':p' || part_no, 'sorn', 'routine_use', 'standard', id, 'routine_uses', title,
    title || ' (Unknown agency)' || chr(10) || chr(10) || 'Routine Use ' || label || ' (part ' || (part_no + 1) || ' of ' || total_parts || ')' || chr(10) || chr(10) || part_text,
    'Routine Use ' || label || ' (part ' || (part_no + 1) || ' of ' || total_parts || ')', NULL, NULL, NULL, NULL, NULL, conv_id
  FROM use_parts JOIN uses ON k = id || '|' || label
  UNION ALL
  SELECT 'nist:' || id, 'nist_control', CASE WHEN lang <> 'en' THEN 'control_enhancement' ELSE 'control' END, 'standard', id, NULL, 'control ' || id, text, id || ' control ' || id, NULL, NULL, source,
    CASE lang WHEN 'en' THEN ['low', 'moderate', 'high'] WHEN 'de' THEN ['moderate', 'high'] WHEN 'fr' THEN ['high'] END, NULL, doc_id FROM docs WHERE length(text) <= 2000 AND doc_id % 100 <> 99
  UNION ALL
  SELECT 'nist:' || id || ':p' || part_no, 'nist_control', CASE WHEN lang <> 'en' THEN 'control_enhancement' ELSE 'control' END, 'standard', id, NULL, 'control ' || id,
    id || ' control ' || id || ' (part ' || (part_no + 1) || ' of ' || total_parts || ')' || chr(10) || chr(10) || part_text, id || ' control ' || id || ' (part ' || (part_no + 1) || ' of ' || total_parts || ')',
    NULL, NULL, source, CASE lang WHEN 'en' THEN ['low', 'moderate', 'high'] WHEN 'de' THEN ['moderate', 'high'] WHEN 'fr' THEN ['high'] END, NULL, doc_id
  FROM ctl_parts JOIN docs ON k = id)"""
