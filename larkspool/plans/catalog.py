"""All queries of the chunking and evaluation engine by name, and their SQL for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import gold, quality, retrieval, staging, upsert
from ..operators.split import split_parts
from ..scratch import written
from ..session import spread
from .corpus import CHUNKS_SQL, LOADED, chunks, parts_sql, staged, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def _flat(rows: DataFrame) -> DataFrame:
    """The chunk table's columns in plain types."""
    return rows.select(
        "chunk_id", "doc_type", "chunk_type", "chunk_strategy", "source_id", "section_key", "document_title", "chunk_text", "chunk_label", "ordinal", "agency", "family",
        F.array_join("baselines", ",").alias("baselines"), "content_sha256", (F.unix_seconds("ingested_at") - LOADED).alias("loaded_after"), "chunk_char_count",
    )


_FLAT_SQL = """chunk_id, doc_type, chunk_type, chunk_strategy, source_id, section_key, document_title, chunk_text, chunk_label, CAST(ordinal AS BIGINT) AS ordinal, agency, family,
  array_to_string(baselines, ',') AS baselines, content_sha256, CAST(n AS BIGINT) AS loaded_after, CAST(length(chunk_text) AS INTEGER) AS chunk_char_count"""

# --- splitting and the chunk table


@query(f"""WITH src AS (SELECT doc_id AS k, text AS t FROM documents WHERE length(text) > 2000), {parts_sql("p", "src")}
SELECT k AS doc_id, part_no, total_parts, part_text, CAST(length(part_text) AS INTEGER) AS part_char_count FROM p""")
def q_split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of all long documents."""
    return split_parts(table(spark, sf_dir, "documents"), ["doc_id"], "text", F.length("text") > 2000)


@query(f"""WITH src AS (SELECT doc_id AS k, text AS t FROM documents WHERE length(text) > 2000), {parts_sql("p", "src")}
SELECT total_parts, count(DISTINCT k) AS n_units, count(*) AS n_parts, CAST(max(length(part_text)) AS INTEGER) AS longest, CAST(min(length(part_text)) AS INTEGER) AS shortest FROM p GROUP BY total_parts""")
def q_split_parts_summary(spark, sf_dir):
    """Units and parts by number of parts, with the lengths."""
    parts = q_split_parts(spark, sf_dir)
    return parts.groupBy("total_parts").agg(
        F.count_if(F.col("part_no") == 0).alias("n_units"), F.count("*").alias("n_parts"), F.max("part_char_count").alias("longest"), F.min("part_char_count").alias("shortest")
    )


@query("""SELECT doc_id, CAST(length(w) AS INTEGER) AS n_chars_assembled, length(w) > 2000 AS oversized, CASE WHEN length(w) > 2000 THEN 'oversized_whole' ELSE 'standard' END AS chunk_strategy FROM (
  SELECT doc_id, 'doc ' || doc_id || ' (' || coalesce(source, 'Unknown agency') || ')' || chr(10) || chr(10) || lang || chr(10) || chr(10) || text AS w FROM documents)""")
def q_chunk_text_tagging(spark, sf_dir):
    """Length of the assembled text and the tag that follows from it."""
    docs = table(spark, sf_dir, "documents")
    pieces = F.concat(F.lit("doc "), F.col("doc_id").cast("string")), F.col("source"), F.col("lang"), F.col("text")
    over = T.is_oversized(*pieces)
    return docs.select("doc_id", F.length(T.chunk_text(*pieces)).alias("n_chars_assembled"), over.alias("oversized"), F.when(over, gold.WHOLE).otherwise(gold.STANDARD).alias("chunk_strategy"))


@query(f"WITH {CHUNKS_SQL} SELECT {_FLAT_SQL} FROM chunks")
def q_gold_chunks(spark, sf_dir):
    """The chunk table."""
    return _flat(chunks(spark, sf_dir))


@query(f"WITH {CHUNKS_SQL} SELECT chunk_strategy, count(*) AS n_chunks, CAST(max(length(chunk_text)) AS INTEGER) AS longest, round(avg(length(chunk_text)), 6) AS mean_chars FROM chunks GROUP BY chunk_strategy")
def q_gold_strategy_counts(spark, sf_dir):
    """Chunks for each strategy."""
    return gold.strategy_counts(chunks(spark, sf_dir))


@query(f"WITH {CHUNKS_SQL} SELECT {_FLAT_SQL} FROM chunks WHERE chunk_strategy <> 'sub_split'")
def q_arm_whole(spark, sf_dir):
    """The arm that keeps long sections whole."""
    return _flat(gold.arm(chunks(spark, sf_dir), "whole"))


@query(f"WITH {CHUNKS_SQL} SELECT {_FLAT_SQL} FROM chunks WHERE chunk_strategy <> 'oversized_whole'")
def q_arm_split(spark, sf_dir):
    """The arm that splits them."""
    return _flat(gold.arm(chunks(spark, sf_dir), "split"))


# --- staging and JSON


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS source_id, 'doc ' || doc_id AS title, source AS agency, sha256(text) AS content_sha256, CAST(2 AS BIGINT) AS section_count, CAST(NULL AS BIGINT) AS routine_use_count, 2 AS n_sections, 0 AS n_uses, false AS parse_failed FROM documents
UNION ALL SELECT 't' || conv_id, 'talk ' || conv_id, NULL, NULL, NULL, count(*) + CASE WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END, 0, CAST(count(*) AS INTEGER), false FROM conversations GROUP BY conv_id""")
def q_stg_typed_json(spark, sf_dir):
    """Typed columns of stored JSON documents."""
    notices = staged(spark, sf_dir)["notices"]
    return notices.select("source_id", "title", "agency", "content_sha256", "section_count", "routine_use_count", T.size_or_zero(F.col("sections")).alias("n_sections"), T.size_or_zero(F.col("routine_uses")).alias("n_uses"), "parse_failed")


@query("SELECT event_id, event_type, CAST(props->>'$.k' AS BIGINT) AS k, CAST(props->>'$.k' AS BIGINT) * 2 AS twice, props->>'$.missing' AS missing, json_type(props) <> 'OBJECT' AS parse_failed FROM events")
def q_json_path_access(spark, sf_dir):
    """Paths into JSON strings, cast to types, by text and by variant."""
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"), (F.variant_get(v, "$.k", "bigint") * 2).alias("twice"),
        F.get_json_object("props", "$.missing").alias("missing"), staging.is_unparsed(F.col("props")).alias("parse_failed"),
    )


@query("SELECT event_type, count(*) AS docs, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS total_k FROM events GROUP BY ALL")
def q_group_by_all_health(spark, sf_dir):
    """Health by kind with GROUP BY ALL."""
    return spark.sql("SELECT event_type, count(*) AS docs, sum(from_json(props, 'k BIGINT').k) AS total_k FROM {events} GROUP BY ALL", events=table(spark, sf_dir, "events"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS source_id, source AS agency, 'purpose' AS section_key, 'Purpose' AS heading, CAST(0 AS BIGINT) AS section_ordinal, text AS section_text, CAST(length(text) AS BIGINT) AS section_char_count FROM documents WHERE length(trim(text, ' ')) > 0
UNION ALL SELECT CAST(doc_id AS VARCHAR), source, 'system_name', 'System name', 1, source, length(source) FROM documents WHERE length(trim(source, ' ')) > 0""")
def q_explode_sections(spark, sf_dir):
    """A row for each section of the stored arrays."""
    return staged(spark, sf_dir)["sections"].select("source_id", "agency", "section_key", "heading", "section_ordinal", "section_text", "section_char_count")


@query("""SELECT 't' || conv_id AS source_id, CAST(turn AS VARCHAR) AS routine_use_label, text AS routine_use_text, CAST(length(text) AS BIGINT) AS routine_use_char_count,
  CASE WHEN role <> 'user' THEN text || chr(10) || role || ' ' || text ELSE text END AS routine_use_full_text, CASE WHEN role <> 'user' THEN 1 ELSE 0 END AS subitem_count FROM conversations WHERE length(trim(text, ' ')) > 0""")
def q_explode_items_with_subitems(spark, sf_dir):
    """A row for each item, its sub-items folded into its text."""
    return staged(spark, sf_dir)["uses"].select("source_id", "routine_use_label", "routine_use_text", "routine_use_char_count", "routine_use_full_text", "subitem_count")


@query("SELECT CAST(count(*) + count(DISTINCT conv_id) FILTER (conv_id % 5 = 0) AS BIGINT) AS declared, CAST(count(*) AS BIGINT) AS exploded FROM conversations")
def q_explode_parity(spark, sf_dir):
    """Declared against exploded items."""
    notices = staged(spark, sf_dir)["notices"]
    counts = notices.select("routine_use_count", F.size("routine_uses").alias("n")).where("n is not null")
    return counts.agg(F.sum("routine_use_count").alias("declared"), F.sum("n").cast("bigint").alias("exploded"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS source_id, lang <> 'en' AS is_enhancement, CASE WHEN lang IN ('en', 'de', 'fr') THEN lang = 'en' END AS in_low_baseline,
  CASE WHEN lang IN ('en', 'de', 'fr') THEN lang IN ('en', 'de') END AS in_moderate_baseline, CASE WHEN lang IN ('en', 'de', 'fr') THEN true END AS in_high_baseline, doc_id % 100 = 99 AS parse_failed
  FROM (SELECT doc_id, CASE WHEN doc_id % 100 <> 99 THEN lang END AS lang FROM documents)""")
def q_baseline_flags(spark, sf_dir):
    """Controls with a flag for each baseline."""
    return staged(spark, sf_dir)["controls"].select("source_id", "is_enhancement", "in_low_baseline", "in_moderate_baseline", "in_high_baseline", "parse_failed")


# --- upserts and change feeds: the target holds the orders before a date, the source all that are open


def _orders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"), F.to_date("o_orderdate").alias("day"))
    target = orders.where(F.col("day") < "1997-01-01").select("o_orderkey", "o_custkey", "o_orderstatus", "price")
    source = orders.where("o_orderstatus = 'O'").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), "o_orderstatus", F.round(F.col("price") + 1, 2).alias("price"))
    return target, source


_ORDERS_SQL = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS price, CAST(o_orderdate AS DATE) AS day FROM orders),
tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, price FROM o WHERE day < '1997-01-01'),
src AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_orderstatus, round(price + 1, 2) AS price FROM o WHERE o_orderstatus = 'O'),
merged AS (SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, coalesce(s.price, t.price) AS price,
  CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep' ELSE 'update' END AS action FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey)"""


@query(f"WITH {_ORDERS_SQL} SELECT o_orderkey, o_custkey, o_orderstatus, price, action FROM merged")
def q_merge_upsert(spark, sf_dir):
    """Update of two columns where the key matches, else insert."""
    return upsert.merge_actions(*_orders(spark, sf_dir), ["o_orderkey"], ["o_orderstatus", "price"])


@query(f"""WITH {_ORDERS_SQL} SELECT inserted, updated, kept, CASE WHEN inserted > 0 THEN 'inserted' WHEN updated > 0 THEN 'updated' ELSE 'no_change' END AS status FROM (
  SELECT count(*) FILTER (action = 'insert') AS inserted, count(*) FILTER (action = 'update') AS updated, count(*) FILTER (action = 'keep') AS kept FROM merged)""")
def q_merge_receipt(spark, sf_dir):
    """What a merge did."""
    return upsert.merge_receipt(q_merge_upsert(spark, sf_dir))


@query("SELECT user_id, event_type, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def q_dedupe_last_wins(spark, sf_dir):
    """The last event of each user and kind."""
    return upsert.dedupe_last(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


@query("""WITH RECURSIVE d AS (SELECT lang, source, doc_id, CAST(strlen(text) AS BIGINT) AS row_bytes, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS i FROM documents),
f AS (SELECT lang, source, doc_id, row_bytes, i, 1 AS n, row_bytes AS bytes, 0 AS batch FROM d WHERE i = 1
  UNION ALL SELECT d.lang, d.source, d.doc_id, d.row_bytes, d.i, CASE WHEN x THEN 1 ELSE n + 1 END, CASE WHEN x THEN d.row_bytes ELSE bytes + d.row_bytes END, CASE WHEN x THEN batch + 1 ELSE batch END
  FROM (SELECT f.*, e.row_bytes AS nb, f.bytes + e.row_bytes > 20000 OR f.n >= 5 AS x FROM f JOIN d e ON e.lang = f.lang AND e.source = f.source AND e.i = f.i + 1) g JOIN d ON d.lang = g.lang AND d.source = g.source AND d.i = g.i + 1)
SELECT lang, source, doc_id, row_bytes, batch FROM f""")
def q_batch_plan(spark, sf_dir):
    """Batches of documents under a budget of bytes and rows, for each language and source."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", F.octet_length("text").alias("bytes"))
    plan = upsert.plan_batches(docs, ["doc_id"], F.col("bytes"), ["lang", "source"], 20_000, 5)
    return plan.select("lang", "source", "doc_id", "row_bytes", "batch")


@query("""WITH mark AS (SELECT max(ts) AS m FROM events WHERE event_type = (SELECT min(event_type) FROM events)) SELECT event_id, event_type, user_id FROM events, mark WHERE ts > m""")
def q_incremental_watermark(spark, sf_dir):
    """Events after the latest one that the target holds."""
    events = table(spark, sf_dir, "events")
    kind = events.agg(F.min("event_type").alias("event_type"))
    held = events.join(F.broadcast(kind), "event_type", "left_semi")
    return upsert.newer_rows(events, held, "ts").select("event_id", "event_type", "user_id")


@query(f"""WITH {_ORDERS_SQL}, j AS (SELECT t.o_orderkey AS k, t.o_custkey AS c0, t.o_orderstatus AS s0, t.price AS p0, m.o_custkey AS c1, m.o_orderstatus AS s1, m.price AS p1, m.o_orderkey AS k1 FROM tgt t FULL JOIN merged m ON t.o_orderkey = m.o_orderkey)
SELECT 'insert' AS change_type, k1 AS o_orderkey, c1 AS o_custkey, s1 AS o_orderstatus, p1 AS price FROM j WHERE k IS NULL
UNION ALL SELECT 'delete', k, c0, s0, p0 FROM j WHERE k1 IS NULL
UNION ALL SELECT 'update_preimage', k, c0, s0, p0 FROM j WHERE k IS NOT NULL AND k1 IS NOT NULL AND (c0, s0, p0) IS DISTINCT FROM (c1, s1, p1)
UNION ALL SELECT 'update_postimage', k1, c1, s1, p1 FROM j WHERE k IS NOT NULL AND k1 IS NOT NULL AND (c0, s0, p0) IS DISTINCT FROM (c1, s1, p1)""")
def q_change_feed_diff(spark, sf_dir):
    """What a merge changed, row by row."""
    target, _ = _orders(spark, sf_dir)
    return upsert.change_feed(target, q_merge_upsert(spark, sf_dir).drop("action"), "o_orderkey")


@query("""SELECT event_type, latest, round(age, 6) AS age_days, CASE WHEN round(age, 6) <= 7 THEN 'pass' WHEN round(age, 6) <= 30 THEN 'warn' ELSE 'error' END AS status FROM (
  SELECT event_type, CAST(floor(epoch(max(ts))) AS BIGINT) AS latest, (epoch(TIMESTAMP '2024-02-02') - floor(epoch(max(ts)))) / 86400 AS age FROM events WHERE date_diff('day', DATE '2024-01-02', CAST(ts AS DATE)) < 7 * (length(event_type) - 4) GROUP BY event_type)""")
def q_freshness_status(spark, sf_dir):
    """Freshness of each kind of event at a given time, as if the loads of some kinds had stopped earlier."""
    events = table(spark, sf_dir, "events").where(F.datediff("ts", F.lit("2024-01-02")) < 7 * (F.length("event_type") - 4))
    return upsert.freshness(events, "2024-02-02", "ts", by=["event_type"]).select("event_type", F.unix_seconds(F.col("latest").cast("timestamp")).alias("latest"), "age_days", "status")


@query("""WITH e AS (SELECT event_id % 997 AS chunk_id, event_id, event_type, date_trunc('second', ts) AS load FROM events), mark AS (SELECT max(load) AS m FROM e WHERE event_id % 3 = 0 AND load < TIMESTAMP '2024-01-20'),
old AS (SELECT chunk_id, max_by(event_id, event_id) AS event_id FROM e, mark WHERE event_id % 3 = 0 AND load <= m GROUP BY chunk_id), new AS (SELECT chunk_id, max(event_id) AS event_id FROM e, mark WHERE load > m GROUP BY chunk_id)
SELECT coalesce(new.chunk_id, old.chunk_id) AS chunk_id, e.event_id, e.event_type, new.chunk_id IS NOT NULL AS is_new FROM old FULL JOIN new ON old.chunk_id = new.chunk_id JOIN e ON e.event_id = coalesce(new.event_id, old.event_id)""")
def q_incremental_merge(spark, sf_dir):
    """Rows after the latest of the target merged into it by key; the new column is null in rows that were there before."""
    events = table(spark, sf_dir, "events").select((F.col("event_id") % 997).alias("chunk_id"), "event_id", "event_type", F.date_trunc("second", "ts").alias("ingested_at"))
    held = events.where((F.col("event_id") % 3 == 0) & (F.col("ingested_at") < F.lit("2024-01-20").cast("timestamp")))
    target = written(upsert.dedupe_last(held, ["chunk_id"], ["event_id"]), "incremental_target")
    source = upsert.dedupe_last(upsert.newer_rows(events, target), ["chunk_id"], ["event_id"]).withColumn("is_new", F.lit(True))
    return upsert.incremental_merge(target, source).select("chunk_id", "event_id", "event_type", F.coalesce("is_new", F.lit(False)).alias("is_new"))


@query("SELECT lang, CAST(sum(strlen(text) + strlen(coalesce(source, '')) + strlen(CAST(doc_id AS VARCHAR))) AS BIGINT) AS total_bytes, CAST(max(strlen(text) + strlen(coalesce(source, '')) + strlen(CAST(doc_id AS VARCHAR))) AS BIGINT) AS largest FROM documents GROUP BY lang")
def q_row_bytes(spark, sf_dir):
    """Bytes of the rows that a load sends, by language."""
    size = upsert.row_bytes(["doc_id", "text", "source"])
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(size).cast("bigint").alias("total_bytes"), F.max(size).cast("bigint").alias("largest"))


# --- exploration: schemas, sorted and limited lists, set operations, literal rows


@query("SELECT column_name AS col_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS data_type FROM (DESCRIBE events)")
def q_describe_table(spark, sf_dir):
    """Columns of a table and their types, as DESCRIBE says."""
    from ..sources.files import described

    return described(table(spark, sf_dir, "events"))


@query("SELECT 'OBJECT<k: BIGINT>' AS metadata_schema, count(*) AS n FROM events WHERE json_type(props) = 'OBJECT'")
def q_describe_json(spark, sf_dir):
    """Schemas of stored JSON and how many rows have each."""
    return staging.inferred_schemas(table(spark, sf_dir, "events"), "props").withColumnRenamed("schema", "metadata_schema")


@query("SELECT doc_id, source, length(text) AS n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def q_longest_documents(spark, sf_dir):
    """The twenty longest documents (a report of the top): ORDER BY with LIMIT."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "source", F.length("text").cast("bigint").alias("n_chars")).orderBy(F.col("n_chars").desc(), "doc_id").limit(20)


@query("SELECT 't' || conv_id AS source_id, CAST(turn AS VARCHAR) AS routine_use_label, length(text) AS n FROM conversations WHERE length(trim(text, ' ')) > 0 AND CAST(turn AS VARCHAR) <> '0' ORDER BY n DESC, source_id, routine_use_label")
def q_items_but_the_first(spark, sf_dir):
    """Items under other labels than the first, longest first: an inequality filter and ORDER BY."""
    uses = staged(spark, sf_dir)["uses"].where(F.col("routine_use_label") != "0")
    rows = uses.select("source_id", "routine_use_label", F.length("routine_use_text").cast("bigint").alias("n"))
    return rows.orderBy(F.col("n").desc(), "source_id", "routine_use_label")


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL INTERSECT SELECT doc_id FROM labels WHERE toxic = 1")
def q_set_intersection(spark, sf_dir):
    """Documents that are labelled toxic: INTERSECT."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.where("text is not null").select("doc_id").intersect(labels.where("toxic = 1").select("doc_id"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def q_set_difference(spark, sf_dir):
    """Documents without a label: EXCEPT."""
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT kind, count(doc_id) AS n_docs FROM (SELECT 'en' AS lang, 'english' AS kind UNION ALL SELECT 'de', 'german' UNION ALL SELECT 'xx', 'unknown') LEFT JOIN documents USING (lang) GROUP BY kind")
def q_literal_relation(spark, sf_dir):
    """Rows given as bound parameters, joined with a table."""
    given = {"a": "en", "b": "english", "c": "de", "d": "german", "e": "xx", "f": "unknown"}
    literal = spark.sql("SELECT * FROM VALUES (:a, :b), (:c, :d), (:e, :f) AS v(lang, kind)", args=given)
    return literal.join(table(spark, sf_dir, "documents"), "lang", "left").groupBy("kind").agg(F.count("doc_id").alias("n_docs"))


# --- data tests


@query("SELECT 'documents.text' AS test, count(*) AS failures FROM documents WHERE text IS NULL UNION ALL SELECT 'labels.toxic', count(*) FROM labels WHERE toxic IS NULL UNION ALL SELECT 'joined.quality', count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def q_dq_not_null(spark, sf_dir):
    """Nulls in columns that must have none."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    cases = {"documents.text": quality.not_null(docs, "text"), "labels.toxic": quality.not_null(labels, "toxic"), "joined.quality": quality.not_null(docs.join(labels, "doc_id", "left"), "quality")}
    out = [rows.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures") for name, rows in cases.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def q_dq_unique_combo(spark, sf_dir):
    """Combinations of columns that repeat."""
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def q_dq_accepted_values(spark, sf_dir):
    """Values that are not accepted."""
    return quality.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey", "o_orderpriority")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_dq_relationships(spark, sf_dir):
    """Rows that refer to nothing."""
    return quality.relationships(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query("""WITH t AS (SELECT 'short' AS test, count(*) FILTER (length(text) < 50) AS failures, 25 AS e FROM documents UNION ALL SELECT 'price', count(*) FILTER (NOT o_totalprice > 0), 0 FROM orders UNION ALL SELECT 'discount', count(*) FILTER (NOT l_discount <= 0.09), NULL FROM lineitem)
SELECT test, failures, CASE WHEN failures > e THEN 'error' WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM t""")
def q_dq_expression_thresholds(spark, sf_dir):
    """Expressions with thresholds for warning and error."""
    return quality.results([
        quality.Test("short", quality.expression_is_true(table(spark, sf_dir, "documents"), "length(text) >= 50"), 0, 25),
        quality.Test("price", quality.expression_is_true(table(spark, sf_dir, "orders"), "o_totalprice > 0")),
        quality.Test("discount", quality.expression_is_true(table(spark, sf_dir, "lineitem"), F.col("l_discount") <= 0.09), 0, None),
    ])


@query(f"""WITH {CHUNKS_SQL} (SELECT 'sorn' AS doc_type, CAST(doc_id AS VARCHAR) AS source_id FROM documents UNION SELECT 'nist_control', CAST(doc_id AS VARCHAR) FROM documents UNION SELECT 'sorn', 't' || conv_id FROM conversations)
EXCEPT SELECT doc_type, source_id FROM chunks WHERE chunk_strategy = 'oversized_whole'""")
def q_lost_documents_anti(spark, sf_dir):
    """Stored documents that would be lost if only the long sections were kept whole."""
    s = staged(spark, sf_dir)
    made = gold.document_chunks(s["sections"], s["uses"], s["controls"]).where(F.col("chunk_strategy") == gold.WHOLE)
    return quality.lost_documents(s["bronze"], made)


@query(f"WITH {CHUNKS_SQL} SELECT coalesce(o.source_id, p.source_id) AS source_id, CASE WHEN p.source_id IS NULL THEN 'one part or none' ELSE 'several parts' END AS coverage FROM (SELECT source_id FROM chunks WHERE chunk_strategy = 'oversized_whole') o FULL JOIN (SELECT source_id FROM chunks WHERE chunk_strategy = 'sub_split' GROUP BY source_id HAVING count(*) > 3) p ON o.source_id = p.source_id")
def q_coverage_full_outer(spark, sf_dir):
    """Oversized sections against those with more than three parts."""
    made = chunks(spark, sf_dir)
    whole = made.where("chunk_strategy = 'oversized_whole'").select("source_id", F.lit(True).alias("w"))
    several = made.where("chunk_strategy = 'sub_split'").groupBy("source_id").agg(F.count("*").alias("n")).where("n > 3")
    return whole.join(several, "source_id", "full_outer").select("source_id", F.when(F.col("n").isNull(), "one part or none").otherwise("several parts").alias("coverage"))


@query(f"""WITH src AS (SELECT doc_id AS k, text AS t FROM documents WHERE length(text) > 1000), {parts_sql("p", "src")}
SELECT 'docs' AS corpus, CAST(k AS VARCHAR) AS unit, total_parts FROM p GROUP BY k, total_parts HAVING total_parts < 2""")
def q_split_effect_having(spark, sf_dir):
    """Texts that were split into one part."""
    parts = split_parts(table(spark, sf_dir, "documents"), ["doc_id"], "text", F.length("text") > 1000)
    return quality.splits_without_effect(parts, "docs", ["doc_id"])


def _count(rows: str) -> str:
    return f"(SELECT count(*) FROM {rows})"


def _suite_sql() -> str:
    """Counts of failing rows for every test of the suite, from the tables and the chunk CTEs, and their statuses."""
    longest, docs = T.Limits().longest_part, "documents"
    no_id, no_conv = _count(f"{docs} WHERE doc_id IS NULL"), _count("(SELECT DISTINCT conv_id FROM conversations) WHERE conv_id IS NULL")
    no_lang, twice = _count(f"{docs} WHERE lang IS NULL OR doc_id % 100 = 99"), _count(f"(SELECT doc_id FROM {docs} WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1)")
    tests = {
        "bronze.source_id.not_null": f"2 * {no_id} + {no_conv}", "bronze.doc_type.not_null": "0", "bronze.raw_text.not_null": f"2 * {_count(f'{docs} WHERE text IS NULL')}",
        "bronze.doc_type.accepted": _count("chunks WHERE doc_type NOT IN ('sorn', 'nist_control')"),
        "notices.source_id.not_null": f"{no_id} + {no_conv}", "notices.source_id.unique": twice, "notices.parse_failed.accepted": "0",
        "controls.source_id.not_null": no_id, "controls.source_id.unique": twice, "controls.parse_failed.accepted": _count(f"{docs} WHERE doc_id % 100 = 99"),
        "notices.title.not_null": f"{no_id} + {no_conv}", "notices.section_count.not_null": _count("(SELECT DISTINCT conv_id FROM conversations)"), "notices.section_count.positive": "0",
        "controls.family_id.not_null": no_lang, "controls.is_enhancement.not_null": no_lang, "controls.parent_of_enhancement": "0",
        "sections.section_text.not_null": "0", "sections.source_id.known": _count(f"docs WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM {docs})"),
        "uses.full_text.not_null": _count("uses WHERE full_text IS NULL"), "uses.source_id.known": _count("uses WHERE id NOT IN (SELECT 't' || conv_id FROM conversations)"),
    }
    for name, rows in (("section_parts", "sec_parts"), ("use_parts", "use_parts"), ("control_parts", "ctl_parts")):
        tests |= {
            f"{name}.part_text.not_null": _count(f"{rows} WHERE part_text IS NULL"), f"{name}.part_no.not_null": _count(f"{rows} WHERE part_no IS NULL"),
            f"{name}.source_id.known": _count(f"{rows} WHERE k IS NULL"), f"{name}.unique": _count(f"(SELECT k, part_no FROM {rows} GROUP BY ALL HAVING count(*) > 1)"),
            f"{name}.longest": _count(f"{rows} WHERE length(part_text) > {longest}"), f"{name}.effect": _count(f"(SELECT k FROM {rows} GROUP BY k HAVING max(total_parts) < 2)"),
        }
    tests |= {f"chunks.{c}.not_null": _count(f"chunks WHERE {c} IS NULL") for c in ("chunk_id", "chunk_text", "doc_type", "chunk_strategy")}
    stored = f"SELECT 'sorn' AS t, CAST(doc_id AS VARCHAR) AS i FROM {docs} UNION ALL SELECT 'nist_control', CAST(doc_id AS VARCHAR) FROM {docs} UNION ALL SELECT DISTINCT 'sorn', 't' || conv_id FROM conversations"
    whole, parts = "SELECT DISTINCT source_id, section_key FROM chunks WHERE chunk_strategy = 'oversized_whole'", "SELECT DISTINCT source_id, section_key FROM chunks WHERE chunk_strategy = 'sub_split'"
    sections, notices = f"(SELECT count(*) FROM docs) + (SELECT count(*) FROM {docs} WHERE length(trim(source, ' ')) > 0)", f"(SELECT count(*) FROM {docs}) + (SELECT count(DISTINCT conv_id) FROM conversations)"
    tests |= {
        "chunks.chunk_id.unique": _count("(SELECT chunk_id FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id HAVING count(*) > 1)"),
        "chunks.doc_type.accepted": _count("chunks WHERE doc_type NOT IN ('sorn', 'nist_control')"),
        "chunks.chunk_type.accepted": _count("chunks WHERE chunk_type NOT IN ('section', 'routine_use', 'control', 'control_enhancement')"),
        "chunks.chunk_strategy.accepted": _count("chunks WHERE chunk_strategy NOT IN ('standard', 'oversized_whole', 'sub_split')"),
        "chunks.shortest": _count("chunks WHERE length(chunk_text) < 50"), "chunks.ceiling": _count("chunks WHERE length(chunk_text) > 2000 AND chunk_strategy <> 'oversized_whole'"),
        "lost_documents": _count(f"({stored}) WHERE (t, i) NOT IN (SELECT (doc_type, source_id) FROM chunks)"), "fewer_sections_than_documents": f"CASE WHEN {sections} < {notices} THEN 1 ELSE 0 END",
        "uncovered_sections": _count(f"({whole}) w FULL JOIN ({parts}) p USING (source_id, section_key) WHERE w.source_id IS NULL OR p.source_id IS NULL"),
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS test, CAST({n} AS BIGINT) AS failures" for name, n in tests.items())
    error = "CASE test WHEN 'notices.title.not_null' THEN 5 WHEN 'notices.section_count.positive' THEN 3 WHEN 'chunks.shortest' THEN 25 WHEN 'notices.section_count.not_null' THEN NULL WHEN 'controls.is_enhancement.not_null' THEN NULL ELSE 0 END"
    return f"WITH {CHUNKS_SQL} SELECT test, failures, CASE WHEN failures > {error} THEN 'error' WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM ({rows})"


@query(_suite_sql())
def q_dq_suite(spark, sf_dir):
    """All tests of the suite, on the columns that they look at; of texts those are null or not, and lengths."""

    def kept(name: str, rows: DataFrame, text: str, *columns: str) -> DataFrame:
        slim = [F.when(F.col(text).isNotNull(), "").alias(text)] if text else []
        return written(rows.select(*columns, *slim), f"suite_{name}")

    s = staged(spark, sf_dir)
    part = ("part_no", "total_parts", "part_char_count")
    suite = quality.chunk_suite(
        kept("bronze", s["bronze"], "raw_text", "source_id", "doc_type"),
        kept("notices", s["notices"], "", "source_id", "parse_failed", "title", "section_count"),
        kept("controls", s["controls"], "", "source_id", "parse_failed", "family_id", "is_enhancement", "parent_control"),
        kept("sections", s["sections"], "section_text", "source_id"),
        kept("uses", s["uses"], "routine_use_full_text", "source_id"),
        kept("section_parts", gold.split_sections(s["sections"]), "part_text", "source_id", "section_key", *part),
        kept("use_parts", gold.split_routine_uses(s["uses"]), "part_text", "source_id", "routine_use_label", *part),
        kept("control_parts", gold.split_controls(s["controls"]), "part_text", "source_id", *part),
        kept("chunks", gold.document_chunks(s["sections"], s["uses"], s["controls"]), "chunk_text", "chunk_id", "doc_type", "chunk_type", "chunk_strategy", "chunk_char_count", "source_id", "section_key"),
        T.Limits(),
    )
    return quality.results(suite)


@query(f"""WITH {CHUNKS_SQL}, c AS (SELECT * FROM chunks WHERE NOT (chunk_strategy = 'sub_split' AND source_id LIKE '%3') AND NOT (chunk_strategy = 'oversized_whole' AND source_id LIKE '%4'))
SELECT coalesce(w.source_id, p.source_id) AS source_id, coalesce(w.section_key, p.section_key) AS section_key, CASE WHEN p.source_id IS NULL THEN 'oversized section has no sub_split parts' ELSE 'sub_split parts have no oversized section' END AS problem
FROM (SELECT DISTINCT source_id, section_key FROM c WHERE chunk_strategy = 'oversized_whole') w FULL JOIN (SELECT DISTINCT source_id, section_key FROM c WHERE chunk_strategy = 'sub_split') p USING (source_id, section_key) WHERE w.source_id IS NULL OR p.source_id IS NULL""")
def q_uncovered_sections(spark, sf_dir):
    """Sections that lack their parts, and parts that lack their section, in a table from which some are taken out."""
    last = F.right("source_id", F.lit(1))
    lost = ((F.col("chunk_strategy") == "sub_split") & (last == "3")) | ((F.col("chunk_strategy") == "oversized_whole") & (last == "4"))
    return quality.uncovered_sections(chunks(spark, sf_dir).where(~lost))


@query("""SELECT n AS section_rows, m AS document_rows FROM (SELECT count(*) FILTER (length(trim(text, ' ')) > 0 AND doc_id % 2 = 0) + count(*) FILTER (length(trim(source, ' ')) > 0 AND doc_id % 2 = 0) AS n, count(*) AS d FROM documents),
  (SELECT count(*) + (SELECT count(DISTINCT conv_id) FROM conversations) AS m FROM documents) WHERE n < m""")
def q_fewer_sections_than_documents(spark, sf_dir):
    """Both counts, as the sections of every other notice are lost."""
    s = staged(spark, sf_dir)
    return quality.fewer_sections_than_documents(s["sections"].where(F.col("source_id").try_cast("bigint") % 2 == 0), s["notices"])


# --- retrieval: questions are the benchmark's texts, and a target is a document that shares a line with one


def _texts(spark, sf_dir) -> DataFrame:
    """The chunks, each once with the arms that it is in; routine uses and controls compete in both."""
    kind = F.col("chunk_strategy")
    arms = F.array_compact(F.array(*(F.when(kind != left_out, F.lit(a)) for a, left_out in gold.ARMS.items())))
    return spread(chunks(spark, sf_dir)).select(arms.alias("arms"), F.col("chunk_id").alias("doc"), F.col("chunk_text").alias("text"), "source_id", "section_key", "chunk_strategy")


def _corpus(spark, sf_dir) -> DataFrame:
    """The chunks as words."""
    return retrieval.tokenised(_texts(spark, sf_dir))


def _questions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def _targets(spark, sf_dir) -> DataFrame:
    def lines(rows: DataFrame, key: str) -> DataFrame:
        return rows.select(key, F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") >= 30).distinct()

    shared = lines(table(spark, sf_dir, "benchmark"), "item_id").join(lines(table(spark, sf_dir, "documents"), "doc_id"), "line")
    return shared.select(F.col("item_id").alias("query_id"), F.col("doc_id").cast("string").alias("source_id"), F.lit("purpose").alias("section_key")).distinct()


_CORPUS_SQL = f"""{CHUNKS_SQL},
corpus AS (SELECT a AS arm, chunk_id AS doc, source_id, section_key, regexp_extract_all(lower(chunk_text), '[a-z0-9]+') AS toks FROM chunks, (VALUES ('whole', 'sub_split'), ('split', 'oversized_whole')) v(a, s) WHERE chunk_strategy <> s),
asked AS (SELECT item_id AS query_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) GROUP BY ALL),
post AS (SELECT arm, doc, CAST(n AS INTEGER) AS doc_length, term, count(*) AS tf FROM (SELECT arm, doc, len(toks) AS n, unnest(toks) AS term FROM corpus) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
stats AS (SELECT arm, count(*) AS n_docs, avg(len(toks)) AS mean_length FROM corpus GROUP BY arm),
idf AS (SELECT arm, term, df, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) AS idf FROM (SELECT arm, term, count(*) AS df FROM post GROUP BY ALL) JOIN stats USING (arm))"""
_TOP_SQL = f"""{_CORPUS_SQL},
scores AS (SELECT arm, query_id, doc, round(sum(times * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * doc_length / mean_length))), 6) AS score
  FROM post JOIN idf USING (arm, term) JOIN stats USING (arm) JOIN asked USING (term) GROUP BY ALL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arm, query_id ORDER BY score DESC, doc) AS rank FROM scores) WHERE rank <= 5)"""
_METRICS_SQL = f"""{_TOP_SQL},
b_lines AS (SELECT DISTINCT item_id, line FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark) WHERE length(line) >= 30),
d_lines AS (SELECT DISTINCT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) >= 30),
targets AS (SELECT DISTINCT item_id AS query_id, CAST(doc_id AS VARCHAR) AS source_id FROM b_lines JOIN d_lines USING (line)),
over AS (SELECT source_id FROM chunks WHERE chunk_strategy = 'oversized_whole'),
qs AS (SELECT item_id AS query_id, CASE WHEN item_id IN (SELECT query_id FROM targets WHERE source_id IN (SELECT source_id FROM over)) THEN 'contested' ELSE 'control' END AS class FROM benchmark),
graded AS (SELECT top.*, c.source_id, c.section_key, t.query_id IS NOT NULL AS relevant FROM top JOIN corpus c USING (arm, doc) LEFT JOIN targets t ON t.query_id = top.query_id AND t.source_id = c.source_id AND c.section_key IS NOT DISTINCT FROM 'purpose'),
firsts AS (SELECT *, relevant AND row_number() OVER (PARTITION BY arm, query_id, source_id, section_key ORDER BY rank) = 1 AS first FROM graded),
got AS (SELECT arm, query_id, max(CAST(relevant AS INTEGER)) AS hit, sum(CAST(first AS INTEGER)) AS found, min(rank) FILTER (relevant) AS first_at, sum(CASE WHEN first THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg FROM firsts GROUP BY ALL),
wanted AS (SELECT query_id, count(*) AS wanted FROM targets GROUP BY ALL),
scored AS (SELECT arm, qs.query_id, class, coalesce(CAST(hit AS DOUBLE), 0) AS hit, coalesce(found / wanted, 0) AS recall, coalesce(1 / first_at, 0) AS mrr,
  CASE WHEN wanted > 0 THEN coalesce(dcg / list_sum(list_transform(range(1, least(wanted, 5) + 1), lambda i: 1 / log2(i + 1))), 0) ELSE 0 END AS ndcg
  FROM qs CROSS JOIN (VALUES ('whole'), ('split')) a(arm) LEFT JOIN wanted USING (query_id) LEFT JOIN got USING (arm, query_id))"""


@query(f"WITH {_CORPUS_SQL} SELECT arm, doc, doc_length, term, tf FROM post")
def q_bm25_postings(spark, sf_dir):
    """Frequencies of the questions' terms in the chunks of both arms."""
    return retrieval.postings(_corpus(spark, sf_dir), retrieval.query_terms(_questions(spark, sf_dir))).select("arm", "doc", "doc_length", "term", "tf")


@query(f"WITH {_CORPUS_SQL} SELECT arm, term, df, round(idf, 6) AS idf FROM idf")
def q_bm25_idf(spark, sf_dir):
    """Their inverse document frequencies by arm."""
    corpus = _corpus(spark, sf_dir)
    found = retrieval.postings(corpus, retrieval.query_terms(_questions(spark, sf_dir)))
    return retrieval.idf(found, retrieval.corpus_statistics(corpus)).withColumn("idf", F.round("idf", 6))


@query(f"WITH {_TOP_SQL} SELECT arm, query_id, doc, score, CAST(rank AS INTEGER) AS rank FROM top")
def q_bm25_topk(spark, sf_dir):
    """The five best chunks of each question and arm."""
    return retrieval.bm25(_texts(spark, sf_dir), _questions(spark, sf_dir))


def _scores(spark, sf_dir) -> DataFrame:
    questions, targets = _questions(spark, sf_dir), written(_targets(spark, sf_dir), "retrieval_targets")
    corpus = retrieval.prepared(_texts(spark, sf_dir), questions)
    found = written(retrieval.bm25(corpus, questions), "retrieval_results").join(corpus.select("doc", "source_id", "section_key"), "doc")
    over = corpus.where("chunk_strategy = 'oversized_whole'").select("source_id").distinct()
    contested = targets.join(over, "source_id", "left_semi").select("query_id").distinct().withColumn("c", F.lit("contested"))
    asked = questions.join(contested, "query_id", "left").select("query_id", F.coalesce("c", F.lit("control")).alias("class"))
    return retrieval.metrics(found, targets, asked)


@query(f"WITH {_METRICS_SQL} SELECT arm, query_id, class, round(hit, 6) AS hit, round(recall, 6) AS recall, round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg FROM scored")
def q_retrieval_metrics(spark, sf_dir):
    """hit, recall, MRR and nDCG of each question and arm."""
    return _scores(spark, sf_dir).select("arm", "query_id", "class", *(F.round(m, 6).alias(m) for m in retrieval.METRICS))


@query(f"""WITH {_METRICS_SQL}, means AS (SELECT coalesce(class, 'all') AS class, arm, count(*) AS n, avg(hit) AS hit, avg(recall) AS recall, avg(mrr) AS mrr, avg(ndcg) AS ndcg FROM scored GROUP BY GROUPING SETS ((class, arm), (arm))),
long AS (SELECT class, arm, n, unnest(['hit', 'recall', 'mrr', 'ndcg']) AS metric, unnest([hit, recall, mrr, ndcg]) AS value FROM means)
SELECT a.class, a.metric, a.n, round(a.value, 6) AS whole, round(b.value, 6) AS split, round(b.value - a.value, 6) AS delta, CASE WHEN abs(b.value - a.value) < 1e-9 THEN '=' WHEN b.value > a.value THEN '+' ELSE '-' END AS trend
FROM long a JOIN long b ON a.class = b.class AND a.metric = b.metric AND a.arm = 'whole' AND b.arm = 'split'""")
def q_ab_report_rollup(spark, sf_dir):
    """Means of both arms by class and over all, and what splitting changed."""
    return retrieval.comparison(_scores(spark, sf_dir))


@query(f"WITH {_METRICS_SQL} SELECT count(*) FILTER ((a.hit, a.recall, a.mrr, a.ndcg) IS DISTINCT FROM (b.hit, b.recall, b.mrr, b.ndcg)) AS moved, count(*) AS n_control FROM scored a JOIN scored b ON a.query_id = b.query_id AND a.arm = 'whole' AND b.arm = 'split' WHERE a.class = 'control'")
def q_crowding(spark, sf_dir):
    """Control questions whose metrics moved."""
    return retrieval.crowding(_scores(spark, sf_dir))


@query(f"""WITH {CHUNKS_SQL}, n AS (SELECT count(*) FILTER (chunk_strategy = 'standard' AND source_id LIKE '%3') AS a, count(*) FILTER (chunk_strategy = 'standard' AND source_id LIKE '%4') AS b,
  count(*) FILTER (chunk_strategy = 'standard' AND source_id LIKE '%5') AS c, count(*) FILTER (chunk_strategy = 'sub_split' AND source_id LIKE '%7') AS d, count(*) FILTER (chunk_strategy = 'oversized_whole' AND source_id LIKE '%8') AS e FROM chunks)
SELECT unnest(['standard chunk absent from arm A', 'standard chunk absent from arm B', 'chunk with different text', 'sub_split chunk in arm A', 'oversized_whole chunk in arm B']) AS problem, unnest([a, b, c, d, e]) AS n FROM n""")
def q_structural_validity(spark, sf_dir):
    """What is wrong with two arms that were damaged: chunks lost, changed and put into the wrong arm."""
    made = written(chunks(spark, sf_dir), "structural_chunks")
    last, kind = F.right("source_id", F.lit(1)), F.col("chunk_strategy")
    a = gold.arm(made, "whole").where(~((kind == gold.STANDARD) & (last == "3"))).unionByName(made.where((kind == gold.SPLIT) & (last == "7")))
    a = a.withColumn("chunk_text", F.when((kind == gold.STANDARD) & (last == "5"), F.concat("chunk_text", F.lit("!"))).otherwise(F.col("chunk_text")))
    b = gold.arm(made, "split").where(~((kind == gold.STANDARD) & (last == "4"))).unionByName(made.where((kind == gold.WHOLE) & (last == "8")))
    return retrieval.structural_problems(made, a, b)


@query("""WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(e AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 5) AS score FROM q, embeddings WHERE label <> 0)
SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def q_dense_topk(spark, sf_dir):
    """Vectors most like each query's, behind a filter; queries are the ids that 50 divides."""
    rows = table(spark, sf_dir, "embeddings")
    queries = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.dense_search(rows, queries, 5, F.col("label") != 0, digits=5)


@query("SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_terms, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents)")
def q_tokenize(spark, sf_dir):
    """Tokens of every document."""
    t = T.tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.size(F.array_distinct(t)).cast("bigint").alias("n_terms"), F.array_join(t, " ").alias("tokens"))


# --- parsing


@query(r"""SELECT doc_id, CAST(len(b) AS INTEGER) AS n_lines, coalesce(len(b) >= 20 AND list_sort(list_transform(b, lambda x: length(x)))[len(b) // 2 + 1] BETWEEN 50 AND 85 AND len(list_filter(b, lambda x: regexp_matches(x, '[.:;!?]$'))) < 0.45 * len(b), false) AS hard_wrapped
FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS b FROM documents)""")
def q_hard_wrap_detect(spark, sf_dir):
    """Whether lines are broken at a fixed width."""
    lines = F.split("text", "\n")
    body = F.filter(F.transform(lines, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(body).alias("n_lines"), T.is_hard_wrapped(lines).alias("hard_wrapped"))


@query(r"""SELECT doc_id, regexp_replace(array_to_string(b, ' '), '^\s+|\s+$', '', 'g') AS wrapped, regexp_replace(array_to_string(b, chr(10)), '^\s+|\s+$', '', 'g') AS plain
FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS b FROM documents)""")
def q_reflow(spark, sf_dir):
    """Lines joined again, as wrapped lines and as they are (no blank lines here)."""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select("doc_id", T.reflowed(lines, F.lit(True)).alias("wrapped"), T.reflowed(lines, F.lit(False)).alias("plain"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS long_form, strftime(o_orderdate, '%Y-%m-%d') AS short_form, strftime(o_orderdate, '%Y-%m-%d') AS iso_form, strftime(o_orderdate, '%Y-%m-%d') AS slash_form, CAST(NULL AS VARCHAR) AS no_date FROM orders""")
def q_normalize_date(spark, sf_dir):
    """Dates in four written forms, read back."""
    day = F.col("o_orderdate")
    forms = {"long_form": "MMMM d, yyyy", "short_form": "MMM d, yyyy", "iso_form": "yyyy-MM-dd", "slash_form": "M/d/yyyy"}
    written = {k: T.iso_date(F.concat(F.lit(" "), F.date_format(day, f), F.lit("."))) for k, f in forms.items()}
    return table(spark, sf_dir, "orders").select("o_orderkey", *(c.alias(k) for k, c in written.items()), T.iso_date(F.col("o_orderpriority")).alias("no_date"))


@query("""SELECT o_orderkey, CASE WHEN x LIKE '%rescind%' THEN 'rescindment' WHEN x LIKE '%modif%' OR x LIKE '%amend%' THEN 'modified' WHEN x LIKE '%updat%' OR x LIKE '%reissu%' THEN 'updated' WHEN x LIKE '%new%' THEN 'new' WHEN x LIKE '%notice%' THEN 'notice' ELSE 'unknown' END AS action_type
FROM (SELECT o_orderkey, lower(CASE o_orderpriority WHEN '1-URGENT' THEN 'Notice to rescind' WHEN '2-HIGH' THEN 'Notice of amendment' WHEN '3-MEDIUM' THEN 'Reissuance' WHEN '5-LOW' THEN 'Notice of a New System' ELSE o_orderpriority END) AS x FROM orders)""")
def q_classify_action(spark, sf_dir):
    """Kinds of action lines."""
    p = F.col("o_orderpriority")
    line = F.when(p == "1-URGENT", "Notice to rescind").when(p == "2-HIGH", "Notice of amendment").when(p == "3-MEDIUM", "Reissuance").when(p == "5-LOW", "Notice of a New System").otherwise(p)
    return table(spark, sf_dir, "orders").select("o_orderkey", T.action_kind(line).alias("action_type"))


#: The notices that documents are put into, by doc_id modulo 4: a complete one, two that lack sections, and one without any.
#: Their lines before the document's and after them; what stands behind each heading is the section's text.
_FIRST = ["ACTION: Notice of a modified system.", "DATES: January 5, 2024."]
_USES_HEADING = "Routine uses of records maintained in this system:"
_COMPLETE = [
    ("system_name_and_number", "System name:"), ("system_location", "SYSTEM LOCATION:"), ("categories_of_individuals", "Categories of individuals covered by the system:"),
    ("categories_of_records", "Categories of records in the system:"), ("authority_for_maintenance", "Authority for maintenance of the system:"), ("purpose", "PURPOSE(S):"),
    ("routine_uses", _USES_HEADING), ("record_access_procedures", "RECORD ACCESS PROCEDURES:"), ("history", "HISTORY:"),
]
_PARTIAL = [("system_name_and_number", "System name:"), ("purpose", "PURPOSE(S):"), ("routine_uses", _USES_HEADING), ("history", "HISTORY:")]
_SAID = {"system_location": " At the seat.", "categories_of_individuals": " People.", "categories_of_records": " Names and dates.", "authority_for_maintenance": " 5 U.S.C. 301.", "record_access_procedures": " Ask."}


def _around(headings: list[tuple[str, str]]) -> tuple[list[str], list[str]]:
    lines = [heading + _SAID.get(key, "") for key, heading in headings]
    at = next(i for i, (key, _) in enumerate(headings) if key == "routine_uses")
    return [*_FIRST, *lines[: at + 1]], [*lines[at + 1 :], "89 FR 12345"]


_LINES = {0: _around(_COMPLETE), 1: _around(_PARTIAL), 2: (_FIRST, []), 3: _around(_PARTIAL)}


def _notice_files(spark, sf_dir) -> DataFrame:
    """Documents under the headings of a notice: each line but the first with a letter, as routine uses have them."""
    letters = F.array(*map(F.lit, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    body = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.when(i == 0, "").otherwise(F.concat(F.element_at(letters, F.least(i, F.lit(26)).cast("int")), F.lit(". "))), x))
    key = F.right(F.lpad(F.col("doc_id").cast("string"), 3, "0"), F.lit(3))
    kind = F.col("doc_id") % 4

    def lines(which: int) -> F.Column:
        none = F.array().cast("array<string>")
        return F.coalesce(*(F.when(kind == k, F.array(*map(F.lit, v[which])) if v[which] else none) for k, v in _LINES.items()))

    whole = F.concat(F.array(F.concat(F.lit("DHS/ABC-"), key, F.lit(" "), F.col("source"))), lines(0), body, lines(1))
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("ID-"), F.col("doc_id").cast("string"), F.lit(".docx")).alias("file"), whole.alias("lines"))


def _records(spark, sf_dir) -> DataFrame:
    from ..operators.notices import parse_notices

    return parse_notices(spread(_notice_files(spark, sf_dir)))


def _list_sql(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]::VARCHAR[]"


_STRIP = r"'^\s+|\s+$', '', 'g'"
_KINDS = " ".join(f"WHEN {k} THEN {_list_sql(before)} || body || {_list_sql(after)}" for k, (before, after) in _LINES.items())
#: CTE texts(doc_id, kind, source_file, t): the lines joined again and cleaned.
_TEXTS_SQL = rf"""bodies AS (SELECT *, doc_id % 4 AS kind, list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i = 1 THEN x ELSE substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', least(i - 1, 26), 1) || '. ' || x END) AS body FROM documents),
all_lines AS (SELECT *, ['DHS/ABC-' || right(CASE WHEN doc_id < 1000 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE substring(CAST(doc_id AS VARCHAR), 1, 3) END, 3) || ' ' || source] || CASE kind {_KINDS} END AS ls FROM bodies),
stripped AS (SELECT *, list_transform(ls, lambda x: regexp_replace(x, {_STRIP})) AS ss FROM all_lines),
filled AS (SELECT *, list_filter(ss, lambda x: x <> '') AS fs FROM stripped),
joined AS (SELECT *, CASE WHEN len(fs) >= 20 AND list_sort(list_transform(fs, lambda x: length(x)))[len(fs) // 2 + 1] BETWEEN 50 AND 85 AND len(list_filter(fs, lambda x: regexp_matches(x, '[.:;!?]$'))) < 0.45 * len(fs)
  THEN array_to_string(fs, ' ') ELSE regexp_replace(array_to_string(ss, chr(10)), {_STRIP}) END AS j FROM filled),
marks AS (SELECT *, regexp_replace(regexp_replace(j, '\[\[Page\s+[0-9A-Za-z\-]+\]\]|\(printed page\s+[0-9]+\)', ' ', 'g'), '-{{5,}}', '', 'g') AS m FROM joined),
quotes AS (SELECT *, nfc_normalize(replace(replace(replace(m, chr(65533), '"'), '``', '"'), chr(39) || chr(39), '"')) AS q FROM marks),
blanks AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(q, '[ 	]+', ' ', 'g'), '
{{3,}}', chr(10) || chr(10), 'g'), '[ 	]*
[ 	]*', chr(10), 'g') AS b FROM quotes),
texts AS (SELECT doc_id, kind, 'ID-' || doc_id || '.docx' AS source_file, regexp_replace(b, {_STRIP}) AS t FROM blanks)"""
_HEADS = ", ".join(f"({k}, {i}, '{key}', '{heading}')" for k, headings in ((0, _COMPLETE), (1, _PARTIAL), (3, _PARTIAL)) for i, (key, heading) in enumerate(headings))
#: CTE sections(doc_id, source_file, section_key, heading, ordinal, text) behind ``texts``: each heading's text ends at the next.
_PARSED_SQL = rf"""{_TEXTS_SQL},
heads(kind, ordinal, section_key, heading) AS (VALUES {_HEADS}),
found AS (SELECT doc_id, source_file, t, ordinal, section_key, heading, strpos(t, heading) AS place FROM texts JOIN heads USING (kind)),
sections AS (SELECT doc_id, source_file, section_key, heading, CAST(ordinal AS BIGINT) AS ordinal,
  regexp_replace(substring(t, place + length(heading), coalesce(lead(place) OVER (PARTITION BY doc_id ORDER BY ordinal), length(t) + 1) - place - length(heading)), {_STRIP}) AS text FROM found)"""
_ITEM = r"""'(?s)^(.*?)(^|[\s"(])' || substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', k % 26 + 1, 1) || CASE WHEN k >= 26 THEN substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', k % 26 + 1, 1) ELSE '' END || '\.\s+([A-Z"(].*)$'"""
#: Walk over the labels of each list: what stands before a label, and the rest behind it.
_ITEMS_SQL = rf"""WITH RECURSIVE {_PARSED_SQL},
walk AS (SELECT doc_id, source_file, 0 AS k, CAST(NULL AS VARCHAR) AS before, text AS rest FROM sections WHERE section_key = 'routine_uses'
  UNION ALL SELECT doc_id, source_file, k + 1, regexp_extract(rest, {_ITEM}, 1) || regexp_extract(rest, {_ITEM}, 2), regexp_extract(rest, {_ITEM}, 3) FROM walk WHERE k < 52 AND regexp_matches(rest, {_ITEM})),
steps AS (SELECT *, lead(before) OVER (PARTITION BY doc_id ORDER BY k) AS following FROM walk),
items AS (SELECT doc_id, source_file, 'PREAMBLE' AS label, regexp_replace(before, {_STRIP}) AS text FROM steps WHERE k = 1 AND regexp_replace(before, {_STRIP}) <> ''
  UNION ALL SELECT doc_id, source_file, substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', (k - 1) % 26 + 1, 1) || CASE WHEN k > 26 THEN substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', (k - 1) % 26 + 1, 1) ELSE '' END, regexp_replace(coalesce(following, rest), {_STRIP}) FROM steps WHERE k > 0)"""


@query(f"WITH {_TEXTS_SQL} SELECT source_file, t AS raw_text, sha256(t) AS content_sha256, CAST(length(t) AS BIGINT) AS char_count FROM texts")
def q_normalize_text(spark, sf_dir):
    """Clean texts and their digests."""
    return _records(spark, sf_dir).select("source_file", "raw_text", "content_sha256", "char_count")


@query(f"WITH {_PARSED_SQL} SELECT source_file, section_key, heading, ordinal, text, CAST(length(text) AS BIGINT) AS char_count FROM sections")
def q_find_headings(spark, sf_dir):
    """Headings and bodies of every notice."""
    return _records(spark, sf_dir).select("source_file", F.inline("sections"))


@query(rf"""{_ITEMS_SQL} SELECT source_file, label, text, CAST(length(text) AS BIGINT) AS char_count,
  CAST(CASE WHEN label = 'PREAMBLE' THEN 0 ELSE len(regexp_extract_all(regexp_replace(text, '(\s)', '', 'g'), '(^|[\s;:.])\d{{1,2}}\.\s')) END AS INTEGER) AS subitem_count FROM items""")
def q_split_lettered_items(spark, sf_dir):
    """Lettered items of every notice."""
    return _records(spark, sf_dir).select("source_file", F.explode("routine_uses").alias("u")).select("source_file", "u.label", "u.text", "u.char_count", F.size("u.subitems").alias("subitem_count"))


@query("""SELECT 'ID-' || doc_id || '.docx' AS source_file, 'DHS/ABC-' || right(CASE WHEN doc_id < 1000 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE substring(CAST(doc_id AS VARCHAR), 1, 3) END, 3) AS system_number, 'DHS' AS agency, 'ABC' AS component,
  CAST(doc_id AS VARCHAR) AS fr_doc_number, 'modified' AS action_type, '2024-01-05' AS effective_date, doc_id % 4 <> 2 AS has_citation FROM documents""")
def q_extract_metadata(spark, sf_dir):
    """Typed metadata of every notice."""
    return _records(spark, sf_dir).select("source_file", "system_number", "agency", "component", "fr_doc_number", "action_type", "effective_date", F.array_contains("fr_citations", "89 FR 12345").alias("has_citation"))


@query(f"""WITH {_TEXTS_SQL} SELECT parse_status, count(*) AS n, CAST(min(missing) AS INTEGER) AS least_missing FROM (
  SELECT CASE kind WHEN 0 THEN 'ok' WHEN 2 THEN CASE WHEN length(t) < 500 THEN 'empty' ELSE 'not_a_sorn' END ELSE 'partial' END AS parse_status, CASE kind WHEN 0 THEN 0 WHEN 2 THEN 8 ELSE 5 END AS missing FROM texts) GROUP BY parse_status""")
def q_parse_status(spark, sf_dir):
    """Verdicts on the notices."""
    return _records(spark, sf_dir).groupBy("parse_status").agg(F.count("*").alias("n"), F.min(F.size("missing_sections")).alias("least_missing"))


@query("""SELECT n_name || CASE WHEN r = 0 THEN '' ELSE '(1)' END AS source_id, CASE WHEN r = 0 THEN n_name || ' ' || n_name || chr(10) || chr(10) || 'a. Keep [' || r_name || '].' || chr(10) || '  1. Twice.' || chr(10) || chr(10) || 'Discussion:' || chr(10) || 'See [x].' ELSE n_name || '(1) More' || chr(10) || chr(10) END AS raw_text,
  r = 1 AS is_enhancement, upper(r_name) AS family_id, CASE WHEN r = 0 THEN 'low,high' ELSE '' END AS baselines FROM nation JOIN region ON n_regionkey = r_regionkey, range(2) t(r) WHERE NOT (r = 1 AND n_name < 'J')""")
def q_flatten_catalog(spark, sf_dir):
    """A nested catalogue (regions as families, nations as controls) as flat payloads; some enhancements are withdrawn."""
    from ..operators.controls import flatten_catalog

    nations = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))

    def pair(**fields) -> F.Column:
        return F.struct(*((v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in fields.items()))

    label = F.array(pair(name="label", value=F.col("n_name")))
    inner = F.array(pair(name="item", props=F.array(pair(name="label", value="1.")), prose="Twice."))
    parts = F.array(
        pair(name="statement", props=F.array(pair(name="label", value="a.")), prose="Keep {{ insert: param, p1 }}.", parts=inner),
        pair(name="guidance", props=F.lit(None).cast("array<struct<name: string, value: string>>"), prose="See {{ insert: param, x }}.", parts=F.lit(None).cast("array<struct<name: string, props: array<struct<name: string, value: string>>, prose: string>>")),
        pair(name="assessment", props=F.lit(None).cast("array<struct<name: string, value: string>>"), prose="Dropped.", parts=inner),
    )
    status = F.when(F.col("n_name") < "J", "withdrawn").otherwise("live")
    more = pair(id=F.concat(F.col("n_name"), F.lit(".1")), title="More", props=F.array(pair(name="label", value=F.concat(F.col("n_name"), F.lit("(1)"))), pair(name="status", value=status)))
    control = pair(id=F.col("n_name"), title=F.col("n_name"), props=label, params=F.array(pair(id="p1", label=F.col("r_name"))), parts=parts, controls=F.array(more))
    groups = nations.groupBy("r_name").agg(F.to_json(F.struct(F.first("r_name").alias("id"), F.first("r_name").alias("title"), F.collect_list(control).alias("controls"))).alias("group"))
    lists = nations.select(F.col("n_name").alias("control_id"), F.explode(F.array(*(F.struct(F.lit(b).alias("baseline"), F.lit(i).alias("place")) for i, b in enumerate(("low", "high"))))).alias("b"))
    flat = flatten_catalog(groups, lists.select("control_id", "b.*"), None)
    m = F.from_json("metadata", staging.CONTROL_METADATA)
    return flat.select("source_id", "raw_text", m["is_enhancement"].alias("is_enhancement"), m["family_id"].alias("family_id"), F.array_join(m["baselines"], ",").alias("baselines"))


@query("SELECT 'AC-' || n_nationkey AS source_id, CASE n_regionkey WHEN 0 THEN 'AC' WHEN 1 THEN 'AU' ELSE 'PM' END AS family_id, n_name AS title FROM nation WHERE n_regionkey IN (0, 1, 2)")
def q_default_families(spark, sf_dir):
    """Controls of the families that are taken by default; two of five are none of them."""
    from ..operators.controls import baselines_of, flatten_catalog

    family = F.element_at(F.array(*map(F.lit, ("ac", "au", "pm", "zz", "at"))), F.col("n_regionkey") + 1)
    control = F.struct(F.concat(F.lit("ac-"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("title"))
    groups = table(spark, sf_dir, "nation").groupBy(family.alias("id")).agg(F.collect_list(control).alias("controls")).select(F.to_json(F.struct("id", F.col("id").alias("title"), "controls")).alias("group"))
    m = F.from_json("metadata", staging.CONTROL_METADATA)
    return flatten_catalog(groups, baselines_of(groups, {})).select("source_id", m["family_id"].alias("family_id"), m["title"].alias("title"))


QUERIES = {name.removeprefix("q_"): f for name, f in QUERIES.items()}
ORACLES = {name.removeprefix("q_"): sql for name, sql in ORACLES.items()}
