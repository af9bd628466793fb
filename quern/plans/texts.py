"""Queries of the text families: cleaning, chunking, classifying, extracting, mapping to observations, streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators.bulletins import BULLETINS
from ..operators import chunks, classify, extract, mappers, quality, resolve
from ..sources import readers, views
from ..sources.views import LINES, OBS
from ..streaming import intake
from .registry import query

_WS = "'[ \\t\\n\\x0B\\f\\r]+'"

# --- cleaning and token counts


@query(f"SELECT doc_id, length(trim(regexp_replace(text, {_WS}, ' ', 'g'))) AS n, md5(trim(regexp_replace(text, {_WS}, ' ', 'g'))) AS digest FROM documents")
def t6_collapse(spark, d):
    c = text.collapse(F.col("text"))
    return views.table(spark, d, "documents").select("doc_id", F.length(c).cast("long").alias("n"), F.md5(c).alias("digest"))


@query(f"SELECT doc_id, md5(trim(regexp_replace(concat_ws(' ', nullif(trim(source), ''), nullif(trim(text), '')), {_WS}, ' ', 'g'))) AS evidence FROM documents")
def t7_evidence(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.md5(text.evidence(F.col("source"), F.col("text"))).alias("evidence"))


@query("SELECT doc_id, md5(lower(regexp_replace(text, '[^a-zA-Z0-9]', '', 'g'))) AS digest FROM documents")
def t8_alnum_key(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.md5(text.alnum_key(F.col("text"))).alias("digest"))


@query("SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') <> '' AS has_text, len(regexp_extract_all(html, '&[a-z]+;')) AS entities FROM pages")
def t12_markup(spark, d):
    p = views.table(spark, d, "pages")
    return p.select("page_id", (F.regexp_replace("html", "<[^>]*>", "") != "").alias("has_text"), F.regexp_count("html", F.lit("&[a-z]+;")).cast("long").alias("entities"))


@query("SELECT doc_id, md5(concat('--- SOURCE INFO ---', chr(10), 'URL: ', source, chr(10), 'Folder: ', lang, chr(10), 'File: ', doc_id::VARCHAR, chr(10), chr(10), text)) AS digest FROM documents")
def t13_source_header(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.md5(text.source_header(F.col("source"), F.col("lang"), F.col("doc_id").cast("string"), F.col("text"))).alias("digest"))


@query()
def t3_claim_text(spark, d):
    """Cleaned lines that differ from what they were."""
    lines = views.lines(spark, d)
    return resolve.rewrite(lines, "line", text.claim_text(F.col("line"))).select("doc_id", "line_no", "before", "after")


@query("SELECT doc_id, len(regexp_extract_all(text, '[0-9][0-9,]*(?:\\.[0-9]+)?')) AS n_numbers, len(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?%')) AS n_percents FROM documents")
def m15_token_counts(spark, d):
    return views.table(spark, d, "documents").select("doc_id", numbers.number_tokens(F.col("text")).cast("long").alias("n_numbers"), numbers.percent_tokens(F.col("text")).cast("long").alias("n_percents"))


@query("SELECT doc_id, round(len(regexp_extract_all(text, '[A-Z]')) / nullif(len(regexp_extract_all(text, '[A-Za-z]')), 0), 6) AS upper_ratio FROM documents")
def m16_upper_ratio(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.round(numbers.upper_ratio(F.col("text")), 6).alias("upper_ratio"))


# --- lines, sentences, windows


@query("SELECT doc_id, line_no, md5(line) AS digest FROM lines", LINES)
def g3_lines(spark, d):
    return chunks.lines(views.table(spark, d, "documents")).select("doc_id", "line_no", F.md5("line").alias("digest"))


@query()
def g2_chunks(spark, d):
    return chunks.chunks(views.table(spark, d, "documents"), 2000).select("doc_id", "chunk_no", F.length("chunk").alias("n"), F.md5("chunk").alias("digest"))


@query("SELECT doc_id, line_no FROM lines WHERE regexp_matches(lower(line), '^[0-9]+$|^page [0-9]+( of [0-9]+)?$|^(figure|table) [0-9]+[.:]?') OR (length(line) <= 60 AND NOT regexp_matches(line, '[.!?:;,]$') AND regexp_matches(line, '^[A-Z][A-Z0-9 &/-]+$'))", LINES)
def g4_artifacts(spark, d):
    return chunks.lines(views.table(spark, d, "documents")).where(chunks.artifact(F.col("line"))).select("doc_id", "line_no")


@query()
def g5_wrapped_lines(spark, d):
    return chunks.wrapped_lines(chunks.lines(views.table(spark, d, "documents")), ["doc_id"], "line_no").select("doc_id", "line_no", F.md5("line").alias("digest"))


@query("SELECT doc_id, count(*) FILTER (WHERE k = 1 OR regexp_matches(part, '^[A-Z0-9<(]')) AS n FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS k FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents WHERE trim(text) <> '')) GROUP BY 1")
def g6_sentences(spark, d):
    """Sentences of every document; the SQL cuts at every stop and counts the cuts that a capital, a number or a bracket follows."""
    return chunks.sentences(views.table(spark, d, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query()
def g6_all_sentences(spark, d):
    """Sentences of every document that has any, held to brute force."""
    return chunks.sentences(views.table(spark, d, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, line_no, len(list_filter(list_transform(string_split(line, '|'), lambda x: trim(x)), lambda x: x <> '')) AS n FROM lines WHERE contains(line, '|')", LINES)
def g7_cells(spark, d):
    return chunks.lines(views.table(spark, d, "documents")).where(F.contains("line", F.lit("|"))).select("doc_id", "line_no", F.size(chunks.cells(F.col("line"))).cast("long").alias("n"))


@query("SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z/&+-]{12,}')) AS token FROM documents) WHERE contains(token, 'the')::INTEGER + contains(token, 'ing')::INTEGER + contains(token, 'tion')::INTEGER >= 2 GROUP BY 1")
def g8_suspicious_tokens(spark, d):
    return chunks.suspicious_tokens(views.table(spark, d, "documents"), ["the", "ing", "tion"])


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS context FROM conversations")
def g9_carried_context(spark, d):
    c = views.table(spark, d, "conversations").withColumn("digest", F.md5("text"))
    return chunks.carried_context(c, ["conv_id"], "turn", F.col("role") == "user", "digest").select("conv_id", "turn", "context")


@query("SELECT doc_id, line_no, md5(string_agg(line, ' ') OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) AS digest FROM lines", LINES)
def g14_line_shingles(spark, d):
    return chunks.ahead(chunks.lines(views.table(spark, d, "documents")), ["doc_id"], "line_no", "line", 4).select("doc_id", "line_no", F.md5("window").alias("digest"))


@query("SELECT doc_id, line_no, sum(n) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)::BIGINT AS n FROM (SELECT doc_id, line_no, len(regexp_extract_all(line, '[0-9][0-9,]*(?:\\.[0-9]+)?')) AS n FROM lines)", LINES)
def g13_numbers_ahead(spark, d):
    rows = chunks.numbers_ahead(chunks.lines(views.table(spark, d, "documents")), ["doc_id"], "line_no", "line", 8)
    return rows.select("doc_id", "line_no", F.size("numbers").cast("long").alias("n"))


@query("SELECT doc_id, island, count(*) AS n FROM (SELECT doc_id, sum(CASE WHEN regexp_matches(line, '^[A-E]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no)::BIGINT AS island FROM lines) GROUP BY ALL", LINES)
def g11_islands(spark, d):
    rows = chunks.islands(chunks.lines(views.table(spark, d, "documents")), ["doc_id"], "line_no", F.col("line").rlike("^[A-E]"))
    return rows.groupBy("doc_id", "island").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT doc_id, arg_min(line, line_no) AS label, count(*) FILTER (WHERE NOT regexp_matches(line, '^[A-C]'))::INTEGER AS n FROM (SELECT *, sum(regexp_matches(line, '^[A-C]')::INTEGER) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM lines) WHERE island > 0 GROUP BY doc_id, island HAVING n >= 1", LINES,
)
def g10_labelled_blocks(spark, d):
    rows = chunks.lines(views.table(spark, d, "documents"))
    return chunks.labelled_blocks(rows, ["doc_id"], "line_no", F.col("line").rlike("^[A-C]"), ~F.col("line").rlike("^[A-C]"), least=1).select("doc_id", "label", F.size("values").alias("n"))


# --- classifiers


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(text), '\\bart\\b|\\btreatment\\b') THEN 'treatment' WHEN regexp_matches(lower(text), '\\bpolicy\\b|\\bmemo\\b') THEN 'policy' ELSE 'general' END AS metric FROM documents")
def c2_metric_type(spark, d):
    rules = {"treatment": r"\bart\b|\btreatment\b", "policy": r"\bpolicy\b|\bmemo\b"}
    return views.table(spark, d, "documents").select("doc_id", classify.first_rule(F.col("text"), rules, "general").alias("metric"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'NCR' WHEN n_nationkey % 4 = 1 THEN 'CARAGA' WHEN n_nationkey % 4 = 2 THEN '4A' ELSE '7' END AS code FROM nation")
def c5_region_code(spark, d):
    said = F.element_at(F.array(*map(F.lit, ("National Capital Region", "Region XIII", "Region IV-A", "Region VII"))), (F.col("n_nationkey") % 4 + 1).cast("int"))
    return views.table(spark, d, "nation").select("n_nationkey", classify.region_code(said).alias("code"))


@query("SELECT doc_id, len(regexp_extract_all(text, '\\|')) >= 3 OR len(regexp_extract_all(text, '\\b[0-9]{4}\\b')) >= 4 OR regexp_matches(text, '(?:[0-9]+[ ,]+){6,}') AS scrambled FROM documents")
def c12_scrambled(spark, d):
    return views.table(spark, d, "documents").select("doc_id", classify.scrambled(F.col("text")).alias("scrambled"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)\\b(?:hospital|street|avenue|building|road|rd\\.|drive|room)\\b|\\b(?:telephone|mobile|fax|email|website|facebook)\\b|\\b[0-9]{7,}\\b|\\b[0-9]{3}\\s*/\\s*[0-9]{8,}\\b') THEN 'artifact' ELSE 'text' END AS kind FROM documents")
def c9_artifact(spark, d):
    return views.table(spark, d, "documents").select("doc_id", F.when(classify.artifact_words(F.col("text")), "artifact").otherwise("text").alias("kind"))


@query()
def c10_review_queue(spark, d):
    docs = views.table(spark, d, "documents")
    claims = extract.claims(docs).join(docs.select("doc_id", "source"), "doc_id").select(
        "doc_id", "line_no", "category", "claim_text", F.when(F.col("source") < "src5", "surveillance_report").otherwise("other").alias("document_type"), classify.metric_type(F.col("category"), F.col("claim_text")).alias("metric_type"),
        F.lit("HIV").alias("primary_disease"), F.lit("Unknown").alias("region"), F.lit(None).cast("int").alias("year"), F.lit(False).alias("observed"),
    )
    return classify.review(claims).select("doc_id", "line_no", "category", "review_reason", "priority", "notes")


# --- claims and observations


@query()
def x_claims(spark, d):
    """All extraction strategies over whole documents."""
    return extract.claims(views.table(spark, d, "documents")).select("doc_id", "line_no", "category", F.md5("claim_text").alias("digest"))


@query()
def x5_located_snippets(spark, d):
    docs = views.table(spark, d, "documents")
    found = extract.narrative_sentences(docs, markers=("the", "de", "der")).select("doc_id", "line_no", "snippet").join(docs.select("doc_id", "text"), "doc_id")
    return extract.located(found).select("doc_id", "line_no", "start", "stop", F.length("window").alias("n"))


@query("SELECT c.conv_id, c.turn, contains(d.text, c.text) AS exact FROM conversations c JOIN documents d ON c.conv_id = d.doc_id")
def q1_verbatim(spark, d):
    pairs = views.table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("snippet")).join(views.table(spark, d, "documents").select(F.col("doc_id").alias("conv_id"), "text"), "conv_id")
    return quality.verbatim(pairs, "text", "snippet").select("conv_id", "turn", "exact")


CELLS = "cells AS (SELECT region, count(*) AS a, count(*) FILTER (WHERE metric = '5-LOW') AS b, count(*) FILTER (WHERE unit = 'F') AS c, count(*) FILTER (WHERE unit = 'O') AS dd, count(*) FILTER (WHERE unit = 'P') AS e, count(*) + 7 AS t, count(*) FILTER (WHERE year = 1998) AS p FROM obs GROUP BY 1)"


def _cells(spark, d):
    """Seven-cell table rows made of region totals, to be parsed back."""
    o = views.observations(spark, d)
    g = o.groupBy("region").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("metric") == "5-LOW").alias("b"), *[F.count_if(F.col("unit") == u).alias(n) for u, n in zip("FOP", ("c", "dd", "e"), strict=True)], F.count_if(F.col("year") == 1998).alias("p"))
    cell = lambda c: F.format_number(F.col(c), 0)
    g = g.withColumn("t", F.col("a") + 7)
    value = F.concat_ws(" | ", cell("a"), cell("b"), cell("c"), cell("dd"), cell("e"), cell("t"), F.concat(F.col("p").cast("string"), F.lit("%")))
    return g.select(F.col("region").alias("claim_id"), value.alias("value"), F.concat(F.lit("Treatment Outcome: "), "region", F.lit(" has values "), F.replace(value, F.lit(" | "), F.lit(", ")), F.lit(".")).alias("claim_text"))


@query(
    "SELECT claim_id, metric, value::DOUBLE AS value FROM (UNPIVOT (SELECT region AS claim_id, a AS alive_on_art, b AS lost_to_follow_up, c AS died, dd AS transferred_out, e AS stopped, t AS total, p AS lost_to_follow_up_pct, 7::BIGINT AS not_on_treatment FROM cells) ON COLUMNS(* EXCLUDE claim_id) INTO NAME metric VALUE value)", OBS, CELLS,
)
def o5_treatment_outcomes(spark, d):
    return mappers.treatment_outcomes(_cells(spark, d)).select("claim_id", "metric", "value")


@query("SELECT region AS claim_id, region AS label FROM cells", OBS, CELLS)
def o38_row_label(spark, d):
    return _cells(spark, d).select("claim_id", extract.row_label(F.col("claim_text")).alias("label"))


@query(
    "SELECT region AS claim_id, 'reported_cases' AS metric, 'total' AS subgroup, scope, value FROM (UNPIVOT (SELECT region, a AS month, b AS year_to_date, c AS cumulative FROM cells) ON month, year_to_date, cumulative INTO NAME scope VALUE value)", OBS, CELLS,
)
def o8_quick_facts(spark, d):
    rows = _cells(spark, d).withColumn("c", mappers.split_cells(F.col("value"))).select("claim_id", F.lit("Total reported cases").alias("label"), F.array_join(F.slice("c", 1, 3), " | ").alias("value"))
    return mappers.quick_facts(rows)


@query("SELECT n_nationkey::BIGINT AS claim_id, concat(n_nationkey % 12 + 1) AS region, n AS count, p AS share FROM (SELECT n_nationkey, count(*) AS n, (count(*) % 90)::DOUBLE AS p FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)")
def o19_regional_mentions(spark, d):
    romans = "I II III IV V VI VII VIII IX X XI XII".split()
    n = views.table(spark, d, "nation").join(views.table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("n"))
    said = F.concat(F.lit("Most were in Region "), F.element_at(F.array(*map(F.lit, romans)), (F.col("n_nationkey") % 12 + 1).cast("int")), F.lit(" with "), F.col("n").cast("string"), F.lit(" ("), (F.col("n") % 90).cast("string"), F.lit("%)."))
    return mappers.regional_mentions(n.select(F.col("n_nationkey").cast("long").alias("claim_id"), said.alias("claim_text")))


@query(
    "SELECT doc_id, metric, '' AS subgroup, '' AS scope, value FROM (SELECT doc_id, unnest(['viral_load_tested_count', 'viral_load_tested_pct']) AS metric, unnest([n_chars::DOUBLE, (doc_id % 90 + 5)::DOUBLE]) AS value FROM documents WHERE n_chars IS NOT NULL AND doc_id IS NOT NULL)",
)
def o_narrative_of_documents(spark, d):
    """Every narrative topic over every sentence of whole documents, each with a sentence of a bulletin after its prose."""
    docs = views.table(spark, d, "documents")
    more = F.concat(F.lit(".\nSo far "), F.format_number("n_chars", 0), F.lit(" ("), (F.pmod("doc_id", F.lit(90)) + 5).cast("string"), F.lit("%) PLHIV have been tested for viral load."))
    s = chunks.sentences(docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), more).alias("text")))
    claims = s.select(F.concat_ws(":", "doc_id", "sentence_no").alias("claim_id"), F.lit(0).alias("page_index"), F.col("sentence").alias("claim_text"), F.lit("").alias("snippet"))
    return mappers.narrative(claims, BULLETINS).select(F.split("claim_id", ":")[0].cast("long").alias("doc_id"), "metric", "subgroup", "scope", "value")


@query("SELECT src, dst, relation FROM (SELECT DISTINCT concat('document:', document_id) AS src, concat('metric:', metric) AS dst, 'reports' AS relation FROM obs UNION SELECT DISTINCT concat('document:', document_id), concat('disease:', subgroup), 'mentions' FROM obs)", OBS)
def o40_graph_edges(spark, d):
    return mappers.graph(views.observations(spark, d).select("document_id", F.col("subgroup").alias("disease"), "metric"))[1]


@query("SELECT kind, count(*) AS n FROM (SELECT DISTINCT 'document' AS kind, document_id::VARCHAR AS name FROM obs UNION SELECT DISTINCT 'disease', subgroup FROM obs UNION SELECT DISTINCT 'metric', metric FROM obs) GROUP BY 1", OBS)
def o40_graph_vertices(spark, d):
    return mappers.graph(views.observations(spark, d).select("document_id", F.col("subgroup").alias("disease"), "metric"))[0].groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type, regexp_extract(props, '[0-9]+') AS item FROM events")
def x10_coerced_payload(spark, d):
    e = views.table(spark, d, "events").select("event_id", F.concat(F.lit('Here it is: {"findings": [{"claim_text": "'), "event_type", F.lit('", "value": "'), F.regexp_extract("props", "[0-9]+", 0), F.lit('"}]} done')).alias("raw"))
    return extract.coerced(e, "raw").select("event_id", F.col("claim_text").alias("event_type"), F.col("value").alias("item"))


# --- streams: batch form has the oracle, the stream drains the same rows


def _scratch(spark) -> str:
    """A new folder in the one that driver and executors share; a temporary one only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/quern-stream-{uuid.uuid4().hex}"


def _events(spark, d):
    """Events as a stream of the files where they lie, and a folder for what the query keeps."""
    path = f"{d}/events.parquet"
    stream = intake.follow(spark, path, spark.read.parquet(path).schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp")), _scratch(spark)


@query("SELECT event_id, event_type FROM events WHERE value > 50")
def y1_intake(spark, d):
    stream, at = _events(spark, d)
    intake.drain(stream.where("value > 50").select("event_id", "event_type"), f"{at}/out", f"{at}/log")
    return spark.read.parquet(f"{at}/out")


@query("SELECT DISTINCT event_id FROM events")
def y2_dedupe(spark, d):
    stream, at = _events(spark, d)
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    intake.drain(intake.deduped(twice, "ts", ["event_id"], "60 days").select("event_id"), f"{at}/out", f"{at}/log")
    return spark.read.schema("event_id long").parquet(f"{at}/out")


@query("SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL")
def y4_throughput(spark, d):
    """Complete mode keeps every window of the drained backlog; append mode follows a live stream."""
    stream, at = _events(spark, d)
    windows = intake.throughput(stream, "ts", ["event_type"]).drop("total")
    intake.drain_to(windows, lambda batch, _: batch.write.mode("overwrite").parquet(f"{at}/out"), f"{at}/log", "complete")
    return spark.read.parquet(f"{at}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 900 SECOND AS session_end, count(*) AS events FROM (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 900 SECOND THEN 1 ELSE 0 END AS s FROM events)) GROUP BY user_id, k",
)
def y5_sessions(spark, d):
    stream, at = _events(spark, d)
    intake.drain_to(intake.sessions(stream, "ts", ["user_id"]), lambda batch, _: batch.write.mode("overwrite").parquet(f"{at}/out"), f"{at}/log", "complete")
    return spark.read.parquet(f"{at}/out").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def y6_upsert_sink(spark, d):
    """Each batch's newest rows replace those of their key; only the buckets of the target that hold such keys are written anew."""
    stream, at = _events(spark, d)
    rows = stream.select("user_id", "event_type", "event_id", "ts")
    intake.upsert_into(rows, f"{at}/table", f"{at}/log", ["user_id", "event_type"], ["ts", "event_id"])
    return intake.upserted(spark, f"{at}/table", rows.schema).select("user_id", "event_type", "event_id")


@query("SELECT event_id, ts < TIMESTAMP '2024-01-10' AS late FROM events")
def y7_late_rows(spark, d):
    stream, at = _events(spark, d)

    def split(batch, number):
        for part, name in zip(intake.split_late(batch, "ts", "2024-01-10 00:00:00"), ("on_time", "late"), strict=True):
            part.select("event_id", F.lit(name == "late").alias("late")).write.mode("overwrite").parquet(f"{at}/{name}/batch={number}")

    intake.drain_to(stream, split, f"{at}/log")
    return spark.read.parquet(f"{at}/on_time").drop("batch").unionByName(spark.read.parquet(f"{at}/late").drop("batch"))


@query("SELECT doc_id, local_name, n FROM (SELECT doc_id, concat(source, '_', doc_id) AS local_name, length(text) AS n FROM documents)")
def p3_safe_names(spark, d):
    docs = views.table(spark, d, "documents")
    name = F.regexp_replace(text.safe_file_name(F.col("doc_id").cast("string"), F.col("source")), r"\.pdf$", "")
    return docs.select("doc_id", name.alias("local_name"), F.length("text").cast("long").alias("n"))


@query("SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<p>([^<]*)</p>', 1)) AS p FROM pages) GROUP BY 1")
def g1_page_paragraphs(spark, d):
    pages = views.table(spark, d, "pages")
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), F.lit(1)))).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT page_id, trim(replace(replace(replace(replace(replace(replace(replace(regexp_replace(label, '<[^>]*>', '', 'g'), '&#8211;', '-'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), ' ') AS label "
    "FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a[ \\t\\n\\x0B\\f\\r][^>]*?href=\"([^\"]*)\"[^>]*>(.*?)</a>', 2)) AS label FROM pages)"
)
def s8_link_labels(spark, d):
    """The label of every link of every page, markup out and entities decoded."""
    return readers.links(views.table(spark, d, "pages")).select("page_id", "label")


@query()
def s8_all_link_labels(spark, d):
    """Every link label, entities decoded, held to brute force."""
    return readers.links(views.table(spark, d, "pages")).select("page_id", "label")


@query("SELECT doc_id, round(median(length(line)), 4) AS median_length, max(length(line)) AS longest FROM lines GROUP BY 1", LINES)
def a19_line_profile(spark, d):
    rows = chunks.lines(views.table(spark, d, "documents"))
    return rows.groupBy("doc_id").agg(F.round(F.median(F.length("line")), 4).alias("median_length"), F.max(F.length("line")).cast("long").alias("longest"))


@query("SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, line_no)::INTEGER AS place FROM lines QUALIFY place <= 3", LINES)
def r1_longest_lines(spark, d):
    rows = chunks.lines(views.table(spark, d, "documents"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc(F.length("line")), "line_no"))
    return rows.withColumn("place", place).where("place <= 3").select("doc_id", "line_no", "place")
