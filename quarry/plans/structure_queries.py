"""Structure operators over conversations, documents and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import structure as S
from quarry.plans import bindings as B
from quarry.plans.registry import query
from quarry.session import table

FOLD = "WITH " + B.TURNS_SQL.strip() + """,
marked AS (SELECT *, CASE WHEN lag(type) OVER w IS NULL OR type IN ('heading', 'table') OR lag(type) OVER w = 'table' THEN 1 ELSE 0 END AS starts FROM turns WINDOW w AS (PARTITION BY doc ORDER BY ord)),
folded AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY doc ORDER BY ord) - 1 AS INTEGER) AS section FROM marked),
secs AS (SELECT doc, section, arg_min(type, ord) AS kind, CAST(count(*) AS INTEGER) AS n_units, min(ord) AS first_ord, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS text, count(*) FILTER (WHERE type <> 'heading') AS n_body FROM folded GROUP BY doc, section)"""


@query("section_fold", FOLD + " SELECT doc, section, kind, n_units, first_ord, text FROM secs")
def section_fold(spark, sf_dir):
    return S.sections(B.turns(spark, sf_dir)).drop("units")


@query("section_split", FOLD + """, body AS (SELECT f.doc, f.section, CAST(row_number() OVER (PARTITION BY f.doc, f.section ORDER BY f.ord) AS INTEGER) AS child, f.text FROM folded f JOIN secs s ON s.doc = f.doc AND s.section = f.section WHERE f.type <> 'heading' AND length(s.text) > 1500 AND s.n_body >= 2)
SELECT doc, section, CAST(0 AS INTEGER) AS child, text FROM secs UNION ALL SELECT doc, section, child, text FROM body""")
def section_split(spark, sf_dir):
    return S.split_long(S.sections(B.turns(spark, sf_dir)))


@query("link_prev_next", "WITH " + B.TURNS_SQL.strip() + """, n AS (SELECT doc, ord, row_number() OVER (PARTITION BY doc ORDER BY ord) AS k FROM turns), i AS (SELECT doc, ord, doc || ':' || lpad(CAST(k AS VARCHAR), CAST(greatest(3, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS node_id FROM n)
SELECT doc, ord, node_id, lag(node_id) OVER (PARTITION BY doc ORDER BY ord) AS previous, lead(node_id) OVER (PARTITION BY doc ORDER BY ord) AS next FROM i""")
def link_prev_next(spark, sf_dir):
    return S.linked_nodes(B.turns(spark, sf_dir).select("doc", "ord"), "ord")


@query("section_path", "WITH " + B.TURNS_SQL.strip() + """, h AS (SELECT doc, ord, type = 'heading' AS head, length(text) % 4 + 1 AS depth FROM turns),
up AS (SELECT i.doc, i.ord, j.ord AS above FROM h i JOIN h j ON j.doc = i.doc AND j.head AND (j.ord < i.ord) WHERE j.depth < coalesce((SELECT min(k.depth) FROM h k WHERE k.doc = i.doc AND k.head AND k.ord > j.ord AND k.ord <= i.ord), 1000000))
SELECT h.doc, h.ord, coalesce(string_agg('t' || above, '/' ORDER BY above), '') AS path FROM h LEFT JOIN up ON up.doc = h.doc AND up.ord = h.ord GROUP BY h.doc, h.ord""")
def section_path(spark, sf_dir):
    t = B.turns(spark, sf_dir)
    units = t.select("doc", "ord", (F.col("type") == "heading").alias("is_heading"), (F.length("text") % 4 + 1).alias("depth"), F.concat(F.lit("t"), F.col("ord").cast("string")).alias("label"))
    return S.section_paths(units)


@query("markdown_chunks", r"""WITH md AS (SELECT conv_id, string_agg(CASE WHEN role = 'user' THEN '# ' || coalesce(text, '') ELSE coalesce(text, '') END, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
lines AS (SELECT conv_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM (SELECT conv_id, regexp_split_to_array(text, '\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\x{2028}\x{2029}]') AS l FROM md)),
marked AS (SELECT *, CAST(sum(CASE WHEN starts_with(ltrim(line), '#') THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) AS INTEGER) AS s FROM lines),
secs AS (SELECT conv_id, s, arg_min(line, i) AS first, string_agg(line, chr(10) ORDER BY i) AS whole, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT starts_with(ltrim(line), '#')), '') AS rest FROM marked GROUP BY conv_id, s HAVING trim(string_agg(line, '' ORDER BY i)) <> ''),
titled AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY s) AS n, CASE WHEN starts_with(ltrim(first), '#') THEN trim(regexp_replace(first, '^#+', '')) ELSE '' END AS title, rest FROM secs)
SELECT conv_id, conv_id || ':c' || lpad(CAST(n AS VARCHAR), CAST(greatest(2, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS chunk_id, title, regexp_replace(title || chr(10) || chr(10) || rest, '^\s+|\s+$', '', 'g') AS text FROM titled""")
def markdown_chunks(spark, sf_dir):
    """Conversations written as markdown, the user's turns as headings, cut at the headings."""
    c = table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    line = F.when(F.col("role") == "user", F.concat(F.lit("# "), text)).otherwise(text)
    md = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("u")).select("conv_id", F.array_join(F.transform("u", lambda x: x["l"]), "\n").alias("text"))
    return S.markdown_chunks(md, "conv_id", "text")


@query("heading_depth", r"SELECT o_orderkey, CASE WHEN n <> '' THEN CAST(len(string_split(n, '.')) AS INTEGER) ELSE CAST(coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 4 END, 1) AS INTEGER) END AS depth FROM (SELECT *, regexp_extract(CASE o_orderkey % 2 WHEN 0 THEN o_custkey || '.' || o_orderkey || ' ' ELSE '' END || 'Heading', '^\s*(\d+(?:\.\d+)*)\.?\s', 1) AS n FROM orders)")
def heading_depth(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    number = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("."), F.col("o_orderkey").cast("string"), F.lit(" "))).otherwise("")
    level = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") % 4).cast("int")
    return o.select("o_orderkey", X.heading_depth(F.concat(number, F.lit("Heading")), level).cast("int").alias("depth"))


@query("sentence_split", r"SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, s AS sentence FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS s FROM (SELECT doc_id, list_filter(string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS l FROM documents))")
def sentence_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("pos", "sentence"))


@query("batching", "SELECT l_orderkey, l_linenumber, l_partkey, CAST((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 3 AS BIGINT) AS batch FROM lineitem")
def batching(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return S.batches(line, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], 3).drop("l_suppkey")


@query("strip_think", r"SELECT conv_id, turn, trim(text) AS answer FROM conversations WHERE role = 'assistant'")
def strip_think(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    reply = F.concat(F.lit("<think>first\nthis</think>"), "text", F.lit("<think>cut off "), "role")
    return c.select("conv_id", "turn", X.strip_think(reply).alias("answer"))


@query("lenient_json", "SELECT event_id, props AS reply_json, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events")
def lenient_json(spark, sf_dir):
    """JSON out of replies that wrap it in prose and fences."""
    e = table(spark, sf_dir, "events")
    wrapped = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\nDone."))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("It is "), "props", F.lit(" as asked."))).otherwise(F.concat(F.lit("<output>"), "props", F.lit("</output>")))
    found = e.select("event_id", X.json_block(wrapped).alias("reply_json"))
    first = F.element_at(F.json_object_keys("reply_json"), 1)
    return found.select("event_id", "reply_json", F.from_json("reply_json", "map<string,string>")[first].alias("first_value"))


@query("render_prompt", r"SELECT conv_id, 'System: be exact.' || chr(10) || string_agg(upper(substr(role, 1, 1)) || substr(role, 2) || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS prompt FROM conversations GROUP BY conv_id")
def render_prompt(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    line = F.concat(F.upper(F.substring("role", 1, 1)), F.expr("substring(role, 2)"), F.lit(": "), F.coalesce("text", F.lit("")))
    lines = F.array_sort(F.collect_list(F.struct("turn", line.alias("l"))))
    return c.groupBy("conv_id").agg(lines.alias("u")).select("conv_id", F.concat(F.lit("System: be exact.\n"), F.array_join(F.transform("u", lambda x: x["l"]), "\n")).alias("prompt"))
