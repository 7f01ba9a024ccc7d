"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from quarry.llm import sharding
from quarry.llm.licences import SLACK, TEMPLATES, places_of


def _strings(words: tuple[bytes, ...]) -> str:
    return "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"


def _templates() -> str:
    """The licence templates as SQL rows: number, label, base, words, least share, key phrases."""
    return ", ".join(f"({k}, '{t.label}', {str(t.base).lower()}, {_strings(t.words)}, {t.least}, {len(t.phrases)})" for k, t in enumerate(TEMPLATES))


def _phrases() -> str:
    """Their key phrases as SQL rows: template, number, words, place in the template."""
    return ", ".join(f"({k}, {j}, {_strings(phrase)}, {at})" for k, t in enumerate(TEMPLATES) for j, (at, phrase) in enumerate(places_of(t)))


OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT k FROM p),
g AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS win FROM (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, lengths WHERE len(w) >= k)),
h AS (SELECT g.r, g.k, g.i, p.item FROM g JOIN p ON g.k = p.k AND g.win = p.win),
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, k, i FROM h)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hits.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256, coalesce(hits.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.r = hits.r LEFT JOIN items ON d.r = items.r
"""

#: The slots a source gets are counted (a small target is taken as it is); its words up to
#: there, over the repeats, are taken.
OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, sha256(coalesce('t' || text, '')) AS text_key FROM documents),
e AS (SELECT *, CAST('0x' || substr(sha256('20240301|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_key), 1, 15) AS BIGINT) AS h FROM d),
s1 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s2 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number, 3.0 * source_size AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s1),
s3 AS (SELECT *, CAST([5.0, 2.0, 1.0][number % 3 + 1] AS DOUBLE) AS weight FROM s2),
s4 AS (SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing FROM s3),
s5 AS (SELECT *, rest * weight > cap * sharing AS capped FROM s4),
s6 AS (SELECT *, CASE WHEN capped OR cap = 0 THEN CAST(cap AS DOUBLE) ELSE CAST((total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)) / sum(weight) FILTER (WHERE NOT capped) OVER () * weight AS DOUBLE) END AS target FROM s5),
s7 AS (SELECT *, CASE WHEN number = max(number) OVER () THEN 1.0 ELSE coalesce(sum(target) OVER (ORDER BY number) / nullif(sum(target) OVER (), 0), 0) END AS high FROM s6),
s8 AS (SELECT *, coalesce(lag(high) OVER (ORDER BY number), 0) AS low FROM s7),
b AS (SELECT CAST(sum(source_size) AS BIGINT) AS total, least(4096, greatest(1, CAST(sum(source_size) AS BIGINT) >> 20)) AS block FROM s1),
points AS (SELECT slot, x - floor(x) AS point FROM (SELECT slot, (slot % 65536) * CAST(0.6180339887498949 AS DOUBLE) + (slot // 65536) * CAST(0.47548671310877194 AS DOUBLE) AS x FROM (SELECT unnest(range((total + block - 1) // block)) AS slot FROM b))),
slots AS (SELECT number, row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS rank FROM points JOIN s8 ON point >= low AND point < high),
counts AS (SELECT s8.number, CASE WHEN (SELECT block FROM b) > 1 AND s8.target < 1024 * (SELECT block FROM b) THEN CAST(floor(s8.target + 0.5) AS BIGINT) ELSE coalesce(c.n, 0) * (SELECT block FROM b) END AS reach FROM s8 LEFT JOIN (SELECT number, count(*) AS n FROM slots GROUP BY number) c ON c.number = s8.number),
o AS (SELECT e.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, text_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM e)
SELECT o.doc_id, o.size, s.source_size, s.target, CAST(greatest(0, least(a + size, coalesce(reach, 0)) - a) + greatest(0, least(a + size, coalesce(reach, 0) - source_size) - a) + greatest(0, least(a + size, coalesce(reach, 0) - 2 * source_size) - a) AS BIGINT) AS taken
FROM o JOIN s8 s ON o.source IS NOT DISTINCT FROM s.source LEFT JOIN counts c ON c.number = s.number
"""

OP4 = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP5 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT r, s FROM (SELECT r, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
common AS (SELECT s, count(*) AS df FROM sh GROUP BY s),
ranked AS (SELECT sh.r, sh.s, n.n, row_number() OVER (PARTITION BY sh.r ORDER BY common.df, sh.s) AS k FROM sh JOIN common USING (s) JOIN n USING (r)),
prefix AS (SELECT r, s, n FROM ranked WHERE k <= n - CAST(ceil(n * 0.8) AS BIGINT) + 1),
cand AS (SELECT DISTINCT a.r AS a, b.r AS b FROM prefix a JOIN prefix b ON a.s = b.s AND a.r < b.r AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n),
overlap AS (SELECT c.a, c.b, count(*) AS shared FROM cand c JOIN sh x ON x.r = c.a JOIN sh y ON y.r = c.b AND y.s = x.s GROUP BY c.a, c.b),
links AS (SELECT a, b FROM overlap JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS r, b AS o FROM sym UNION SELECT reach.r, sym.b FROM reach JOIN sym ON sym.a = reach.o),
least AS (SELECT reach.r, min(d.doc_id) AS low FROM reach JOIN d ON d.r = reach.o GROUP BY reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(least.low, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(least.low, d.doc_id)) AS kept FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN least ON least.r = d.r
"""

OP6 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?INST\]|/?s>|</?SYS>>|ROLE=|/ROLE\])')) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 14 + length(role) END AS size FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
CAST(sum(size) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

OP7 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT html, max(page_id) AS largest FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
CASE WHEN g.html IS NULL OR p.page_id IS NOT DISTINCT FROM g.largest THEN 'response' ELSE 'revisit' END AS record_type,
CASE WHEN g.html IS NULL OR p.page_id IS NOT DISTINCT FROM g.largest THEN NULL ELSE g.largest END AS refers_to
FROM p LEFT JOIN g ON p.n >= 1000 AND p.html = g.html
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT * FROM (VALUES {_templates()}) AS x(k, label, base, body, least, phrases)),
p AS (SELECT * FROM (VALUES {_phrases()}) AS x(k, j, phrase, place)),
near AS (SELECT r, w, p.* FROM d JOIN p ON contains(' ' || array_to_string(w, ' ') || ' ', ' ' || array_to_string(phrase, ' ') || ' ')),
here AS (SELECT r, k, j, place, i - 1 - place AS start FROM (SELECT *, unnest(range(1, len(w) - len(phrase) + 2)) AS i FROM near) WHERE w[i : i + len(phrase) - 1] = phrase),
chains AS (SELECT a.r, a.k, a.place, a.start, b.j, min(abs(b.start - a.start)) AS away, arg_min(b.start, abs(b.start - a.start) * 2 + CASE WHEN b.start > a.start THEN 1 ELSE 0 END) AS nearest FROM here a JOIN here b ON a.r = b.r AND a.k = b.k WHERE a.j = 0 GROUP BY a.r, a.k, a.place, a.start, b.j),
whole AS (SELECT c.r, c.k, c.place + c.start AS start, list_distinct(list(c.nearest)) AS starts FROM chains c JOIN t ON t.k = c.k WHERE c.away <= {SLACK} GROUP BY c.r, c.k, c.place, c.start, t.phrases HAVING count(*) = t.phrases),
m AS (SELECT h.r, t.label, t.base, t.least, h.start, len(list_filter(range(1, len(t.body) + 1), lambda i: len(list_filter(h.starts, lambda s: s + i >= 1 AND coalesce(d.w[s + i] = t.body[i], false))) > 0)) / CAST(len(t.body) AS DOUBLE) AS share FROM whole h JOIN t ON t.k = h.k JOIN d ON d.r = h.r),
g AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM m WHERE share >= least GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM d LEFT JOIN g ON g.r = d.r
"""



def _crc_table() -> list[int]:
    """The CRC-32 of each byte, by the rule."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


def _permuted(source: str, columns: str, seed: int = 20_240_229) -> str:
    """SELECT columns and x, the rows of ``source`` with ``x`` permuted once; a and b are columns of theirs."""
    sql = f"SELECT *, x // b AS l, x % b AS r, CAST(0 AS BIGINT) AS v FROM ({source})"
    for i, (first, second, third) in enumerate(sharding.round_keys(seed)):
        of, to, size = ("l", "r", "b") if i % 2 else ("r", "l", "a")
        v = f"(({of} + {first}) % {sharding.PRIME})"
        sql = f"SELECT * REPLACE (({v} * {v} + {second}) % {sharding.PRIME} AS v) FROM ({sql})"
        sql = f"SELECT * REPLACE ((v * ((v + {third}) % {sharding.PRIME}) + {of}) % {sharding.PRIME} AS v) FROM ({sql})"
        sql = f"SELECT * REPLACE (({to} + v) % {size} AS {to}) FROM ({sql})"
    return f"SELECT {columns}, l * b + r AS x FROM ({sql})"


#: CRCs byte by byte, the order of SHA-256 draws, and the permutation applied until it lands inside.
OP10 = f"""
WITH RECURSIVE t AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])) AS c FROM documents),
d AS (SELECT doc_id, CAST(size AS BIGINT) AS size, xor(c, 4294967295) AS text_crc32 FROM t),
e AS (SELECT *, CAST(row_number() OVER (ORDER BY substr(sha256('20240229|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size || '|' || text_crc32), 1, 15), doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS row_number FROM d),
h AS (SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM (SELECT n, CAST(floor(sqrt(greatest(0, n - 1))) AS BIGINT) + 1 AS a FROM (SELECT CAST(greatest(1, count(*)) AS BIGINT) AS n FROM d))),
w AS ({_permuted("SELECT row_number, n, a, b, row_number AS x FROM e, h", "row_number, n, a, b")} UNION ALL {_permuted("SELECT * FROM w WHERE x >= n", "row_number, n, a, b")})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % 24 AS INTEGER) AS shard, x // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard, e.row_number FROM e JOIN w ON e.row_number = w.row_number WHERE x < n
"""

ORACLES: dict[str, str] = {
    "op2_decontamination": OP2,
    "op3_mixing": OP3,
    "op4_top_k": OP4,
    "op5_near_duplicates": OP5,
    "op6_chat_format": OP6,
    "op7_warc": OP7,
    "op9_licences": OP9,
    "op10_sharding": OP10,
}
