"""Structural checks: links, ages, routes, differences, id resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broken_links(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, link) of links to no known page; links to the web are not checked."""
    inside = edges.where(~F.col("link").rlike("^https?:"))
    known = pages.select(F.col("path").alias("target")).distinct()
    return inside.join(known, "target", "left_anti").select("page_id", "link").distinct()


def orphans(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, path) of pages that no link leads to; the root page is none."""
    linked = edges.select(F.col("target").alias("path")).distinct()
    return pages.where("path <> ''").join(linked, "path", "left_anti").select("page_id", "path")


def stale(rows: DataFrame, id_col: str, stamp: Column, now: str, days: int = 180) -> DataFrame:
    """(id, age_days) of rows older than ``days`` whole days at ``now``."""
    age = F.floor((F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(stamp.cast("timestamp"))) / 86400)
    return rows.select(id_col, age.alias("age_days")).where(F.col("age_days") > days)


#: Fields a page must have, and what its status may be: fixed values.
REQUIRED = ("type", "title", "timestamp")
STATUSES = ("conflicted", "draft", "researched", "seed", "stale")


def knowledge_base(pages: DataFrame, edges: DataFrame, now: str, days: int = 180) -> DataFrame:
    """(category, path, detail) of a knowledge base's problems: schema, broken-link, orphan, stale.

    Pages are (path, has_front, type, title, timestamp, status); a null field is a missing
    one. Edges are (path, link, target). A page without front matter has that problem alone,
    and its links count for nobody. Index pages are no orphans. Only researched pages grow
    stale; their timestamps must parse.
    """
    problem = lambda category, detail: F.struct(F.lit(category).alias("category"), detail.alias("detail"))
    none = F.lit(None).cast("struct<category:string,detail:string>")
    missing = [F.when(F.col("has_front") & F.col(f).isNull(), problem("schema", F.lit(f"missing required field '{f}'"))).otherwise(none) for f in REQUIRED]
    odd = F.when(F.col("has_front") & F.col("status").isNotNull() & ~F.col("status").isin(*STATUSES), problem("schema", F.concat(F.lit("invalid status '"), "status", F.lit("'"))))
    bare = F.when(~F.col("has_front"), problem("schema", F.lit("missing frontmatter block")))
    stamp = F.col("timestamp").try_cast("timestamp")
    watched = F.col("has_front") & (F.col("status") == "researched") & (F.coalesce("timestamp", F.lit("")) != "")
    age = F.floor((F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(stamp)) / 86400)
    unread = F.when(watched & stamp.isNull(), problem("schema", F.concat(F.lit("unparseable timestamp '"), "timestamp", F.lit("'"))))
    old = F.when(watched & (age > days), problem("stale", F.concat(F.lit("last updated "), age.cast("string"), F.lit(" days ago"))))
    own = pages.select("path", F.explode(F.filter(F.array(bare, *missing, odd, unread, old), lambda x: x.isNotNull())).alias("p")).select("p.category", "path", "p.detail")
    read = edges.where(~F.col("link").rlike("^https?:")).join(pages.where("has_front").select(F.col("path").alias("_from")).distinct(), F.col("path") == F.col("_from"), "left_semi")
    known = pages.select(F.col("path").alias("_known")).distinct()
    broken = read.join(known, F.col("target") == F.col("_known"), "left_anti").select(F.lit("broken-link").alias("category"), "path", F.concat(F.lit("links to missing file '"), "link", F.lit("'")).alias("detail"))
    is_index = (F.coalesce("type", F.lit("")) == "Index") | F.col("path").rlike("(^|/)index[.]md$")
    linked = read.select(F.col("target").alias("_to")).distinct()
    alone = pages.where(F.col("has_front") & ~is_index).join(linked, F.col("path") == F.col("_to"), "left_anti").select(F.lit("orphan").alias("category"), "path", F.lit("no incoming links").alias("detail"))
    return own.unionByName(broken).unionByName(alone)


def routes(pages: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """A conversion route for each document from signals of its pages, the first rule that holds."""
    text = F.col(text_col)
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    s = pages.groupBy(doc_col).agg(
        F.avg(F.length(text)).alias("chars"),
        share(F.length(F.rtrim(text)) < 10).alias("image_only"),
        share(F.contains(text, F.lit("|"))).alias("tables"),
        F.avg(F.regexp_count(text, F.lit(r"[%$*#]"))).alias("math"),
        F.max(F.when(F.contains(text, F.lit("____")), 1).otherwise(0)).alias("form"),
    )
    density = F.when(F.col("math") >= 5, "high").when(F.col("math") >= 1, "medium").otherwise("low")
    route = F.when(F.col("form") == 1, "form").when(F.col("image_only") >= 0.6, "scanned").when(F.col("math") >= 5, "math").when(F.col("tables") >= 0.6, "table-heavy").when(F.col("chars") <= 150, "slides").otherwise("digital-text")
    return s.select(doc_col, F.round("chars", 6).alias("chars"), F.round("tables", 6).alias("table_share"), density.alias("math_density"), route.alias("route"))


def snapshot_diff(left: DataFrame, right: DataFrame, key: str, content: str) -> DataFrame:
    """(key, kind) of rows in one snapshot only, or with different content."""
    a = left.select(F.col(key).alias("ka"), F.col(content).alias("ca"))
    b = right.select(F.col(key).alias("kb"), F.col(content).alias("cb"))
    kind = F.when(F.col("kb").isNull(), "only left").when(F.col("ka").isNull(), "only right").when(~F.col("ca").eqNullSafe(F.col("cb")), "differs")
    return a.join(b, F.col("ka") == F.col("kb"), "full").select(F.coalesce("ka", "kb").alias(key), kind.alias("kind")).where("kind is not null")


def resolve_suffixes(asked: DataFrame, names: DataFrame) -> DataFrame:
    """(emitted, id): an exact id, else the one id that ends in ':' and it, else the one id
    that ends in it (two characters at least); null if several do.

    Each name is exploded into its suffixes, so every tier is an equi-join.
    """
    wanted = asked.select("emitted").distinct()
    exact = names.select(F.col("id").alias("emitted"), F.col("id").alias("exact")).join(wanted, "emitted").groupBy("emitted").agg(F.min("exact").alias("exact"))
    tails = names.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.length("id")), lambda i: F.struct(F.substr("id", i).alias("emitted"), (F.substr("id", i - 1, F.lit(1)) == ":").alias("colon")))).alias("t")).select("id", "t.*")
    tiers = tails.join(wanted, "emitted").groupBy("emitted").agg(
        F.count(F.when(F.col("colon"), 1)).alias("n_colon"), F.min(F.when(F.col("colon"), F.col("id"))).alias("colon_id"), F.count(F.lit(1)).alias("n_any"), F.min("id").alias("any_id")
    )
    one = F.when(F.col("n_colon") == 1, F.col("colon_id"))
    bare = F.when((F.length("emitted") >= 2) & (F.col("n_any") == 1), F.col("any_id"))
    return asked.select("emitted").join(exact, "emitted", "left").join(tiers, "emitted", "left").select("emitted", F.coalesce("exact", one, bare).alias("id"))
