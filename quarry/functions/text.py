"""Text predicates, keys and measures as Column expressions; nothing here runs Python on executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word for ranking and overlap: letters and digits of any script.
NOT_WORD = r"[^\p{L}\p{N}]+"
#: The format of a cited claim in generated prose.
MARKER = r"\[claim:([A-Za-z0-9_.\-]+)\]"


def verbatim_ok(quote: Column, text: Column) -> Column:
    """A quote counts only as an exact, non-empty substring; nulls never do."""
    return (F.length(F.coalesce(quote, F.lit(""))) > 0) & F.coalesce(F.contains(text, quote), F.lit(False))


def slice_span(text: Column, start: Column, end: Column) -> Column:
    """The code points [start, end) if that is a forward slice within the text, else null."""
    inside = (start >= 0) & (end <= F.length(text)) & (start < end)
    return F.when(inside, F.substring(text, start.cast("int") + 1, (end - start).cast("int")))


def span_ok(start: Column, end: Column, text: Column, quote: Column) -> Column:
    """The span is valid and, if a quote is echoed (even an empty one), equal to it."""
    piece = slice_span(text, start, end)
    return piece.isNotNull() & (quote.isNull() | F.coalesce(piece == quote, F.lit(False)))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda x: x != "")


def token_set(text: Column) -> Column:
    """Distinct a-z0-9 words; other letters separate words, on purpose."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets as arrays; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def normalised_hash(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def claim_norm(claim: Column) -> Column:
    """A claim's words without punctuation, in any script."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(claim), r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))


def claim_key(claim: Column, locators: Column) -> Column:
    """What makes two claims the same: the normalised claim and its sorted locators."""
    return F.concat_ws("||", claim_norm(claim), F.array_join(F.sort_array(locators), "\x1f"))


def short_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(text, 256), 1, 16))


def sentences(text: Column) -> Column:
    """Split after . ! ? before white space, white space collapsed first."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.filter(F.split(F.regexp_replace(flat, r"([.!?]) ", "$1\x01"), "\x01"), lambda s: s != "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def web_source_id(url: Column) -> Column:
    """Slug of host and path, trimmed before it is cut at 60, and 8 digits of the URL's hash."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"[?#].*$", "")
    return F.concat(F.substring(slug(bare), 1, 60), F.lit("-"), F.substring(F.sha2(url, 256), 1, 8))


def once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value computed once a row, however often ``of`` names it."""
    return F.element_at(F.transform(F.array(value), of), 1)


def hash_embedding(text: Column, dims: int = 16) -> Column:
    """A deterministic unit vector from the bytes of the text's SHA-256; the text is hashed once."""

    def scaled(raw: Column) -> Column:
        norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
        return once(norm, lambda n: F.when(n > 0, F.transform(raw, lambda x: x / n)).otherwise(raw))

    def drawn(digest: Column) -> Column:
        return F.array(*[F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("double") / 255.0 * 2.0 - 1.0 for i in range(dims)])

    return once(F.sha2(text, 256), lambda digest: once(drawn(digest), scaled))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if a norm is 0."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def heading_depth(text: Column, level: Column) -> Column:
    """Parts of a dotted number in front, else the given level, else 1."""
    number = F.regexp_extract(text, r"^\s*(\d+(?:\.\d+)*)\.?\s", 1)
    return F.when(number != "", F.size(F.split(number, r"\."))).otherwise(F.coalesce(level, F.lit(1)))


def unprintable_share(text: Column) -> Column:
    """Share of characters outside tab..carriage return and blank..tilde; null for no text."""
    return F.when(F.length(text) > 0, 1 - F.length(F.regexp_replace(text, r"[^\x09-\x0d\x20-\x7e]", "")) / F.length(text))


def wilson(passes: Column, runs: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Lower and upper bound of a proportion; (0, 1) without runs."""
    p, n = passes / runs, runs.cast("double")
    middle, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    low, high = (middle - spread) / (1 + z * z / n), (middle + spread) / (1 + z * z / n)
    empty = runs == 0
    return F.when(empty, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), low)), F.when(empty, F.lit(1.0)).otherwise(F.least(F.lit(1.0), high))


def marker_ids(prose: Column) -> Column:
    """Distinct claim ids cited, in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(prose, F.lit(MARKER), 1))


def strip_think(reply: Column) -> Column:
    """A reply without its reasoning: what follows the last closing tag, else no open block."""
    after = F.regexp_replace(reply, r"(?s)^.*</think>", "")
    return F.trim(F.regexp_replace(after, r"(?s)<think>.*$", ""))


def json_block(reply: Column) -> Column:
    """The first JSON object or array in a reply, fenced or in prose; null if it doesn't parse."""
    output = F.regexp_extract(reply, r"(?s)<output>(.*?)</output>", 1)
    body = F.when(output != "", output).otherwise(F.regexp_replace(strip_think(reply), r"(?s)^.*?```(?:json)?\s*(.*?)```.*$", "$1"))
    found = F.regexp_extract(body, r"(?s)([\[{].*[\]}])", 1)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)


def page_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), 1)


def resolved_link(base: Column, link: Column) -> Column:
    """A link against the path it stands in: '/' is the root, '..' and '.' are folded."""
    folder = F.regexp_replace(base, r"[^/]*$", "")
    whole = F.when(F.startswith(link, F.lit("/")), link).otherwise(F.concat(folder, link))
    empty = F.array().cast("array<string>")
    steps = F.aggregate(
        F.split(whole, "/"),
        empty,
        lambda done, s: F.when((s == "") | (s == "."), done).when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, s)),
    )
    return F.array_join(steps, "/")
