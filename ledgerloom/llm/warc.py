"""WARC derivatives: metadata and plain-text conversion records of stored responses.

Every derived record refers to its response by identifier, target and date. The metadata
record carries all headers of the source record (as ``source-...`` fields, digests among
them), the HTTP status and type, the page's language and title and its outlinks. The
conversion record holds the page's text. All HTML5 named and numeric character references in
text, titles and outlinks are decoded, row by row in Python. Blocks get digests of their own.

Null url: no target header. Null payload: empty text. A response whose HTTP type is not
``text/...`` has a metadata record only. Identifiers are computed from the response's, so
runs agree and repeated responses give repeated records. Extra columns are not read. Each
response is handled alone: no row moves. A page of any length is one row of a task, which
holds it and its text whole. An empty table gives no records.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRLF = "\r\n"
# Markup that hides text and tags that end a line.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>"
LINE_TAGS = (
    r"(?i)</?(?:article|aside|blockquote|body|br|div|dd|dl|dt|footer|form|h[1-6]|head|header"
    r"|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
)
OTHER_TAGS = r"<[^>]*>"
# NAMED and OUTLINK are for the SQL twin, which knows less than REFERENCE and LINK: these
# references only, and quoted links.
NAMED = (
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),  # last, so that nothing is decoded twice
)
BLANKS = r"[ \t\r\f]+"
LINE_ENDS = r" ?\n[ \n]*"
OUTLINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']([^\"'>]*)[\"']"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*([\"'][^\"'>]*[\"']|[^\s\"'>]++(?=[\s>]))"
REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)")
# In an attribute a name without semicolon counts only before other characters than these.
IN_LINK = re.compile(
    r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=;])))"
)
LANGUAGE = r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)"
TITLE = r"(?is)<title[^>]*>(.*?)</title"


def decoded(text: str) -> str:
    """Named and numeric character references as characters, once; no-break space is blank."""
    return REFERENCE.sub(lambda m: unescape(m[0]).replace("\xa0", " "), text)


def decoded_link(url: str) -> str:
    def one(m: re.Match) -> str:
        known = m[0][1] == "#" or m[0][1:] in html5
        return unescape(m[0]) if known else m[0]

    return IN_LINK.sub(one, url)


@F.arrow_udf(T.StringType())
def _decoded(texts: pa.Array) -> pa.Array:
    return pa.array(
        [t and (decoded(t) if "&" in t else t) for t in texts.to_pylist()], pa.string()
    )


@F.arrow_udf(T.ArrayType(T.StringType()))
def _decoded_links(lists: pa.Array) -> pa.Array:
    return pa.array(
        [links and [decoded_link(u) for u in links] for links in lists.to_pylist()],
        pa.list_(pa.string()),
    )


def plain_text(html: Column) -> Column:
    """Visible text, one line per block of markup."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, LINE_TAGS, "\n")
    text = _decoded(F.regexp_replace(text, OTHER_TAGS, ""))
    text = F.regexp_replace(F.regexp_replace(text, BLANKS, " "), LINE_ENDS, "\n")
    return F.trim(text, F.lit(" \n"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def identifier(*parts: Column) -> Column:
    """A record id computed from other values."""
    name = F.md5(F.concat_ws("\n", *parts))
    dashed = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    one_line = F.regexp_replace(value, "[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), one_line, F.lit(CRLF)), F.lit(""))


def _header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Pages (page_id, url, html) as response records."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    length = F.octet_length(payload).cast("string")
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"),
        F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        length,
        F.lit(CRLF + CRLF),
    )
    block = F.concat(F.col("http_head"), F.col("payload"))
    return (
        pages.select("page_id", "url", payload.alias("payload"), head.alias("http_head"))
        .withColumn("payload_digest", digest(F.col("payload")))
        .select(
            "page_id",
            identifier(F.col("page_id"), F.col("url"), F.col("payload_digest")).alias("record_id"),
            F.col("url").alias("target_uri"),
            F.lit(date).alias("date"),
            F.array(
                _header("WARC-Block-Digest", digest(block)),
                _header("WARC-Payload-Digest", F.col("payload_digest")),
                _header("Content-Type", F.lit("application/http; msgtype=response")),
                _header("Content-Length", F.octet_length(block).cast("string")),
            ).alias("source_headers"),
            "http_head",
            "payload",
        )
    )


def derivatives(records: DataFrame, keep: list[str]) -> DataFrame:
    """Derived records of ``responses``-shaped rows, with the columns ``keep``."""
    status = F.regexp_extract("http_head", r"^HTTP/[0-9.]+ ([0-9]{3})", 1)
    kind = F.regexp_extract("http_head", r"(?i)\ncontent-type: *([^\r\n]*)", 1)
    html = F.col("payload")
    title = F.trim(_decoded(F.regexp_replace(F.regexp_extract(html, TITLE, 1), BLANKS, " ")))
    found = F.transform(
        F.regexp_extract_all(html, F.lit(LINK), 1),
        lambda u: F.regexp_replace(u, "^[\"']|[\"']$", ""),
    )
    links = F.transform(_decoded_links(found), lambda u: _field("outlink", u))
    source = F.transform(
        "source_headers",
        lambda h: F.concat(F.lit("source-"), F.lower(h["name"]), F.lit(": "), h["value"],
                           F.lit(CRLF)),
    )
    fields = F.concat(
        F.array_join(source, ""),
        _field("http-status", F.nullif(status, F.lit(""))),
        _field("http-content-type", F.nullif(kind, F.lit(""))),
        _field("language", F.nullif(F.regexp_extract(html, LANGUAGE, 1), F.lit(""))),
        _field("title", F.nullif(title, F.lit(""))),
        F.array_join(links, ""),
    )

    def record(warc_type: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(warc_type).alias("warc_type"),
            F.lit(content_type).alias("content_type"),
            block.alias("block"),
        )

    metadata = record("metadata", "application/warc-fields", fields)
    conversion = record("conversion", "text/plain; charset=utf-8", plain_text(html))
    of_text = F.lower(kind).startswith("text/")
    carried = [F.col(c) for c in dict.fromkeys([*keep, "target_uri", "date"])]
    payload_digest = F.filter(
        "source_headers", lambda h: F.lower(h["name"]) == "warc-payload-digest"
    )
    out = records.select(
        *carried,
        F.col("record_id").alias("refers_to"),
        F.get(payload_digest, F.lit(0))["value"].alias("payload_digest"),
        F.explode(
            F.when(of_text, F.array(metadata, conversion)).otherwise(F.array(metadata))
        ).alias("derived"),
    ).select("*", "derived.*")
    out = out.withColumn("record_id", identifier(F.col("refers_to"), F.col("warc_type")))
    out = out.withColumn("block_digest", digest(F.col("block"))).withColumn(
        "content_length", F.octet_length("block").cast("long")
    )
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("warc_type")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Refers-To-Target-URI", F.col("target_uri")),
        _field("WARC-Refers-To-Date", F.col("date")),
        _field("WARC-Block-Digest", F.col("block_digest")),
        _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.col("content_length").cast("string")),
    )
    return out.withColumn("header", header).drop("derived", "date")


def write_warc(records: DataFrame, path: str) -> None:
    """Gzipped WARC files, one per task: a record ends with two line ends."""
    (
        records.select(F.concat("header", F.lit(CRLF), "block").alias("value"))
        .write.option("lineSep", CRLF + CRLF)
        .option("compression", "gzip")
        .text(path)
    )
