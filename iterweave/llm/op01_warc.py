"""WARC derivatives: metadata and plain-text conversion records for response records.

Every response yields two linked records.  The *metadata* record keeps what the response
said about itself: status line, HTTP headers and digests, as warc-fields.  The *conversion*
record holds the payload's plain text.  Both name the response in ``WARC-Refers-To`` (with
its target URI and date), name its payload digest, and carry a digest of their own block.
Record ids derive from the response's id and the record type, so reruns agree and a lost
task writes the same records again.

Text extraction: comments, scripts and styles go, block-level tags become line breaks,
other tags go, the common character entities are decoded, white space is collapsed.

``to_warc`` serialises records, ``write_warc`` writes them as WARC files, one per task.
Everything is a projection: no shuffle, no state.

Defined results: a null page is an empty payload, a null URL an empty target URI; an empty
payload has an empty conversion; a response without a header end is all header; repeated
rows give repeated records with the same ids; an empty table gives no records; other
columns of the input are ignored by ``responses`` and passed through by ``derivatives``
unless their names clash with a record's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"  # for tables that do not say when a page was fetched
RECORD = (
    "record_type",
    "record_id",
    "refers_to",
    "target_uri",
    "date",
    "source_digest",
    "block_digest",
    "content_type",
    "content_length",
    "headers",
    "block",
)

# Patterns that mean the same to Java's and RE2's regular expressions; applied in turn.  A tag
# ends before the next "<", so that a page of unclosed tags is read once and not from each.
_TAG = r"(?:[ \t\r\n/][^<>]*)?>"
_BREAKS = "p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|header|footer|nav|aside|main|title|head|body|html|blockquote|pre|form"
REPLACEMENTS = (
    (r"(?s)<!--.*?(?:-->|\z)", " "),
    (rf"(?is)<script{_TAG}.*?(?:</script{_TAG}|\z)", " "),
    (rf"(?is)<style{_TAG}.*?(?:</style{_TAG}|\z)", " "),
    (rf"(?i)</?(?:{_BREAKS}){_TAG}", "\n"),
    (r"<[a-zA-Z/!?][^<>]*>", ""),
    (r"&nbsp;|&#160;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;|&apos;", "'"),
    ("&amp;", "&"),
    (r"[ \t\r\f\x0B]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"\A[ \n]+|[ \n]+\z", ""),
)


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_urn(*parts: Column) -> Column:
    """A version 8 UUID (RFC 9562: free content) from a hash of the parts."""
    h = F.sha2(F.concat_ws("\n", *parts).cast("binary"), 256)
    part = lambda at, n: F.substring(h, at, n)
    uuid = F.concat_ws(
        "-",
        part(1, 8),
        part(9, 4),
        F.concat(F.lit("8"), part(13, 3)),
        F.concat(F.lit("8"), part(16, 3)),
        part(19, 12),
    )
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def plain_text(html: Column) -> Column:
    return reduce(
        lambda text, change: F.regexp_replace(text, change[0], change[1]),
        REPLACEMENTS,
        html,
    )


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records from (page_id, url, html): (page_id, record_id, target_uri, date,
    block), the block being the HTTP message."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(CRLF * 2),
    )
    url = F.coalesce("url", F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return pages.select(
        "page_id",
        record_urn(F.lit("response"), key, url, digest(html)).alias("record_id"),
        url.alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, html).alias("block"),
    )


def _headers(fields: list[tuple[str, Column]]) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    return F.concat_ws(CRLF, F.lit(VERSION), *lines)


def _record(kind: str, content_type: str, block: Column, response: Column) -> Column:
    """One record about a response (its id, URI, date and payload digest)."""
    record_id = record_urn(F.lit(kind), response["record_id"])
    length = F.octet_length(block).cast("long")
    fields = [
        ("WARC-Type", F.lit(kind)),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", response["date"]),
        ("WARC-Target-URI", response["target_uri"]),
        ("WARC-Refers-To", response["record_id"]),
        ("WARC-Refers-To-Target-URI", response["target_uri"]),
        ("WARC-Refers-To-Date", response["date"]),
        ("WARC-Source-Payload-Digest", response["digest"]),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", F.lit(content_type)),
        ("Content-Length", length.cast("string")),
    ]
    return F.struct(
        F.lit(kind).alias("record_type"),
        record_id.alias("record_id"),
        response["record_id"].alias("refers_to"),
        response["target_uri"].alias("target_uri"),
        response["date"].alias("date"),
        response["digest"].alias("source_digest"),
        digest(block).alias("block_digest"),
        F.lit(content_type).alias("content_type"),
        length.alias("content_length"),
        _headers(fields).alias("headers"),
        block.alias("block"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Two records per response (record_id, target_uri, date, block), with the columns of
    RECORD after the input's other columns."""
    others = [c for c in records.columns if c not in RECORD and not c.startswith("_")]
    end = F.instr("block", CRLF * 2)
    head = F.when(end > 0, F.substring("block", F.lit(1), end - 1)).otherwise(F.col("block"))
    payload = F.when(end > 0, F.substring(F.col("block"), end + 4, F.length("block"))).otherwise("")
    read = records.select(*others, "record_id", "target_uri", "date", head.alias("_head"), payload.alias("_payload"))
    read = read.withColumn("_digest", digest(F.col("_payload"))).select(
        *others,
        "_head",
        F.explode(F.array(plain_text(F.col("_payload")))).alias("_text"),
        F.struct("record_id", "target_uri", "date", F.col("_digest").alias("digest")).alias("_response"),
    )
    status = F.substring_index("_head", CRLF, 1)
    sent = F.substring(F.col("_head"), F.length(status) + 3, F.length("_head"))
    lines = F.filter(F.split(sent, CRLF), lambda line: line != "")
    kept = F.array_join(F.transform(lines, lambda line: F.concat(F.lit("source-header-"), line, F.lit(CRLF))), "")
    about = F.concat(
        F.lit("source-status: "),
        status,
        F.lit(CRLF),
        kept,
        F.lit("source-payload-digest: "),
        F.col("_response.digest"),
        F.lit(CRLF),
        F.lit("conversion-block-digest: "),
        digest(F.col("_text")),
        F.lit(CRLF),
    )
    read = read.select(*others, "_text", "_response", F.explode(F.array(about)).alias("_about"))
    response = F.col("_response")
    made = F.array(
        _record("metadata", "application/warc-fields", F.col("_about"), response),
        _record("conversion", "text/plain; charset=utf-8", F.col("_text"), response),
    )
    return read.select(*others, F.explode(made).alias("_record")).select(*others, "_record.*")


def to_warc(records: DataFrame) -> DataFrame:
    """Each record as it stands in a WARC file, but for the two line ends after it."""
    return records.select(F.concat("headers", F.lit(CRLF * 2), "block").alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    to_warc(records).write.option("lineSep", CRLF * 2).text(path)


def op1_warc_derivatives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return derivatives(responses(pages)).select(
        "page_id",
        "record_type",
        "record_id",
        "refers_to",
        "target_uri",
        "source_digest",
        "block_digest",
        "content_length",
        F.sha2(F.col("headers").cast("binary"), 256).alias("headers_sha256"),
    )


def _urn_sql(h: str) -> str:
    return (
        f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-8' || substr({h}, 13, 3)"
        f" || '-8' || substr({h}, 16, 3) || '-' || substr({h}, 19, 12) || '>'"
    )


def _text_sql() -> str:
    found = "html"
    for pattern, put in REPLACEMENTS:
        quoted = "chr(10)" if put == "\n" else "'" + put.replace("'", "''") + "'"
        found = f"regexp_replace({found}, '{pattern.replace(chr(39), chr(39) * 2)}', {quoted}, 'g')"
    return found


SQL = f"""
with filled as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as html from pages),
hashed as (
  select *, 'sha256:' || sha256(html) as source_digest, {_text_sql()} as text from filled),
named as (
  select *, {_urn_sql("sha256(concat_ws(chr(10), 'response', coalesce(page_id::varchar, ''), url, source_digest))")} as refers_to
  from hashed),
blocks as (
  select *, 'metadata' as record_type, 'application/warc-fields' as content_type,
    'source-status: HTTP/1.1 200 OK' || chr(13) || chr(10)
    || 'source-header-Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
    || 'source-header-Content-Length: ' || strlen(html) || chr(13) || chr(10)
    || 'source-payload-digest: ' || source_digest || chr(13) || chr(10)
    || 'conversion-block-digest: sha256:' || sha256(text) || chr(13) || chr(10) as block
  from named
  union all
  select *, 'conversion', 'text/plain; charset=utf-8', text from named),
ids as (
  select *, {_urn_sql("sha256(concat_ws(chr(10), record_type, refers_to))")} as record_id,
    'sha256:' || sha256(block) as block_digest, strlen(block)::bigint as content_length
  from blocks)
select page_id, record_type, record_id, refers_to, url as target_uri, source_digest, block_digest,
  content_length,
  sha256(concat_ws(chr(13) || chr(10), '{VERSION}', 'WARC-Type: ' || record_type,
    'WARC-Record-ID: ' || record_id, 'WARC-Date: {DATE}', 'WARC-Target-URI: ' || url,
    'WARC-Refers-To: ' || refers_to, 'WARC-Refers-To-Target-URI: ' || url,
    'WARC-Refers-To-Date: {DATE}', 'WARC-Source-Payload-Digest: ' || source_digest,
    'WARC-Block-Digest: ' || block_digest, 'Content-Type: ' || content_type,
    'Content-Length: ' || content_length)) as headers_sha256
from ids
"""
