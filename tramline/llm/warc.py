"""Derivative records of WARC responses: linked metadata and plain-text conversions."""

from __future__ import annotations

import gzip
import hashlib
import io
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "\r\n"
#: (pattern, replacement) from HTML to text, in this order; each reads the same in Java's and RE2's syntax.
TEXT = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?i)</?(address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>", "\n"),
    (r"<[a-zA-Z/!?][^>]*>", ""),
)
#: Characters of the named references, by name.
NAMED = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
SPACE = ((r"[ \t\r\f ]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", ""))
HREF = r"(?i)<a\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"


def decoded(text: Column) -> Column:
    """The text with its numeric and named references (decimal, hexadecimal, HTML 4's names) as characters, in one
    pass; what isn't one stays as it is."""
    names = F.map_from_arrays(F.lit(list(NAMED)), F.lit(list(NAMED.values())))

    def part(x: Column, i: Column) -> Column:
        ref = F.regexp_extract(x, REFERENCE, 1)
        hexed = ref.rlike("^#[xX]")
        code = F.when(hexed, F.conv(F.substr(ref, F.lit(3)), 16, 10).try_cast("int")).otherwise(F.substr(ref, F.lit(2)).try_cast("int"))
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(ref.startswith("#"), F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))).otherwise(F.try_element_at(names, ref))
        kept = F.concat(F.lit("&"), x)
        return F.when(i == 0, x).when(ref == "", kept).otherwise(F.coalesce(F.concat(char, F.substr(x, F.char_length(ref) + 2)), kept))

    return F.array_join(F.transform(F.split(text, "&", -1), part), "")  # the text stands here once, so it's made once


def plain_text(html: Column) -> Column:
    for pattern, to in TEXT:
        html = F.regexp_replace(html, pattern, to)
    html = decoded(html)
    for pattern, to in SPACE:
        html = F.regexp_replace(html, pattern, to)
    return html


def record_id(*parts: Column) -> Column:
    """A urn:uuid made of an MD5, so that reruns give the same ids."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def responses_of_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records (page_id, record_id, target_uri, date, block) of a table of pages: page_id, url, html. The
    block is an HTTP message. Null html is an empty payload; a null url leaves target_uri null."""
    html = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(END + END))
    own = record_id(F.lit("response"), F.col("page_id").cast("string"), F.coalesce("url", F.lit("")), F.md5(html))
    return pages.select("page_id", own.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.concat(head, html).alias("block"))


def parsed(responses: DataFrame) -> DataFrame:
    """The rows with status, source_headers (lines of the HTTP head) and payload; a block without an empty line is
    all payload and has neither."""
    cut = F.instr("block", END + END)
    head = F.when(cut > 0, F.substr("block", F.lit(1), cut - 1))
    first = F.substring_index(head, END, 1)
    lines = F.when(F.instr(head, END) > 0, F.substr(head, F.instr(head, END) + 2)).otherwise(F.when(head.isNotNull(), F.lit("")))
    payload = F.when(cut > 0, F.substr("block", cut + 4)).otherwise(F.col("block"))
    return responses.select("*", F.try_element_at(F.split(first, " "), F.lit(2)).try_cast("int").alias("status"), lines.alias("source_headers"), F.coalesce(payload, F.lit("")).alias("payload"))


def derive(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows for each response (record_id, target_uri, date, block), after the columns in `keep`:

    warc_type metadata (status, source headers, title, links) and conversion (the payload as plain text). Both have a
    record_id of their own, refers_to (the response's id), the response's target_uri and date, content_type,
    content_length, block_digest, payload_digest (of the response's payload), source_headers, status, title,
    n_links and the block. A column payload_digest of the responses, taken from bytes, stands before our own. A null
    block is an empty payload; empty and very long ones are like any other; rows that repeat give rows that repeat; no
    responses give no rows; columns beside these, whatever their names, are left aside unless `keep` names them."""
    given = "payload_digest" in responses.columns
    src = parsed(responses.select(*keep, "record_id", "target_uri", "date", "block", *["payload_digest"] * given))
    html = F.col("payload")
    own = F.coalesce("payload_digest", digest(html)) if given else digest(html)
    src = src.select(*keep, F.col("record_id").alias("refers_to"), "target_uri", F.col("date").alias("warc_date"), "status", "source_headers", "payload",
        own.alias("payload_digest"), F.regexp_extract(html, TITLE, 1).alias("title"), F.regexp_extract_all(html, F.lit(HREF)).alias("links"))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value))
    listed = lambda name, values: F.when(F.size(values) > 0, F.concat(F.lit(name + ": "), F.array_join(values, f"{END}{name}: ")))
    headers = F.filter(F.split("source_headers", END), lambda x: x != "")
    fields = F.concat_ws(
        END, line("http-status", F.col("status").cast("string")), listed("source-header", headers), line("source-payload-digest", F.col("payload_digest")),
        line("source-payload-length", F.octet_length("payload").cast("string")), line("title", F.col("title")), listed("outlink", F.col("links")),
    )
    both = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), F.concat(fields, F.lit(END)).alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("payload")).alias("block")),
    )
    out = src.select(*keep, "refers_to", "target_uri", "warc_date", "status", "source_headers", "payload_digest", "title", F.size("links").cast("long").alias("n_links"), F.inline(both))
    return out.select(
        *keep, "warc_type", record_id(F.col("warc_type"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri", "warc_date", "content_type", F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"), "payload_digest", "source_headers", "status", "title", "n_links", "block",
    )


def record_text(df: DataFrame) -> DataFrame:
    """`record`: each derived row as WARC/1.1 bytes, ready for a file."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value))
    names = (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"))
    head = F.concat_ws(END, F.lit("WARC/1.1"), *[line(n, F.col(c)) for n, c in names], line("Content-Length", F.col("content_length").cast("string")))
    return df.select("record_id", F.concat(head, F.lit(END + END), F.col("block"), F.lit(END + END)).cast("binary").alias("record"))


def read_records(data: bytes):
    """(headers, block) of each record in the bytes of a .warc or .warc.gz file. The block of a record cut short is
    what there is of it, and its headers say so by a "truncated" of their own."""
    f = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)

    def get(read, *size):
        try:
            return read(*size)
        except (EOFError, gzip.BadGzipFile):  # a compressed file cut short
            return b""

    while line := get(f.readline):
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while line := get(f.readline).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = get(f.read, size := int(headers.get("content-length") or 0))
        if len(block) < size:
            headers["truncated"] = "yes"
        yield headers, block


def read_responses(spark, path: str) -> DataFrame:
    """Response records of WARC files, one task a file: record_id, target_uri, date, block (as text, bytes that aren't
    UTF-8 replaced), payload_digest (of the payload's bytes as they are), truncated."""
    import pyarrow as pa

    names = ["record_id", "target_uri", "date", "block", "payload_digest", "truncated"]

    def table(rows):
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in list(zip(*rows, strict=True))[:5]), pa.array([r[5] for r in rows])], names=names)

    def run(batches):
        from tramline.llm.warc import read_records

        for b in batches:
            for data in b.column(0):
                rows, size = [], 0
                for h, block in read_records(data.as_py()):
                    if h.get("warc-type") == "response":
                        _, cut, payload = block.partition(b"\r\n\r\n")
                        sha = "sha256:" + hashlib.sha256(payload if cut else block).hexdigest()
                        rows.append((h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), block.decode("utf-8", "replace"), sha, "truncated" in h))
                        size += len(block)
                    if size > 16_000_000:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "record_id string, target_uri string, date string, block string, payload_digest string, truncated boolean")


def oracle(date: str = "2024-01-01T00:00:00Z") -> str:
    """The query in DuckDB's SQL."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    end = "chr(13) || chr(10)"
    text = "payload"
    for p, to in TEXT:
        text = f"regexp_replace({text}, {lit(p)}, {'chr(10)' if to else lit('')}, 'g')"
    names = f"MAP([{', '.join(map(lit, NAMED))}], [{', '.join(map(lit, NAMED.values()))}])"
    ref = f"regexp_extract(x, {lit(REFERENCE)}, 1)"
    code = f"CASE WHEN regexp_matches({ref}, '^#[xX]') THEN try_cast('0x' || substr({ref}, 3) AS INT) ELSE try_cast(substr({ref}, 2) AS INT) END"
    char = f"CASE WHEN starts_with({ref}, '#') THEN CASE WHEN {code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343 THEN chr({code}) END ELSE names[{ref}] END"
    text = f"array_to_string(list_transform(string_split({text}, '&'), lambda x, i: CASE WHEN i = 1 THEN x WHEN {ref} = '' THEN '&' || x ELSE coalesce({char} || substr(x, length({ref}) + 2), '&' || x) END), '')"
    for p, to in SPACE:
        text = f"regexp_replace({text}, {lit(p)}, {'chr(10)' if to == chr(10) else lit(to)}, 'g')"
    uuid = lambda h: f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'"
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
r AS (SELECT *, 'sha256:' || sha256(payload) AS payload_digest, regexp_extract(payload, {lit(TITLE)}, 1) AS title, regexp_extract_all(payload, {lit(HREF)}, 1) AS links,
  md5('response|' || page_id::VARCHAR || '|' || coalesce(url, '') || '|' || md5(payload)) AS h FROM p),
m AS (SELECT *, {uuid("h")} AS refers_to FROM r), n AS (SELECT {names} AS names),
b AS (SELECT *, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type, {text} AS block FROM m CROSS JOIN n
  UNION ALL SELECT *, 'metadata', 'application/warc-fields', 'http-status: 200' || {end} || 'source-header: Content-Type: text/html; charset=utf-8' || {end} || 'source-header: Content-Length: ' || strlen(payload)::VARCHAR
    || {end} || 'source-payload-digest: ' || payload_digest || {end} || 'source-payload-length: ' || strlen(payload)::VARCHAR || {end} || 'title: ' || title
    || CASE WHEN len(links) > 0 THEN {end} || 'outlink: ' || array_to_string(links, {end} || 'outlink: ') ELSE '' END || {end} FROM m CROSS JOIN n)
SELECT page_id, warc_type, {uuid("md5(warc_type || '|' || refers_to)")} AS record_id, refers_to, url AS target_uri, {lit(date)} AS warc_date, content_type, strlen(block)::BIGINT AS content_length,
  'sha256:' || sha256(block) AS block_digest, payload_digest, 'Content-Type: text/html; charset=utf-8' || {end} || 'Content-Length: ' || strlen(payload)::VARCHAR AS source_headers, 200 AS status, title, len(links)::BIGINT AS n_links, block FROM b"""
