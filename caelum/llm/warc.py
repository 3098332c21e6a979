"""WARC derivatives: from response records, linked metadata and plain-text conversion records."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import table

CRLF = "\r\n"
VERSION = "WARC/1.1"
NO_DATE = "1970-01-01T00:00:00Z"

#: Named character references that are decoded, besides all numeric ones: those of HTML 4, and the apostrophe's.
NAMED = {**{k: ord(html5[f"{k};"]) for k in name2codepoint}, "apos": 39}
REFERENCE = "&[#A-Za-z0-9]{1,31};"
HIDDEN = r"(?is)<(?:!--.*?--|script\b[^>]*>.*?</script\s*|style\b[^>]*>.*?</style\s*)>"
BLOCK = (
    r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|title|article|section|header|footer|nav|main|aside|form"
    r"|blockquote|pre|hr|dl|dt|dd)\b[^>]*>"
)
TAG = r"<[A-Za-z/!?][^>]*>"
BLANKS = "[ \\t\\r\\f\\x0B\\x{A0}]{2,}|[\\t\\r\\f\\x0B\\x{A0}]"  # a lone space stays as it is
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"
VALUE = "(\"[^\"]*\"|'[^']*'|[^\\s\"'>]+)"  # of an attribute, with its quotes
LANGUAGE = rf"(?i)<html\b[^>]*\blang\s*=\s*{VALUE}"
LINK = rf"(?i)<a\b[^>]*\bhref\s*=\s*{VALUE}"


def digest(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value, 256))


def record_id(kind: str, *parts: Column) -> Column:
    """A name-based id: the same input gives the same id in every run and every retried task."""
    parts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    h = F.sha2(F.concat_ws("\n", F.lit(kind), *parts), 256)
    piece = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("urn:uuid:"), piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-8"), piece(13, 3), F.lit("-a"), piece(16, 3), F.lit("-"), piece(19, 12)
    )


def decoded(text: Column) -> Column:
    """Character references decoded once; what is no known name or no valid character stays as it is.

    ``text`` is looked at once, by a split at each ampersand. It should be a column, not an expression that is dear to compute.
    """
    names = F.create_map(*[x for k, v in NAMED.items() for x in (F.lit(k), F.lit(chr(v)))])

    def char(name: Column) -> Column:
        code = F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.regexp_extract(name, "^#[xX]([0-9A-Fa-f]{1,6})$", 1), 16, 10)).otherwise(
            F.regexp_extract(name, "^#([0-9]{1,7})$", 1)
        )
        code = code.try_cast("bigint")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.when(F.startswith(name, F.lit("#")), numeric).otherwise(F.try_element_at(names, name))

    def piece(part: Column, place: Column) -> Column:
        name = F.regexp_extract(part, "^([#A-Za-z0-9]{1,31});", 1)
        after = F.substr(part, F.length(name) + 2)
        plain = F.concat(F.lit("&"), part)
        return F.when(place == 0, part).when(name == "", plain).otherwise(F.coalesce(F.concat(char(name), after), plain))

    return F.array_join(F.transform(F.split(text, "&", -1), piece), "")


def without_tags(html: Column) -> Column:
    """No comments, scripts and styles; block tags end lines, other tags vanish."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), BLOCK, "\n"), TAG, "")


def tidy(text: Column) -> Column:
    """Runs of blanks as one space, no blanks around line ends and no empty lines."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, BLANKS, " "), " ?\\n[ \\n]*", "\n"), F.lit(" \n"))


def head(fields: list[tuple[str, Column]]) -> Column:
    """The header of a record; a null field is left out."""
    lines = [F.concat(F.lit(f"{k}: "), F.regexp_replace(v.cast("string"), "[\\r\\n]+", " ")) for k, v in fields]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(CRLF + CRLF))


def responses(pages: DataFrame, date: str = NO_DATE) -> DataFrame:
    """Response records of fetched pages: ``page_id, record_id, target_uri, date, block``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    http = F.concat_ws(
        CRLF,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string")),
    )
    return pages.select(
        F.col("page_id").cast("long"),
        record_id("response", F.col("page_id"), F.col("url"), html).alias("record_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(http, F.lit(CRLF + CRLF), html).alias("block"),
    )


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record of every response record (``page_id, record_id, target_uri, date, block``).

    Both refer to the response by WARC-Refers-To and to each other by WARC-Concurrent-To, and keep its target and date. The
    metadata block lists the source's HTTP status and headers, its block and payload digests, title, language
    and outlinks; the conversion block is the page's plain text. ``record`` is the whole record but for the closing blank
    lines, which ``write`` adds. Null blocks and pages without html give an empty conversion; a null target leaves its header
    out; repeated rows give their records again, with the same ids; an empty table gives no records; other columns are left out.
    """
    block = F.coalesce(F.col("block"), F.lit(""))
    split = F.locate(CRLF + CRLF, F.col("_block"))
    source = (
        records.select(F.col("page_id"), F.col("record_id").alias("refers_to"), "target_uri", "date", block.alias("_block"))
        .withColumn("_http", F.when(split > 0, F.expr("substring(_block, 1, locate('\r\n\r\n', _block) - 1)")).otherwise(""))
        .withColumn("_payload", F.when(split > 0, F.expr("substring(_block, locate('\r\n\r\n', _block) + 4)")).otherwise(F.col("_block")))
        .withColumn("source_digest", digest(F.col("_block")))
        .withColumn("payload_digest", digest(F.col("_payload")))
        .withColumn("_bare", without_tags(F.col("_payload")))
        .withColumn("_text", tidy(decoded(F.col("_bare"))))
        .withColumn("_title", F.trim(F.regexp_replace(F.regexp_extract("_payload", TITLE, 1), "\\s+", " ")))
    )
    unquoted = lambda x: F.when(x.rlike("^[\"']"), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x)
    tidied = lambda x: F.trim(F.regexp_replace(unquoted(x), "\\s+", " "))
    lines = lambda name, values: F.transform(values, lambda v: F.concat(F.lit(f"{name}: "), v))
    about = F.concat(
        lines("source-header", F.filter(F.split("_http", CRLF), lambda x: x != "")),
        F.array(F.concat(F.lit("source-block-digest: "), F.col("source_digest")), F.concat(F.lit("source-payload-digest: "), F.col("payload_digest"))),
        lines("title", F.filter(F.array(decoded(F.col("_title"))), lambda x: x != "")),
        lines("language", F.filter(F.transform(F.array(F.regexp_extract("_payload", LANGUAGE, 1)), tidied), lambda x: x != "")),
        lines("outlink", F.transform(F.regexp_extract_all("_payload", F.lit(LINK), F.lit(1)), tidied)),
    )
    source = source.withColumn("_about", F.concat(F.array_join(about, CRLF), F.lit(CRLF)))
    made = lambda kind: record_id(kind, F.col("refers_to"))
    derived = F.array(
        *[
            F.struct(
                F.lit(kind).alias("warc_type"),
                made(kind).alias("record_id"),
                made(other).alias("concurrent_to"),
                F.lit(content).alias("content_type"),
                F.col(body).alias("block"),
            )
            for kind, other, content, body in (
                ("metadata", "conversion", "application/warc-fields", "_about"),
                ("conversion", "metadata", "text/plain; charset=utf-8", "_text"),
            )
        ]
    )
    out = source.select("page_id", "refers_to", "target_uri", "date", "source_digest", "payload_digest", F.explode(derived).alias("_r"))
    out = out.select("page_id", "_r.*", "refers_to", "target_uri", "date", "source_digest", "payload_digest")
    out = out.withColumn("content_length", F.octet_length("block").cast("long")).withColumn("block_digest", digest(F.col("block")))
    angled = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    fields = [
        ("WARC-Type", F.col("warc_type")),
        ("WARC-Record-ID", angled("record_id")),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To", angled("refers_to")),
        ("WARC-Concurrent-To", angled("concurrent_to")),
        ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length")),
    ]
    return out.withColumn("record", F.concat(head(fields), F.col("block")))


def write(records: DataFrame, path: str) -> None:
    """WARC files below ``path``, one for each task, from a column ``record``."""
    records.select("record").write.option("lineSep", CRLF + CRLF).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``warc_type, record_id, refers_to, target_uri, date, content_type, content_length, block`` of WARC files.

    Files are split at a record's closing blank lines before the next version line. A block whose length is not the one its
    header states gets a null block.
    """
    raw = spark.read.option("lineSep", f"{CRLF}{CRLF}{VERSION}{CRLF}").text(path).select(F.concat(F.lit(CRLF), F.col("value")).alias("value"))
    at = F.locate(CRLF + CRLF, F.col("value"))
    raw = raw.withColumn("_head", F.when(at > 0, F.expr("substring(value, 1, locate('\r\n\r\n', value) - 1)")).otherwise(F.col("value")))
    raw = raw.withColumn("_rest", F.when(at > 0, F.expr("substring(value, locate('\r\n\r\n', value) + 4)")).otherwise(""))
    field = lambda k: F.nullif(F.regexp_extract("_head", rf"(?i)\r\n{k}:\s*<?([^\r\n>]*)", 1), F.lit(""))
    size = field("Content-Length").try_cast("long")
    tail = F.octet_length("_rest") - size  # the last record of a file still has its blank lines
    block = F.when(tail == 0, F.col("_rest")).when((tail == 4) & F.endswith("_rest", F.lit(CRLF + CRLF)), F.expr("left(_rest, length(_rest) - 4)"))
    names = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type"}
    return raw.where("value <> '\r\n'").select(*[field(v).alias(k) for k, v in names.items()], size.alias("content_length"), block.alias("block"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(responses(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    return rows.select(
        "page_id", "warc_type", "record_id", "concurrent_to", "refers_to", "target_uri", "content_length", "block_digest", "source_digest", "payload_digest"
    )


def _sql() -> str:
    """The query in DuckDB's SQL; patterns and names are the constants above."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    names = ", ".join(f"{q(f'&{k};')}: chr({v})" for k, v in NAMED.items())
    code = (
        "try_cast(case when lower(substr(r, 1, 3)) = '&#x' then "
        "case when regexp_matches(r, '^&#[xX][0-9A-Fa-f]{1,6};$') then '0x' || substr(r, 4, length(r) - 4) end "
        "else nullif(regexp_extract(r, '^&#([0-9]{1,7});$', 1), '') end as bigint)"
    )
    char = (
        f"case when r = '' then r when substr(r, 2, 1) = '#' then case when {code} between 1 and 55295 or {code} between 57344 and 1114111 "
        f"then chr(cast({code} as integer)) else r end else coalesce((map {{{names}}})[r], r) end"
    )
    def decode(x):
        parts = f"regexp_split_to_array({x}, {q(REFERENCE)})"
        refs = f"list_concat([''], regexp_extract_all({x}, {q(REFERENCE)}))"
        return f"array_to_string(list_transform(list_zip({refs}, {parts}), lambda z : (list_transform([z[1]], lambda r : {char}))[1] || z[2]), '')"
    uuid = lambda kind, *p: (
        f"(list_transform([sha256(concat_ws(chr(10), {q(kind)}, {', '.join(p)}))], lambda h : 'urn:uuid:' || h[1:8] || '-' || h[9:12] || '-8' || h[13:15] || '-a' || h[16:18] || '-' || h[19:30]))[1]"
    )
    nl = "chr(13) || chr(10)"
    one = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'), ' ')"
    bare = lambda x: f"case when {x}[1] in (chr(34), chr(39)) then {x}[2:length({x}) - 1] else {x} end"
    kept = lambda name, x: f"list_transform(list_filter([{x}], lambda x : x <> ''), lambda x : '{name}: ' || x)"
    return f"""
with p as (
  select page_id, url, coalesce(html, '') as html from pages),
s as (
  select *, {uuid('response', "coalesce(cast(page_id as varchar), '')", "coalesce(url, '')", 'html')} as refers_to,
    ['HTTP/1.1 200 OK', 'Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(html)] as http,
    regexp_replace(regexp_replace(regexp_replace(html, {q(HIDDEN)}, '', 'g'), {q(BLOCK)}, chr(10), 'g'), {q(TAG)}, '', 'g') as bare
  from p),
d as (
  select *, 'sha256:' || sha256(array_to_string(http, {nl}) || {nl} || {nl} || html) as source_digest,
    'sha256:' || sha256(html) as payload_digest,
    trim(regexp_replace(regexp_replace({decode('bare')}, {q(BLANKS)}, ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10)) as text
  from s),
m as (
  select *, array_to_string(list_concat(
      list_transform(http, lambda x : 'source-header: ' || x),
      ['source-block-digest: ' || source_digest, 'source-payload-digest: ' || payload_digest],
      {kept('title', f"(list_transform([{one(f'regexp_extract(html, {q(TITLE)}, 1)')}], lambda t : {decode('t')}))[1]")},
      {kept('language', f"(list_transform([regexp_extract(html, {q(LANGUAGE)}, 1)], lambda t : {one(bare('t'))}))[1]")},
      list_transform(regexp_extract_all(html, {q(LINK)}, 1), lambda x : 'outlink: ' || {one(bare('x'))})), {nl}) || {nl} as about,
    {uuid('metadata', 'refers_to')} as meta_id, {uuid('conversion', 'refers_to')} as conv_id
  from d)
select page_id, 'metadata' as warc_type, meta_id as record_id, conv_id as concurrent_to, refers_to, url as target_uri,
  strlen(about) as content_length, 'sha256:' || sha256(about) as block_digest, source_digest, payload_digest from m
union all
select page_id, 'conversion', conv_id, meta_id, refers_to, url, strlen(text), 'sha256:' || sha256(text), source_digest, payload_digest from m
"""


SQL = _sql()
