"""Derived WARC records: from responses to linked metadata and plain-text conversion records.

DataFrame functions, but for character references, which Python's table resolves. A derived record names the response it comes from, repeats that
response's address and date, and carries its payload digest.
"""

from __future__ import annotations

import html as markup_of
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"

# What is cut out of HTML with its content, and what stands for a line break.
HIDDEN = r"(?is)<!--.*?-->|<(?:script|style|template|noscript)\b[^>]*>.*?</(?:script|style|template|noscript)\s*>"
# A tag begins with a letter after the bracket, and a bracket in a quoted attribute does not end it. Nothing is
# ever given back, so a tag that does not end costs no more than its length.
INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
BREAKING = rf"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|body|head|html|blockquote|pre|hr|td|th|form|main|aside)\b{INSIDE}"
ANY_TAG = rf"</?[A-Za-z]{INSIDE}|<[!?][^>]*>"
# What is left where quotes do not match.
LOOSE_TAG = r"</?[A-Za-z][^>]*>"
TITLE = rf"(?is)<title\b{INSIDE}(.*?)</title\s*>"
# HIDDEN and ANY_TAG as Java finds them faster: only a bracket is worth a closer look. The SQL has those above.
QUICK_HIDDEN = r"(?is)<(?:!--.*?-->|(?:script|style|template|noscript)\b[^>]*>.*?</(?:script|style|template|noscript)\s*>)"
QUICK_TAG = rf"<(?:/?[A-Za-z]{INSIDE}|[!?][^>]*>)"
# Runs of blanks that are not one space already.
BLANK_RUN = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"


# A reference in text: decimal, hexadecimal or named, the closing mark optional as in HTML.
REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{1,31};?)")


# White space breaks no line in HTML, nor does it when written as a reference.
BLANKS = str.maketrans("\xa0\t\n\f\r", " " * 5)


def resolve(text: str) -> str:
    """``text`` with each character reference of HTML resolved once, so ``&amp;lt;`` gives ``&lt;``."""
    return REFERENCE.sub(lambda r: markup_of.unescape(r.group()).translate(BLANKS), text) if "&" in text else text


def _resolved(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(resolve, na_action="ignore")


def _plain(markup: Column) -> Column:
    """Character references resolved, blanks collapsed within lines, empty lines gone."""
    markup = F.pandas_udf(_resolved, "string", F.PandasUDFType.SCALAR_ITER)(markup)
    markup = F.regexp_replace(markup, BLANK_RUN, " ")
    return F.btrim(F.regexp_replace(markup, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def html_text(html: Column) -> Column:
    """The visible text of a page, a line for each block."""
    shown = F.regexp_replace(F.regexp_replace(html, QUICK_HIDDEN, ""), r"[\x0A\x0D]+", " ")
    return _plain(_without_tags(F.regexp_replace(shown, BREAKING, "\n")))


def _without_tags(markup: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(markup, QUICK_TAG, ""), LOOSE_TAG, "")


def title(html: Column) -> Column:
    return F.regexp_replace(_plain(_without_tags(F.regexp_extract(html, TITLE, 1))), "\n", " ")


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """An id that depends on the parts only, so that a repeated run writes the same records."""
    h = F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)
    cut = [F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of fetched pages: ``page_id``, ``record_id``, ``target_uri``, ``date``, ``http``, ``payload``, digests.

    A null page counts as an empty one; a null address as an empty one. A record belongs to
    its page id, address and content, so repeated rows give records of the same id.
    """
    url, html = F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("target_uri"), html.alias("payload"))
    length = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length)
    rows = rows.withColumns({"date": F.lit(date), "http": http, "payload_digest": digest(F.col("payload"))})
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    own = record_id(F.lit("response"), number, F.col("target_uri"), F.col("payload_digest"))
    return rows.withColumn("record_id", own)


def derive(found: DataFrame) -> DataFrame:
    """Two records for each response: ``metadata`` and ``conversion``, each with its header and block.

    Both refer to the response; the metadata also name the conversion, and list the HTTP
    header of the source, the title and the length of the text.
    """
    rows = found.withColumns(
        {
            "text": html_text(F.col("payload")),
            "title": title(F.col("payload")),
            "conversion_id": record_id(F.lit("conversion"), F.col("record_id")),
        }
    )
    fields = F.concat_ws(
        CRLF,
        F.concat(F.lit("source-http: "), F.replace(F.col("http"), F.lit(CRLF), F.lit(" | "))),
        F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")),
        F.concat(F.lit("conversion: "), F.col("conversion_id")),
        F.concat(F.lit("title: "), F.col("title")),
        F.concat(F.lit("text-characters: "), F.char_length("text").cast("string")),
    )
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("warc_type"),
            record_id(F.lit("metadata"), F.col("record_id")).alias("own_id"),
            F.lit("application/warc-fields").alias("content_type"),
            F.concat(fields, F.lit(CRLF)).alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("warc_type"),
            F.col("conversion_id").alias("own_id"),
            F.lit("text/plain; charset=utf-8").alias("content_type"),
            F.col("text").alias("block"),
        ),
    )
    records = rows.select("page_id", "record_id", "target_uri", "date", "payload_digest", F.inline(kinds))
    return records.select(
        "page_id",
        "warc_type",
        F.col("own_id").alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        F.col("payload_digest").alias("source_digest"),
        digest(F.col("block")).alias("block_digest"),
        "content_type",
        F.octet_length("block").cast("long").alias("content_length"),
        "block",
    )


def render(records: DataFrame, out: str = "record") -> DataFrame:
    """``records`` with each one as it stands in a file, header, block and closing lines.

    A line break within a header value, as in an address from outside, becomes a blank: a value ends
    with its line. A null value leaves its line out, a null block gives null. Repeated rows stay.
    """
    pairs = [
        ("WARC-Type", "warc_type"),
        ("WARC-Record-ID", "record_id"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "date"),
        ("WARC-Source-Payload-Digest", "source_digest"),
        ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"),
    ]
    lines = [F.concat(F.lit(f"{name}: "), F.regexp_replace(column, r"[\r\n]+", " ")) for name, column in pairs]
    length = F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"))
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines, length)
    return records.withColumn(out, F.concat(head, F.lit(CRLF * 2), F.col("block"), F.lit(CRLF * 2)))


def parse(rendered: DataFrame, column: str = "record") -> DataFrame:
    """Header fields (a map) and block of rendered records, one in each row; null for a null. Other columns go."""
    end = F.instr(F.col(column), CRLF * 2)
    fields = F.slice(F.split(F.substring(F.col(column), F.lit(1), end - 1), CRLF), F.lit(2), F.greatest(F.size(F.split(F.substring(F.col(column), F.lit(1), end - 1), CRLF)) - 1, F.lit(0)))
    keys = F.transform(fields, lambda f: F.substring_index(f, ": ", 1))
    values = F.transform(fields, lambda f: F.substring(f, F.instr(f, ": ") + 2, F.char_length(f)))
    body = F.substring(F.col(column), end + 4, F.char_length(column) - end - 7)
    return rendered.select(F.map_from_arrays(keys, values).alias("header"), body.alias("block"))


def _reference_tables() -> str:
    """Python's table of named references, and the numbers that do not stand for the character of that code, as DuckDB maps."""
    import html.entities

    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    names = ", ".join(f"{quoted(name)}: {quoted(value)}" for name, value in html.entities.html5.items())
    # Control characters and codes that are no characters are all below 160, in one block, or at the end of a plane.
    codes = [*range(160), *range(0xFDD0, 0xFDF0), *(plane * 0x10000 + last for plane in range(17) for last in (0xFFFE, 0xFFFF))]
    other = {code: markup_of.unescape(f"&#{code};") for code in codes}
    numbers = ", ".join(f"{code}: {quoted(value)}" for code, value in other.items() if value != chr(code))
    return f"SELECT MAP {{{names}}} AS names, MAP {{{numbers}}} AS numbers"


def _resolved_sql(text: str) -> str:
    """``resolve`` in DuckDB: a text is cut at references, each is looked up, and the pieces are joined again."""
    pieces = f"regexp_extract_all({text}, '{REFERENCE.pattern}|[^&]+|&')"
    code = """CASE WHEN p[3] IN ('x', 'X') THEN TRY_CAST('0x' || rtrim(p[4:], ';') AS BIGINT) ELSE TRY_CAST(rtrim(p[3:], ';') AS BIGINT) END"""
    lone = "coalesce(n, 1114112) > 1114111 OR n BETWEEN 55296 AND 57343"
    number = f"list_transform([{code}], lambda n: coalesce(numbers[n], CASE WHEN {lone} THEN chr(65533) ELSE chr(n::INT) END))[1]"
    # A name that is not known as a whole may begin with one that is.
    start = "list_filter(list_transform(range(len(p) - 2, 1, -1), lambda k: names[p[2:k + 1]] || p[k + 2:]), lambda x: x IS NOT NULL)[1]"
    found = f"CASE WHEN p[2] = '#' THEN {number} ELSE coalesce(names[p[2:]], {start}, p) END"
    found = f"translate({found}, chr(160) || chr(9) || chr(10) || chr(12) || chr(13), '     ')"
    return f"array_to_string(list_transform({pieces}, lambda p: CASE WHEN len(p) > 1 AND p[1] = '&' THEN {found} ELSE p END), '')"


def oracle(date: str) -> str:
    """The query over ``pages`` in DuckDB, with the same expressions spelled in its functions."""
    uuid = lambda h: f"'<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] || '-' || {h}[21:32] || '>'"

    def plain(x: str) -> str:
        x = _resolved_sql(x)
        x = rf"regexp_replace({x}, '[\x20\x09\x0B-\x0D]+', ' ', 'g')"
        x = rf"regexp_replace({x}, ' ?\n[ \n]*', chr(10), 'g')"
        return rf"regexp_replace({x}, '\A[ \n]+|[ \n]+\z', '', 'g')"

    shown = rf"regexp_replace(regexp_replace(payload, '{HIDDEN}', '', 'g'), '[\x0A\x0D]+', ' ', 'g')"
    # DuckDB's expressions never go back, and have no marks for that.
    quoted = lambda pattern: pattern.replace("'", "''").replace("++", "+").replace("*+", "*")
    untagged = lambda x: f"regexp_replace(regexp_replace({x}, '{quoted(ANY_TAG)}', '', 'g'), '{LOOSE_TAG}', '', 'g')"
    body = untagged(f"regexp_replace({shown}, '{quoted(BREAKING)}', chr(10), 'g')")
    head = untagged(f"regexp_extract(payload, '{quoted(TITLE)}', 1)")
    return f"""
        WITH r AS (
            SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
                   'sha256:' || sha256(coalesce(html, '')) AS source_digest, names, numbers FROM pages, ({_reference_tables()})
        ), i AS (
            SELECT *, sha256('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || target_uri || '|' || source_digest) AS h,
                   {plain(body)} AS text, replace({plain(head)}, chr(10), ' ') AS title
            FROM r
        ), d AS (
            SELECT *, {uuid("h")} AS response_id, chr(13) || chr(10) AS crlf FROM i
        ), c AS (
            SELECT *, sha256('conversion|' || response_id) AS c, sha256('metadata|' || response_id) AS m FROM d
        ), g AS (
            SELECT page_id, 'metadata' AS warc_type, {uuid("m")} AS record_id, response_id AS refers_to, target_uri, source_digest,
                   'application/warc-fields' AS content_type,
                   'source-http: HTTP/1.1 200 OK | Content-Type: text/html; charset=utf-8 | Content-Length: ' || strlen(payload) || crlf
                   || 'source-payload-digest: ' || source_digest || crlf || 'conversion: ' || {uuid("c")} || crlf
                   || 'title: ' || title || crlf || 'text-characters: ' || length(text) || crlf AS block
            FROM c
            UNION ALL
            SELECT page_id, 'conversion', {uuid("c")}, response_id, target_uri, source_digest, 'text/plain; charset=utf-8', text FROM c
        )
        SELECT page_id, warc_type, record_id, refers_to, target_uri, '{date}' AS date, source_digest,
               'sha256:' || sha256(block) AS block_digest, content_type, strlen(block) AS content_length, block
        FROM g
    """
