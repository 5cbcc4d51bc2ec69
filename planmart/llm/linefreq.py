"""Site-relative line frequency: drop lines that stand on too large a share of a host's pages.

DataFrame functions only.  Per page, distinct lines become pairs of 64-bit
hashes; counts per (host, line) are combined before the shuffle, so neither a
hot host nor a very common line gathers in one task.  What is joined back is
one row per host with its boilerplate lines: at most (mean distinct lines per
page of that host) / max_ratio of them, however many pages the host has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.llm.common import written

MAX_RATIO = 0.1
MIN_PAGES = 2           # a line on a single page isn't repeated at all


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """Two independent XXH64 values of the trimmed line: equal lines only, for all practical sizes."""
    trimmed = F.trim(line)
    return F.struct(F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit(7), trimmed).alias("h2"))


def boilerplate(pages: DataFrame, host: str, text: str,
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the keys of each host's lines on more than `max_ratio` of its pages.

    Blank lines are never boilerplate; a line on fewer than `min_pages` pages
    isn't either, so a line must be repeated to go.  NULL is a host of
    its own; pages without text count in the host's total.
    """
    rows = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(
        F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _key))
    found = (rows.select("host", F.explode(keys).alias("line"))
             .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_pages))
    return (found.join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
            .where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
            .groupBy("host").agg(F.collect_list("line").alias("lines")))


def drop_boilerplate(pages: DataFrame, host: str, text: str,
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """`pages` with `text` cut down to the lines that aren't boilerplate of their host,
    and with n_lines and n_dropped (lines of the page, lines dropped; blank ones count).

    Every row stays, also one whose lines all go (its text is then empty).  NULL
    texts stay NULL with zero lines.  Repeated rows count as pages each.
    Columns named n_lines or n_dropped before are replaced.  `pages` is read
    twice: hand in a table, or written rows where their text is costly to make.
    """
    # written, so that its size is known: while it is small the texts needn't move to their hosts
    bad = written(boilerplate(pages, host, text, max_ratio, min_pages).toDF("of", "bad"))
    names = [c for c in pages.columns if c.lower() not in ("n_lines", "n_dropped")]
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    site, body = f"c{names.index(host)}", f"c{names.index(text)}"
    lines = _lines(F.col(body))
    kept = F.when(F.col("bad").isNull(), lines).otherwise(
        F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("bad"), _key(x))))
    rows = rows.join(bad, F.col(site).eqNullSafe(F.col("of")), "left").withColumn("kept", kept)
    size = F.when(F.col(body).isNull(), 0).otherwise(F.size(lines)).cast("long")
    left = F.when(F.col(body).isNull(), 0).otherwise(F.size("kept")).cast("long")
    return rows.select(*[F.array_join("kept", "\n").alias(c) if c == text else F.col(f"c{i}").alias(c)
                         for i, c in enumerate(names)],
                       size.alias("n_lines"), (size - left).alias("n_dropped"))


def url_host(url: Column) -> Column:
    """The host of a URL, lower case, without port; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Visible lines of a page: scripts, styles, heads and comments go, block tags end a line."""
    text = F.regexp_replace(html, r"(?is)<(?:script|style|head)\b.*?</(?:script|style|head)>|<!--.*?-->", "")
    text = F.regexp_replace(text, r"[\s]+", " ")
    text = F.regexp_replace(text, r"(?i)</?(?:p|div|br|li|ul|ol|nav|article|section|table|tr|td|h[1-6]|header|footer|html|body)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.regexp_replace(text, r" *\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def page_lines(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) as page_id, host, text."""
    return pages.select("page_id", url_host(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))


ORACLE_SQL = rf"""
WITH p0 AS (
  SELECT page_id,
    coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), '') AS host,
    regexp_replace(html, '(?is)<(?:script|style|head)\b.*?</(?:script|style|head)>|<!--.*?-->', '', 'g') AS t0,
    row_number() OVER () AS rid
  FROM pages),
p1 AS (SELECT page_id, host, rid, regexp_replace(t0, '[\s]+', ' ', 'g') AS t1 FROM p0),
p2 AS (SELECT page_id, host, rid, regexp_replace(t1, '(?i)</?(?:p|div|br|li|ul|ol|nav|article|section|table|tr|td|h[1-6]|header|footer|html|body)\b[^>]*>', chr(10), 'g') AS t2 FROM p1),
p3 AS (SELECT page_id, host, rid, regexp_replace(regexp_replace(t2, '<[^>]*>', '', 'g'), ' *\n[ \n]*', chr(10), 'g') AS t3 FROM p2),
p4 AS (SELECT page_id, host, rid, regexp_replace(t3, '^[ \n]+|[ \n]+$', '', 'g') AS text FROM p3),
p5 AS (SELECT page_id, host, rid, string_split(text, chr(10)) AS ls FROM p4),
l AS (SELECT rid, page_id, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM p5),
t AS (SELECT host, count(*) AS pages FROM p4 GROUP BY host),
c AS (SELECT host, trim(line) AS line, count(DISTINCT rid) AS n FROM l WHERE trim(line) <> '' GROUP BY ALL),
bad AS (SELECT c.host, c.line FROM c JOIN t USING (host) WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO}::DOUBLE * pages),
k AS (SELECT l.rid, string_agg(l.line, chr(10) ORDER BY pos) AS text, count(*) AS n
      FROM l WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.host = l.host AND bad.line = trim(l.line)) GROUP BY l.rid)
SELECT p5.page_id, p5.host,
  CASE WHEN p5.ls IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST(coalesce(len(p5.ls), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(p5.ls), 0) - coalesce(k.n, 0) AS BIGINT) AS n_dropped
FROM p5 LEFT JOIN k USING (rid)
"""
