"""Dropping boilerplate lines by their frequency within a site.

A line's frequency is the number of its host's pages that hold it, over
the number of the host's pages; a line on more than ``ratio`` of them, and
on ``min_pages`` at least, is boilerplate there and is dropped from every
page of that host.  Pages with the same text count as one page, so that
mirrors of a page don't make its lines boilerplate.

Plan: lines are counted as 64-bit hashes per host (two partial
aggregations, no window, no list of a line's pages).  A host has fewer
boilerplate lines than its mean number of lines a page over ``ratio``, so
they fit in one array per host.  That table is written once; its size
decides whether the join with the documents is broadcast, and otherwise
Spark splits the join's hot hosts.  Two lines of one host share a hash with
a chance of 2^-64 a pair.

Defined results: lines are compared without spaces at either end; lines
that are then empty are never dropped; a null text stays null and is no
page; a null host counts as the empty host; repeated rows are one page and
all come back; with every line dropped the text is empty; other columns
are carried untouched, also those whose names the operator uses itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import col, stage

RATIO = 0.05
MIN_PAGES = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(
    df: DataFrame, host_col: str, text_col: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """host, lines (array of line hashes): what to drop, one row a host."""
    pages = df.select(
        F.coalesce(col(host_col).cast("string"), F.lit("")).alias("host"), col(text_col).cast("string").alias("text")
    ).where("text is not null")
    pages = pages.select("host", "text", F.xxhash64("text").alias("page"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _key))
    lines = pages.select("host", "page", F.explode(keys).alias("line"))
    on = lines.groupBy("host", "line").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= min_pages)
    total = pages.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    return (
        on.join(total, "host")
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def drop_boilerplate(
    df: DataFrame,
    host_col: str,
    text_col: str,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    dropped_col: str | None = None,
) -> DataFrame:
    """``df`` with the boilerplate lines gone from the text; with
    ``dropped_col``, also the number of lines dropped from each row."""
    drop = stage(boilerplate(df, host_col, text_col, ratio, min_pages), "boilerplate-lines")
    whole = df.select(
        F.struct("*").alias("row"),
        F.coalesce(col(host_col).cast("string"), F.lit("")).alias("host"),
        col(text_col).cast("string").alias("text"),
    )
    joined = whole.join(drop, "host", "left")
    kept = F.filter(_lines(F.col("text")), lambda x: ~F.array_contains(F.col("lines"), _key(x)) | (F.trim(x) == ""))
    untouched = F.col("lines").isNull() | F.col("text").isNull()
    done = joined.select(
        "row",
        F.when(untouched, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
        F.when(untouched, F.lit(0)).otherwise(F.size(_lines(F.col("text"))) - F.size(kept)).cast("long").alias("gone"),
    )
    out = [F.col("kept_text" if c == text_col else f"row.`{c}`").alias(c) for c in df.columns]
    return done.select(*out, *([F.col("gone").alias(dropped_col)] if dropped_col else []))


ORACLE = f"""
WITH pages AS (
  SELECT DISTINCT coalesce(source, '') AS host, text FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT DISTINCT host, text, trim(l, ' ') AS line
  FROM (SELECT host, text, unnest(string_split(text, chr(10))) AS l FROM pages)
), total AS (
  SELECT host, count(*) AS pages FROM pages GROUP BY host
), dropped AS (
  SELECT host, line FROM lines JOIN total USING (host) WHERE line <> ''
  GROUP BY host, line, pages HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * pages
), split AS (
  SELECT doc_id, n, host, generate_subscripts(parts, 1) AS i, unnest(parts) AS l
  FROM (SELECT doc_id, coalesce(source, '') AS host, string_split(text, chr(10)) AS parts,
               row_number() OVER () AS n
        FROM documents WHERE text IS NOT NULL)
), marked AS (
  SELECT s.*, d.line IS NOT NULL AS gone
  FROM split s LEFT JOIN dropped d ON s.host = d.host AND trim(s.l, ' ') = d.line
)
SELECT doc_id, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
       CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped
FROM marked GROUP BY doc_id, n
UNION ALL
SELECT doc_id, NULL, 0 FROM documents WHERE text IS NULL
"""
