"""Boilerplate lines by how often a site repeats them.

A line is boilerplate on a host when it is repeated, on ``min_pages`` pages of the host at least, and they make up
more than ``max_ratio`` of the host's pages. Lines are counted and found by hashes; the texts are shuffled once, when
pages meet the lines that they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadlake.llm.common import cut, free_name


#: Characters that do not tell two lines apart at their ends.
BLANK = "".join(map(chr, range(0x21)))


def split_lines(text: Column, separator: str) -> Column:
    """Lines of a text, as they stand; a null text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), separator, -1)


def _key(line: Column) -> Column:
    """What makes two lines the same: 128-bit hash of the line without outer blanks; null for blank lines."""
    trimmed = F.btrim(line, F.lit(BLANK))
    return F.when(trimmed != "", F.unhex(F.md5(trimmed)))


def _whole(text: Column) -> Column:
    """128-bit hash of a whole text; a null text is the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def page_lines(docs: DataFrame, host: Column, id_col: str, text_col: str, separator: str, copies_once: bool = False) -> DataFrame:
    """Columns ``id``, ``host`` and ``key``: each line of a page once. A null host is the empty host.

    With ``copies_once`` a column ``whole`` tells the texts apart.
    """
    keys = F.array_distinct(F.transform(split_lines(F.col(text_col), separator), _key))
    whole = [_whole(F.col(text_col)).alias("whole")] if copies_once else []
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(host, F.lit("")).alias("host"), *whole, F.explode(keys).alias("key"))
    return rows.where("key is not null")


def boilerplate(lines: DataFrame, totals: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """Host and key of the lines that at least ``min_pages`` pages and more than ``max_ratio`` of their host's contain."""
    shares = lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    return shares.join(totals, "host").where(F.col("pages") > F.lit(max_ratio) * F.col("total")).select("host", "key")


def drop_boilerplate(
    docs: DataFrame,
    host: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    separator: str = "\n",
    max_ratio: float = 0.1,
    min_pages: int = 2,
    max_loss: float = 1.0,
    joiner: str = "\n",
    copies_once: bool = False,
) -> DataFrame:
    """``docs`` without the boilerplate lines of each host; same rows and columns.

    ``separator`` is a regular expression, ``joiner`` what kept lines are joined with. Pages that lose no line
    keep their text untouched. A page that would lose more than ``max_loss`` of the characters
    of its lines is kept whole. With ``copies_once`` pages of a host with one whole text count as one page, so that
    a text is no boilerplate because it is copied, and its copies stay for another stage to find.

    A page counts once however often it repeats a line. Null and empty texts have no line and
    stay, and count as pages of their host. Ids must tell pages with different lines apart; repeated rows each
    count as a page (save with ``copies_once``) and stay repeated. Rows with a null id count too, but stay as they are.
    """
    lines = cut(page_lines(docs, host, id_col, text_col, separator, copies_once))
    pages, counted = docs.select(F.coalesce(host, F.lit("")).alias("host"), _whole(F.col(text_col)).alias("whole")), lines
    if copies_once:
        pages, counted = pages.distinct(), lines.select("host", "key", "whole").distinct()
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    hits = lines.join(boilerplate(counted, totals, max_ratio, min_pages), ["host", "key"])
    page, keys = free_name(docs, "hit_page"), free_name(docs, "hit_keys")
    # A page's distinct lines bound this set.
    hits = hits.where("id is not null").groupBy(F.col("id").alias(page)).agg(F.collect_set("key").alias(keys))
    whole = split_lines(F.col(text_col), separator)
    kept = F.filter(whole, lambda line: ~F.coalesce(F.array_contains(F.col(keys), _key(line)), F.lit(False)))
    drops = F.col(keys).isNotNull()
    if max_loss < 1:
        size = lambda part: F.aggregate(part, F.lit(0), lambda n, line: n + F.length(line))
        drops = drops & (size(kept) >= (1 - max_loss) * size(whole))
    cleaned = F.when(drops, F.array_join(kept, joiner)).otherwise(F.col(text_col))
    joined = docs.join(hits, F.col(id_col) == F.col(page), "left")
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns])
