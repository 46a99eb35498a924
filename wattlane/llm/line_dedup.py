"""Line deduplication by site-relative frequency: lines on too many of a site's pages are boilerplate.

Only DataFrame functions. The counting pass shuffles one digest per distinct
line of a page, pre-aggregated before the shuffle; texts are never shuffled:
each site's boilerplate is one array, joined to the pages (broadcast when
Spark's own size limit allows it, else a join that splits hot sites).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import stage


@dataclass(frozen=True)
class LineDedupConfig:
    """A line goes when more than ``max_ratio`` of its site's pages, and at least ``min_pages`` of them, hold it."""

    max_ratio: float = 0.1
    min_pages: int = 3


BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """What makes two lines equal: the digest of the line without outer blanks."""

    return F.md5(F.btrim(line, F.lit(BLANKS)))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def boilerplate_lines(pages: DataFrame, site: str, text: str, cfg: LineDedupConfig | None = None) -> DataFrame:
    """(site, line_key, pages, site_pages) of every line above the ratio; at most lines-per-page / max_ratio a site.

    Each row of ``pages`` is a page; a line counts once a page. Rows with a
    null site form one site; null texts count as pages without lines.
    """

    cfg = cfg or LineDedupConfig()
    pages = pages.select(F.col(site).alias("site"), F.col(text).alias("text"))
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    lines = F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(BLANKS))))
    counts = (
        pages.select("site", F.explode(lines).alias("line")).where("line != ''")
        .groupBy("site", F.md5("line").alias("line_key")).agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= cfg.min_pages)
    )
    found = counts.join(totals.withColumnRenamed("site", "total_site"), F.col("site").eqNullSafe(F.col("total_site")))
    return found.where(F.col("pages") > cfg.max_ratio * F.col("site_pages")).drop("total_site")


def dedup_lines(pages: DataFrame, site: str = "source", text: str = "text",
                cfg: LineDedupConfig | None = None) -> DataFrame:
    """``row`` (all of the page's columns, unchanged), n_lines, n_dropped and the cleaned ``text``.

    One row per page, repeated rows included. Blank lines always stay; a page
    of boilerplate alone keeps an empty text; a null text stays null with no
    lines. An empty table gives an empty result.
    """

    found = boilerplate_lines(pages, site, text, cfg)
    by_site = stage(found.groupBy(F.col("site").alias("at")).agg(F.collect_list("line_key").alias("bad")), "boilerplate")
    rows = pages.select(F.struct("*").alias("row"), F.col(site).alias("site"), F.col(text).alias("whole"))
    joined = rows.join(by_site, F.col("site").eqNullSafe(F.col("at")), "left")
    lines = _lines(F.col("whole"))
    kept = F.when(F.col("bad").isNull(), lines).otherwise(
        F.filter(lines, lambda x: _blank(x) | ~F.array_contains(F.col("bad"), _key(x))))
    sized = joined.select("row", "whole", F.coalesce(F.size(lines), F.lit(0)).alias("n_all"), kept.alias("kept"))
    n_lines = F.when(F.col("whole").isNull(), 0).otherwise(F.col("n_all"))
    n_kept = F.when(F.col("whole").isNull(), 0).otherwise(F.size("kept"))
    return sized.select(
        "row",
        n_lines.cast("long").alias("n_lines"),
        (n_lines - n_kept).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


def drop_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", length: str = "n_chars",
                     cfg: LineDedupConfig | None = None) -> DataFrame:
    """The documents, with all their columns, their boilerplate lines dropped and ``length``, if there, counted anew."""

    found = dedup_lines(docs, site, text, cfg)
    new = {text: F.col("text")} | ({length: F.length("text").cast("long")} if length in docs.columns else {})
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
