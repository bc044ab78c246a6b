"""Removal of boilerplate: lines that a large share of a site's pages carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.session import checkpointed

#: A line goes if more than this share of the pages of its host have it, and at least so many pages.
RATIO, MIN_PAGES = 0.05, 3
#: Boilerplate lines that are sent to every executor; more are joined by host.
BROADCAST_LINES = 100_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """Two 64-bit hashes that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) == ""


def boilerplate(docs: DataFrame, host: Column, text: Column, ratio: float, min_pages: int) -> DataFrame:
    """(host, drop): per host the keys of its boilerplate lines.

    A page counts once for each different line. A host's lines are at most its mean number of lines a page divided
    by `ratio`, so they fit one row whatever the number of its pages.
    """
    pages = docs.groupBy(host.alias("host")).agg(F.count("*").alias("pages"))
    lines = docs.select(host.alias("host"), F.explode(F.array_distinct(_lines(text))).alias("line"))
    having = lines.filter(~_blank(F.col("line"))).select("host", _key(F.col("line")).alias("key")) \
        .groupBy("host", "key.a", "key.b").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    often = having.join(pages, having.host.eqNullSafe(pages.host)).drop(pages.host) \
        .filter(F.col("n") > F.lit(ratio) * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("drop"))


def without_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The documents with `text` rid of boilerplate, and the columns n_lines and n_dropped.

    A line is what stands between newlines. It goes from every page of a host if more than `ratio` of the host's
    pages, and `min_pages` at least, have it; blank lines stay. Pages are rows, repeated ones too. Rows without a
    host are one host's. A null text stays null and has no lines. A text may become empty; its row stays. Columns of
    `docs` named n_lines or n_dropped are replaced; other names do no harm.
    """
    found = checkpointed(boilerplate(docs, F.col(host), F.col(text), ratio, min_pages), "lines")
    n_lines = found.agg(F.sum(F.size("drop"))).first()[0] or 0
    lead = "_" * (1 + max(map(len, docs.columns)))
    site, kept = lead + "site", lead + "kept"
    found = found.select(F.struct("host", "drop").alias(site))
    rows = docs.join(
        F.broadcast(found) if n_lines <= BROADCAST_LINES else found, F.col(host).eqNullSafe(F.col(f"{site}.host")), "left")
    drop = F.coalesce(f"{site}.drop", F.array().cast("array<struct<a:bigint,b:bigint>>"))
    lines = _lines(F.col(text))
    rows = rows.withColumn(kept, F.when(
        F.size(drop) > 0, F.filter(lines, lambda x: _blank(x) | ~F.array_contains(drop, _key(x)))).otherwise(lines))
    return rows.select(
        *[F.array_join(kept, "\n").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("bigint").alias("n_dropped"))
