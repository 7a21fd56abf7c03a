"""File listings in HTML: parse them and choose the files that need fetching again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.columns import file_number, utc_instant

CELLS = 5
METADATA_DIR = "match_metadata"


def _text(html: Column) -> Column:
    """Text of an HTML fragment: tags out, the common entities decoded, trimmed."""
    plain = F.regexp_replace(html, "<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(plain, r"^\s+|\s+$", ""))


def listing_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per table row of the striped listing table, its cells in ``cells``.

    A page without the table, or a row without five cells, stops the job.
    """
    keep = [F.col(c) for c in pages.columns if c != html]
    table = F.regexp_extract(html, r'(?is)<table[^>]*class="[^"]*\bstriped\b[^"]*"[^>]*>(.*?)</table>', 1)
    body = F.regexp_extract(table, r"(?is)<tbody[^>]*>(.*?)</tbody>", 1)
    rows = F.regexp_extract_all(
        F.when(F.regexp_like(table, F.lit("(?is)<tbody")), body).otherwise(F.raise_error(F.lit("no listing table"))),
        F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"),
        1,
    )
    cells = F.regexp_extract_all("_row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)
    return pages.select(*keep, F.explode(rows).alias("_row")).select(
        *keep,
        F.when(F.size(cells) == CELLS, cells).otherwise(F.raise_error(F.lit("a listing row has five cells"))).alias("cells"),
    )


def parse_listing(pages: DataFrame, html: str = "html") -> DataFrame:
    """Files and folders of listing pages: is_dir, name, bytes, modified (UTC instant), href."""
    rows = listing_rows(pages, html)
    cell = [F.col("cells")[i] for i in range(CELLS)]
    without_icon = F.regexp_replace(cell[0], r"(?is)<i\b[^>]*>.*?</i>", "")
    return rows.select(
        *[c for c in rows.columns if c != "cells"],
        F.startswith(_text(cell[0]), F.lit("folder")).alias("is_dir"),
        _text(without_icon).alias("name"),
        F.split_part(_text(cell[1]), F.lit(" "), F.lit(1)).try_cast("bigint").alias("bytes"),
        utc_instant(_text(cell[3])).alias("modified"),
        F.nullif(F.regexp_extract(cell[4], r'(?is)<a\b[^>]*href="([^"]*)"', 1), F.lit("")).alias("href"),
    )


def entered(wanted: str = METADATA_DIR) -> Column:
    """Whether a fetch goes into a row of a listing: a folder with the wanted name."""
    return F.col("is_dir") & (F.col("name") == wanted)


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per list item that holds a plain link: its position, target and text."""
    keep = [F.col(c) for c in pages.columns if c != html]
    pattern = r'<li><a href="([^"]*)">([^<]*)</a></li>'
    targets = F.regexp_extract_all(html, F.lit(pattern), 1)
    texts = F.regexp_extract_all(html, F.lit(pattern), 2)
    links = F.arrays_zip(targets.alias("href"), texts.alias("text"))
    rows = pages.select(*keep, F.posexplode(links).alias("position", "_link"))
    return rows.select(*keep, "position", "_link.href", "_link.text")


def select_stale(
    remote: DataFrame, local: DataFrame, allow: list[str], id_range: range, slack: str = "1 minute"
) -> DataFrame:
    """Remote files to fetch: wanted by name (top folder) or number (metadata folder), and missing
    locally or newer than the local copy by ``slack`` or more. A wanted file that exists locally but
    whose time on either side is unknown stops the job.

    ``remote`` has name, modified and in_metadata; ``local`` has name and modified. ``id_range`` counts up.
    """
    number = file_number(F.col("name"))
    in_range = number.between(id_range.start, id_range.stop - 1) & ((number - id_range.start) % id_range.step == 0)
    wanted = F.when(F.col("in_metadata"), in_range).otherwise(F.col("name").isin(list(allow)))
    mine = local.select("name", F.col("modified").alias("_local"), F.lit(True).alias("_here"))
    fresh = F.col("modified") - F.col("_local") < F.expr(f"INTERVAL '{slack.split()[0]}' {slack.split()[1]}")
    unknown = F.raise_error(F.concat(F.lit("no readable time for "), F.col("name"))).cast("boolean")
    stale = F.when(F.col("_here").isNull(), F.lit(True)).otherwise(F.coalesce(~fresh, unknown))
    return (
        remote.where(F.coalesce(wanted, F.lit(False)))
        .join(mine, "name", "left")
        .where(stale)
        .drop("_local", "_here")
    )
