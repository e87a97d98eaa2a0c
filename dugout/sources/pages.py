"""Links and tables of stored web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import baseball as rules

_HREF = r'<a\s[^>]*?href="([^"]*)"'


def links(pages: DataFrame, key: str, url: str, html: str, prefix: str = "") -> DataFrame:
    """(key, pos, href, resolved) of the links that start with a prefix, in page order."""
    found = pages.select(key, url, F.posexplode(F.regexp_extract_all(html, F.lit(_HREF), F.lit(1))).alias("pos", "href"))
    site = F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1)
    folder = F.regexp_extract(url, r"^([a-z]+://[^/?#]+(?:/[^?#]*/|/?))", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    resolved = (
        F.when(F.col("href").rlike("^[a-z]+://"), F.col("href"))
        .when(F.col("href").startswith("//"), F.concat(F.regexp_extract(url, "^([a-z]+:)", 1), F.col("href")))
        .when(F.col("href").startswith("/"), F.concat(site, F.col("href")))
        .when(F.col("href").startswith("#"), F.concat(F.regexp_replace(url, "#.*$", ""), F.col("href")))
        .otherwise(F.concat(folder, F.col("href")))
    )
    return found.filter(F.col("href").startswith(prefix)).select(key, "pos", "href", resolved.alias("resolved"))


def url_parts(url: Column) -> dict[str, Column]:
    """Host, first path part and the last number in the path."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    return {
        "host": F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1),
        "first_part": F.regexp_extract(path, r"^/([^/]*)", 1),
        "number": F.regexp_extract(path, r"(\d+)/?$", 1).try_cast("bigint"),
    }


def sections(html: Column, heading_open: str, item: str) -> Column:
    """Array of (heading_no, heading, items) where the items follow their heading.

    ``heading_open`` is the text that starts a heading; the heading is the first text in it.  ``item`` is
    a pattern with one group.  Everything happens inside the row, so a page never has to be regrouped.
    """
    parts = F.split(html, heading_open)
    return F.transform(
        parts,
        lambda part, i: F.struct(
            i.alias("heading_no"),
            F.when(i > 0, F.regexp_extract(part, r"^[^>]*>(?:<[^>]*>)*([^<]*)", 1)).alias("heading"),
            F.regexp_extract_all(part, F.lit(item), F.lit(1)).alias("items"),
        ),
    )


def section_rows(pages: DataFrame, key: str, html: str, heading_open: str, item: str) -> DataFrame:
    """One row per item with its heading."""
    opened = pages.select(key, F.explode(sections(F.col(html), heading_open, item)).alias("s"))
    return opened.select(key, "s.heading_no", "s.heading", F.posexplode("s.items").alias("pos", "item"))


def section_status(heading: Column) -> Column:
    return (
        F.when(heading.isin(*rules.ACTIVE_SECTIONS), "Active")
        .when(heading.isin(*rules.INACTIVE_SECTIONS), "Inactive")
        .otherwise("Unknown")
    )


def roster_rows(pages: DataFrame, team: str, html: str) -> DataFrame:
    """Player rows (section, number, name, position, active) of a roster page."""
    rows = section_rows(pages, team, html, '<tr class="stathead"', r'<tr class="(?:odd|even)row player[^"]*"[^>]*>(.*?)</tr>')

    def cell(i: int) -> Column:
        cells = F.regexp_extract_all("item", F.lit(r"<td[^>]*>(.*?)</td>"), F.lit(1))
        return F.regexp_replace(F.get(cells, i), "<[^>]*>", "")

    heading = F.trim("heading")
    return rows.select(
        team, heading.alias("section"), cell(0).alias("number"), cell(1).alias("name"), cell(2).alias("position"),
        section_status(heading).alias("active"),
    )


def game_file_links(games: DataFrame, address: str, names: tuple[str, ...]) -> DataFrame:
    """One row per game and wanted file with its full address."""
    return games.withColumn("file_name", F.explode(F.array(*[F.lit(n) for n in names]))).withColumn(
        "file_address", F.concat_ws("/", F.rtrim(F.col(address), F.lit("/")), "file_name")
    )


def inclusive_range(links_: DataFrame, order: str, address: str, start: str, stop: str) -> DataFrame:
    """Addresses from the first one that meets ``start`` to the first one that meets ``stop``, both included.

    Two addresses meet when one contains the other, as deeper links do.  Without a start nothing is kept.
    """

    def meets(boundary: str) -> Column:
        return F.contains(F.col(address), F.lit(boundary)) | F.contains(F.lit(boundary), F.col(address))

    ends = links_.agg(
        F.min(F.when(meets(start), F.col(order))).alias("lo"), F.min(F.when(meets(stop), F.col(order))).alias("hi")
    ).first()
    if ends["lo"] is None:
        return links_.limit(0)
    kept = links_.filter(F.col(order) >= F.lit(ends["lo"]))
    return kept if ends["hi"] is None else kept.filter(F.col(order) <= F.lit(ends["hi"]))
