"""From pages to rows: links, headings, legs, tables and rankings.

Each page is read once into a struct; what belongs to one page is worked out
inside its row with array expressions, so nothing is shuffled until pages of
different kinds are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions.html import read_page
from legwise.functions.numbers import leg_number_text, round_half_even, to_number
from legwise.functions.text import (
    attribute_values,
    cell_text,
    first_number,
    leg_number,
    route_part,
    strip_text,
)
from legwise.operators.ordering import first_k
from legwise.schema import (
    BIB_ATTRIBUTE,
    CLASSIFICATIONS,
    FIGURE_CLASS,
    RANKING_TABLE_CLASS,
    SeriesSite,
    TAB_BUTTON_CLASSES,
    TAB_LINK_ATTRIBUTE,
)
from legwise.sources.tables import missing_to_null
from legwise.staging import stage, stage_pages

POINTS_CODES = ("ipe", "ime")
TIMED_CODES = ("ite", "ije", "ice")
TEAM_CODES = ("ete",)


def with_page(
    df: DataFrame,
    html: str = "html",
    into: str = "page",
    figure_class: str = FIGURE_CLASS,
    tab_classes: Sequence[str] = TAB_BUTTON_CLASSES,
    tab_link: str = TAB_LINK_ATTRIBUTE,
    bib_attribute: str = BIB_ATTRIBUTE,
) -> DataFrame:
    """Add the page's content struct (headings, figures, options, tabs, bibs, tables)."""
    content = read_page(F.col(html), figure_class, tuple(tab_classes), tab_link, bib_attribute)
    return df.withColumn(into, content)


def completeness(page: Column, html: Column) -> Column:
    """How much of a page is there, as a struct that sorts: legs, tabs, figures, rows, length, and a hash for ties.

    A page that was cut off anywhere has no more of any of them than the whole one.
    """
    rows = F.aggregate(page["tables"], F.lit(0), lambda n, t: n + F.size(t["rows"]))
    return F.struct(
        F.size(page["options"]).alias("legs"),
        F.size(page["tabs"]).alias("tabs"),
        F.size(page["figures"]).alias("figures"),
        rows.alias("rows"),
        F.length(html).alias("length"),
        F.xxhash64(html).alias("hash"),
    )


def page_versions(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One page per address, and the addresses stored in versions that differ.

    Of those the most complete one counts.  The second table has ``url``, ``n_versions``, ``n_rows``
    and ``kept`` (the chosen one's completeness).  Only repeated addresses, a small written table, are
    aggregated, and only those whose versions differ are read; all other pages stay where they are.
    """
    counted = pages.groupBy("url").agg(F.count(F.lit(1)).alias("n_rows"), F.min(F.xxhash64("html")).alias("_least"), F.max(F.xxhash64("html")).alias("_most"))
    repeated = stage(
        counted.where("n_rows > 1").select(F.col("url").alias("_url"), (F.col("_least") != F.col("_most")).alias("_differs")), "repeated"
    )
    again = F.col("url").eqNullSafe(F.col("_url"))
    if repeated.isEmpty():
        none = with_page(pages.limit(0)).withColumn("kept", completeness(F.col("page"), F.col("html")))
        return pages.select("url", "html"), none.select("url", F.lit(0).alias("n_versions"), F.lit(0).alias("n_rows"), "kept")
    once = pages.select("url", "html").join(repeated, again, "left_anti")
    copies = pages.select("url", "html").join(repeated.where(~F.col("_differs")), again, "left_semi").groupBy("url").agg(F.first("html").alias("html"))
    ranked = with_page(pages.select("url", "html").join(repeated.where("_differs"), again, "left_semi"))
    ranked = ranked.withColumn("_rank", completeness(F.col("page"), F.col("html"))).drop("page")
    # written: its pages and the list of versions both come from it
    chosen = stage_pages(
        ranked.groupBy("url").agg(
            F.max_by("html", "_rank").alias("html"), F.max("_rank").alias("kept"),
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_rank.hash").alias("n_versions"),
        ),
        "page-versions",
    )
    whole = once.unionByName(copies).unionByName(chosen.select("url", "html"))
    return whole, chosen.select("url", "n_versions", "n_rows", "kept")


def version_rejects(versions: DataFrame, sites: Sequence[SeriesSite]) -> DataFrame:
    """Reject rows naming the versions of a page that were left out."""
    left_out, kept = F.col("n_versions") - 1, F.col("kept")
    reason = F.format_string(
        "%d other versions of this page; kept the most complete one (%d legs, %d rows, %d characters)",
        left_out, kept["legs"], kept["rows"], kept["length"],
    )
    return versions.select(classify_host(F.col("url"), sites).alias("series"), "url", reason.alias("reason"))


# --- links ------------------------------------------------------------------


def links(df: DataFrame, html: str, attribute: str) -> DataFrame:
    """One row per attribute value with its position on the page."""
    found = attribute_values(F.col(html), attribute)
    return df.select(*[c for c in df.columns if c != html], F.posexplode(found).alias("pos", "link"))


def _next_pairs(years: Column) -> Column:
    length = F.greatest(F.size(years) - 1, F.lit(0))
    return F.zip_with(
        F.slice(years, F.lit(1), length),
        F.slice(years, F.lit(2), length),
        lambda a, b: a.isNull() | b.isNull() | (a >= b),
    )


def newest_first(years: Column) -> Column:
    """Whether no year exceeds the one before it; missing years agree with anything."""
    return F.forall(_next_pairs(years), lambda fine: fine)


def recency_order(found: Column, digits: str = r"\d{4}") -> Column:
    """Links as structs (year, pos, link), newest first, links without year last.

    A list that is already in order stays as it is.
    """
    entries = F.transform(
        found,
        lambda link, pos: F.struct(
            first_number(link, digits).alias("year"), pos.alias("pos"), link.alias("link")
        ),
    )
    years = F.transform(entries, lambda entry: entry["year"])
    by_age = F.transform(
        entries, lambda e: F.struct((-F.coalesce(e["year"], F.lit(-1))).alias("age"), e["pos"].alias("pos"), e.alias("entry"))
    )
    newest = F.transform(F.array_sort(by_age), lambda aged: aged["entry"])
    return F.when(newest_first(years), entries).otherwise(newest)


def classify_host(url: Column, sites: Sequence[SeriesSite], what: str = "series") -> Column:
    """Series (or prefix) of the first site whose host text occurs in the address."""
    chosen = F.lit(None).cast("string")
    for site in reversed(sites):
        chosen = F.when(F.contains(url, F.lit(site.host)), getattr(site, what)).otherwise(chosen)
    return chosen


def edition_links(history_pages: DataFrame, sites: Sequence[SeriesSite]) -> DataFrame:
    """Edition pages listed on the history pages, newest first, with absolute address."""
    url = F.col("url")
    listed = history_pages.select(
        classify_host(url, sites).alias("series"),
        classify_host(url, sites, "prefix").alias("prefix"),
        F.posexplode(recency_order(attribute_values(F.col("html"), TAB_LINK_ATTRIBUTE))).alias(
            "pos", "entry"
        ),
    )
    return listed.select(
        "series",
        "prefix",
        "pos",
        F.col("entry.year").alias("link_year"),
        F.concat("prefix", "entry.link").alias("url"),
    )


def newest_pages(found: DataFrame, k: int, oldest: bool = False) -> DataFrame:
    """The first (or last) ``k`` links of each series' list."""
    order = F.col("pos").desc() if oldest else F.col("pos").asc()
    return first_k(found, ["series"], [order], k, "n")


def last_link_per_label(
    df: DataFrame, keys: Sequence[str], label: str = "label", link: str = "link", pos: str = "pos"
) -> DataFrame:
    """One link per label, the last one on the page."""
    return df.groupBy(*keys, label).agg(F.max_by(link, pos).alias(link))


# --- edition pages ----------------------------------------------------------


def first_heading(page: Column, tag: str = "h3") -> Column:
    return F.get(F.filter(page["headings"], lambda h: h["tag"] == tag), F.lit(0))["text"]


def heading_edition(page: Column) -> Column:
    """Edition from the last four characters of the page's heading."""
    return F.right(first_heading(page), F.lit(4)).try_cast("int")


def stated_distance(page: Column) -> Column:
    """Second figure of the page without blanks and commas, rounded half to even."""
    figure = F.translate(F.get(page["figures"], F.lit(1)), " ,", "")
    return round_half_even(to_number(figure)).try_cast("int")


def leg_list(df: DataFrame, page: str = "page") -> DataFrame:
    """Legs of the page's first option list, in order, with number, start and end."""
    keys = [c for c in df.columns if c != page]
    options = df.select(*keys, F.posexplode(F.col(page)["options"]).alias("row_no", "label"))
    label = F.col("label")
    return options.select(
        *keys,
        F.col("row_no").cast("bigint").alias("row_no"),
        label,
        leg_number(label).alias("leg"),
        route_part(label, 0).alias("start"),
        route_part(label, 1).alias("end"),
    )


def tab_links(df: DataFrame, keys: Sequence[str], prefix: Column, page: str = "page") -> DataFrame:
    """Absolute address per tab label; of equal labels an active button wins, then the later one."""
    tabs = df.select(*keys, prefix.alias("_prefix"), F.posexplode(F.col(page)["tabs"]).alias("_at", "tab"))
    flat = tabs.select(
        *keys, F.struct("tab.active", "_at").alias("pos"), F.col("tab.label").alias("label"), F.concat("_prefix", "tab.link").alias("link")
    )
    return last_link_per_label(flat, keys)


# --- tables -----------------------------------------------------------------


def first_table(page: Column, css_class: str | None = None) -> Column:
    """The page's first table, or its first table of that class."""
    tables = page["tables"]
    if css_class is not None:
        tables = F.filter(tables, lambda t: t["class"] == css_class)
    return F.get(tables, F.lit(0))


def clean_rows(table: Column) -> Column:
    """Cells of the table's data rows, cleaned like a table reader's; missing markers are NULL."""
    body = F.filter(table["rows"], lambda r: F.size(r["cells"]) > 0)
    return F.transform(
        body, lambda r: F.transform(r["grid"], lambda text: missing_to_null(cell_text(text)))
    )


def header_names(table: Column) -> Column:
    header = F.get(F.filter(table["rows"], lambda r: r["is_header"]), F.lit(0))["grid"]
    return F.transform(header, lambda name: cell_text(name))


def table_rows(df: DataFrame, table: Column, page: str = "page") -> DataFrame:
    """Header names and data cells of a table, one row per data row, numbered from 0.

    Header and rows are taken out of the page first, so the exploded rows carry
    the header but not the page.
    """
    keys = [c for c in df.columns if c != page]
    read = df.select(*keys, header_names(table).alias("header"), clean_rows(table).alias("_rows"))
    rows = read.select(*keys, "header", F.posexplode("_rows").alias("row_no", "cells"))
    return rows.withColumn("row_no", F.col("row_no").cast("bigint"))


def cell(name: str) -> Column:
    """The cell below the header ``name``; NULL when the table has no such column."""
    at = F.array_position("header", F.lit(name))
    return F.when(at > 0, F.get("cells", (at - 1).cast("int")))


def attach_by_position(rows: Column, values: Column) -> Column:
    """Rows paired with the values at the same positions, only if there are as many values as rows.

    Pairs are structs (row, value); the value is NULL throughout when the numbers differ.
    """
    row, value = F.lit("row"), F.lit("value")
    paired = F.zip_with(rows, values, lambda r, v: F.named_struct(row, r, value, v))
    alone = F.transform(rows, lambda r: F.named_struct(row, r, value, F.lit(None).cast("string")))
    return F.when(F.size(rows) == F.size(values), paired).otherwise(alone)


def bib_number(bib: Column) -> Column:
    return F.regexp_replace(bib, "#", "").try_cast("int")


def standings_rows(df: DataFrame, table: Column, bibs: Column, page: str = "page") -> DataFrame:
    """Rows of a final-standings table, with the page's bib numbers attached by position."""
    keys = [c for c in df.columns if c != page]
    read = df.select(
        *keys, header_names(table).alias("header"), clean_rows(table).alias("_rows"), bibs.alias("_bibs")
    )
    paired = read.select(
        *keys, "header", F.posexplode(attach_by_position(F.col("_rows"), F.col("_bibs"))).alias("row_no", "_pair")
    )
    rows = paired.select(*keys, "header", "row_no", F.col("_pair.row").alias("cells"), F.col("_pair.value").alias("_bib"))
    return rows.select(
        *keys,
        F.col("row_no").cast("bigint").alias("row_no"),
        to_number(cell("Rank")).try_cast("int").alias("rank"),
        cell("Rank").alias("rank_text"),
        cell("Rider").alias("participant"),
        bib_number(F.col("_bib")).alias("bib"),
        cell("Team").alias("team"),
        cell("Times").alias("times"),
        cell("Gap").alias("gap"),
        cell("B").alias("bonus"),
        cell("P").alias("penalty"),
    )


# --- leg rankings -----------------------------------------------------------


def request_grid(legs: DataFrame, ranking_link: str = "ranking_link") -> DataFrame:
    """Every leg with every classification and the address of its ranking page."""
    classes = F.array(
        *[F.struct(F.lit(n).alias("classification"), F.lit(c).alias("code")) for n, c in CLASSIFICATIONS]
    )
    grid = legs.select("*", F.inline(classes))
    return grid.withColumn("request", ranking_address(F.col(ranking_link), F.col("leg"), F.col("code")))


def ranking_address(link: Column, leg: Column, code: Column) -> Column:
    """Whole leg numbers are written without decimals."""
    return F.concat(link, F.lit("?stage="), leg_number_text(leg), F.lit("&type="), code)


def ranking_page_keys(pages: DataFrame) -> DataFrame:
    """Split ranking page addresses into link, leg number and code."""
    url = F.col("url")
    return pages.where(F.contains(url, F.lit("?stage="))).withColumns(
        {
            "ranking_link": F.substring_index(url, "?", 1),
            "leg": to_number(F.regexp_extract(url, r"[?&]stage=([^&]*)", 1)),
            "code": F.regexp_extract(url, r"[?&]type=([^&]*)", 1),
        }
    )


def page_keys(pages: DataFrame) -> DataFrame:
    """Address, ranking link, leg number and code of every page; other pages are linked by their address."""
    url = F.col("url")
    ranking = F.contains(url, F.lit("?stage="))
    leg = to_number(F.regexp_extract(url, r"[?&]stage=([^&]*)", 1))
    return pages.select(
        "url",
        F.when(ranking, F.substring_index(url, "?", 1)).otherwise(url).alias("link"),
        F.when(ranking, leg).alias("leg"),
        F.when(ranking, F.regexp_extract(url, r"[?&]type=([^&]*)", 1)).alias("code"),
        "html",
    )


def checkpoint_rows(rows: Column) -> Column:
    """Position and text of the single-cell rows, which name a checkpoint."""
    at, text = F.lit("at"), F.lit("text")
    marked = F.transform(
        rows,
        lambda r, i: F.when(
            F.size(r["cells"]) == 1,
            F.named_struct(at, i, text, strip_text(F.get(r["cells"], F.lit(0)))),
        ),
    )
    return F.array_compact(marked)


def rows_below_checkpoints(rows: Column, checkpoints: Column) -> Column:
    """The rows as structs (row_no, checkpoint, row); the rows of the checkpoints themselves are left out.

    Each checkpoint's run of rows is cut out once, so a page costs its length.
    """
    start = F.named_struct(F.lit("at"), F.lit(-1), F.lit("text"), F.lit(None).cast("string"))
    begins = F.concat(F.array(start), F.coalesce(checkpoints, F.array().cast("array<struct<at:int,text:string>>")))
    later = F.slice(begins, F.lit(2), F.size(begins))
    ends = F.concat(F.transform(later, lambda c: c["at"]), F.array(F.size(rows)))
    runs = F.zip_with(
        begins, ends,
        lambda c, end: F.named_struct(F.lit("text"), c["text"], F.lit("first"), c["at"] + 1, F.lit("count"), end - c["at"] - 1),
    )
    below = F.transform(
        runs,
        lambda run: F.transform(
            F.slice(rows, run["first"] + 1, run["count"]),
            lambda r, i: F.named_struct(F.lit("row_no"), run["first"] + i, F.lit("checkpoint"), run["text"], F.lit("row"), r),
        ),
    )
    return F.flatten(below)


def ranking_rows(
    df: DataFrame,
    code: str = "code",
    page: str = "page",
    css_class: str = RANKING_TABLE_CLASS,
    keep_short: bool = False,
) -> DataFrame:
    """Ranking rows of pages of any classification, in one wide layout.

    A table of a header and at most one row holds no ranking.  Points and climber
    tables name a checkpoint in single-cell rows, which applies to the rows below.
    Rows with too few cells are left out; ``keep_short`` keeps them, marked by the
    column ``short_cells`` (their number of cells, NULL for whole rows).
    """
    keys = [c for c in df.columns if c != page]
    kind = F.col(code)
    points, timed, team = (kind.isin(*codes) for codes in (POINTS_CODES, TIMED_CODES, TEAM_CODES))
    found = df.select(*keys, first_table(F.col(page), css_class)["rows"].alias("_all"))
    listed = found.select(
        *keys, F.when(F.size("_all") > 2, F.slice("_all", F.lit(2), F.size("_all"))).alias("_rows")
    )
    # computed before the rows are exploded, so that a row carries its own checkpoint only
    marked = listed.withColumn("_checkpoints", F.when(points, checkpoint_rows(F.col("_rows"))))
    exploded = marked.select(*keys, F.inline(rows_below_checkpoints(F.col("_rows"), F.col("_checkpoints"))))
    needed = (
        F.when(points | timed, 4)
        .when(team, 3)
        .otherwise(F.raise_error(F.concat(F.lit("unknown classification code "), kind)).cast("int"))
    )
    cells = F.col("row.cells")

    def at(index: int) -> Column:
        return strip_text(F.get(cells, F.lit(index)))

    wide = exploded.where(F.size(cells) >= (F.lit(1) if keep_short else needed)).select(
        *keys,
        F.col("row_no").cast("bigint").alias("row_no"),
        at(0).alias("rank_text"),
        F.when(~team, at(1)).alias("participant"),
        F.when(team, at(1)).otherwise(at(2)).alias("team"),
        F.when(timed, at(3)).when(team, at(2)).alias("times"),
        F.when(timed, at(4)).when(team, at(3)).alias("gap"),
        F.when(kind == "ipe", at(4)).when(kind == "ite", at(5)).alias("bonus"),
        F.when(kind == "ite", at(6)).alias("penalty"),
        F.when(points, at(3)).alias("points"),
        F.when(points, F.col("checkpoint")).alias("checkpoint"),
        F.when(F.size(cells) < needed, F.size(cells)).alias("short_cells"),
    )
    return wide if keep_short else wide.drop("short_cells")


def missing_rankings(grid: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of the request grid for which no ranking row exists."""
    return grid.join(rows.select(*keys).distinct(), list(keys), "left_anti")


def latest_leg(legs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest known leg number per edition."""
    return legs.where(F.col("leg").isNotNull()).groupBy(*keys).agg(F.max("leg").alias("leg"))
