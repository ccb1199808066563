"""Links, headings, legs and rankings from pages.

The driver's pages hold no tables, so pages with tables are written from rows
first, one page per source row, and then read like any other page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from legwise.operators import extract as X
from legwise.operators.opencolumns import other_cells, spread_out
from legwise.functions.text import first_number
from legwise.schema import RANKING_TABLE_CLASS, SeriesSite
from spark_queries.registry import query
from spark_queries.views import columns_of, table


@query(
    "page_links",
    """
    SELECT page_id, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, unnest(found) AS link
    FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS found FROM pages)
    """,
)
def page_links(spark, sf_dir):
    return X.links(table(spark, sf_dir, "pages").select("page_id", "html"), "html", "href")


@query(
    "url_number",
    r"SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '(\d+)', 1), '') AS INTEGER) AS number FROM pages",
)
def url_number(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", first_number(F.col("url"), r"\d+").alias("number"))


@query(
    "page_headings",
    """
    SELECT page_id, heading, right(heading, 4) AS ending FROM (
      SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'),
        '&quot;?', '"', 'g'), '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&amp;?', '&', 'g') AS heading FROM pages)
    """,
)
def page_headings(spark, sf_dir):
    """First heading of every page with entities resolved."""
    read = X.with_page(columns_of(spark, sf_dir, "pages", "page_id", "html"))
    heading = X.first_heading(F.col("page"), "h1")
    return read.select("page_id", heading.alias("heading"), F.right(heading, F.lit(4)).alias("ending"))


SITES = (
    SeriesSite("blog", "://blog.", "https://blog.example"),
    SeriesSite("mobile", "://m.", "https://m.example"),
    SeriesSite("other", "://", "https://example"),
)


@query(
    "pages_by_host",
    r"""
    SELECT page_id, series, CASE series WHEN 'blog' THEN 'https://blog.example' WHEN 'mobile' THEN 'https://m.example'
             ELSE 'https://example' END || regexp_replace(url, '^[a-z]+://[^/]*', '') AS address
    FROM (SELECT *, CASE WHEN url LIKE '%://blog.%' THEN 'blog' WHEN url LIKE '%://m.%' THEN 'mobile'
                         ELSE 'other' END AS series FROM pages)
    """,
)
def pages_by_host(spark, sf_dir):
    """Series by host text, and links made absolute with the series' prefix."""
    url = F.col("url")
    link = F.regexp_replace(url, "^[a-z]+://[^/]*", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        X.classify_host(url, SITES).alias("series"),
        F.concat(X.classify_host(url, SITES, "prefix"), link).alias("address"),
    )


@query(
    "last_link_per_label",
    """
    WITH found AS (
      SELECT page_id, generate_subscripts(l, 1) AS pos, unnest(l) AS link
      FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages))
    SELECT page_id, CAST(length(link) AS INTEGER) AS label, arg_max(link, pos) AS link FROM found GROUP BY 1, 2
    """,
)
def last_link_per_label(spark, sf_dir):
    found = X.links(table(spark, sf_dir, "pages").select("page_id", "html"), "html", "href")
    return X.last_link_per_label(found.withColumn("label", F.length("link")), ["page_id"])


# --- lists of links with years ------------------------------------------------

_LINK_LISTS = """
WITH lists AS (
  SELECT o_orderkey, ['/en/' || CAST(year(o_orderdate) AS VARCHAR) || '/a', '/en/' || (1990 + o_custkey % 10) || '/b',
    '/en/history', '/en/' || (1985 + o_orderkey % 12) || '/d'] AS links,
    [year(o_orderdate), 1990 + o_custkey % 10, NULL, 1985 + o_orderkey % 12] AS years
  FROM orders
)
"""


def _link_list() -> Column:
    def anchor(link: Column) -> Column:
        return F.concat(F.lit('<a data-tabs-ajax="'), link, F.lit('">x</a>'))

    return F.concat(
        anchor(F.concat(F.lit("/en/"), F.year("o_orderdate").cast("string"), F.lit("/a"))),
        anchor(F.concat(F.lit("/en/"), (F.col("o_custkey") % 10 + 1990).cast("string"), F.lit("/b"))),
        anchor(F.lit("/en/history")),
        anchor(F.concat(F.lit("/en/"), (F.col("o_orderkey") % 12 + 1985).cast("string"), F.lit("/d"))),
    )


@query(
    "links_recency_check",
    f"{_LINK_LISTS} SELECT o_orderkey, years[1] >= years[2] AS in_order FROM lists",
)
def links_recency_check(spark, sf_dir):
    """Whether a page lists its links newest first; links without year agree with anything."""
    found = X.attribute_values(_link_list(), "data-tabs-ajax")
    years = F.transform(found, lambda link: first_number(link))
    return _orders(spark, sf_dir).select("o_orderkey", X.newest_first(years).alias("in_order"))


@query(
    "links_recency_order",
    f"""{_LINK_LISTS},
    found AS (
      SELECT o_orderkey, years[1] >= years[2] AS in_order, unnest([0, 1, 2, 3]) AS pos,
             unnest(links) AS link, unnest(years) AS link_year FROM lists)
    SELECT o_orderkey, link, CAST(link_year AS INTEGER) AS link_year,
           CAST(CASE WHEN in_order THEN pos ELSE row_number() OVER (
             PARTITION BY o_orderkey ORDER BY coalesce(link_year, -1) DESC, pos) - 1 END AS INTEGER) AS n
    FROM found
    """,
)
def links_recency_order(spark, sf_dir):
    entries = X.recency_order(X.attribute_values(_link_list(), "data-tabs-ajax"))
    listed = _orders(spark, sf_dir).select("o_orderkey", F.posexplode(entries).alias("n", "entry"))
    return listed.select(
        "o_orderkey", "n", F.col("entry.link").alias("link"), F.col("entry.year").alias("link_year")
    )


@query(
    "page_distance",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS edition,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(round_even(o_custkey + 1000 + (o_orderkey % 4) / 4.0::DOUBLE, 0) AS INTEGER) END AS distance
    FROM orders
    """,
)
def page_distance(spark, sf_dir):
    """Edition and rounded distance of edition pages; no second figure gives NULL."""
    amount = F.col("o_custkey") + 1000 + (F.col("o_orderkey") % 4) / 4
    figure = F.concat(
        F.lit('<p class="big statsInfos__number"> '), F.format_number(amount, 2), F.lit(" <span>7</span></p>")
    )
    html = F.concat(
        F.lit("<h3>Edition <b>"), F.year("o_orderdate").cast("string"),
        F.lit('</b></h3><p class="statsInfos__number">21</p>'),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(figure),
    )
    read = X.with_page(_orders(spark, sf_dir).select("o_orderkey", html.alias("html")))
    return read.select(
        "o_orderkey",
        X.heading_edition(F.col("page")).alias("edition"),
        X.stated_distance(F.col("page")).alias("distance"),
    )


HISTORY_SITES = (
    SeriesSite("F", "//f.example", "https://f.example"),
    SeriesSite("O", "//o.example", "https://o.example"),
    SeriesSite("P", "//", "https://p.example"),
)


@query(
    "history_links",
    f"""{_LINK_LISTS},
    found AS (
      SELECT o_orderkey, years[1] >= years[2] AS in_order, unnest([0, 1, 2, 3]) AS pos,
             unnest(links) AS link, unnest(years) AS link_year FROM lists)
    SELECT o_orderstatus AS series, 'https://' || lower(o_orderstatus) || '.example' AS prefix,
           CAST(CASE WHEN in_order THEN pos ELSE row_number() OVER (
             PARTITION BY o_orderkey ORDER BY coalesce(link_year, -1) DESC, pos) - 1 END AS INTEGER) AS pos,
           CAST(link_year AS INTEGER) AS link_year,
           'https://' || lower(o_orderstatus) || '.example' || link AS url
    FROM found JOIN orders USING (o_orderkey)
    """,
)
def history_links(spark, sf_dir):
    """Edition pages listed by history pages: series by host, newest first, absolute."""
    address = F.concat(F.lit("https://"), F.lower("o_orderstatus"), F.lit(".example/history"))
    history = _orders(spark, sf_dir).select(address.alias("url"), _link_list().alias("html"))
    return X.edition_links(history, HISTORY_SITES)


@query(
    "tab_links",
    """
    SELECT o_orderkey, label, 'https://x' || link AS link FROM (
      SELECT o_orderkey, unnest(['Ranking', 'Stages winners']) AS label,
             unnest(['/r/' || CASE WHEN o_orderstatus = 'P' THEN 'again' ELSE CAST(o_custkey AS VARCHAR) END, '/w/' || o_orderpriority]) AS link
      FROM orders)
    """,
)
def tab_links(spark, sf_dir):
    """Address per tab button; a later button of the same name wins, one without address is skipped."""

    def button(label: str, link: Column, css: str = "tabs__item btn js-tabs-nested") -> Column:
        return F.concat(
            F.lit(f'<button class="{css}" data-tabs-ajax="'), link, F.lit(f'">\n <i>{label}</i> </button>')
        )

    again = button("Ranking", F.lit("/r/again"), "tabs__item btn js-tabs-nested is-active")
    html = F.concat(
        button("Ranking", F.concat(F.lit("/r/"), F.col("o_custkey").cast("string"))),
        button("Other", F.lit("/o"), "tabs__item"),
        button("Stages winners", F.concat(F.lit("/w/"), F.col("o_orderpriority"))),
        F.lit('<button class="tabs__item btn js-tabs-nested">Ranking</button>'),
        F.when(F.col("o_orderstatus") == "P", again).otherwise(""),
    )
    read = X.with_page(_orders(spark, sf_dir).select("o_orderkey", html.alias("html"))).drop("html")
    return X.tab_links(read, ["o_orderkey"], F.lit("https://x"))


# --- pages with tables ---------------------------------------------------------


def _orders(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
    return columns_of(spark, sf_dir, "orders", *columns)


def _escaped(text: Column) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def _row(*cells: Column, tag: str = "td", attributes: Column | None = None) -> Column:
    opened = F.lit("<tr>") if attributes is None else F.concat(F.lit("<tr "), attributes, F.lit(">"))
    marked = [part for c in cells for part in (F.lit(f"<{tag}> "), c.cast("string"), F.lit(f"\n</{tag}>"))]
    return F.concat(opened, *marked, F.lit("</tr>"))


def _header(*names: str) -> Column:
    return F.concat(F.lit("<thead>"), _row(*[F.lit(n) for n in names], tag="th"), F.lit("</thead>"))


def _table(*rows: Column, css: str = "") -> Column:
    return F.concat(F.lit(f'<html><body><h3>x 1999</h3><table class="{css}">'), *rows, F.lit("</table></body></html>"))


@query(
    "html_table_roundtrip",
    r"""
    SELECT doc_id, CAST(0 AS BIGINT) AS row_no, lang, regexp_replace(
      regexp_replace(text, '^\s+|\s+$', '', 'g'), '[\r\n]+|\s{2,}', ' ', 'g') AS text
    FROM documents
    """,
)
def html_table_roundtrip(spark, sf_dir):
    """Whole documents written into table cells and read back by header name."""
    documents = columns_of(spark, sf_dir, "documents", "doc_id", "lang", "text")
    html = _table(_header("Lang", "Text"), _row(F.col("lang"), _escaped(F.col("text"))))
    read = X.with_page(documents.select("doc_id", html.alias("html"))).drop("html")
    rows = X.table_rows(read, X.first_table(F.col("page")))
    return rows.select("doc_id", "row_no", X.cell("Lang").alias("lang"), X.cell("Text").alias("text"))


@query(
    "positional_attach",
    """
    SELECT o_orderkey, CAST(i AS BIGINT) AS row_no, CAST(i + 1 AS INTEGER) AS rank, name AS participant,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 200 + i AS INTEGER) END AS bib
    FROM (SELECT *, unnest([0, 1, 2]) AS i, unnest([CAST(o_custkey AS VARCHAR), o_orderpriority, CAST(year(o_orderdate) AS VARCHAR)]) AS name
          FROM orders)
    """,
)
def positional_attach(spark, sf_dir):
    """Bib numbers by position, missing where their count differs from the row count."""
    orders = _orders(spark, sf_dir)

    def bib(offset: int) -> Column:
        value = F.concat(F.lit('data-bib="#'), (F.col("o_custkey") % 200 + offset).cast("string"), F.lit('"'))
        lost = (F.col("o_orderstatus") == "P") if offset == 1 else F.lit(False)
        return F.when(lost, F.lit('class="x"')).otherwise(value)

    html = _table(
        _header("Rank", "Rider"),
        _row(F.lit("1"), F.col("o_custkey"), attributes=bib(0)),
        _row(F.lit("2"), F.col("o_orderpriority"), attributes=bib(1)),
        _row(F.lit("3"), F.year("o_orderdate"), attributes=bib(2)),
    )
    read = X.with_page(orders.select("o_orderkey", html.alias("html"))).drop("html")
    rows = X.standings_rows(read, X.first_table(F.col("page")), F.col("page.bibs"))
    return rows.select("o_orderkey", "row_no", "rank", "participant", "bib")


_RANKING_CODE = {
    "1-URGENT": "ite", "2-HIGH": "ipe", "3-MEDIUM": "ime", "4-NOT SPECIFIED": "ije", "5-LOW": "ete",
}


@query(
    "ranking_rows_by_class",
    """
    WITH pages_of AS (
      SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'ite' WHEN '2-HIGH' THEN 'ipe' WHEN '3-MEDIUM' THEN 'ime'
             WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_custkey % 2 = 1 THEN 'ice' ELSE 'ije' END ELSE 'ete' END AS code,
             CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders
    ),
    listed AS (
      SELECT o_orderkey, code, 0 AS row_no, ['1', c, s, y, c, s, y] AS cells, NULL AS checkpoint FROM pages_of
      UNION ALL SELECT o_orderkey, code, 2, ['2', s, c, y, y], 'km ' || c FROM pages_of
      UNION ALL SELECT o_orderkey, code, 4, ['3', y, c, s], 'km ' || y FROM pages_of
    )
    SELECT o_orderkey, code, CAST(row_no AS BIGINT) AS row_no, cells[1] AS rank_text,
      CASE WHEN code <> 'ete' THEN cells[2] END AS participant,
      CASE WHEN code = 'ete' THEN cells[2] ELSE cells[3] END AS team,
      CASE WHEN code IN ('ite', 'ije', 'ice') THEN cells[4] WHEN code = 'ete' THEN cells[3] END AS times,
      CASE WHEN code IN ('ite', 'ije', 'ice') THEN cells[5] WHEN code = 'ete' THEN cells[4] END AS gap,
      CASE code WHEN 'ipe' THEN cells[5] WHEN 'ite' THEN cells[6] END AS bonus,
      CASE code WHEN 'ite' THEN cells[7] END AS penalty,
      CASE WHEN code IN ('ipe', 'ime') THEN cells[4] END AS points,
      CASE WHEN code IN ('ipe', 'ime') THEN checkpoint END AS checkpoint
    FROM listed
    """,
)
def ranking_rows_by_class(spark, sf_dir):
    """Ranking pages of all classifications: ragged rows, checkpoints and short rows."""
    return X.ranking_rows(_ranking_pages(spark, sf_dir))


@query(
    "ranking_short_rows",
    """
    WITH pages_of AS (SELECT o_orderkey, o_orderpriority IN ('2-HIGH', '3-MEDIUM') AS points FROM orders)
    SELECT o_orderkey, CAST(place AS BIGINT) AS row_no, cells AS short_cells
    FROM pages_of, (VALUES (1, 1), (3, 1), (5, 2)) AS s(place, cells) WHERE NOT points OR cells > 1
    """,
)
def ranking_short_rows(spark, sf_dir):
    """Rows of the same pages that have too few cells and go to the rejects."""
    rows = X.ranking_rows(_ranking_pages(spark, sf_dir), keep_short=True)
    return rows.where("short_cells IS NOT NULL").select("o_orderkey", "row_no", "short_cells")


def _ranking_pages(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    customer, status, year = F.col("o_custkey"), F.col("o_orderstatus"), F.year("o_orderdate")
    checkpoint = F.concat(F.lit("km "), customer.cast("string"))
    second = F.concat(F.lit("km "), year.cast("string"))
    html = _table(
        _row(F.lit("Rank"), F.lit("Rider"), tag="th"),
        _row(F.lit("1"), customer, status, year, customer, status, year),
        _row(checkpoint),
        _row(F.lit("2"), status, customer, year, year),
        _row(second),
        _row(F.lit("3"), year, customer, status),
        _row(F.lit("4"), year),
        css=RANKING_TABLE_CLASS,
    )
    codes = F.create_map(*[F.lit(x) for pair in _RANKING_CODE.items() for x in pair])
    combative = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (customer % 2 == 1)
    code = F.when(combative, "ice").otherwise(codes[F.col("o_orderpriority")])
    return X.with_page(orders.select("o_orderkey", code.alias("code"), html.alias("html"))).drop("html")


# --- legs and request grid -------------------------------------------------------


@query(
    "option_legs",
    """
    SELECT o_orderkey, CAST(i AS BIGINT) AS row_no, leg, start, "end" FROM (
      SELECT o_orderkey, unnest([0, 1]) AS i, unnest([0.0::DOUBLE, o_custkey % 20 + 0.5::DOUBLE]) AS leg,
             unnest([o_orderstatus, CAST(year(o_orderdate) AS VARCHAR)]) AS start,
             unnest([o_orderpriority, o_orderstatus]) AS "end" FROM orders)
    """,
)
def option_legs(spark, sf_dir):
    """Legs from the first option list of a page; later lists are not read."""
    orders = _orders(spark, sf_dir)
    number = (F.col("o_custkey") % 20).cast("string")
    html = F.concat(
        F.lit("<select><option>Prologue : "), "o_orderstatus", F.lit(" &gt; "), "o_orderpriority",
        F.lit("</option><option>Stage "), number, F.lit(".5 : "), F.year("o_orderdate").cast("string"),
        F.lit(" &gt; "), "o_orderstatus", F.lit("</option></select><select><option>Stage 9 : A &gt; B</option></select>"),
    )
    read = X.with_page(orders.select("o_orderkey", html.alias("html"))).drop("html")
    return X.leg_list(read).drop("label")


_CLASSES = """
classes AS (SELECT * FROM (VALUES ('Individual (Stage)', 'ite'), ('Points (Stage)', 'ipe'), ('Climber (Stage)', 'ime'),
  ('Youth (Stage)', 'ije'), ('Combative (Stage)', 'ice'), ('Team (Stage)', 'ete')) AS t(classification, code))"""


@query(
    "leg_class_grid",
    f"""
    WITH {_CLASSES}
    SELECT l_suppkey, leg, classification, code,
           '/s' || l_suppkey || '?stage=' || CAST(CAST(leg AS INTEGER) AS VARCHAR) || '&type=' || code AS request
    FROM (SELECT DISTINCT l_suppkey, CAST(l_linenumber AS DOUBLE) AS leg FROM lineitem), classes
    """,
)
def leg_class_grid(spark, sf_dir):
    legs = (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", F.col("l_linenumber").cast("double").alias("leg"))
        .distinct()
        .withColumn("ranking_link", F.concat(F.lit("/s"), F.col("l_suppkey").cast("string")))
    )
    return X.request_grid(legs).drop("ranking_link")


@query(
    "missing_grid_cells",
    f"""
    WITH {_CLASSES},
    present AS (
      SELECT DISTINCT CAST(l_partkey AS DOUBLE) AS leg, CASE l_linenumber WHEN 1 THEN 'Individual (Stage)' WHEN 2 THEN 'Points (Stage)'
        WHEN 3 THEN 'Climber (Stage)' WHEN 4 THEN 'Youth (Stage)' WHEN 5 THEN 'Combative (Stage)' WHEN 6 THEN 'Team (Stage)' END AS classification
      FROM lineitem)
    SELECT g.leg, g.classification FROM (SELECT * FROM (SELECT CAST(p_partkey AS DOUBLE) AS leg FROM part), classes) g
    ANTI JOIN present p ON p.leg = g.leg AND p.classification = g.classification
    """,
)
def missing_grid_cells(spark, sf_dir):
    """Cells of the grid for which no ranking row exists."""
    legs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("double").alias("leg"), F.lit("/r").alias("ranking_link")
    )
    names = {i + 1: name for i, (name, _) in enumerate(X.CLASSIFICATIONS)}
    by_number = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("double").alias("leg"),
        F.try_element_at(by_number, F.col("l_linenumber")).alias("classification"),
    )
    grid = X.request_grid(legs).select("leg", "classification")
    return X.missing_rankings(grid, rows, ["leg", "classification"])


@query(
    "latest_leg_per_edition",
    """
    SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS edition, max(nullif(month(l_shipdate), 12))::DOUBLE AS leg
    FROM lineitem GROUP BY ALL HAVING max(nullif(month(l_shipdate), 12)) IS NOT NULL
    """,
)
def latest_leg_per_edition(spark, sf_dir):
    """Largest known leg number; missing numbers are ignored."""
    legs = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("edition"),
        F.nullif(F.month("l_shipdate"), F.lit(12)).cast("double").alias("leg"),
    )
    return X.latest_leg(legs, ["l_suppkey", "edition"])


@query(
    "page_versions",
    """
    SELECT url, count(*) AS n_rows, count(DISTINCT html) AS n_versions, CAST(max(length(html)) AS INTEGER) AS kept_length
    FROM (SELECT url, html FROM pages UNION ALL SELECT url, html FROM pages
          UNION ALL SELECT url, left(html, length(html) // 2) FROM pages UNION ALL SELECT url, left(html, length(html) // 3) FROM pages)
    GROUP BY url HAVING count(DISTINCT html) > 1
    """,
)
def page_versions(spark, sf_dir):
    """Every page stored twice and cut off at a half and at a third: the whole one counts."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    cut = [pages.select("url", F.substring("html", F.lit(1), F.floor(F.length("html") / k).cast("int")).alias("html")) for k in (2, 3)]
    chosen, listed = X.page_versions(pages.unionByName(pages).unionByName(cut[0]).unionByName(cut[1]))
    lengths = chosen.select(F.col("url").alias("_url"), F.length("html").alias("kept_length"))
    return listed.join(lengths, F.col("url").eqNullSafe(F.col("_url"))).select("url", "n_rows", "n_versions", "kept_length")


@query(
    "open_columns",
    """
    SELECT c_custkey, c_name AS winner,
           CASE WHEN c_nationkey % 5 <> 0 AND c_mktsegment = 'BUILDING' THEN c_name END AS "BUILDING jersey",
           CASE WHEN c_nationkey % 5 <> 0 AND c_mktsegment = 'MACHINERY' THEN c_name END AS "MACHINERY jersey",
           CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS note
    FROM customer
    """,
)
def open_columns(spark, sf_dir):
    """Tables whose headers differ by row: a named column, two jerseys picked by their names, a note left in the map, an empty column nowhere."""
    at = F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.array(F.lit("Stages"), F.lit("Winner of stage"), F.concat("c_mktsegment", F.lit(" jersey")), F.lit("Empty"), F.lit("Note")).alias("header"),
        F.array(
            F.col("c_custkey").cast("string"), F.col("c_name"), F.when(at % 5 != 0, F.col("c_name")), F.lit(None).cast("string"),
            F.when(at % 2 == 0, F.col("c_mktsegment")),
        ).alias("cells"),
    )
    named = rows.select("c_custkey", X.cell("Winner of stage").alias("winner"), other_cells(F.col("header"), F.col("cells"), ["Stages", "Winner of stage"]).alias("others"))
    spread = spread_out(named, "others", lambda name: name.rlike("^(B|M).* jersey$"))
    return spread.withColumn("note", F.col("others")["Note"]).drop("others")
