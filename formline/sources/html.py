"""HTML stats tables as rows, read by built-in string and array functions.

A page never leaves its row until the table's body rows are exploded, so the
whole chain is one narrow stage. A table is found by matching ``table`` tags in
depth, so one inside a cell does not end the outer one; its text is text of the
cell. Cells that span rows or columns fill a grid, whose rows are then read.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The two tables of a stats page, their column prefixes and their key column.
FOR_TABLE, AGAINST_TABLE = "stats_squads_standard_for", "stats_squads_standard_against"
FOR_PREFIX, AGAINST_PREFIX = "Offensive", "Defensive"
KEY_COLUMN = "Squad"
# Seasons and address pattern of the stats pages.
FIRST_SEASON, LAST_SEASON = 2017, 2024
SEASON_URL = "https://fbref.com/en/comps/9/{year}-{next_year}/Premier-League-Stats"

_NAMED = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&nbsp;": " ", "&apos;": "'"}


def season_urls(years: DataFrame, year: str = "year", template: str = SEASON_URL) -> DataFrame:
    """The page address of every season in a table of years."""
    y = F.col(year).cast("string")
    following = (F.col(year) + 1).cast("string")
    url = F.replace(F.replace(F.lit(template), F.lit("{year}"), y), F.lit("{next_year}"), following)
    return years.select(year, url.alias("url"))


def season_range(spark, first: int = FIRST_SEASON, last: int = LAST_SEASON) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def _table_text(html: Column, table_id: str) -> Column:
    """The first table with this id, from its opening to its own closing tag; empty if there is none."""
    visible = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    quoted = re.escape(table_id)
    wanted = rf"(?is)^<table\b(?=[^>]*\sid\s*=\s*(?:\"{quoted}\"|'{quoted}'|{quoted}(?=[\s>])))[^>]*>"
    # A part begins at an opening tag or behind a closing one, and holds one tag of either kind at most.
    parts = F.split(visible, r"(?i)(?=<table\b)|(?<=</table\s{0,8}>)")
    state = lambda depth, own, done, text: F.struct(
        depth.alias("depth"), own.alias("own"), done.alias("done"), text.alias("text")
    )

    def step(s: Column, part: Column) -> Column:
        opens = part.rlike(r"(?i)^<table\b")
        depth = s["depth"] + F.when(opens, 1).otherwise(0)
        own = F.when((s["own"] == 0) & opens & part.rlike(wanted), depth).otherwise(s["own"])
        ends = part.rlike(r"(?i)</table\s{0,8}>$")
        shown = F.when(depth > own, F.regexp_replace(part, r"(?s)<[^>]*>", " ")).otherwise(part)
        text = F.when((own > 0) & ~s["done"], F.concat(s["text"], shown)).otherwise(s["text"])
        done = s["done"] | (ends & (own > 0) & (depth == own))
        return state(F.greatest(depth - F.when(ends, 1).otherwise(0), F.lit(0)), own, done, text)

    start = state(F.lit(0), F.lit(0), F.lit(False), F.lit(""))
    return F.aggregate(parts, start, step, lambda s: F.when(s["done"], s["text"]).otherwise(""))


def _numbered(plain: Column) -> Column:
    """``&#65;`` and ``&#x41;`` as their characters; a number that is no character becomes U+FFFD."""
    found = F.array_distinct(F.regexp_extract_all(plain, F.lit(r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), F.lit(0)))

    def char(entity: Column) -> Column:
        digits = F.regexp_extract(entity, r"([0-9a-fA-F]+);", 1)
        code = F.when(F.lower(entity).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("int")
        known = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        safe = F.when(known, code).otherwise(0xFFFD)
        # An ampersand is named again, so that what follows it is not read as an entity of its own.
        return F.when(code == 38, "&amp;").otherwise(F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32"))

    return F.aggregate(found, plain, lambda text, entity: F.replace(text, entity, char(entity)))


def _text(cell: Column) -> Column:
    plain = _numbered(F.regexp_replace(cell, r"(?s)<[^>]*>", ""))
    names = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    found = F.array_distinct(F.regexp_extract_all(plain, F.lit(r"&[A-Za-z][A-Za-z0-9]*;"), F.lit(0)))
    # Ampersands come last, so that what they lead to is not read as an entity.
    others = F.filter(found, lambda e: (e != "&amp;") & F.map_contains_key(names, e))
    plain = F.aggregate(others, plain, lambda text, e: F.replace(text, e, F.try_element_at(names, e)))
    return F.trim(F.regexp_replace(F.replace(plain, F.lit("&amp;"), F.lit("&")), r"\s+", " "))


def _cells(row: Column) -> Column:
    """The cells of one row: text ``t`` and ``left``, the rows below that it covers; one that spans columns is repeated."""
    cell = F.lit(r"(?is)<t[hd]\b([^>]*)>(.*?)</t[hd]\s*>")
    attributes = F.regexp_extract_all(row, cell, F.lit(1))
    texts = F.regexp_extract_all(row, cell, F.lit(2))

    def span(attribute: Column, name: str) -> Column:
        said = F.regexp_extract(attribute, rf"(?i)\b{name}\s*=\s*[\"']?(\d{{1,5}})", 1)
        return F.when(said == "", 1).otherwise(F.greatest(said.cast("int"), F.lit(1)))

    def spread(text: Column, attribute: Column) -> Column:
        one = F.struct(_text(text).alias("t"), (span(attribute, "rowspan") - 1).alias("left"))
        return F.array_repeat(one, span(attribute, "colspan"))

    return F.flatten(F.zip_with(texts, attributes, spread))


_PLACED = "array<struct<t:string,left:int>>"


def _grid(rows: Column) -> Column:
    """Rows of cell texts: a cell that covers rows below it stands in each of them, in its own column.

    Spans beyond the last row are cut; a column that neither a span nor a cell fills is null.
    """

    def place(open_spans: Column, cells: Column) -> Column:
        """The cells of one row, put into the columns that no open span holds."""
        held = F.filter(F.sequence(F.lit(0), F.size(open_spans)), lambda k: F.coalesce(F.get(open_spans, k)["left"] > 0, F.lit(False)))
        last = F.coalesce(F.element_at(F.concat(F.array(F.lit(-1)), held), -1), F.lit(-1))
        width = F.greatest(F.size(cells) + F.size(held), last + 1)

        def step(s: Column, k: Column) -> Column:
            above, cell = F.get(open_spans, k), F.get(cells, s["next"])
            covered = F.coalesce(above["left"] > 0, F.lit(False))
            entry = F.when(covered, F.struct(above["t"].alias("t"), (above["left"] - 1).alias("left"))).otherwise(
                F.struct(cell["t"].alias("t"), F.coalesce(cell["left"], F.lit(0)).alias("left"))
            )
            return F.struct(
                (s["next"] + F.when(covered, 0).otherwise(1)).alias("next"), F.concat(s["out"], F.array(entry)).alias("out")
            )

        start = F.struct(F.lit(0).alias("next"), F.array().cast(_PLACED).alias("out"))
        columns = F.filter(F.sequence(F.lit(0), width), lambda k: k < width)
        return F.aggregate(columns, start, step, lambda s: s["out"])

    def below(s: Column, cells: Column) -> Column:
        both = lambda p: F.struct(p.alias("above"), F.concat(s["rows"], F.array(p)).alias("rows"))
        return F.get(F.transform(F.array(place(s["above"], cells)), both), F.lit(0))

    start = F.struct(F.array().cast(_PLACED).alias("above"), F.array().cast(f"array<{_PLACED}>").alias("rows"))
    filled = F.aggregate(rows, start, below, lambda s: s["rows"])
    spans = F.exists(rows, lambda cells: F.exists(cells, lambda c: c["left"] > 0))
    return F.transform(F.when(spans, filled).otherwise(rows), lambda cells: F.transform(cells, lambda c: c["t"]))


def flat_names(top: Column, sub: Column) -> Column:
    """``sub`` under an unnamed top cell, else ``top_sub``."""

    def name(upper: Column, lower: Column) -> Column:
        unnamed = upper.isNull() | (upper == "") | upper.contains("Unnamed")
        return F.when(unnamed, lower).otherwise(F.concat_ws("_", upper, lower))

    return F.zip_with(top, sub, name)


def prefix_names(names: Column, prefix: str, key: str = KEY_COLUMN) -> Column:
    """Put ``prefix_`` before every name but the key's."""
    return F.transform(names, lambda n: F.when(n == key, n).otherwise(F.concat(F.lit(prefix + "_"), n)))


def html_tables(
    pages: DataFrame, ids: Sequence[str], table_id: str, html: str = "html", header_rows: int = 2, prefix: str | None = None
) -> DataFrame:
    """Body rows of the table ``table_id``: ids, ``row_no``, ``names`` and ``cells`` arrays.

    Pages without the table give no rows. An empty cell is null.
    """
    tr = F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>")
    # A page without the table has no rows to explode, so it needs no filter of its own.
    cells = F.transform(F.regexp_extract_all(F.col("_table"), tr, F.lit(1)), _cells)
    found = pages.select(*ids, _table_text(F.col(html), table_id).alias("_table")).select(*ids, cells.alias("_cells"))
    parsed = found.select(*ids, _grid(F.col("_cells")).alias("_rows"))
    names = F.get("_rows", F.lit(0))
    if header_rows == 2:
        names = flat_names(names, F.get("_rows", F.lit(1)))
    if prefix:
        names = prefix_names(names, prefix)
    body = F.slice("_rows", header_rows + 1, F.greatest(F.size("_rows") - header_rows, F.lit(0)))
    return (
        parsed.select(*ids, names.alias("names"), F.posexplode(body).alias("row_no", "_cells"))
        .select(*ids, "row_no", "names", F.transform("_cells", lambda c: F.nullif(c, F.lit(""))).alias("cells"))
    )


def cell(name: str) -> Column:
    """The cell under column ``name``; null if the table has no such column."""
    return F.get("cells", F.array_position("names", name) - 1)


def pick_columns(rows: DataFrame, ids: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """A flat table: output name -> table column name."""
    return rows.select(*ids, "row_no", *[cell(source).alias(out) for out, source in columns.items()])


def drop_repeated_headers(rows: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """Drop body rows whose key cell repeats the key's own name."""
    return rows.where(F.coalesce(cell(key), F.lit("")) != key)


def missing_tables(pages: DataFrame, ids: Sequence[str], table_ids: Sequence[str], html: str = "html") -> DataFrame:
    """The reject list: one row per page and table that the page does not have; a null page has none."""
    found = lambda t: F.coalesce(_table_text(F.col(html), t) != "", F.lit(False))
    checks = [F.struct(F.lit(t).alias("table_id"), found(t).alias("found")) for t in table_ids]
    return pages.select(*ids, F.inline(F.array(*checks))).where(~F.col("found")).drop("found")


def squad_stats(
    pages: DataFrame, ids: Sequence[str], for_columns: Mapping[str, str], against_columns: Mapping[str, str]
) -> DataFrame:
    """Both tables of a page, cleaned, prefixed and left-merged on the squad.

    The column maps name output columns by their flat, prefixed table names.
    """
    offence = drop_repeated_headers(html_tables(pages, ids, FOR_TABLE, prefix=FOR_PREFIX))
    defence = drop_repeated_headers(html_tables(pages, ids, AGAINST_TABLE, prefix=AGAINST_PREFIX))
    left = pick_columns(offence, ids, {KEY_COLUMN: KEY_COLUMN, **for_columns}).drop("row_no")
    right = pick_columns(defence, ids, {KEY_COLUMN: KEY_COLUMN, **against_columns}).drop("row_no")
    return left.join(right, [*ids, KEY_COLUMN], "left")
