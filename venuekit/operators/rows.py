"""Operators that turn one row into several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.functions.json import is_nested, json_pairs, literal_map, nested_pairs
from venuekit.functions.text import strip_chars, without_markup

# Attribute values that mean "not given".
PLACEHOLDERS = ("None", "none")


def explode_list(df: DataFrame, column: str, alias: str, *keep: str, separator: str = ",") -> DataFrame:
    """One row per item of a separated list; items are not trimmed."""
    return df.select(*keep, F.explode(F.split(column, separator)).alias(alias))


def posexplode_list(
    df: DataFrame, items: Column, position: str, alias: str, *keep: str
) -> DataFrame:
    """One row per array item with its zero-based position."""
    return df.select(*keep, F.posexplode(items).alias(position, alias))


def flatten_attributes(df: DataFrame, key: str, attributes: str) -> DataFrame:
    """Nested attribute JSON to rows (key, attr_key, attr_val) without placeholders."""
    pair = df.select(key, F.explode(nested_pairs(F.col(attributes))).alias("pair"))

    def unquote(c: Column) -> Column:
        return strip_chars(F.replace(c, F.lit("u'"), F.lit("")), "'")

    return pair.select(
        key,
        unquote(F.col("pair.key")).alias("attr_key"),
        unquote(F.col("pair.value")).alias("attr_val"),
    ).where(~F.col("attr_val").isin(list(PLACEHOLDERS)))


def unread_attributes(df: DataFrame, key: str, attributes: str) -> DataFrame:
    """Attribute texts (with a NULL key) and objects nested in them that do not parse, for a data check."""
    text = F.col(attributes)
    whole = df.where(text.isNotNull() & (F.trim(text) != "") & F.from_json(text, "map<string,string>").isNull())
    nested = (
        df.select(key, F.explode(json_pairs(F.col(attributes))).alias("pair"))
        .select(key, F.col("pair.key").alias("attr_key"), F.col("pair.value").alias("attr_val"))
        .where(is_nested(F.col("attr_val")) & literal_map(F.col("attr_val")).isNull())
    )
    return nested.unionAll(whole.select(key, F.lit(None).cast("string").alias("attr_key"), text.alias("attr_val")))


def html_rows(
    df: DataFrame, key: str, html: str, pattern: str, names: tuple[str, ...]
) -> DataFrame:
    """Repeated elements of stored pages as rows.

    ``pattern`` matches one element and has one group per name in ``names``.
    """
    element = F.col("element")
    found = F.posexplode(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)))
    return df.select(key, found.alias("pos", "element")).select(
        key,
        "pos",
        *[F.regexp_extract(element, pattern, i).alias(n) for i, n in enumerate(names, start=1)],
    )


#: Comments, scripts, tags and the text between them, in the order in which they stand.
_MARKUP = r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*+>|<[^<>]*+>|[^<]++|<"
# The most columns a cell may span, and rows that stand for "to the end" where zero is given.
MOST_COLUMNS, TO_THE_END = 1000, 65534


def _span(tag: Column, name: str) -> Column:
    given = F.regexp_extract(tag, rf"(?i)\s{name}\s*+=\s*+[\"']?(\d{{1,5}})", 1)
    return F.coalesce(given.try_cast("int"), F.lit(1))


def _table_cells(df: DataFrame, key: str, html: str, number: int) -> DataFrame:
    """Cells (_page, key, row, cell, text, across, down) of the ``number``-th outer table of each page.

    The depth of tables at each tag is a running sum along the page, so that a table
    ends at its own end tag; what stands in tables inside a cell is text of that cell.
    """
    tokens = F.posexplode(F.regexp_extract_all(html, F.lit(_MARKUP), F.lit(0))).alias("at", "token")
    rows = df.select(key, F.monotonically_increasing_id().alias("_page"), html).select(key, "_page", tokens)
    # a page's tags in order; a page is one value, which bounds the group
    along = Window.partitionBy("_page").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tag = F.lower(F.regexp_extract("token", r"^(</?[a-zA-Z]+)[\s/>]", 1))
    step = F.when(tag == "<table", 1).when(tag == "</table", -1).otherwise(0)
    rows = rows.where(~F.col("token").rlike(r"(?is)^<(?:!--|script\b|style\b)")).withColumns({"_tag": tag, "_step": step})
    rows = rows.withColumn("_sum", F.sum("_step").over(along))
    # end tags without a table before them count for nothing
    rows = rows.withColumn("_depth", F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(along)))
    outer = (F.col("_depth") == 1) & (F.col("_tag") == "<table")
    rows = rows.withColumn("_table", F.count_if(outer).over(along)).where((F.col("_table") == number) & (F.col("_depth") >= 1))
    own = F.col("_depth") == 1
    opens = own & F.col("_tag").isin("<td", "<th")
    ends = own & F.col("_tag").isin("</td", "</th", "<tr", "</tr", "<table")
    mark = F.when(opens, True).when(ends, False)
    rows = rows.withColumns(
        {
            "_row": F.count_if(own & (F.col("_tag") == "<tr")).over(along),
            "_cell": F.count_if(opens).over(along),
            "_inside": F.last(mark, ignorenulls=True).over(along),
            "_opens": opens,
        }
    ).where(F.col("_inside") | (own & (F.col("_tag") == "<tr")))
    parts = F.array_sort(F.collect_list(F.struct("at", "token")))
    first = F.max(F.when(F.col("_opens"), F.col("token")))
    across, down = _span(F.col("_first"), "colspan"), _span(F.col("_first"), "rowspan")
    return (
        rows.groupBy("_page", "_row", "_cell")
        .agg(F.first(key).alias(key), parts["token"].alias("_parts"), first.alias("_first"))
        .select(
            "_page", key, "_row", "_cell",
            without_markup(F.array_join("_parts", "")).alias("text"),
            # a row's start tag is an entry without a width, so that a row without cells is known
            F.when(F.col("_first").isNotNull(), F.least(F.greatest(across, F.lit(1)), F.lit(MOST_COLUMNS))).alias("across"),
            F.when(down == 0, TO_THE_END).otherwise(down).alias("down"),
        )
    )


def _laid_out(rows: Column) -> Column:
    """Rows of cells (text, across, down) as rows of texts, each cell repeated in all the places that it covers."""
    kept = "array<struct<col:int,left:int,text:string>>"
    start = F.struct(F.array().cast(kept).alias("pending"), F.array().cast("array<array<string>>").alias("lines"))

    def place(state: Column, row: Column) -> Column:
        pending = state["pending"]
        slots = F.flatten(F.transform(row["cells"], lambda c: F.array_repeat(F.struct(c["text"], c["down"]), c["across"])))
        taken = F.transform(pending, lambda p: p["col"])
        reach = F.size(slots) + F.size(pending) + F.coalesce(F.array_max(taken), F.lit(0))
        free = F.filter(F.sequence(F.lit(0), reach), lambda i: ~F.array_contains(taken, i))
        placed = F.transform(slots, lambda s, i: F.struct(F.get(free, i).alias("col"), s["down"].alias("left"), s["text"].alias("text")))
        every = F.concat(pending, placed)
        width = F.array_max(F.transform(every, lambda c: c["col"]))
        line = F.transform(F.sequence(F.lit(0), width), lambda i: F.get(F.filter(every, lambda c: c["col"] == i), 0)["text"])
        line = F.coalesce(line, F.array().cast("array<string>"))
        open_ = F.transform(
            F.filter(every, lambda c: c["left"] > 1),
            lambda c: F.struct(c["col"].alias("col"), (c["left"] - 1).alias("left"), c["text"].alias("text")),
        )
        return F.struct(open_.cast(kept).alias("pending"), F.concat(state["lines"], F.array(line)).alias("lines"))

    return F.aggregate(rows, start, place, lambda state: F.filter(state["lines"], lambda line: F.size(line) > 0))


def html_table(df: DataFrame, key: str, html: str, columns: tuple[str, ...], number: int = 1) -> DataFrame:
    """Body rows of one outer table of each stored page, by default of the first; its first row is the header.

    Tables may be nested, and cells may span columns and rows: their text then stands in each place
    that they cover.  A row with fewer cells than ``columns`` has NULL in the others; rows that nothing covers don't count.
    Pages without the table have no row.
    """
    cells = _table_cells(df, key, html, number)
    listed = F.array_sort(F.collect_list(F.struct("_cell", "text", "across", "down")))
    rows = cells.groupBy("_page", "_row").agg(F.first(key).alias(key), F.filter(listed, lambda c: c["across"].isNotNull()).alias("cells"))
    pages = rows.groupBy("_page").agg(F.first(key).alias(key), F.array_sort(F.collect_list(F.struct("_row", "cells"))).alias("_rows"))
    return (
        pages.select(key, F.posexplode(_laid_out(F.col("_rows"))).alias("pos", "cells"))
        .where("pos > 0")
        .select(key, "pos", *[F.get("cells", i).alias(c) for i, c in enumerate(columns)])
    )
