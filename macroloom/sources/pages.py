"""Table cells of landed HTML pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macroloom.functions.dates import long_date
from macroloom.functions.text import count_elements, element_text, html_segments, nested_element, segments_element


def cell(html: Column, table: int, row: int) -> Column:
    """Text of the first cell of row ``row`` of table ``table`` (both from zero), tables inside tables counted as they open."""
    return segments_cell(html_segments(html, "table"), table, row)


def segments_cell(tables: Column, table: int, row: int) -> Column:
    """``cell`` of a page that is in segments of its tables already."""
    return element_text(nested_element(nested_element(segments_element(tables, table), "tr", row), "td", 0))


def announced_date(pages: DataFrame, html: str = "html", table: int = 4, row: int = 1) -> DataFrame:
    """Add ``announced`` (date) and ``problem`` (null, or what the page lacks)."""
    body = F.col(html)
    # Each step is a column of its own: written into each other, every one would repeat those before it.
    pages = pages.withColumn("__table", nested_element(body, "table", table))
    pages = pages.withColumn("__row", nested_element(F.col("__table"), "tr", row))
    pages = pages.withColumn("__cell", nested_element(F.col("__row"), "td", 0))
    the_table, the_row, the_cell = F.col("__table"), F.col("__row"), F.col("__cell")
    found_tables, found_rows = count_elements(body, "table"), count_elements(the_table, "tr")
    announced = long_date(element_text(the_cell))
    problem = (
        F.when(the_table.isNull(), F.format_string(f"expected at least {table + 1} tables, found %d", found_tables))
        .when(the_row.isNull(), F.format_string(f"expected at least {row + 1} rows, found %d", found_rows))
        .when(the_cell.isNull(), F.lit("the row has no cell"))
        .when(announced.isNull(), F.concat(F.lit("not a date: "), element_text(the_cell)))
    )
    return pages.withColumns({"announced": announced, "problem": problem}).drop("__table", "__row", "__cell")
