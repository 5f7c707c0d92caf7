"""Text parsing: missing tokens, delimited cells, code shapes."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_in(value: Column, tokens) -> Column:
    """Null when the cell equals one of ``tokens``."""
    return F.when(~value.isin(list(tokens)), value)


def null_if_not_applicable(value: Column) -> Column:
    """Null when the cell reads ``N/A`` in any letter case; other text is kept."""
    return F.when(F.upper(value) != "N/A", value)


def multi_value(value: Column, delimiter: str = ";") -> Column:
    """A delimited cell as an array of trimmed pieces."""
    return F.transform(F.split(value, delimiter), lambda piece: F.trim(piece))


def fields(line: Column, delimiter: str = "\t") -> Column:
    """A ragged delimited line as an array; read it with ``field``."""
    return F.split(line, delimiter)


def field(parts: Column, index) -> Column:
    """Field ``index`` counted from zero, null past the end of the line."""
    return F.get(parts, index if isinstance(index, Column) else F.lit(index))


def aggregate_code(numeric_code: Column) -> Column:
    """Code of an aggregate that has no code of its own: ``G`` and three digits."""
    digits = numeric_code.cast("string")
    return F.concat(F.lit("G"), F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits))


def unit_from_description(description: Column) -> Column:
    """``PT`` for percentages, ``IX`` for indices, otherwise null."""
    lowered = F.lower(description)
    return F.when(lowered.contains("percent"), "PT").when(lowered.contains("index"), "IX")


def label_or_english(name: Column, names: Column) -> Column:
    """Label of a code: its name, else the English one, else empty text."""
    return F.coalesce(name, names["en"], F.lit(""))


def nth_element(html: Column, tag: str, n: int) -> Column:
    """The ``n``-th (from zero) ``<tag>…</tag>`` block of a page, null when there are fewer."""
    return F.get(F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>"), F.lit(0)), F.lit(n))


def html_segments(html: Column, tag: str) -> Column:
    """A page cut before each ``<tag …>`` and behind each ``</tag>``, so that a segment opens and closes one at most.

    Segments are (text, opens, closes), the last two 0 or 1. Comments are gone.
    """
    plain = F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?-->", ""), rf"(?i)</{tag}\s*>", f"</{tag}>")
    pieces = F.split(plain, rf"(?i)(?=<{tag}\b)|(?<=</{tag}>)")
    # Whether a segment opens an element is asked once here: a fold that asked would ask wherever it uses the answer.
    return F.transform(
        pieces, lambda s: F.struct(s.alias("text"), s.rlike(rf"(?i)^<{tag}\b").cast("int").alias("opens"), s.endswith(f"</{tag}>").cast("int").alias("closes"))
    )


def nested_element(html: Column, tag: str, n: int) -> Column:
    """The ``n``-th (from zero) ``<tag>`` of a page with all that stands in it, elements of the same tag too.

    Elements count in the order they open. A fold over the segments keeps the depth behind each; an
    element ends where the depth falls back to what it was before it, or with the page. Closing tags
    without an opening one are passed over.
    """
    return segments_element(html_segments(html, tag), n)


def segments_element(segments: Column, n: int) -> Column:
    """``nested_element`` of a page that is in segments already, for pages of which several elements are wanted."""
    start = F.struct(F.lit(0).alias("opened"), F.lit(0).alias("depth"), F.lit(-1).alias("base"), F.lit(False).alias("done"), F.lit("").alias("text"))

    def step(state, segment):
        opening = segment["opens"]
        base = F.when((opening == 1) & (state["opened"] == n), state["depth"]).otherwise(state["base"])
        depth = F.greatest(state["depth"] + opening - segment["closes"], F.lit(0))
        inside = (base >= 0) & ~state["done"]
        return F.struct(
            (state["opened"] + opening).alias("opened"),
            depth.alias("depth"),
            base.alias("base"),
            (state["done"] | (inside & (depth <= base))).alias("done"),
            F.when(inside, F.concat(state["text"], segment["text"])).otherwise(state["text"]).alias("text"),
        )

    return F.aggregate(segments, start, step, lambda state: F.when(state["base"] >= 0, state["text"]))


def count_elements(html: Column, tag: str) -> Column:
    return count_opened(html_segments(html, tag))


def count_opened(segments: Column) -> Column:
    return F.size(F.filter(segments, lambda s: s["opens"] == 1))


def element_text(block: Column) -> Column:
    """Text of an HTML block: tags removed, ends trimmed."""
    return F.regexp_replace(F.regexp_replace(block, r"(?s)<[^>]*>", ""), r"^\s+|\s+$", "")
