"""CSV scans. Every cell is read as text; types are assigned by the pipelines."""

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macroloom.functions.dates import published_date
from macroloom.functions.text import null_if_in
from macroloom.operators.observations import drop_envelope, named, plain_headers
from macroloom.schema import MISSING_TOKENS
from macroloom.sources.text_lines import scan_lines
from macroloom.work import stored


def file_forms(spark: SparkSession, path) -> list:
    """(file, header line, whether some cell spans lines) of every file: one row each, from one text scan.

    A cell that spans lines shows as a line with an odd number of quotes.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")).alias("at"),
        "value",
        (quotes % 2 == 1).alias("open"),
    )
    header = F.regexp_replace(F.min_by("value", "at"), "^\ufeff", "")
    return lines.groupBy("file").agg(header.alias("header"), F.max("open").alias("multi_line")).orderBy("file").collect()


def logical_rows(spark: SparkSession, files: list) -> DataFrame:
    """(file, first, value): the rows of CSV files with cells that span lines; ``first`` marks each file's header.

    Files are split between tasks at line breaks all the same. A line break is inside a cell where an
    odd number of quotes stands before it. Every file block counts its quotes; a running sum over the
    blocks before, one row each, tells a block how it starts, and another one which row is still open
    there. Lines that are rows by themselves stay where they are; only pieces of longer rows are shuffled.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value", quotes.alias("quotes"),
    )
    at = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy(*at).agg(F.sum("quotes").alias("quotes"))
    opened = counts.select(*at, F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy(*at).orderBy("seq")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(opened, at).withColumn("starts", (before + F.col("earlier")) % 2 == 0).drop("earlier")
    placed = placed.withColumn("row", F.last(F.when(F.col("starts"), F.col("seq")), ignorenulls=True).over(inside))
    placed = stored(placed, "csv-lines")
    # A row that goes on from earlier blocks has the number of the last row that starts in them.
    ends = placed.groupBy(*at).agg(F.max_by("row", "seq").alias("row"))
    carried = ends.select(*at, F.last("row", ignorenulls=True).over(earlier).alias("carried"))
    placed = placed.join(carried, at).withColumn("row", F.coalesce("row", "carried"))
    # A file whose header ends in CRLF has its line breaks, those in cells too, as LF, as Spark's reader has them.
    first = F.struct("block", "seq")
    heads = placed.groupBy("file").agg(F.min_by("row", first).alias("head"), F.min_by(F.col("value").endswith("\r"), first).alias("crlf"))
    whole = F.col("starts") & (F.col("quotes") % 2 == 0)
    pieces = placed.filter(~whole).groupBy("file", "row").agg(F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("p"))
    rows = placed.filter(whole).select("file", "row", "value").union(pieces.select("file", "row", F.array_join("p.value", "\n")))
    value = F.regexp_replace(F.when(F.col("crlf"), F.replace("value", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value")), "\r$", "")
    marked = rows.join(heads, "file").select("file", (F.col("row") == F.col("head")).alias("first"), value.alias("value"))
    return marked.filter("value <> ''")


def _of_one_header(spark: SparkSession, files: list, header: str, spans_lines: bool, multi_line: bool) -> DataFrame:
    names = spark.range(1).select(csv_cells(F.lit(header)).alias("c")).first()[0]
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__broken"]])
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "__broken"}
    if spans_lines and not multi_line:
        columns = ", ".join(f"`{n}` string" for n in schema.fieldNames())
        rows = logical_rows(spark, files).filter(~F.col("first"))
        df = rows.select(F.from_csv("value", columns, options).alias("r")).select("r.*")
    else:
        df = spark.read.schema(schema).option("columnPruning", "false").csv(files, header=True, multiLine=multi_line, encoding="UTF-8", **options)
    # Short rows end in nulls; a row with more cells than the header names cannot be placed.
    # Named beside the broken line, a cell keeps the scan from reading that line alone, which Spark refuses.
    too_long = F.size(csv_cells(F.rtrim(F.coalesce("__broken", named(names[0]))))) > len(names)
    message = F.concat(F.lit(f"more than {len(names)} cells in a row: "), F.col("__broken"))
    checked = F.when(F.col("__broken").isNull() | ~too_long, True).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(checked).drop("__broken")


def read_text_csv(spark: SparkSession, path, multi_line=None) -> DataFrame:
    """CSV with a header and doubled quotes; an empty cell is null and nothing else is.

    Every file is read by its own header, which is one line; columns that only some files have are
    null in the others. A row with more cells than its header is an error. All files are split
    between tasks, those with cells that span lines by ``logical_rows``; ``multi_line=True`` has
    every file read whole instead, and ``False`` takes every line for a row.
    """
    forms: dict = {}
    for file, header, spans in file_forms(spark, path):
        name = re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))
        forms.setdefault((header, spans and multi_line is None), []).append(name)
    if not forms:
        return spark.read.csv(path, header=True)
    parts = [_of_one_header(spark, files, header, spans, bool(multi_line)) for (header, spans), files in forms.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_observations(spark: SparkSession, path, multi_line=None) -> DataFrame:
    """Observation file: the usual missing-value tokens are null in every column."""
    df = read_text_csv(spark, path, multi_line)
    return df.select(*[null_if_in(named(c), MISSING_TOKENS).alias(c) for c in df.columns])


def scan_sidecar(spark: SparkSession, path, multi_line=None) -> DataFrame:
    """Series metadata file: texts such as ``N/A`` stay, headers lose their ``[]`` marker."""
    return drop_envelope(plain_headers(read_text_csv(spark, path, multi_line)))


CELL = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def csv_cells(line):
    """Cells of one CSV line as an array, for files whose header differs from file to file."""

    def unquoted(cell):
        inner = F.replace(F.regexp_extract(cell, r'(?s)^"(.*)"$', 1), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), inner).otherwise(cell)

    return F.transform(F.regexp_extract_all(line, F.lit(CELL), F.lit(1)), unquoted)


def scan_probes(spark: SparkSession, folder: str) -> DataFrame:
    """(flow_id, version, published) from landed ``<flow>/<version>.csv`` probe files.

    Folders ``flow_id=<flow>/version=<version>`` with files of any name are read alike. A file whose
    header names FLOW_ID and VERSION holds the probes of many flow versions, one a row, wherever it
    lies: catalogues of very many flow versions are landed in few files.

    A file (or, in a file of many, a flow version) without rows or without a PUBLICATION_DATE column
    yields no row, which is what a failed probe looks like downstream. Each file's own header line
    decides which cell is the date; a probe asks for one observation, so only the first row of a flow
    version in a file matters.
    """
    lines = scan_lines(spark, folder, "*.csv")
    heads = lines.filter("line_no = 0").select("file", csv_cells(F.col("value")).alias("header"))
    of_many = F.array_contains("header", "FLOW_ID") & F.array_contains("header", "VERSION")
    rows = lines.filter("line_no > 0").join(heads, "file").withColumn("many", of_many).filter(F.col("many") | (F.col("line_no") == 1))
    cells = rows.select("file", "line_no", "many", "header", csv_cells(F.col("value")).alias("cells"))

    def cell(name):
        at = F.array_position("header", name)
        return F.when(at > 0, F.get("cells", (at - 1).cast("int")))

    def part(name, nth):
        folder = F.regexp_extract("file", rf"/{name}=([^/]+)/", 1)
        of_path = F.when(folder != "", folder).otherwise(F.regexp_extract("file", r"([^/]+)/([^/]+)\.csv$", nth))
        return F.when(F.col("many"), cell(name.upper())).otherwise(of_path).alias(name)

    probes = cells.select("file", "line_no", part("flow_id", 1), part("version", 2), published_date(cell("PUBLICATION_DATE")).alias("published"))
    first = probes.groupBy("file", "flow_id", "version").agg(F.min_by("published", "line_no").alias("published"))
    return first.select("flow_id", "version", "published").filter(F.col("published").isNotNull())
