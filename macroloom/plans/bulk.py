"""Release archives to labelled observations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.functions.numbers import grouped_real, whole
from macroloom.operators.lookup import lookup
from macroloom.operators.observations import named
from macroloom.schema import BULK_CODELISTS, BULK_REALS, BULK_WHOLE_NUMBERS
from macroloom.sources.archives import open_archives, require_sound
from macroloom.sources.xml_docs import enumerations, parse_series, parse_simple_type, series_to_rows
from macroloom.work import stored


def add_labels(rows: DataFrame, codes: DataFrame, per=()) -> DataFrame:
    """Suffix the five coded columns with ``_CODE`` and put a ``_LABEL`` beside each.

    ``codes`` is (per.., codelist_id, code, label); with ``per=("path",)`` every archive is
    labelled from its own schema file.
    """
    for column, codelist in BULK_CODELISTS.items():
        dim = codes.filter(F.col("codelist_id") == codelist)
        on = {**{p: p for p in per}, column: "code"}
        rows = lookup(rows, dim, on, {"label": f"{column}_LABEL"}).withColumnRenamed(column, f"{column}_CODE")
    return rows


def clean_numbers(rows: DataFrame) -> DataFrame:
    """Thousands separators removed, anything that is no number null, whole numbers typed."""
    typed = {c: grouped_real(named(c)) for c in BULK_REALS}
    typed |= {c: whole(grouped_real(named(c)), to) for c, to in BULK_WHOLE_NUMBERS.items()}
    return rows.withColumns(typed)


def parse_archives(archives: DataFrame, check: bool = True, with_path: bool = False) -> DataFrame:
    """Observations of any number of archives, in the vocabulary they were published in.

    ``check`` raises for an archive that is not a sound zip of one XML and one XSD file; without it
    such archives have no rows.
    """
    rows, report = parse_with_report(archives)
    if check:
        require_sound(report)
    return rows if with_path else rows.drop("path")


def parse_with_report(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations of the sound archives with their path, report with verdict of every archive)."""
    report, elements = open_archives(archives)
    series = elements.filter("kind = 'xml'").select("path", parse_series(F.col("element")).alias("s"))
    rows = series_to_rows(series.select("path", "s.*"), keep=["path"])
    types = elements.filter("kind = 'xsd'").select("path", parse_simple_type(F.col("element")).alias("t"))
    # Five labels are read from the code lists, so they are written once; they are small.
    codes = stored(enumerations(types.select("path", "t.*"), keep=["path"]), "bulk-codes")
    return clean_numbers(add_labels(rows, codes, per=("path",))), report
