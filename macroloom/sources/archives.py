"""Release archives: integrity report and streaming extraction.

Spark has no reader for zip members, so this is the one place that runs Python in the tasks: an
archive per input row, members inflated piece by piece, and only elements emitted (never a
member as one cell), which the XML expressions of the JVM parse after a shuffle spreads them.
"""

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.errors import BulkPayloadCorruptError, UnexpectedFileError
from macroloom.schema import CORRUPT_RELEASES
from macroloom.work import stored

REPORT_COLUMNS = ["path", "is_zip", "bad_member", "n_xml", "n_xsd"]
UNPACKED_SCHEMA = "path string, kind string, pos bigint, element string, is_zip boolean, bad_member string, n_xml int, n_xsd int"
ELEMENT_TAG = {"xml": "Series", "xsd": "xs:simpleType"}
PIECE = 1 << 20
ROWS_PER_BATCH = 5_000


def scan_archives(spark: SparkSession, path) -> DataFrame:
    """(path, content) of landed zip files."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.zip")
        .load(path)
        .select("path", "content")
    )


def _members(path, content, kinds):
    """Rows of one archive from one inflation: its elements of ``kinds``, and its report last."""
    stream = io.BytesIO(content)
    if not zipfile.is_zipfile(stream):
        yield path, "report", None, None, False, None, 0, 0
        return
    with zipfile.ZipFile(stream) as folder:
        names = folder.namelist()
        counts = [sum(n.endswith(suffix) for n in names) for suffix in (".xml", ".xsd")]
        bad = None
        for name in names:
            kind = name.rsplit(".", 1)[-1]
            try:
                with folder.open(name) as member:
                    if kind in kinds:
                        for pos, element in enumerate(_elements(member, ELEMENT_TAG[kind])):
                            yield path, kind, pos, element, None, None, None, None
                    else:
                        while member.read(PIECE):
                            pass
            except Exception:  # a wrong checksum, a broken stream, or text that is not UTF-8
                bad = name
                break
        yield path, "report", None, None, True, bad, *counts


def unpack_archives(archives: DataFrame, kinds=("xml", "xsd")) -> DataFrame:
    """Series (``xml``) and simple types (``xsd``) of every archive, and a report row for each, in one pass.

    Reading a member to its end checks its CRC, so the archive is inflated once for all three.
    Elements of an archive that turns out to be broken are among the rows: ``open_archives``
    leaves them out.
    """

    def unpack(batches):
        for batch in batches:
            rows, held = [], 0
            for path, content in zip(batch["path"], batch["content"]):
                for row in _members(path, content, kinds):
                    rows.append(row)
                    held += len(row[3] or "")
                    if len(rows) == ROWS_PER_BATCH or held >= PIECE:
                        yield _frame(rows)
                        rows, held = [], 0
            yield _frame(rows)

    return archives.mapInPandas(unpack, UNPACKED_SCHEMA)


def _frame(rows):
    columns = [c.split()[0] for c in UNPACKED_SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=columns).astype({"pos": "Int64", "is_zip": "boolean", "n_xml": "Int32", "n_xsd": "Int32"})


def audit_archives(archives: DataFrame) -> DataFrame:
    """Report per archive: is it a zip, which member cannot be read, how many XML and XSD members."""
    return unpack_archives(archives, kinds=()).select(*REPORT_COLUMNS)


def open_archives(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report with verdict of every archive, (path, kind, pos, element) of the sound ones).

    The pass is stored, so that the report, the series and the code lists are read from it and no
    archive is inflated again. One task inflates an archive; the shuffle spreads its elements evenly, so
    that many tasks share the parsing of a large one.
    """
    unpacked = stored(unpack_archives(archives), "unpacked")
    report = stored(with_verdict(unpacked.filter("kind = 'report'").select(*REPORT_COLUMNS)), "archive-report")
    sound = report.filter("verdict = 'ok'").select("path")
    elements = unpacked.filter("kind <> 'report'").select("path", "kind", "pos", "element")
    return report, elements.join(sound, "path", "left_semi").repartition("path", "pos")


def release_of_path(path):
    """(month, year) columns of the release an archive is named after, null where it is not."""
    name = r"weo(apr|oct)([0-9]{4})-"
    code = F.regexp_extract(path, name, 1)
    month = F.when(code == "apr", "April").when(code == "oct", "October")
    return month, F.nullif(F.regexp_extract(path, name, 2), F.lit("")).try_cast("int")


def is_known_corrupt(month, year):
    """Whether the published archive of a release is itself corrupt; false where the release is not known."""
    either = F.lit(False)
    for bad_month, bad_year in CORRUPT_RELEASES:
        either = either | ((month == bad_month) & (year == bad_year))
    return F.coalesce(either, F.lit(False))


def with_verdict(report: DataFrame, known_corrupt=None) -> DataFrame:
    """Add ``verdict`` and ``is_retryable``; the published copy of some releases is itself corrupt."""
    verdict = (
        F.when(~F.col("is_zip"), "not a zip")
        .when(F.col("bad_member").isNotNull(), "bad member")
        .when((F.col("n_xml") != 1) | (F.col("n_xsd") != 1), "unexpected members")
        .otherwise("ok")
    )
    month, year = release_of_path(F.col("path"))
    labelled = report.withColumns({"verdict": verdict, "month": month, "year": year})
    if known_corrupt is None:
        return labelled.withColumn("is_retryable", ~is_known_corrupt(F.col("month"), F.col("year")))
    corrupt = known_corrupt.select("month", "year", F.lit(True).alias("__corrupt"))
    joined = labelled.join(corrupt, ["month", "year"], "left")
    return joined.withColumn("is_retryable", F.col("__corrupt").isNull()).drop("__corrupt")


def require_sound(report_with_verdict: DataFrame) -> None:
    """Raise for the first archive that cannot be read, with the reason."""
    bad = report_with_verdict.filter("verdict != 'ok'").orderBy("path").limit(1).collect()
    if not bad:
        return
    row = bad[0]
    if row["verdict"] == "unexpected members":
        raise UnexpectedFileError(
            f"{row['path']}: there should be exactly one xml and one xsd file, found {row['n_xml']} and {row['n_xsd']}"
        )
    note = "" if row["is_retryable"] else "; this release is corrupt in the published archive itself"
    detail = row["verdict"] if row["bad_member"] is None else f"member {row['bad_member']} fails its CRC"
    raise BulkPayloadCorruptError(
        f"{row['path']}: {detail}{note}", key=row["path"], reason=detail, is_retryable=row["is_retryable"]
    )


def _elements(stream, tag):
    """Texts of the ``tag`` elements of a stream, holding no more than one piece and one element."""
    opening = re.compile(rf"<{tag}(?=[\s>/])")
    closing = f"</{tag}>"
    text, at_end = "", False
    reader = io.TextIOWrapper(stream, encoding="utf-8-sig")
    while not at_end:
        piece = reader.read(PIECE)
        at_end = not piece
        text += piece
        start = opening.search(text)
        while start:
            head_end = text.find(">", start.end())
            if head_end < 0:
                break
            if text[head_end - 1] == "/":
                end = head_end + 1
            else:
                found = text.find(closing, head_end)
                if found < 0:
                    break
                end = found + len(closing)
            yield text[start.start() : end]
            text = text[end:]
            start = opening.search(text)
        if start is None:
            text = text[-(len(tag) + 2) :]
        elif start.start():
            text = text[start.start() :]
