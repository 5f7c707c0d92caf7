"""JSON structure messages: dataflow catalogue and code lists."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.functions.text import label_or_english

CODES_TYPE = "array<struct<id: string, name: string, names: map<string, string>>>"
CODELIST_MESSAGE = f"struct<codelists: array<struct<codes: {CODES_TYPE}>>>"
CATALOGUE_MESSAGE = "struct<dataflows: array<struct<id: string, version: string>>>"


def codes_of(message: Column) -> Column:
    """Codes of the newest (last) code list of a message, null when it has none."""
    return F.try_element_at(message["codelists"], F.lit(-1))["codes"]


def explode_codes(df: DataFrame, keys, codes: Column) -> DataFrame:
    """(keys.., code, label): null ids skipped, and of a repeated id the last entry counts."""
    rows = df.select(*keys, F.posexplode_outer(codes).alias("pos", "entry")).filter(F.col("entry.id").isNotNull())
    label = label_or_english(F.col("entry.name"), F.col("entry.names"))
    return rows.groupBy(*keys, F.col("entry.id").alias("code")).agg(F.max_by(label, F.col("pos")).alias("label"))


def scan_codelists(spark: SparkSession, folder: str) -> DataFrame:
    """(agency, codelist_id, code, label) from landed ``<agency>/<id>.json`` files. A broken document fails the scan."""
    path = F.col("_metadata.file_path")
    docs = spark.read.json(
        folder, schema=f"data {CODELIST_MESSAGE}", multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json", mode="FAILFAST"
    ).select(
        F.regexp_extract(path, r"([^/]+)/([^/]+)\.json$", 1).alias("agency"),
        F.regexp_extract(path, r"([^/]+)/([^/]+)\.json$", 2).alias("codelist_id"),
        codes_of(F.col("data")).alias("codes"),
    )
    return explode_codes(docs, ["agency", "codelist_id"], F.col("codes"))


def scan_catalogue(spark: SparkSession, path) -> DataFrame:
    """(pos, flow_id, version) of every dataflow the catalogue lists. A broken document fails the scan."""
    doc = spark.read.json(path, schema=f"data {CATALOGUE_MESSAGE}", multiLine=True, mode="FAILFAST")
    return doc.select(F.posexplode("data.dataflows").alias("pos", "flow")).select(
        "pos", F.col("flow.id").alias("flow_id"), F.coalesce(F.col("flow.version"), F.lit("")).alias("version")
    )
