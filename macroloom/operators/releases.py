"""Which release is served by which flow, which is newest, and what to roll back to."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macroloom.functions.dates import release_month, release_ordinal, version_key, vintage_month, vintage_year
from macroloom.functions.labels import archive_paths
from macroloom.operators.observations import named
from macroloom.work import inline
from macroloom.schema import BULK_RELEASES, CORRUPT_RELEASES, MAX_ROLL_BACK


def candidate_flows(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows that are the bare flow or an archival one."""
    return catalogue.filter((F.col("flow_id") == "WEO") | F.col("flow_id").rlike(r"^WEO_[0-9]{4}_[A-Z]{3}_VINTAGE$"))


def label_flows(candidates: DataFrame, probes: DataFrame) -> DataFrame:
    """Each flow version with the release it serves.

    The probed publication date decides. Without one, an archival flow is labelled by its own
    id; ``month`` and ``year`` stay null where that does not work either.
    """
    probes = probes.select("flow_id", "version", "published")
    labelled = candidates.join(probes, ["flow_id", "version"], "left")
    probed = F.col("published").isNotNull()
    by_id = vintage_month(F.col("flow_id")).isNotNull()
    return labelled.select(
        "flow_id",
        "version",
        "pos",
        (F.col("flow_id") == "WEO").alias("is_bare"),
        probed.alias("probed"),
        F.when(probed, release_month(F.col("published"))).otherwise(vintage_month(F.col("flow_id"))).alias("month"),
        F.when(probed, F.year("published")).when(by_id, vintage_year(F.col("flow_id"))).alias("year"),
    )


def preferred_flow(labelled: DataFrame, key=("month", "year")) -> DataFrame:
    """One flow per release: bare before archival, then the higher version, then the earlier row.

    An aggregate rather than a window, so a release claimed by very many rows is reduced
    before it is shuffled.
    """
    rank = F.struct(F.col("is_bare"), version_key(F.col("version")), -F.col("pos"))
    chosen = F.max_by(F.struct("flow_id", "version"), rank).alias("__flow")
    usable = labelled.filter(F.col(key[0]).isNotNull() & F.col(key[1]).isNotNull())
    return usable.groupBy(*key).agg(chosen).select(*key, "__flow.flow_id", "__flow.version")


def known_bulk(spark: SparkSession) -> DataFrame:
    """(month, year, corrupt) of every bulk release ever published."""
    rows = [(*release, release in CORRUPT_RELEASES) for release in BULK_RELEASES]
    return inline(spark, rows, "month string, year int, corrupt boolean")


def release_table(mapped: DataFrame, bulk: DataFrame) -> DataFrame:
    """(month, year, flow_id, version, listed) of every release of either source, newest first.

    The flow is null for releases that only the bulk archive has. ``listed`` is false for those whose
    published archive is corrupt: they are not offered, although a flow may serve them by name.
    """
    listed = served_releases(mapped, bulk, bulk.filter("corrupt")).withColumn("listed", F.lit(True))
    every = bulk.select("month", "year").union(mapped.select("month", "year")).distinct()
    flows = every.join(mapped.select("month", "year", "flow_id", "version"), ["month", "year"], "left")
    known = flows.join(listed, ["month", "year"], "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    return newest_first(known.select("month", "year", "flow_id", "version", "listed"))


def newest_first(releases: DataFrame) -> DataFrame:
    return releases.orderBy(F.col("year").desc(), (F.col("month") == "October").desc())


def latest(releases: DataFrame) -> DataFrame:
    """The newest release as one row."""
    top = F.max_by(F.struct("month", "year"), release_ordinal(F.col("month"), F.col("year"))).alias("top")
    return releases.agg(top).select("top.*").filter(F.col("month").isNotNull())


def served_releases(mapped: DataFrame, bulk: DataFrame, corrupt: DataFrame) -> DataFrame:
    """Releases of either source without those known to be corrupt."""
    every = mapped.select("month", "year").union(bulk.select("month", "year")).distinct()
    return every.join(corrupt.select("month", "year"), ["month", "year"], "left_anti")


def roll_back_candidates(releases: DataFrame, failed, attempts: int = MAX_ROLL_BACK) -> DataFrame:
    """The next older releases after ``failed``; the newest ones if it is not in the list."""
    month, year = failed
    is_failed = (F.col("month") == month) & (F.col("year") == year)
    if not releases.filter(is_failed).isEmpty():
        cut = year * 2 + (1 if month == "October" else 0)
        releases = releases.filter(release_ordinal(F.col("month"), F.col("year")) < cut)
    return newest_first(releases).limit(attempts)


def first_existing_path(releases: DataFrame, manifest: DataFrame) -> DataFrame:
    """For each release, the first candidate path that exists.

    ``manifest`` is (path, status). A status below 400 exists, 404 (or no row) moves on to the
    next candidate, and any other status met before that makes the release an ``error``:
    being refused is no evidence that a release was never published.
    """
    tried = releases.select(
        "month", "year", F.posexplode(archive_paths(F.col("month"), F.col("year"))).alias("pos", "path")
    ).join(manifest.select("path", "status"), "path", "left")
    status = F.coalesce(F.col("status"), F.lit(404))
    decisive = F.when(status != 404, F.struct("pos", "path", status.alias("status")))
    first = tried.groupBy("month", "year").agg(F.min(decisive).alias("hit"))
    return first.select(
        "month",
        "year",
        F.when(F.col("hit.status") < 400, F.col("hit.path")).alias("path"),
        F.when(F.col("hit").isNull(), "no data").when(F.col("hit.status") < 400, "found").otherwise("error").alias("outcome"),
    )


def keep_first_k(df: DataFrame, group, order, k: int) -> DataFrame:
    """First ``k`` rows per group. Spark prunes each task to k rows per group before shuffling."""
    rank = F.row_number().over(Window.partitionBy(*[named(g) for g in group]).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)
