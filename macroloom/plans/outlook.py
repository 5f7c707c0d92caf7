"""Serving outlook (WEO) releases from landed files.

Layout under the landing root::

    catalogue/*.json                         dataflow catalogue
    probes/<flow>/<version>.csv              publication date of each flow version, or files of many of them
    observations/<flow>/<version>/*.csv      observations of a release
    metadata/<flow>/<version>/*.csv          series metadata of a release
    codelists/<agency>/<id>.json             code lists
    bulk/<year>/.../weo<mon><year>-sdmxdata.zip   bulk archives
    vocabulary/{area_map,unit_map,legacy_labels}  tables of ``plans.vocabulary`` (Parquet)
    releases/                                which flow serves which release, by version (``sources.manifest``)
"""

import logging
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cached_property
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macroloom import vocabulary_values
from macroloom.errors import DataflowDiscoveryError, NoDataError, VersionNotAvailableError
from macroloom.functions.labels import release_sort_key, requested_release
from macroloom.operators.checks import staged
from macroloom.operators.metadata import (
    attach_series_metadata,
    merge_public_metadata,
    public_metadata,
    repair_if_degraded,
)
from macroloom.operators.observations import contract
from macroloom.operators.releases import candidate_flows, first_existing_path, known_bulk, label_flows, preferred_flow, release_table
from macroloom.plans.align import align_observations
from macroloom.plans.bulk import parse_archives
from macroloom.plans.translate import translate_release
from macroloom.schema import AREA_MAP_SCHEMA, CODELIST_SCHEMA, MAX_ROLL_BACK
from macroloom.plans.vocabulary import derive_vocabulary, write_vocabulary
from macroloom.sources.archives import is_known_corrupt, release_of_path, scan_archives
from macroloom.sources.csvs import scan_observations, scan_probes, scan_sidecar
from macroloom.sources.json_docs import scan_catalogue, scan_codelists
from macroloom.sources import manifest
from macroloom.sources.snapshots import DAY, HOUR, PARTITIONS, SCHEMA_VERSION, WEEK, fresh, keyed, read_snapshot, write_snapshot
from macroloom.work import landed, stored

log = logging.getLogger(__name__)


class FlowRef(NamedTuple):
    """The flow, and the version of it, that serves a release."""

    flow_id: str
    version: str


class Served(NamedTuple):
    """A frame with the release it really is; ``ref`` is None for a bulk archive."""

    data: DataFrame
    release: tuple
    ref: FlowRef | None


class Pinned(NamedTuple):
    """One version of the release table: (release, FlowRef or None, listed), newest first."""

    entries: list

    @property
    def flows(self) -> dict:
        return {release: ref for release, ref, _ in self.entries if ref}

    @property
    def listed(self) -> list:
        return [release for release, _, listed in self.entries if listed]


RELEASE_TABLE = (
    T.StructType().add("month", "string").add("year", "integer").add("flow_id", "string").add("version", "string").add("listed", "boolean")
)


class Outlook:
    """Releases of one landing root.

    Frames of flows are lazy; resolving a release reads the manifest, and bulk archives are unpacked
    when they are asked for. ``mapping_ttl`` is the lifetime of a manifest in seconds.
    """

    def __init__(self, spark: SparkSession, root: str, area_map: DataFrame | None = None, mapping_ttl: int = HOUR):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest = f"{self.root}/releases"
        self.mapping_ttl = mapping_ttl
        self._area_map = area_map
        self._pin = ContextVar("pin", default=None)

    # -- dimensions ---------------------------------------------------------------------

    def _optional(self, read, *args):
        try:
            return read(self.spark, *args)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return None

    def _vocabulary(self, name):
        return self._optional(lambda spark: spark.read.parquet(f"{self.root}/vocabulary/{name}"))

    @cached_property
    def codelists(self) -> DataFrame:
        found = self._optional(scan_codelists, f"{self.root}/codelists")
        if found is None or found.isEmpty():
            log.warning("No code lists are landed; every label read from one is null")
            return self.spark.createDataFrame([], CODELIST_SCHEMA)
        return stored(found, "codelists")

    @cached_property
    def area_map(self) -> DataFrame:
        found = self._area_map if self._area_map is not None else self._vocabulary("area_map")
        if found is None:
            log.warning("No area map is landed; numeric area codes are null and bulk releases cannot be translated")
            return self.spark.createDataFrame([], AREA_MAP_SCHEMA)
        return found

    @cached_property
    def unit_map(self) -> DataFrame:
        found = self._vocabulary("unit_map")
        return vocabulary_values.unit_map(self.spark) if found is None else found

    @cached_property
    def legacy_labels(self) -> DataFrame:
        found = self._vocabulary("legacy_labels")
        return vocabulary_values.bulk_only_labels(self.spark) if found is None else found

    # -- releases -----------------------------------------------------------------------

    def pinned(self) -> "Pinned":
        """The releases as the newest manifest has them; made anew if none is younger than its lifetime.

        Every public call reads it once (``_one_manifest``), so that both legs of a call, and all calls
        within an hour, see the same flows whatever lands meanwhile.
        """
        if self._pin.get() is not None:
            return self._pin.get()
        entries = manifest.newest(self.spark, self.manifest, RELEASE_TABLE, self.mapping_ttl)
        if entries is None:
            self.refresh_mapping()
            entries = manifest.newest(self.spark, self.manifest, RELEASE_TABLE, self.mapping_ttl)
        rows = [((r["month"], r["year"]), r["flow_id"] and FlowRef(r["flow_id"], r["version"]), r["listed"]) for r in entries]
        return Pinned(sorted(rows, key=lambda row: release_sort_key(row[0]), reverse=True))

    @contextmanager
    def _one_manifest(self):
        """Inside, in this thread, all steps of a call see one manifest, or each for itself that there is none."""
        try:
            token = self._pin.set(self.pinned())
        except DataflowDiscoveryError:
            token = None
        try:
            yield
        finally:
            if token is not None:
                self._pin.reset(token)

    def refresh_mapping(self) -> None:
        """Publish a new manifest from the landed catalogue and probes. One that is unusable is never published."""
        catalogue = self._optional(scan_catalogue, f"{self.root}/catalogue")
        if catalogue is None:
            raise DataflowDiscoveryError(f"No dataflow catalogue is landed under {self.root}/catalogue")
        probes = self._optional(scan_probes, f"{self.root}/probes")
        if probes is None:
            probes = self.spark.createDataFrame([], "flow_id string, version string, published date")
        labelled = stored(label_flows(candidate_flows(catalogue), probes), "flows")
        missed = labelled.filter(~F.col("probed"))
        bare = missed.filter("is_bare").agg(F.min("version")).first()[0]
        if bare is not None:
            raise ValueError(f"WEO {bare}, which decides what is newest, has no readable publication date")
        # A catalogue may list very many flow versions: their number, and as many of them as fit on a screen.
        number = missed.count()
        for row in missed.orderBy("flow_id", "version").limit(100).collect():
            how = f"labelled {row['month']} {row['year']} by its id" if row["month"] else "skipped"
            log.warning("No publication date for %s %s; %s", row["flow_id"], row["version"], how)
        if number > 100:
            log.warning("%s flow versions have no publication date; all are in %s", number, labelled.inputFiles()[0].rsplit("/", 1)[0])
        mapped = stored(preferred_flow(labelled), "flows")
        if mapped.filter("flow_id = 'WEO'").isEmpty():
            raise DataflowDiscoveryError(f"The dataflow catalogue under {self.root}/catalogue has no usable WEO dataflow")
        manifest.publish(release_table(mapped, known_bulk(self.spark)), self.manifest)

    def flow_mapping(self) -> dict:
        """{(month, year): FlowRef} of the releases that the catalogue's flows serve."""
        return self.pinned().flows

    def versions(self) -> list:
        """Every release that can be served, newest first."""
        return self.pinned().listed

    def resolve(self, release=None, purpose="observations"):
        """(release, FlowRef) from the flow mapping alone; None means its newest release."""
        mapping = self.flow_mapping()
        if release is None:
            release = next(iter(mapping))
        if release not in mapping:
            note = "Series metadata exists only for releases a flow serves. " if purpose == "series metadata" else ""
            raise VersionNotAvailableError(f"No flow serves {release}. {note}Served are {list(mapping)}")
        return release, mapping[release]

    # -- observations -------------------------------------------------------------------

    def observations(self, ref: FlowRef) -> DataFrame:
        """Aligned observations of one flow version (13 columns)."""
        raw = scan_observations(self.spark, f"{self.root}/observations/{ref.flow_id}/{ref.version}")
        return align_observations(raw, self.codelists, self.area_map)

    def sidecar(self, ref: FlowRef) -> DataFrame:
        return scan_sidecar(self.spark, f"{self.root}/metadata/{ref.flow_id}/{ref.version}")

    def _sidecar_or_none(self, ref):
        try:
            return self.sidecar(ref)
        except Exception as exc:  # an annotation never fails the observations
            log.warning("Series metadata of %s %s cannot be read: %s", *ref, exc)
            return None

    def flow_release(self, ref: FlowRef) -> DataFrame:
        return contract(attach_series_metadata(self.observations(ref), self._sidecar_or_none(ref)))

    def archive_path(self, release) -> str:
        """Landed archive of a release."""
        base = f"{self.root}/bulk"
        found = landed(self.spark, base, "*.zip")
        relative = F.regexp_extract("path", r"(/[0-9]{4}/(?:[^/]+/)?[^/]+\.zip)$", 1)
        manifest = found.select(relative.alias("path"), F.lit(200).alias("status"))
        wanted = self.spark.createDataFrame([release], "month string, year int")
        row = first_existing_path(wanted, manifest).first()
        if row is None or row["outcome"] != "found":
            raise NoDataError(f"{base} holds no archive of {release[0]} {release[1]}")
        return base + row["path"]

    def bulk_releases(self) -> DataFrame:
        """Every landed bulk release not known to be corrupt, untranslated, with its release columns."""
        archives = scan_archives(self.spark, f"{self.root}/bulk")
        month, year = release_of_path(F.col("path"))
        parsed = parse_archives(archives.filter(~is_known_corrupt(month, year)).select("path", "content"), with_path=True)
        return parsed.withColumns({"release_month": month, "release_year": year}).drop("path")

    def build_vocabulary(self, anchor=("April", 2025), **options) -> dict:
        """Derive the vocabulary from the landed releases, store it in the landing root and use it.

        ``anchor`` is the release that both a flow and a bulk archive carry.
        """
        _, ref = self.resolve(anchor)
        releases, api = stored(self.bulk_releases(), "bulk"), stored(self.observations(ref), "anchor")
        tables = derive_vocabulary(releases, api, anchor, **options)
        write_vocabulary(tables, f"{self.root}/vocabulary")
        self._area_map = None
        for name in ("area_map", "unit_map", "legacy_labels"):
            self.__dict__.pop(name, None)
        return {name: self._vocabulary(name) for name in tables}

    def bulk_release(self, release) -> DataFrame:
        archives = scan_archives(self.spark, self.archive_path(release))
        dimensions = self.codelists, self.area_map, self.unit_map, self.legacy_labels
        translated = translate_release(parse_archives(archives), *dimensions, check="flag")
        return staged(translated, "bulk-release", f"{release[0]} {release[1]} cannot be translated")[0]

    def _from_either_source(self, release) -> Served:
        try:
            release, ref = self.resolve(release)
        except (VersionNotAvailableError, DataflowDiscoveryError) as exc:
            log.warning("No flow serves %s %s (%s); using the bulk archive", *release, exc)
            return Served(self.bulk_release(release), release, None)
        return Served(self.flow_release(ref), release, ref)

    def serve(self, release=None) -> Served:
        """A release, or the newest one.

        An explicit release may come from the bulk archive but is never replaced by another. The
        newest one may be replaced by one of the next three older ones, if there is no data.
        """
        with self._one_manifest():
            if release is not None:
                return self._from_either_source(requested_release(release))
            versions = self.versions()
            try:
                return self._from_either_source(versions[0])
            except NoDataError as original:
                for older in versions[1 : 1 + MAX_ROLL_BACK]:
                    log.warning("No data for %s %s; trying %s %s", *versions[0], *older)
                    try:
                        return self._from_either_source(older)
                    except NoDataError:
                        continue
                raise original

    def fetch_data(self, release=None) -> DataFrame:
        """The 16 contract columns of a release."""
        return self.serve(release).data

    def fetch_series_metadata(self, release=None) -> DataFrame:
        """Series metadata of a release that a flow serves, all text, keys first."""
        if release is not None:
            release = requested_release(release, "series metadata")
        _, ref = self.resolve(release, "series metadata")
        return public_metadata(self.sidecar(ref))

    def fetch_data_with_metadata(self, release=None) -> DataFrame:
        """Observations with all series metadata, both from the same flow version."""
        served = self.serve(release)
        if served.ref is None:
            raise VersionNotAvailableError(
                f"{served.release[0]} {served.release[1]} is a bulk-archive release, which has no series metadata"
            )
        sidecar = self.sidecar(served.ref)
        metadata = public_metadata(sidecar)
        return merge_public_metadata(repair_if_degraded(served.data, sidecar), metadata)

    # -- snapshots ----------------------------------------------------------------------

    def ingest(self, store: str, release=None) -> tuple:
        """Write a release to the snapshot store and return which release it was."""
        served = self.serve(release)
        flow_id, version = served.ref or ("", "")
        sublayer = "weo_sdmx_parsed" if served.ref is None else "weo_api"
        frame = keyed(served.data, sublayer=sublayer, release=served.release, flow_id=flow_id, flow_version=version)
        write_snapshot(frame, store, sort_by=["CONCEPT_CODE", "REF_AREA_CODE", "TIME_PERIOD"])
        return served.release

    def ingest_metadata(self, store: str, release=None) -> tuple:
        """Write the series metadata of a release that a flow serves to the snapshot store; which release it was."""
        release = None if release is None else requested_release(release, "series metadata")
        release, ref = self.resolve(release, "series metadata")
        frame = public_metadata(self.sidecar(ref))
        write_snapshot(keyed(frame, sublayer="weo_metadata", release=release, flow_id=ref.flow_id, flow_version=ref.version), store)
        return release

    def ingest_codelists(self, store: str) -> None:
        write_snapshot(keyed(self.codelists, sublayer="weo_codelists", release=("none", 0)), store)

    def fetch_stored_metadata(self, store: str, release, ttl_seconds: int = DAY) -> DataFrame:
        """Stored series metadata of the flow version that serves the release now; written first if it is not fresh."""
        release = requested_release(release, "series metadata")
        with self._one_manifest():
            ref = self.resolve(release, "series metadata")[1]
            keys = {"sublayer": "weo_metadata", "flow_id": ref.flow_id, "flow_version": ref.version}
            found = self._optional(lambda spark: read_snapshot(spark, store, **keys))
            if found is None or fresh(found, ttl_seconds).isEmpty():
                self.ingest_metadata(store, release)
        return read_snapshot(self.spark, store, **keys).drop(*PARTITIONS, "ingested_at")

    def fetch_stored(self, store: str, release, ttl_seconds: int = WEEK) -> DataFrame:
        """A release from the snapshot store, which is written first if it has no fresh snapshot.

        The snapshot is looked up under the flow version that serves the release now, so a release
        that moved to another flow is never served from its old snapshot.
        """
        release = requested_release(release)
        with self._one_manifest():
            try:
                ref = self.resolve(release)[1]
            except (VersionNotAvailableError, DataflowDiscoveryError):
                ref = None
            found = self._optional(_snapshot, store, release, ref)
            if found is None or fresh(found, ttl_seconds).isEmpty():
                self.ingest(store, release)
        return read_release(self.spark, store, release, ref)


def read_release(spark: SparkSession, store: str, release, ref: FlowRef | None = None) -> DataFrame:
    """A stored release as a pruned scan; filters on area and concept reach the files."""
    return contract(_snapshot(spark, store, requested_release(release), ref))


def _snapshot(spark, store, release, ref):
    month, year = release
    keys = {"release_year": year, "release_month": month, "schema_version": SCHEMA_VERSION}
    keys |= {"sublayer": "weo_sdmx_parsed"} if ref is None else {
        "sublayer": "weo_api", "flow_id": ref.flow_id, "flow_version": ref.version
    }
    return read_snapshot(spark, store, **keys)
