"""Sources as files and as ZIP archives of delimited members: routed by name, hashed, loaded once.

Archives are read as streams through Hadoop's file systems and their members laid out in a folder that executors see, so
neither has to be on the driver's disk.
"""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.sources import csv as strict
from evidentia.sources.manifest import Manifest, ManifestConflict

Writer = Callable[[str, DataFrame], int]


@dataclass(frozen=True)
class Route:
    """Members whose whole name matches (or a file by itself, without a pattern) go to a target under a parser contract.

    A file without a header has fixed columns; with one, fixed columns are what its header must be. The key of a row names
    the content and the row's number, and where said so the release and the member.
    """

    pattern: str | None
    target: str
    namespace: str
    contract: str
    header: bool = True
    columns: tuple[str, ...] | None = None
    version: str = "v1"
    keyed_by_release: bool = False
    keyed_by_member: bool = True


#: The fields of a sale, which its files do not name.
SALE_FIELDS = (
    "transaction_id", "price_paid", "transfer_date", "postcode", "property_type", "old_new", "duration", "paon", "saon", "street", "locality", "town_city", "district", "county", "category", "record_status",
)
#: The sources by dataset. Member names and headers.
ROUTES: dict[str, tuple[Route, ...]] = {
    "sales": (Route(None, "raw_sale", "sale.source-row", "sale_csv_v1", header=False, columns=tuple(f"{c}_raw" for c in SALE_FIELDS)),),
    "certificates": (
        Route(r"certificates-\d{4}\.csv", "raw_certificate", "certificate.source-row", "certificate_csv_v1"),
        Route(r"recommendations-\d{4}\.csv", "raw_recommendation", "recommendation.source-row", "recommendation_csv_v1"),
    ),
    "allocations": (Route(r"Data/ONSUD_DEC_2025_[A-Z]{2}\.csv", "raw_allocation", "allocation.source-row", "allocation_csv_v1"),),
    "districts": (Route(None, "raw_district", "district.source-row", "district_csv_v1", columns=("LAD25CD", "LAD25NM", "LAD25NMW", "ObjectId"), version="v2", keyed_by_release=True, keyed_by_member=False),),
    "planning_authorities": (Route(None, "raw_planning_authority", "planning-authority.source-row", "planning_authority_csv_v1", columns=("LPA25CD", "LPA25NM", "Co_terminous", "ObjectId"), version="v2", keyed_by_release=True, keyed_by_member=False),),
}


def route_of(routes: Sequence[Route], member: str) -> Route | None:
    return next((r for r in routes if r.pattern and re.fullmatch(r.pattern, member)), None)


class _Streams:
    """Byte streams of the session's file systems; nothing passes through Python."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def open(self, path: str):
        fs, p = self.at(path)
        return fs.open(p)

    def size(self, path: str) -> int:
        fs, p = self.at(path)
        return fs.getFileStatus(p).getLen()

    def digest(self, source, target=None) -> str:
        """SHA-256 of what is left in a stream, which is copied to the target on the way."""
        digest = self.jvm.java.security.MessageDigest.getInstance("SHA-256")
        stream = self.jvm.java.security.DigestInputStream(source, digest)
        self.jvm.org.apache.commons.io.IOUtils.copyLarge(stream, target or self.jvm.java.io.OutputStream.nullOutputStream())
        return bytes(digest.digest()).hex()

    def sha256(self, path: str) -> str:
        source = self.open(path)
        try:
            return self.digest(source)
        finally:
            source.close()

    def names(self, path: str) -> list[str]:
        archive, out = self.jvm.java.util.zip.ZipInputStream(self.open(path)), []
        try:
            while (entry := archive.getNextEntry()) is not None:
                if not entry.isDirectory():
                    out.append(entry.getName())
        finally:
            archive.close()
        return out

    def extract(self, path: str, wanted: Callable[[str], bool], folder: str) -> dict[str, tuple[str, str, int]]:
        """Wanted members as files of a folder: path, digest and size by name."""
        archive, out = self.jvm.java.util.zip.ZipInputStream(self.open(path)), {}
        try:
            while (entry := archive.getNextEntry()) is not None:
                name = entry.getName()
                if entry.isDirectory() or not wanted(name):
                    continue
                to = f"{folder}/{len(out)}.csv"
                fs, p = self.at(to)
                target = fs.create(p, True)
                try:
                    digest = self.digest(archive, target)
                finally:
                    target.close()
                out[name] = (to, digest, self.size(to))
        finally:
            archive.close()
        return out

    def delete(self, path: str) -> None:
        fs, p = self.at(path)
        fs.delete(p, True)


def _load(spark: SparkSession, path: str, route: Route, release: dict, entry: dict, member: str, run_id: str, write: Writer) -> int:
    """Rows of one file, checked and keyed, to the writer."""
    if route.header:
        found = strict.header_of(spark, path)
        if route.columns and tuple(found) != route.columns:
            raise strict.HeaderDrift(f"Source header drift for {member}: expected {list(route.columns)}, found {found}")
        names = strict.snake_header(found)
    else:
        names = list(route.columns or ())
    rows = strict.read_strict(spark, path, names, header=route.header)
    fields = [F.lit(entry["content_sha256"])]
    if route.keyed_by_release:
        fields.insert(0, F.lit(release["release_key"]))
    if route.keyed_by_member:
        fields.append(F.lit(member))
    loaded_at = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    return write(route.target, strict.with_lineage(rows, route.namespace, release["release_id"], entry["file_id"], fields, member, run_id, route.contract, loaded_at, route.version, entry["parent_file_id"]))


def load_file(spark: SparkSession, path: str, route: Route, manifest: Manifest, release: dict, run_id: str, write: Writer) -> str:
    """LOADED or SKIPPED; a file that fails is marked, and so is its release."""
    streams, name = _Streams(spark), path.rsplit("/", 1)[-1]
    entry = manifest.register_file(release["release_id"], run_id, name, streams.sha256(path), streams.size(path), route.contract, "CSV")
    if entry["status"] == "LOADED":
        return "SKIPPED"
    try:
        rows = _load(spark, path, route, release, entry, name, run_id, write)
    except Exception as error:
        manifest.mark_file(entry["file_id"], "FAILED", error=str(error)[:4000])
        manifest.mark_release(release["release_id"], "FAILED")
        raise
    manifest.mark_file(entry["file_id"], "LOADED", rows)
    manifest.mark_release(release["release_id"], "LOADED")
    return "LOADED"


def load_archive(spark: SparkSession, path: str, routes: Sequence[Route], manifest: Manifest, release: dict, run_id: str, write: Writer, scratch: str) -> dict[str, int]:
    """Every routed member that is not loaded yet goes to write(target, rows), in the order of names; counts of loaded and skipped.

    write must have stored the rows when it returns, as the members' files are gone afterwards. A member that fails is
    marked and raised; those before it stay loaded, and a retry goes on behind them. An archive that was loaded whole is
    skipped; if its members or their contracts are no longer what the routes say, that is an error.
    """
    streams, name = _Streams(spark), path.rsplit("/", 1)[-1]
    archive = manifest.register_file(release["release_id"], run_id, name, streams.sha256(path), streams.size(path), "zip_archive_v1", "ZIP_ARCHIVE")
    routed = {m: r for m in streams.names(path) if (r := route_of(routes, m))}
    if archive["status"] == "LOADED":
        known = {m["member_path"]: m["contract"] for m in manifest.members(archive["file_id"]) if m["status"] == "LOADED"}
        if known != {m: r.contract for m, r in routed.items()}:
            raise ManifestConflict(f"members or contracts of {name} are not those that were loaded: {known}")
        return {"loaded": 0, "skipped": len(routed)}
    if not routed:
        raise ValueError(f"no routed members in {name}")
    folder, done = f"{scratch.rstrip('/')}/members-{uuid.uuid4().hex}", {"loaded": 0, "skipped": 0}
    try:
        for member, (file, digest, size) in sorted(streams.extract(path, routed.__contains__, folder).items()):
            entry = manifest.register_file(release["release_id"], run_id, member, digest, size, routed[member].contract, "ZIP_MEMBER", archive["file_id"])
            if entry["status"] == "LOADED":
                done["skipped"] += 1
                continue
            try:
                rows = _load(spark, file, routed[member], release, entry, member, run_id, write)
            except Exception as error:
                manifest.mark_file(entry["file_id"], "FAILED", error=str(error)[:4000])
                manifest.mark_file(archive["file_id"], "PARTIAL", error=str(error)[:4000])
                manifest.mark_release(release["release_id"], "PARTIAL")
                raise
            manifest.mark_file(entry["file_id"], "LOADED", rows)
            done["loaded"] += 1
    finally:
        streams.delete(folder)
    manifest.finish_archive(archive["file_id"])
    return done


def into_tables(folder: str) -> Writer:
    """A writer that appends to a table for each target; rows of a content that is loaded again have the same keys, and are not added twice."""
    from evidentia.operators.store import append_if_absent

    def write(target: str, rows: DataFrame) -> int:
        append_if_absent(rows, f"{folder.rstrip('/')}/{target}", ["source_record_key"])
        return rows.count()

    return write
