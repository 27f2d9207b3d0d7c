"""What has been loaded, as stored tables: releases, files by content, the archives that hold them, and how each ended.

Tables are small and have one writer. Every change is a new version of its table, so a driver that dies leaves the last
whole state, from which a rerun goes on.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from evidentia.functions.keys import stable_sha256_of
from evidentia.operators import store

TABLES = {
    "releases": "release_id string, release_key string, publisher string, dataset_code string, release_label string, metadata string, status string, registered_at timestamp, loaded_at timestamp",
    "files": "file_id string, release_id string, parent_file_id string, run_id string, file_kind string, file_name string, content_sha256 string, byte_size long, contract string, "
    "observed_rows long, accepted_rows long, quarantined_rows long, status string, registered_at timestamp, loaded_at timestamp, error string",
    "containers": "container_key string, parent_file_id string, child_file_id string, member_path string, run_id string, registered_at timestamp",
    "runs": "run_id string, command string, started_at timestamp, completed_at timestamp, status string, error string",
}
_KEYS = {"releases": "release_id", "files": "file_id", "containers": "container_key", "runs": "run_id"}


class ManifestConflict(ValueError):
    """What is to be registered contradicts what has been."""


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC).replace(tzinfo=None)


class Manifest:
    """The control tables in a folder of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        return store.read(self.spark, path) if store.exists(self.spark, path) else self.spark.createDataFrame([], TABLES[name])

    def _rows(self, name: str, **where: str) -> list[dict]:
        found = self.table(name)
        for column, value in where.items():
            found = found.filter(found[column].eqNullSafe(value))
        return [r.asDict() for r in found.collect()]

    def _put(self, name: str, *rows: dict) -> None:
        columns = [c.split()[0] for c in TABLES[name].split(", ")]
        store.upsert(self.spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], TABLES[name]), f"{self.folder}/{name}", [_KEYS[name]])

    def start_run(self, command: str) -> str:
        run = {"run_id": str(uuid.uuid4()), "command": command, "started_at": _now(), "status": "RUNNING"}
        self._put("runs", run)
        return run["run_id"]

    def end_run(self, run_id: str, error: str | None = None) -> None:
        (run,) = self._rows("runs", run_id=run_id)
        self._put("runs", run | {"completed_at": _now(), "status": "FAILED" if error else "SUCCEEDED", "error": error})

    def register_release(self, publisher: str, dataset: str, label: str, **metadata: str) -> dict:
        """The release's row; the same release with other metadata is an error."""
        key, said = stable_sha256_of("dataset-release", "v1", [publisher, dataset, label]), json.dumps(metadata, sort_keys=True)
        if known := self._rows("releases", release_key=key):
            if known[0]["metadata"] != said:
                raise ManifestConflict(f"release {publisher} {dataset} {label} was registered with other metadata")
            return known[0]
        row = {"release_id": str(uuid.uuid4()), "release_key": key, "publisher": publisher, "dataset_code": dataset, "release_label": label, "metadata": said, "status": "REGISTERED", "registered_at": _now()}
        self._put("releases", row)
        return row

    def register_file(self, release_id: str, run_id: str, name: str, sha256: str, size: int, contract: str, kind: str, parent: str | None = None) -> dict:
        """The row of this content in its release, whatever its name; the same content under another contract is an error.

        A member is noted in each archive that holds it.
        """
        known = [r for r in self._rows("files", release_id=release_id, content_sha256=sha256) if r["byte_size"] == size]
        row = min(known, key=lambda r: r["registered_at"]) if known else None
        if row and row["contract"] != contract:
            raise ManifestConflict(f"content {sha256} was loaded under contract {row['contract']}, not {contract}")
        if row is None:
            row = {
                "file_id": str(uuid.uuid4()), "release_id": release_id, "parent_file_id": parent, "run_id": run_id, "file_kind": kind, "file_name": name, "content_sha256": sha256, "byte_size": size,
                "contract": contract, "status": "REGISTERED", "registered_at": _now(),
            }
            self._put("files", row)
        if parent:
            key = stable_sha256_of("source-file-container", "v1", [parent, row["file_id"], name])
            if not self._rows("containers", container_key=key):
                self._put("containers", {"container_key": key, "parent_file_id": parent, "child_file_id": row["file_id"], "member_path": name, "run_id": run_id, "registered_at": _now()})
        return row

    def mark_file(self, file_id: str, status: str, rows: int | None = None, error: str | None = None) -> None:
        """A file's new status; a load that succeeds clears an earlier error."""
        (row,) = self._rows("files", file_id=file_id)
        loaded = {"loaded_at": _now() if status == "LOADED" else None}
        self._put("files", row | loaded | {"status": status, "observed_rows": rows, "error": error})

    def mark_release(self, release_id: str, status: str) -> None:
        (row,) = self._rows("releases", release_id=release_id)
        self._put("releases", row | {"status": status, "loaded_at": _now() if status == "LOADED" else None})

    def members(self, archive_id: str) -> list[dict]:
        """Files that an archive holds, with their path in it."""
        held = {r["child_file_id"]: r["member_path"] for r in self._rows("containers", parent_file_id=archive_id)}
        return [r | {"member_path": held[r["file_id"]]} for r in self._rows("files") if r["file_id"] in held]

    def finish_archive(self, archive_id: str) -> str:
        """LOADED if all members are, else PARTIAL; the archive has its members' counts, its release the same status."""
        members = self.members(archive_id)
        status = "LOADED" if members and all(m["status"] == "LOADED" for m in members) else "PARTIAL"
        (row,) = self._rows("files", file_id=archive_id)
        counts = {c: sum(m[c] or 0 for m in members) for c in ("observed_rows", "accepted_rows", "quarantined_rows")}
        self._put("files", row | counts | {"status": status, "loaded_at": _now() if status == "LOADED" else None, "error": None})
        self.mark_release(row["release_id"], status)
        return status

    def publish_counts(self, reconciled: DataFrame) -> None:
        """Copy accepted and quarantined counts of a reconciliation (file_id, observed_rows, accepted_rows, quarantined_rows,
        reconciliation_status) to the files and add them up for their archives; refused unless all of it passed and covers
        every loaded file."""
        columns = ["observed_rows", "accepted_rows", "quarantined_rows"]
        if bad := reconciled.filter("reconciliation_status <> 'PASSED'").count():
            raise ManifestConflict(f"{bad} files do not reconcile")
        files = self.table("files")
        held = self.table("containers").select("child_file_id", "parent_file_id").distinct()
        archives = held.select(held.parent_file_id.alias("file_id")).distinct()
        leaves = files.filter("status = 'LOADED'").join(archives, "file_id", "left_anti")
        if missing := leaves.join(reconciled, "file_id", "left_anti").count():
            raise ManifestConflict(f"{missing} loaded files are not in the reconciliation")
        updated = store.update_from(files, reconciled, ["file_id"], columns)
        children = updated.select(updated.file_id.alias("child_file_id"), *columns).join(held, "child_file_id")
        rolled = children.groupBy(children.parent_file_id.alias("file_id")).sum(*columns).toDF("file_id", *columns)
        store.replace(store.update_from(updated, rolled, ["file_id"], columns), f"{self.folder}/files")
