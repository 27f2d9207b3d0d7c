"""Artifacts that runs leave or depend on: fingerprints, model files under their digest, reports that are never overwritten."""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict
from pathlib import Path
from typing import Any

from evidentia.operators.linkage import Comparison, Level


class ArtifactDrift(RuntimeError):
    """An artifact is not what its manifest says."""


def file_fingerprint(path: Path | str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def directory_fingerprint(folder: Path | str) -> str:
    """One digest of a folder's files, in the order of their paths; path and content lengths frame each."""
    digest, root = hashlib.sha256(), Path(folder)
    for path in sorted(p for p in root.rglob("*") if p.is_file()):
        name = path.relative_to(root).as_posix().encode()
        digest.update(len(name).to_bytes(8, "big") + name + path.stat().st_size.to_bytes(8, "big") + bytes.fromhex(file_fingerprint(path)))
    return digest.hexdigest()


def verify_install(manifest: Mapping[str, str], root: Path | str) -> None:
    """Every file and folder that a manifest names is there with its fingerprint."""
    for name, expected in manifest.items():
        path = Path(root) / name
        if not path.exists():
            raise ArtifactDrift(f"{name} is missing")
        found = directory_fingerprint(path) if path.is_dir() else file_fingerprint(path)
        if found != expected:
            raise ArtifactDrift(f"{name} has fingerprint {found}, not {expected}")


def model_json(model: tuple[Comparison, ...]) -> str:
    return json.dumps([asdict(c) for c in model], sort_keys=True, indent=1)


def save_model(model: tuple[Comparison, ...], path: Path | str) -> str:
    """Write a model once and give its SHA-256."""
    with open(path, "x", encoding="utf-8") as file:
        file.write(model_json(model))
    return file_fingerprint(path)


def load_model(path: Path | str, sha256: str) -> tuple[Comparison, ...]:
    """The model of a file that has this digest."""
    if (found := file_fingerprint(path)) != sha256:
        raise ArtifactDrift(f"the model has digest {found}, not {sha256}")
    with open(path, encoding="utf-8") as file:
        return tuple(Comparison(c["name"], c["null"], tuple(Level(**x) for x in c["levels"])) for c in json.load(file))


def write_report(folder: Path | str, parts: Mapping[str, Any]) -> dict[str, str]:
    """JSON parts and their manifest of digests in a new folder; one that is there already is an error."""
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=False)
    for name, value in parts.items():
        (root / f"{name}.json").write_text(json.dumps(value, sort_keys=True, indent=1, default=str), encoding="utf-8")
    manifest = {f"{name}.json": file_fingerprint(root / f"{name}.json") for name in parts}
    (root / "artifact_manifest.json").write_text(json.dumps(manifest, sort_keys=True, indent=1), encoding="utf-8")
    return manifest


class ResourceMonitor:
    """Peak resident memory of this process and least free disk of a folder, sampled while a block runs."""

    def __init__(self, folder: Path | str = ".", seconds: float = 0.2):
        self.folder, self.seconds = folder, seconds
        self.peak_rss, self.least_free, self.elapsed = 0, None, 0.0

    def _sample(self) -> None:
        with open("/proc/self/statm") as file:
            self.peak_rss = max(self.peak_rss, int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE"))
        stat = os.statvfs(self.folder)
        free = stat.f_bavail * stat.f_frsize
        self.least_free = free if self.least_free is None else min(self.least_free, free)

    @contextlib.contextmanager
    def running(self) -> Iterator[ResourceMonitor]:
        done = threading.Event()

        def watch() -> None:
            while not done.wait(self.seconds):
                self._sample()

        thread, began = threading.Thread(target=watch, daemon=True), time.monotonic()
        self._sample()
        thread.start()
        try:
            yield self
        finally:
            done.set()
            thread.join()
            self._sample()
            self.elapsed = time.monotonic() - began


def assert_pinned(found: Callable[[], tuple[float, float]], expected: tuple[float, float], tolerance: float = 1e-6) -> None:
    """A transform still gives its golden point; a cache of its results must not be added to otherwise."""
    if any(abs(a - b) > tolerance for a, b in zip(found(), expected, strict=True)):
        raise ArtifactDrift(f"the transform gives {found()}, not {expected}")
