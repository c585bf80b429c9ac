"""Layers that are published whole or not at all: step manifests, completion markers, staged swaps.

Markers describe folders that the driver can see; data itself is written by Spark. A step's key holds the fingerprint of the
parameters and of the inputs' inventory, so changed inputs never meet stale results.
"""

from __future__ import annotations

import datetime
import fnmatch
import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterable
from pathlib import Path

from velograph.sources.sinks import write_json

MARKER, MANIFESTS = "_complete.json", "_steps"


def now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")


def inventory(root: Path, artifacts: Iterable[Path | str]) -> dict[str, dict]:
    """Kind, bytes and (for files) time of change of each artifact below root; folders count all their files."""
    out = {}
    for a in sorted({str(Path(a).relative_to(root) if Path(a).is_absolute() else a) for a in artifacts}):
        p = root / a
        if p.is_dir():
            sizes = [x.stat().st_size for x in p.rglob("*") if x.is_file() and not x.name.startswith((".", "_"))]
            out[a] = {"kind": "folder", "files": len(sizes), "bytes": sum(sizes)}
        elif p.is_file():
            out[a] = {"kind": "file", "bytes": p.stat().st_size, "changed_ns": p.stat().st_mtime_ns}
        else:
            raise FileNotFoundError(p)
    return out


def inputs_key(fingerprint: str, files: Iterable[Path]) -> str:
    """A key of the parameters and of names, sizes and times of the input files."""
    seen = [(str(p), p.stat().st_size, p.stat().st_mtime_ns) for p in sorted(files)]
    return hashlib.sha256(json.dumps([fingerprint, seen]).encode()).hexdigest()


def _read(path: Path) -> dict | None:
    try:
        found = json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None
    return found if isinstance(found, dict) else None


def _holds(root: Path, found: dict | None, **wanted) -> bool:
    if found is None or any(found.get(k) != v for k, v in wanted.items() if v is not None):
        return False
    try:
        return inventory(root, found.get("artifacts", {})) == found.get("artifacts")
    except FileNotFoundError:
        return False


def step_path(root: Path, step: str) -> Path:
    if not step or "/" in step or step.startswith("."):
        raise ValueError(f"no name of a step: {step!r}")
    return root / MANIFESTS / f"{step}.json"


def finish_step(root: Path, layer: str, step: str, artifacts: Iterable[Path | str], key: str, details: dict | None = None) -> Path:
    write_json(step_path(root, step), {"layer": layer, "step": step, "key": key, "finished": now(), "artifacts": inventory(root, artifacts), "details": details or {}})
    return step_path(root, step)


def step_is_done(root: Path, layer: str, step: str, key: str) -> bool:
    """Whether the step ended with the same key and its artifacts are still as they were."""
    return _holds(root, _read(step_path(root, step)), layer=layer, step=step, key=key)


def finish_layer(root: Path, layer: str, key: str, artifacts: Iterable[Path | str], details: dict | None = None) -> Path:
    write_json(root / MARKER, {"layer": layer, "key": key, "finished": now(), "artifacts": inventory(root, artifacts), "details": details or {}})
    return root / MARKER


def layer_is_done(root: Path, layer: str | None = None, key: str | None = None, required: Iterable[str] = ()) -> bool:
    found = _read(root / MARKER)
    return _holds(root, found, layer=layer, key=key) and set(required) <= set(found["artifacts"])


def layer_marker(root: Path) -> dict | None:
    return _read(root / MARKER)


def is_stale(root: Path, key: str) -> bool:
    """Whether a layer stands there that was made under another key: other parameters, or other inputs."""
    found = layer_marker(root)
    return found is not None and found.get("key") != key


# Names of files that systems and Spark leave beside data, and that never belong in what is handed on.
SIDECARS = ("._*", ".DS_Store", "*.crc", "_SUCCESS", MARKER)


def is_sidecar(name: str) -> bool:
    return any(fnmatch.fnmatchcase(name.rsplit("/", 1)[-1], s) for s in SIDECARS)


def drop_strays(root: Path) -> int:
    """Delete what file browsers have left below root; Spark's own markers stay. How many files."""
    strays = [p for pattern in SIDECARS[:2] for p in root.rglob(pattern) if p.is_file()]
    for p in strays:
        p.unlink()
    return len(strays)


def finish_batches(root: Path, key: str, fingerprint: str, batches: list[str]) -> None:
    """Note that all batches of a run have ended, so that they can be published without their inputs."""
    write_json(root / "_all.json", {"key": key, "fingerprint": fingerprint, "batches": batches})


def ended_batches(root: Path, fingerprint: str) -> tuple[str, list[str]] | None:
    """The run's key and its batches, if all of them ended under these parameters and still are as they were."""
    found = _read(root / "_all.json")
    if found is None or found.get("fingerprint") != fingerprint or not set(found["batches"]) <= set(checkpoints(root)):
        return None
    return found["key"], found["batches"]


def checkpoints(root: Path) -> dict[str, tuple[Path, dict]]:
    """Finished batches below root by batch key. Unfinished ones are left out; two of one key are an error."""
    out: dict[str, tuple[Path, dict]] = {}
    for p in sorted(root.glob(f"*/{MARKER}")):
        found = _read(p)
        if not _holds(p.parent, found):
            continue
        if found["key"] in out:
            raise ValueError(f"two checkpoints of one batch: {out[found['key']][0]} and {p.parent}")
        out[found["key"]] = (p.parent, found)
    return out


def _inside(path: Path, root: Path | None) -> None:
    if root is not None and (path.resolve() == root.resolve() or not path.resolve().is_relative_to(root.resolve())):
        raise ValueError(f"{path} isn't below {root}")


def drop_staging(path: Path, staging_root: Path | None = None) -> None:
    _inside(path, staging_root)
    if path.is_symlink():
        raise ValueError(f"{path} is a link")
    shutil.rmtree(path, ignore_errors=True)


def swap_in(source: Path, target: Path, staging_root: Path | None = None) -> None:
    """Put a finished folder in target's place; if that fails, target is as before."""
    _inside(source, staging_root)
    if not source.is_dir():
        raise FileNotFoundError(source)
    target.parent.mkdir(parents=True, exist_ok=True)
    if source.stat().st_dev != target.parent.stat().st_dev:  # a rename needs one file system
        near = target.parent / f".{target.name}.{uuid.uuid4().hex}"
        shutil.copytree(source, near)
        shutil.rmtree(source)
        source = near
    old = target.parent / f".{target.name}.old.{uuid.uuid4().hex}"
    had = target.exists()
    if had:
        os.replace(target, old)
    try:
        os.replace(source, target)
    except BaseException:
        if had:
            os.replace(old, target)
        raise
    if had:
        shutil.rmtree(old, ignore_errors=True)
