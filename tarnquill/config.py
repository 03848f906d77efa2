"""Runtime paths: templates, environment, and stage markers."""

from __future__ import annotations

import hashlib
import json
import os
import re
from pathlib import Path

_KEY = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


class RuntimePaths:
    """Named paths that may refer to each other as {name}; an environment variable PREFIX_NAME overrides one."""

    def __init__(self, paths: dict[str, str], prefix: str = "TARNQUILL", environment: dict[str, str] | None = None) -> None:
        environment = os.environ if environment is None else environment
        self.raw = {k: environment.get(f"{prefix}_{k.upper()}", v) for k, v in paths.items()}

    def __getitem__(self, name: str) -> str:
        return self._resolved(name, ())

    def _resolved(self, name: str, above: tuple[str, ...]) -> str:
        if name in above:
            raise ValueError("paths refer to each other in a circle: " + " -> ".join((*above, name)))
        if name not in self.raw:
            raise KeyError(name)
        return _KEY.sub(lambda m: self._resolved(m[1], (*above, name)), self.raw[name])

    def require(self, name: str, kind: str = "any") -> Path:
        path = Path(self[name])
        ok = {"file": path.is_file, "folder": path.is_dir, "any": path.exists}[kind]()
        if not ok:
            raise FileNotFoundError(f"{name}: no {kind} at {path}")
        return path


def write_json(path: str | Path, value: object) -> None:
    """Written whole or not at all; NaN is refused."""
    path = Path(path)
    part = path.with_name(path.name + ".part")
    part.write_text(json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False), encoding="utf-8")
    part.replace(path)


def signature(*parts: object) -> str:
    """What a stage depends on, as one hash."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def stage_done(marker: str | Path, expected: str) -> bool:
    """Whether a marker says that the stage was completed for the same inputs."""
    path = Path(marker)
    return path.is_file() and json.loads(path.read_text(encoding="utf-8")).get("signature") == expected


def indices(text: str) -> list[int]:
    """"1-3,7" as [1, 2, 3, 7]; repeated or falling ranges are refused."""
    out: list[int] = []
    for part in text.split(","):
        low, _, high = part.strip().partition("-")
        numbers = list(range(int(low), int(high or low) + 1))
        if not numbers or set(numbers) & set(out):
            raise ValueError(f"bad range {part!r}")
        out += numbers
    return out


def frozen_sources(inventory: dict[str, dict[str, int]]) -> list[str]:
    """Files whose size or time of change isn't that of the inventory {path: {"size": .., "mtime_ns": ..}}."""
    changed = []
    for path, stated in inventory.items():
        file = Path(path)
        if not file.is_file() or file.stat().st_size != stated["size"] or file.stat().st_mtime_ns != stated["mtime_ns"]:
            changed.append(path)
    return changed


def stage_report(folder: str | Path) -> dict[str, dict]:
    """The markers of completed stages below a folder."""
    return {p.stem.removesuffix("_COMPLETE"): json.loads(p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*_COMPLETE.json"))}


def inventory_problems(root: str | Path, manifest: dict[str, str]) -> dict[str, str]:
    """What differs from a manifest {relative path: sha256}: unsafe, missing, changed, or unlisted files."""
    root = Path(root).resolve()
    problems = {}
    for name, sha in manifest.items():
        path = (root / name).resolve()
        if not path.is_relative_to(root):
            problems[name] = "unsafe"
        elif not path.is_file():
            problems[name] = "missing"
        elif hashlib.sha256(path.read_bytes()).hexdigest() != sha:
            problems[name] = "changed"
    listed = {(root / n).resolve() for n in manifest}
    return problems | {str(p.relative_to(root)): "unlisted" for p in root.rglob("*") if p.is_file() and p not in listed}
