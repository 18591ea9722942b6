"""Fetching pinned source files: attempts, staging, size and digest, archives."""

from __future__ import annotations

import os
import shutil
import time
import urllib.request
import zipfile
from pathlib import Path

from ..functions import require
from .sinks import sha256_file


def fetch(url: str, target: str, size: int | None = None, sha256: str | None = None, attempts: int = 3, wait: float = 2.0) -> str:
    """Download to ``target`` unless it is there and fits; staged, then renamed."""
    if os.path.exists(target) and _fits(target, size, sha256):
        return target
    staged, last = f"{target}.part", None
    for k in range(attempts):
        try:
            with urllib.request.urlopen(url) as source, open(staged, "wb") as file:  # noqa: S310
                shutil.copyfileobj(source, file)
            require(_fits(staged, size, sha256), f"{url} has another size or digest than the pinned one")
            os.replace(staged, target)
            return target
        except Exception as e:  # noqa: BLE001  each attempt may fail in its own way
            last = e
            Path(staged).unlink(missing_ok=True)
            if k + 1 < attempts:
                time.sleep(wait)
    raise last


def _fits(path: str, size: int | None, sha256: str | None) -> bool:
    return (size is None or os.path.getsize(path) == size) and (sha256 is None or sha256_file(path) == sha256.lower())


def unpack(archive: str, folder: str, depth: int = 2) -> list[str]:
    """Extract a ZIP file, and ZIP files within it; paths stay inside ``folder``."""
    root, out = os.path.realpath(folder), []
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            path = os.path.realpath(os.path.join(root, name))
            require(path.startswith(root + os.sep), f"{name} leaves the folder")
            if name.endswith("/"):
                continue
            z.extract(name, root)
            if name.lower().endswith(".zip") and depth > 1:
                out += unpack(path, os.path.dirname(path), depth - 1)
            else:
                out.append(path)
    return out
