"""Files of any store, as tasks and data sources in Python reach them."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow.fs as pafs


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme):]
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.rstrip("/")
    store, path = pafs.FileSystem.from_uri(uri)
    return store, path.rstrip("/")


def safe_path(path: str) -> str:
    """A relative path that stays below its folder: segments that would climb or vanish are percent-encoded."""
    parts = path.split("/")
    return "/".join({"": "%20", ".": "%2E", "..": "%2E%2E"}.get(p, p) for p in parts)


def entries(store: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """Names in a folder, whether each is a file, and its length; a local folder is gone through entry by entry, however many it has."""
    if not isinstance(store, pafs.LocalFileSystem):
        for info in store.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            yield info.base_name, info.type == pafs.FileType.File, info.size or 0
        return
    with os.scandir(folder) as found:
        for entry in found:
            try:
                yield entry.name, entry.is_file(), entry.stat().st_size
            except FileNotFoundError:  # gone meanwhile
                pass
