"""Files by path or URI: listed in bulk, read by range.

A path without a scheme is one that all executors have mounted; file:, hdfs:,
s3: and gs: URIs go through Arrow's file systems, on the driver for the list
and in the tasks for the bytes.
"""

from __future__ import annotations

import fnmatch
import posixpath
import re

from pyarrow import fs

_WILD = re.compile(r"[*?\[]")


def place(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, what to put before its paths to make URIs again)."""
    if "://" not in path or path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
        return fs.LocalFileSystem(), posixpath.abspath(path), ""
    scheme, rest = path.split("://", 1)
    # wildcards are no part of a URI: they are put back behind the root
    root, _, tail = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{root}/")
    inner = posixpath.join(base, tail) if base else tail
    prefix = f"{scheme}://" if scheme in ("s3", "s3a", "gs", "gcs") else f"{scheme}://{root}"
    return system, inner, prefix


def listed(path: str, name: str = "*") -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files of a folder and all below it that are named like ``name``, or of those a pattern matches; sorted."""
    system, inner, prefix = place(path)
    wild = _WILD.search(inner)
    if wild is None:
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [(prefix + inner, info.size)]
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
        return sorted((prefix + i.path, i.size) for i in found if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, name))
    base = inner[: inner.rfind("/", 0, wild.start())]
    found = system.get_file_info(fs.FileSelector(base or "/", recursive=True, allow_not_found=True))
    parts = inner.split("/")
    same = lambda p: len(p) == len(parts) and all(fnmatch.fnmatchcase(a, b) for a, b in zip(p, parts, strict=True))
    return sorted((prefix + i.path, i.size) for i in found if i.type == fs.FileType.File and same(i.path.split("/")))


def opened(path: str):
    """The file for reads at any offset."""
    system, inner, _ = place(path)
    return system.open_input_file(inner)
