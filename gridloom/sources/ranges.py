"""Parts of files, on the driver and in tasks, in any store that has a path."""

from __future__ import annotations

from pyarrow import fs


def _open(path: str):
    if "://" in path or path.startswith("file:"):
        system, where = fs.FileSystem.from_uri(path)
    else:
        system, where = fs.LocalFileSystem(), path
    return system, where


def size(path: str) -> int:
    system, where = _open(path)
    return system.get_file_info(where).size or 0


def exists(path: str) -> bool:
    system, where = _open(path)
    return system.get_file_info(where).type == fs.FileType.File


def read(path: str, start: int, length: int) -> bytes:
    """Bytes from ``start``; fewer at the file's end."""
    system, where = _open(path)
    with system.open_input_file(where) as f:
        return f.read_at(max(0, min(length, f.size() - start)), start) if start < f.size() else b""
