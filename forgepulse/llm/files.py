"""Files that tasks write and read by a path all of them share."""

from __future__ import annotations

from typing import Any


def opened(path: str, mode: str) -> Any:
    """A stream on any file system that the path names: local, HDFS or an object store."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    if mode == "wb":
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        return system.open_output_stream(inner, compression=None)
    return system.open_input_file(inner)


def listed(path: str, endings: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files below a folder that end so, in order."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    root = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        return []
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((root + f.path, f.size) for f in found if f.is_file and f.path.endswith(endings))


def renamed(source: str, target: str) -> None:
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(source)
    system.move(inner, fs.FileSystem.from_uri(target)[1])
