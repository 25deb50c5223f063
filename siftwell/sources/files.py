"""Files of any shared file system, opened from Python workers by their address."""

from __future__ import annotations

import os


def file_system(path: str):
    """(file system, path in it) of an address such as hdfs://..., s3://..., file://... or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path))


def open_file(path: str, write: bool = False, at: int = 0):
    """A binary stream; folders above a file that is written are made, reading begins ``at`` a byte."""
    system, inner = file_system(path)
    if write:
        system.create_dir(os.path.dirname(inner), recursive=True)
        return system.open_output_stream(inner, compression=None)
    if at:
        f = system.open_input_file(inner)
        f.seek(at)
        return f
    return system.open_input_stream(inner, compression=None)


def find_files(path: str) -> list[str]:
    """Addresses of the files of a folder, or that a pattern in the last part of the address matches, by name."""
    import fnmatch

    from pyarrow import fs

    system, inner = file_system(path)
    bare = inner.rstrip("/")
    head = path[: path.rindex(bare)] if "://" in path and bare in path else ""  # scheme and host, where the inner path lacks them
    kind = system.get_file_info(inner).type if "*" not in inner and "?" not in inner else None
    if kind == fs.FileType.File:
        return [head + inner]
    folder = inner if kind == fs.FileType.Directory else os.path.dirname(inner)
    pattern = "*" if kind == fs.FileType.Directory else os.path.basename(inner)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(head + x.path for x in found if x.type == fs.FileType.File and fnmatch.fnmatch(x.base_name, pattern))
