"""Files of whatever store Arrow can open, for tasks that open them by name."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def _normal(root: str) -> str:
    """The spelling Arrow knows: Hadoop's names of local files and buckets differ."""
    if root.startswith("file:") and not root.startswith("file://"):
        return "file://" + root.removeprefix("file:")
    scheme, found, rest = root.partition("://")
    return f"s3://{rest}" if found and scheme in ("s3a", "s3n") else root


def open_store(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there."""
    root = _normal(root)
    if "://" in root:
        system, path = fs.FileSystem.from_uri(root)
    else:
        system, path = fs.LocalFileSystem(), root
    return system, path.rstrip("/")


def can_open(root: str) -> bool:
    """Whether tasks can open files of that store by name. Others are left to
    Spark's own readers."""
    try:
        open_store(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def folders(system: fs.FileSystem, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def files(system: fs.FileSystem, path: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File)


def read_file(system: fs.FileSystem, path: str) -> bytes | None:
    """The bytes of a file; None if it is not there."""
    try:
        with system.open_input_stream(path) as stream:
            return stream.read()
    except FileNotFoundError:
        return None


def write_file(system: fs.FileSystem, path: str, data: bytes) -> None:
    """Written aside and then put in place, so no reader sees half a file and a
    repeated task writes the same file again."""
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as stream:
        stream.write(data)
    system.move(aside, path)

