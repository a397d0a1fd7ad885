"""Files that tasks write to the folder shared by all executors, through Arrow's file systems."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_once(folder: str, name: str):
    """Opens a new file for one attempt of a task; (stream, its name).

    Each attempt has its own file. A reader only opens files whose names came back with the results of the tasks
    that succeeded, so what a lost or repeated attempt leaves is never read.
    """
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    unique = f"{name}-{uuid.uuid4().hex}"
    return system.open_output_stream(f"{path}/{unique}"), unique


def read_range(folder: str, name: str, start: int, size: int) -> bytes:
    system, path = open_folder(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        file.seek(start)
        return file.read(size)


def local_copy(folder: str, name: str) -> str:
    """A path that can be mapped into memory: the file itself if the folder is mounted, else a copy for this executor."""
    system, path = open_folder(folder)
    if isinstance(system, fs.LocalFileSystem):
        return f"{path}/{name}"
    target = os.path.join(tempfile.gettempdir(), f"model-{name}")
    if not os.path.exists(target):
        part = f"{target}.{uuid.uuid4().hex}"
        fs.copy_files(f"{path}/{name}", part, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
        os.replace(part, target)
    return target
