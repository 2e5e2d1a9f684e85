"""Opening files of the shared folder inside tasks (local, hdfs:// or s3:// paths)."""

from __future__ import annotations

from typing import BinaryIO

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def create(uri: str) -> BinaryIO:
    system, path = _at(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)  # else the name decides


def open_at(uri: str) -> BinaryIO:
    """Seekable input."""
    system, path = _at(uri)
    return system.open_input_file(path)
