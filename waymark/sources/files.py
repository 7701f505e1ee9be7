"""Files that the driver itself lists, writes and removes: names of folders, and small ones such as commits.

A path without a scheme is local; on a cluster give the shared folder's, such as hdfs:// or s3://.
"""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def names(uri: str) -> list[str]:
    """Names of what lies in a folder, in order; none where it doesn't exist."""
    fs, path = place(uri)
    return sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)))


def exists(uri: str) -> bool:
    fs, path = place(uri)
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def read(uri: str) -> bytes:
    fs, path = place(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


def create(uri: str, data: bytes) -> None:
    """A new file, there at once and whole; FileExistsError where there is one of that name.

    Local folders refuse a second writer for sure; others do as their rename does, so let one writer at a time work on a folder.
    """
    fs, path = place(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as f:
        f.write(data)
    try:
        if isinstance(fs, pafs.LocalFileSystem):
            os.link(draft, path)
        else:
            if fs.get_file_info(path).type != pafs.FileType.NotFound:
                raise FileExistsError(uri)
            fs.move(draft, path)
    finally:
        if fs.get_file_info(draft).type != pafs.FileType.NotFound:
            fs.delete_file(draft)


def remove(uri: str) -> None:
    """A file or a folder with all that is in it; nothing happens where there is none."""
    fs, path = place(uri)
    kind = fs.get_file_info(path).type
    if kind == pafs.FileType.Directory:
        fs.delete_dir(path)
    elif kind != pafs.FileType.NotFound:
        fs.delete_file(path)
