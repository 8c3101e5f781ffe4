"""Single files on any filesystem Arrow knows, for work inside tasks."""

from __future__ import annotations

import io
import shutil
import uuid
from typing import BinaryIO


def filesystem_of(path: str):
    """(filesystem, path inside it); a path without a scheme is a local one."""

    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def open_stream(path: str):
    """A readable byte stream; FileNotFoundError if there is no such file."""

    system, inner = filesystem_of(path)
    return system.open_input_stream(inner, compression=None)


def exists(path: str) -> bool:
    from pyarrow import fs

    system, inner = filesystem_of(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def subfolders(path: str, prefix: str = "") -> list[str]:
    """Names of the folders right below ``path`` that begin with ``prefix``; none if it isn't there."""

    from pyarrow import fs

    system, inner = filesystem_of(path)
    listed = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(f.base_name for f in listed if f.type == fs.FileType.Directory and f.base_name.startswith(prefix))


def read_bytes(path: str) -> bytes:
    with open_stream(path) as source:
        return source.read()


def remove(path: str) -> None:
    """Delete a file that may not be there."""

    if exists(path):
        system, inner = filesystem_of(path)
        system.delete_file(inner)


def publish(path: str, content: bytes | BinaryIO) -> None:
    """Write a whole file under another name first, then move it to ``path``.

    Readers see the old file or the new one. Where a filesystem cannot move onto a file, the old
    one is removed just before. A stream is copied piece by piece.
    """

    system, inner = filesystem_of(path)
    folder, _, name = inner.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        shutil.copyfileobj(io.BytesIO(content) if isinstance(content, bytes) else content, out, 1 << 20)
    try:
        system.move(draft, inner)
    except OSError:
        system.delete_file(inner)
        system.move(draft, inner)
