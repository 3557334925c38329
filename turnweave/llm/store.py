"""Files that tasks write to, and read from, the folder that driver and executors share.

A task writes each file under a name of its own and reports it as a row; only the rows of tasks that
succeeded reach the manifest, so what a lost or repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import uuid


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, payload, exact: bool = False) -> str:
    """Write ``payload`` (bytes or an iterable of bytes) under a fresh name; returns its URI.

    With ``exact`` the file gets the very name, by a rename when it is whole; for names that stand for the content.
    """
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)
    final, name = name, f"{uuid.uuid4().hex}-{name}"
    with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
        for part in [payload] if isinstance(payload, bytes | bytearray | memoryview) else payload:
            out.write(part)
    if exact:
        fs.move(f"{path}/{name}", f"{path}/{final}")
    return f"{folder}/{final if exact else name}"


def open_input(uri: str):
    """A seekable file."""
    fs, path = _open(uri)
    return fs.open_input_file(path)


def read_file(uri: str) -> bytes:
    with open_input(uri) as f:
        return f.read()


def delete_file(uri: str) -> None:
    fs, path = _open(uri)
    fs.delete_file(path)
