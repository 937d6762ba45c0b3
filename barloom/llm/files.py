"""Binary files written by tasks into the shared folder.

A name is written under a temporary name first and then moved, so a task that is run
again (its executor was lost) replaces its file by the same bytes.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    store, path = _open(uri)
    store.create_dir(path, recursive=True)


def put(uri: str, data: bytes) -> None:
    store, path = _open(uri)
    folder, _, name = path.rpartition("/")
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, path)


def get(uri: str) -> bytes:
    store, path = _open(uri)
    with store.open_input_file(path) as f:
        return f.read()


def remove_folder(uri: str) -> None:
    store, path = _open(uri)
    if store.get_file_info(path).type != fs.FileType.NotFound:
        store.delete_dir(path)
