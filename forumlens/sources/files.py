"""Single files in a shared folder, for exports that Spark's writers don't make."""

from __future__ import annotations

import uuid

from pyarrow import fs


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def put(store: fs.FileSystem, path: str, data: bytes) -> None:
    """Write a whole file: under a name of its own first, so that readers see
    all of it or nothing and a repeated task replaces it by the same."""
    folder, _, name = path.rpartition("/")
    mine = f"{folder}/_{uuid.uuid4().hex}"
    with store.open_output_stream(mine, compression=None) as out:
        out.write(data)
    store.move(mine, f"{folder}/{name}")
