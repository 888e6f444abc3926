"""Files in the shared folder, opened by URI from any worker."""

from __future__ import annotations

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a path without scheme is a mounted shared folder."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def make_folder(uri: str) -> None:
    system, path = place(uri)
    system.create_dir(path, recursive=True)
