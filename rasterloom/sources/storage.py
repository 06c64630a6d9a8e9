"""Byte streams on the shared storage, by URI.

``file:`` URIs and plain paths use the operating system; any other scheme is
opened through ``pyarrow.fs``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO
from urllib.parse import unquote, urlparse


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else uri
    return None


@contextmanager
def create(uri: str) -> Iterator[BinaryIO]:
    """A new file that appears under its name only once it is whole.

    A task that dies half way leaves nothing under ``uri``; the retry writes
    the file anew.
    """
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(uri)
        part = f"{inner}.{uuid.uuid4().hex}.part"
        try:
            with store.open_output_stream(part) as out:
                yield out
        except BaseException:
            store.delete_file(part)
            raise
        store.move(part, inner)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with open(part, "wb") as out:
            yield out
    except BaseException:
        os.remove(part)
        raise
    os.replace(part, path)


@contextmanager
def reopen(uri: str) -> Iterator[BinaryIO]:
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(uri)
        with store.open_input_file(inner) as src:
            yield src
        return
    with open(path, "rb") as src:
        yield src


def exists(uri: str) -> bool:
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(uri)
        return store.get_file_info(inner).type != fs.FileType.NotFound
    return os.path.exists(path)
