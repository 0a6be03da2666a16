"""Binary files that tasks write to shared storage."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager


@contextmanager
def whole_file(folder: str, name: str) -> Iterator:
    """A stream to write a file under a name of this attempt; at the end it is moved into place.

    A lost or repeated task leaves either no file of that name or a whole one, and a repeat replaces it.
    An attempt that fails removes what it wrote.
    ``folder`` is any location pyarrow's file systems know (a shared mount, HDFS, an object store).
    """
    from pyarrow.fs import FileSystem

    store, root = FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    attempt = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
    try:
        with store.open_output_stream(attempt, compression=None) as out:
            yield out
    except BaseException:
        store.delete_file(attempt)
        raise
    store.move(attempt, posixpath.join(root, name))
