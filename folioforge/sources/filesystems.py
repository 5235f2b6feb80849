"""Files by URI, wherever they lie, through Arrow's filesystems."""

from __future__ import annotations

import importlib

from pyarrow import fs


def opened(uri: str, factory: str | None = None) -> tuple[fs.FileSystem, str]:
    """A filesystem and the path in it. factory: "module:function", which takes the URI and gives both, for schemes that Arrow does not know."""
    if factory:
        module, _, name = factory.partition(":")
        return getattr(importlib.import_module(module), name)(uri)
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file://"):  # as it is: Arrow would decode %-signs, and refuse spaces
        from urllib.parse import unquote

        return fs.LocalFileSystem(), unquote(uri[7:])
    return fs.FileSystem.from_uri(uri)
