"""A store of objects without folders or renames, for the tests: flat://folder, objects are files whose names are quoted keys."""

import os
import shutil
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs


class Flat(fs.FileSystemHandler):
    def __init__(self, root):
        self.root = root

    def _file(self, key):
        return f"{self.root}/{quote(key.strip('/'), safe='')}"

    def _keys(self):
        return [unquote(n) for n in os.listdir(self.root)]

    def get_type_name(self):
        return "flat"

    def normalize_path(self, path):
        return path

    def _info(self, key):
        key = key.strip("/")
        if os.path.exists(self._file(key)):
            return fs.FileInfo(key, fs.FileType.File)
        below = any(k.startswith(key + "/") for k in self._keys())
        return fs.FileInfo(key, fs.FileType.Directory if below else fs.FileType.NotFound)

    def get_file_info(self, paths):
        return [self._info(p) for p in paths]

    def get_file_info_selector(self, selector):
        base = selector.base_dir.strip("/") + "/"
        keys = sorted(k for k in self._keys() if k.startswith(base))
        if selector.recursive:
            return [fs.FileInfo(k, fs.FileType.File) for k in keys]
        heads = dict.fromkeys(base + k[len(base) :].split("/")[0] for k in keys)
        return [self._info(h) for h in heads]

    def create_dir(self, path, recursive):
        pass

    def delete_file(self, path):
        os.remove(self._file(path))

    def copy_file(self, src, dst):
        shutil.copy(self._file(src), self._file(dst))

    def move(self, src, dst):
        raise NotImplementedError("objects have no rename")

    def delete_dir(self, path):
        raise NotImplementedError("objects have no folders")

    delete_dir_contents = delete_root_dir_contents = open_append_stream = delete_dir

    def open_input_stream(self, path):
        return pa.PythonFile(open(self._file(path), "rb"), mode="r")

    open_input_file = open_input_stream

    def open_output_stream(self, path, metadata):
        return pa.PythonFile(open(self._file(path), "wb"), mode="w")


def at(uri):
    return fs.PyFileSystem(Flat(uri.removeprefix("flat://"))), "bucket/books"
