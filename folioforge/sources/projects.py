"""Project folders as a Spark data source: `project_folders`, with rows of project_id, path, content.

Writing follows Spark's protocol. Each task attempt writes below a staging folder that is the job's
own, and tells the driver which projects it holds; on commit each project appears under its name as
a whole, and one that is there already is refused and left as it is; on abort, and after commit, the
staging folder goes. So a task that is tried again or runs twice leaves nothing behind, and a failed
job publishes nothing. A task stages no file of a project that is there already, so a refusal costs a look, not a copy.

Reading lists each project's folder in the task that reads it and gives many files in a batch; the driver lists
only the names of projects. The option `only` (a pattern below a project's folder) leaves other files unopened.

Any Arrow filesystem will do (file, hdfs, s3, gs, abfs); the option `filesystem` names a factory
("module:function", see filesystems.opened) for others. Where folders can be renamed, a project is
published by one rename. Where they cannot, as in object stores, its files are copied and a mark is
written last, below `.published`; without its mark a project is not there for readers and may be written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from folioforge.sources.filesystems import opened

SCHEMA = "project_id string, path string, content binary"
#: Filesystems of which a folder is renamed at once.
RENAMED = ("local", "hdfs")
_MARKS = ".published"
#: Files and bytes of a batch that a reader gives, whichever is reached first.
_BATCH_FILES, _BATCH_BYTES = 1000, 4 << 20
#: Projects that a commit publishes at once: each waits for its store, not for the driver's work.
_PUBLISHERS = 16


def _exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


def _checked(name: str, *, parts: bool) -> str:
    """A name that stays below its folder."""
    pieces = name.split("/") if parts else [name]
    if any(p in ("", ".", "..") or "/" in p or "\x00" in p for p in pieces) or (not parts and name.startswith(".")):
        raise ValueError(f"not a name below a folder: {name!r}")
    return name


class _Place:
    """The folder that holds the projects."""

    def __init__(self, options: dict):
        self.system, base = opened(options["path"], options.get("filesystem"))
        self.base = base.rstrip("/")
        self.renames = self.system.type_name in RENAMED
        self.made: set[str] = set()

    def target(self, project: str) -> str:
        return f"{self.base}/{project}"

    def mark(self, project: str) -> str:
        return f"{self.base}/{_MARKS}/{project}"

    def published(self, project: str) -> bool:
        return _exists(self.system, self.target(project) if self.renames else self.mark(project))

    def projects(self) -> list[str]:
        folder = self.base if self.renames else f"{self.base}/{_MARKS}"
        found = self.system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        wanted = fs.FileType.Directory if self.renames else fs.FileType.File
        return sorted(f.base_name for f in found if f.type == wanted and not f.base_name.startswith("."))

    def files(self, folder: str, only: str = "*") -> list[str]:
        """The files below a folder whose path in it is like `only`, where an asterisk stands for any text; without one, nothing is listed."""
        if "*" not in only:
            return [path] if self.system.get_file_info(path := f"{folder}/{only}").type == fs.FileType.File else []
        found = self.system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        return sorted(f.path for f in found if f.type == fs.FileType.File and fnmatchcase(f.path[len(folder) + 1 :], only))

    def put(self, path: str, content: bytes) -> None:
        folder = path.rpartition("/")[0]
        if folder not in self.made:
            self.system.create_dir(folder, recursive=True)
            if len(self.made) >= 10_000:
                self.made.clear()
            self.made.add(folder)
        with self.system.open_output_stream(path) as out:
            out.write(content)

    def remove(self, folder: str) -> None:
        if self.renames:
            if _exists(self.system, folder):
                self.system.delete_dir(folder)
            return
        for path in self.files(folder):
            self.system.delete_file(path)

    def publish(self, project: str, staged: list[str]) -> bool:
        """Shows a project's staged folders (one for each task that had some of its files) under its name; False if it is there already."""
        if self.published(project):
            return False
        if not self.renames:
            self.remove(self.target(project))  # what a commit that was cut short left
            for folder in staged:
                for path in self.files(folder):
                    place = self.target(project) + path[len(folder) :]
                    self.system.create_dir(place.rpartition("/")[0], recursive=True)
                    self.system.copy_file(path, place)
            self.put(self.mark(project), b"")
            return True
        for other in staged[1:]:
            for path in self.files(other):
                place = staged[0] + path[len(other) :]
                self.system.create_dir(place.rpartition("/")[0], recursive=True)
                self.system.move(path, place)
        try:
            self.system.move(staged[0], self.target(project))
        except OSError:
            if self.published(project):  # another job was quicker
                return False
            raise
        return True


@dataclass
class _Staged(WriterCommitMessage):
    folder: str
    projects: list[str] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.job = self.options.get("job") or uuid.uuid4().hex

    def _staging(self, place: _Place) -> str:
        return f"{place.base}/.staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        place = _Place(self.options)
        folder = f"{self._staging(place)}/{uuid.uuid4().hex}"  # no other attempt's
        fresh: dict[str, bool] = {}
        try:
            for batch in iterator:
                for project, path, content in zip(*[batch.column(c) for c in ("project_id", "path", "content")], strict=True):
                    project, path = project.as_py(), path.as_py()
                    if project not in fresh:
                        fresh[project] = not place.published(_checked(project, parts=False))
                    if fresh[project]:
                        place.put(f"{folder}/{project}/{_checked(path, parts=True)}", content.as_py() or b"")
        except BaseException:
            place.remove(folder)
            raise
        return _Staged(folder, [project for project, new in fresh.items() if new])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        place = _Place(self.options)
        staged: dict[str, list[str]] = {}
        for m in messages:
            for project in m.projects if m else []:
                staged.setdefault(project, []).append(f"{m.folder}/{project}")
        with ThreadPoolExecutor(_PUBLISHERS) as pool:
            done = [project for project, new in zip(staged, pool.map(place.publish, staged, staged.values()), strict=True) if new]
        place.remove(self._staging(place))
        if self.options.get("job"):
            place.put(f"{place.base}/.report-{self.job}", json.dumps(sorted(done)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        place = _Place(self.options)
        place.remove(self._staging(place))


@dataclass
class _Projects(InputPartition):
    names: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        names = _Place(self.options).projects()
        step = max(1, -(-len(names) // int(self.options.get("partitions", "64"))))
        return [_Projects(names[k : k + step]) for k in range(0, len(names), step)] or [_Projects([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        place = _Place(self.options)
        return _batches(self._files(place, partition.names))

    def _files(self, place: _Place, names: list[str]) -> Iterator[tuple[str, str, bytes]]:
        for project in names:
            folder = place.target(project)
            for path in place.files(folder, self.options.get("only", "*")):
                with place.system.open_input_stream(path) as file:
                    yield project, path[len(folder) + 1 :], file.read()


def _batches(files: Iterable[tuple[str, str, bytes]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    as_batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)], ["project_id", "path", "content"])
    for file in files:
        held.append(file)
        size += len(file[2])
        if len(held) >= _BATCH_FILES or size >= _BATCH_BYTES:
            yield as_batch(held)
            held, size = [], 0
    if held:
        yield as_batch(held)


class ProjectFolders(DataSource):
    @classmethod
    def name(cls) -> str:
        return "project_folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("projects are never overwritten")
        return _Writer(self.options)


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(ProjectFolders)
    return spark


def write_projects(files: DataFrame, root: str, *, filesystem: str | None = None) -> list[str]:
    """Publishes project_id, path, content below root; returns the ids of the projects that this call published, in order.

    All files of a project are dealt to one task. What the driver holds is a name a project.
    """
    registered(files.sparkSession)
    job = uuid.uuid4().hex
    options = {"path": root, "job": job} | ({"filesystem": filesystem} if filesystem else {})
    files.select("project_id", "path", "content").repartition("project_id").write.format("project_folders").mode("append").options(**options).save()
    place = _Place(options)
    report = f"{place.base}/.report-{job}"
    with place.system.open_input_stream(report) as file:
        done = json.loads(file.read())
    place.system.delete_file(report)
    return done


def read_folders(spark: SparkSession, root: str, *, filesystem: str | None = None, only: str = "*") -> DataFrame:
    """project_id, path, content of all published projects, through Arrow's filesystems; of those files alone whose path is like `only`."""
    options = {"path": root, "only": only} | ({"filesystem": filesystem} if filesystem else {})
    return registered(spark).read.format("project_folders").options(**options).load()
