"""Document trees as a Spark data source and sink, ``doc_tree`` (SRC-1, SRC-2, SNK-1, SNK-2).

Spark's file sources skip names that begin with ``_`` or ``.``, and such files (``_snippet.mdx``) are content here; their
writers name files themselves. This one reads and writes any names::

    spark.dataSource.register(DocTree)
    files = spark.read.format("doc_tree").load(root).where("ext in ('.md', '.mdx')")
    files.write.format("doc_tree").mode("overwrite").save(other_root)

Stores are opened with ``pyarrow.fs`` in the tasks: mounted folders, hdfs, s3, gs, abfs.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull,
                                    StringEndsWith, StringStartsWith, WriterCommitMessage)

SCHEMA = "rel_path string, path string, length long, ext string, status string, error string, content binary"
#: Bytes and rows of an Arrow batch; files of a directory that one task reads; partitions of a scan; bytes of a file that a row can hold.
BATCH_BYTES, BATCH_ROWS, DIR_FILES, MAX_PARTS, MAX_FILE = 32 << 20, 1000, 1000, 10_000, (1 << 31) - 64
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def open_root(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a root and its path there."""
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[len("file:"):].strip("/")
    if "://" not in root:
        return pafs.LocalFileSystem(), posixpath.abspath(root)
    system, path = pafs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


def extension(name: str) -> str:
    """The last dot of a file's name and what follows; empty without one."""
    name = name.rsplit("/", 1)[-1]
    return name[name.rindex("."):] if "." in name else ""


def _entries(system: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """Name, whether it is a folder, and size of what is right in a folder. Links to folders, which may lead back, are left out;
    a link to nothing is a file (that can't be read)."""
    if not isinstance(system, pafs.LocalFileSystem):
        for info in system.get_file_info(pafs.FileSelector(folder)):
            yield info.base_name, info.type == pafs.FileType.Directory, int(info.size or 0)
        return
    with os.scandir(folder) as found:
        for e in found:
            if e.is_dir(follow_symlinks=False):
                yield e.name, True, 0
            elif not e.is_dir():
                yield e.name, False, e.stat(follow_symlinks=os.path.exists(e.path)).st_size


@dataclass
class Wanted:
    """What pushed filters (and the ``extensions`` option) leave of a tree."""

    extensions: frozenset[str] | None = None
    suffixes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()

    def file(self, rel: str) -> bool:
        return ((self.extensions is None or extension(rel) in self.extensions) and all(rel.endswith(s) for s in self.suffixes)
                and all(rel.startswith(p) for p in self.prefixes))

    def folder(self, rel: str) -> bool:
        """Whether files under a folder can be wanted."""
        return all(f"{rel}/".startswith(p) or p.startswith(f"{rel}/") for p in self.prefixes)

    def narrow(self, extensions) -> None:
        found = frozenset(extensions)
        self.extensions = found if self.extensions is None else self.extensions & found


@dataclass
class Part(InputPartition):
    """Folders (relative) to read: with all below them, or the files right in them; of those the ``shard``-th of ``shards`` by name."""

    folders: list[str]
    deep: bool
    shard: int = 0
    shards: int = 1


class TreeReader(DataSourceReader):
    """A scan: a partition is a folder's own files (dealt to several tasks where there are many) or some folders of level ``depth``
    with all below. The driver lists the folders above that level only.

    A file that can't be read is a row with status ``failed``, its ``error`` and no content, never an empty file; a folder that
    can't be listed fails the scan. Rows come in no order.
    """

    def __init__(self, options):
        self.root, self.depth = options["path"], int(options.get("depth", 2))
        self.with_content = options.get("content", "true").lower() == "true"
        self.wanted = Wanted()
        if options.get("extensions"):
            self.wanted.narrow(options["extensions"].split(","))

    def _list(self, system, base: str, folder: str) -> tuple[list[tuple[str, int]], list[str]]:
        """Files (relative path, size) right in a folder and its sub-folders, those that are wanted, in order."""
        files, folders = [], []
        for name, is_folder, size in _entries(system, posixpath.join(base, folder)):
            rel = posixpath.join(folder, name)
            if is_folder:
                if self.wanted.folder(rel):
                    folders.append(rel)
            elif self.wanted.file(rel):
                files.append((rel, size))
        return sorted(files), sorted(folders)

    def partitions(self) -> list[Part]:
        system, base = open_root(self.root)
        parts, level = [], [""]
        for _ in range(self.depth):
            below = []
            for folder in level:
                files, folders = self._list(system, base, folder)
                shards = -(-len(files) // DIR_FILES)
                parts += [Part([folder], False, i, shards) for i in range(shards)]
                below += folders
            level = below
        size = -(-len(level) // MAX_PARTS) or 1
        return [*parts, *(Part(level[i:i + size], True) for i in range(0, len(level), size))]

    def _walk(self, system, base: str, part: Part) -> Iterator[tuple[str, int]]:
        todo = list(reversed(part.folders))
        while todo:
            files, folders = self._list(system, base, todo.pop())
            yield from files[part.shard::part.shards]
            if part.deep:
                todo += reversed(folders)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, base = open_root(self.root)
        rows, held = [], 0
        for rel, size in self._walk(system, base, partition):
            path, data, error = posixpath.join(base, rel), None, None
            if self.with_content:
                try:
                    if size > MAX_FILE:
                        raise OSError(f"{size} bytes are more than a row can hold")
                    with system.open_input_stream(path) as f:
                        data = f.read()
                except OSError as e:
                    error = f"{type(e).__name__}: {e}"
            rows.append((rel, path, size, extension(rel), "failed" if error else "ok", error, data))
            held += len(data or b"")
            if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


class FilteringReader(TreeReader):
    """A scan that takes filters on ``ext`` (=, in) and ``rel_path`` (begins with, ends with): files that
    they drop are never opened, folders that can't hold others never listed."""

    def pushFilters(self, filters):  # noqa: N802 - Spark's name
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("ext",):
                self.wanted.narrow([f.value])
            elif isinstance(f, In) and f.attribute == ("ext",):
                self.wanted.narrow(f.value)
            elif isinstance(f, StringEndsWith) and f.attribute == ("rel_path",):
                self.wanted.suffixes += (f.value,)
            elif isinstance(f, StringStartsWith) and f.attribute == ("rel_path",):
                self.wanted.prefixes += (f.value,)
            elif not (isinstance(f, IsNotNull) and f.attribute in (("ext",), ("rel_path",))):  # those never are null
                yield f


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


class TreeWriter(DataSourceWriter):
    """One file per row of ``rel_path`` and ``content`` (binary, or text written as UTF-8); rows without content are left out.

    Files are written beside the tree under a name of this job, each under a name of the attempt first and then renamed.
    With mode ``overwrite`` the job's commit puts the new tree in the place of the old one. With ``append`` a task that has
    written all its rows moves its files into the tree, in the place of files of the same path. A job that fails, or is
    aborted, leaves the tree as it was but for the whole files of tasks that ended (``append``). Of rows with the same path one stays.
    """

    def __init__(self, options, overwrite: bool):
        self.root, self.overwrite = options["path"], overwrite
        self.rel, self.content = options.get("rel_path", "rel_path"), options.get("column", "content")
        self.job = uuid.uuid4().hex

    def _places(self):
        system, base = open_root(self.root)
        folder, name = posixpath.split(base)
        return system, base, posixpath.join(folder, f".{name}.{self.job}")

    @staticmethod
    def _checked(rel: str) -> str:
        clean = posixpath.normpath(rel)
        if not rel or rel.endswith("/") or clean.startswith(("/", "..")) or clean == ".":
            raise ValueError(f"not a path of a file under the root: {rel!r}")
        return clean

    def write(self, iterator) -> Written:
        system, base, aside = self._places()
        attempt, done, total = uuid.uuid4().hex, {}, 0
        whole = posixpath.join(aside, "whole" if self.overwrite else attempt)
        for row in iterator:
            data = row[self.content]
            if data is None:
                continue
            rel = self._checked(row[self.rel])
            data = data.encode("utf-8") if isinstance(data, str) else bytes(data)
            target = posixpath.join(whole, rel)
            system.create_dir(posixpath.dirname(target), recursive=True)
            half = posixpath.join(aside, f"{attempt}.half")
            with system.open_output_stream(half) as f:
                f.write(data)
            system.move(half, target)
            done[rel] = target
            total += len(data)
        if not self.overwrite:
            for rel, target in done.items():
                final = posixpath.join(base, rel)
                system.create_dir(posixpath.dirname(final), recursive=True)
                system.move(target, final)
        return Written(len(done), total)

    def commit(self, messages) -> None:
        system, base, aside = self._places()
        if self.overwrite:
            whole, old = posixpath.join(aside, "whole"), posixpath.join(aside, "old")
            system.create_dir(whole, recursive=True)
            if system.get_file_info(base).type == pafs.FileType.Directory:
                system.move(base, old)
            system.move(whole, base)
        self._clear(system, aside)

    def abort(self, messages) -> None:
        system, _, aside = self._places()
        self._clear(system, aside)

    @staticmethod
    def _clear(system, aside: str) -> None:
        if system.get_file_info(aside).type == pafs.FileType.Directory:
            system.delete_dir(aside)


class DocTree(DataSource):
    """Options: ``path``; to read also ``depth`` (2), ``extensions`` (comma-separated), ``content`` (true), ``pushdown`` (as the session
    has it); to write also ``rel_path`` and ``column`` (names of the two columns)."""

    @classmethod
    def name(cls) -> str:
        return "doc_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        # Spark refuses a reader that takes filters where the session doesn't push them
        return FilteringReader(self.options) if self.options.get("pushdown", "false").lower() == "true" else TreeReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return TreeWriter(self.options, overwrite)


def scan_tree(spark: SparkSession, root: str, extensions: tuple[str, ...] | None = None, depth: int = 2) -> DataFrame:
    """SRC-1 / SRC-2: ``(rel_path, path, length, ext, status, error, content)`` of every file under ``root`` (hidden and
    ``_``-prefixed names included), or of those with one of ``extensions`` (case-sensitive, e.g. ``('.md', '.mdx')``).

    Where the session pushes filters into Python sources, so are later ones on ``ext`` and ``rel_path``.
    """
    from docweave.session import ship_package
    ship_package(spark)
    spark.dataSource.register(DocTree)
    pushed = (spark.conf.get(PUSHDOWN, "false") or "false").lower()
    reader = spark.read.format("doc_tree").option("depth", depth).option("pushdown", pushed)
    if extensions is None:
        return reader.load(root)
    if pushed == "true":
        return reader.load(root).where(F.col("ext").isin(*extensions))
    return reader.option("extensions", ",".join(extensions)).load(root)


def write_tree(df: DataFrame, root: str, rel_col: str = "output_path", content_col: str = "content", mode: str = "append") -> None:
    """SNK-1 / SNK-2: one file per row at ``root/<rel_col>`` (see :class:`TreeWriter`)."""
    from docweave.session import ship_package
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(DocTree)
    df.select(F.col(rel_col).alias("rel_path"), F.col(content_col).alias("content")).write.format("doc_tree").mode(mode).save(root)
