"""Page files as a data source, and Markdown files as a sink with a commit, both on Spark's Python data source interface.

The source plans by file sizes alone: small files share a partition, and a file that may hold many pages and is larger than a
partition is read by several tasks, each of which gives its own range of the file's pages. Pages of one file are told apart by
``page_no``. The sink's tasks write below a staging folder; files get their names when the whole job commits, and a task or job
that fails leaves the files that were there before as they are.

Files are reached through Arrow's file systems (local, HDFS, object stores), by the driver for the listing and by the
executors for the rest.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Gives the pages of a file's content, each as content that a decoder reads. May be lazy.
Splitter = Callable[[bytes], Sequence[bytes]]
# Suffixes of page files, and those of kinds that may hold many pages.
SUFFIXES = ["png", "jpg", "jpeg", "bmp", "tiff", "pdf"]
MANY_PAGES = ["tiff", "pdf", "ppm", "pgm", "pnm"]
SCHEMA = "doc_id string, document string, page_no int, path string, content binary"
PARTITION_BYTES = 64 << 20


def arrow_store(uri: str):
    """Arrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + quote(uri[5:] if uri.startswith("file:") else uri)
    return fs.FileSystem.from_uri(uri)


def stem_of(name: str) -> str:
    """A file's name without its suffix; a name that is all suffix stays."""
    head, dot, tail = name.rpartition(".")
    return head if dot and head else name


def document_names(files: Sequence[str]) -> list[str]:
    """Each file's document: its stem, or its whole name where several files have that stem, or one has it as its name."""
    stems, whole = Counter(map(stem_of, files)), set(files)
    return [s if stems[s] == 1 and (s == f or s not in whole) else f for f in files for s in (stem_of(f),)]


def netpbm_pages(content: bytes) -> list[bytes]:
    """The pictures of a binary Netpbm file, which may follow one another."""
    from quireflow.operators.detect import netpbm_size

    out, at = [], 0
    while at < len(content):
        end = at + netpbm_size(content[at:])
        out.append(content[at:end])
        while content[end : end + 1].isspace():
            end += 1
        at = end
    return out or [content]


def split_pages(content: bytes, suffix: str, splitters: dict[str, Splitter]) -> Sequence[bytes]:
    if suffix in splitters:
        return splitters[suffix](content)
    return netpbm_pages(content) if content[:2] in (b"P5", b"P6") else [content]


def page_range(pages: int, share: int, shares: int) -> range:
    """The pages of one of ``shares`` readers of a file."""
    return range(-(-pages * share // shares), -(-pages * (share + 1) // shares))


@dataclass
class Files(InputPartition):
    """(root, path in its store, document, share, shares) of the files that a task reads."""

    files: list[tuple[str, str, str, int, int]]


class PageReader(DataSourceReader):
    def __init__(self, paths: list[str], suffixes: list[str], names: str, partition_bytes: int, splitters: dict[str, Splitter]) -> None:
        self.paths, self.suffixes, self.names, self.partition_bytes, self.splitters = paths, suffixes, names, partition_bytes, splitters

    def listed(self) -> list[tuple[str, str, str, int]]:
        """(path in its store, root, name, bytes) of page files, by path. Of a folder those directly in it with a known suffix; a file that is named itself may have any."""
        from pyarrow import fs

        out = []
        for root in self.paths:
            store, base = arrow_store(root)
            info = store.get_file_info(base)
            if info.type == fs.FileType.File:
                out.append((info.path, root, info.base_name, info.size))
                continue
            for f in store.get_file_info(fs.FileSelector(base)):
                if f.type == fs.FileType.File and f.extension.lower() in self.suffixes and not f.base_name.startswith((".", "_")):
                    out.append((f.path, root, f.base_name, f.size))
        return sorted(out)

    def partitions(self) -> list[Files]:
        files = self.listed()
        names = [name for _, _, name, _ in files]
        out, held, size = [], [], 0
        for (path, root, name, length), document in zip(files, names if self.names == "file" else document_names(names), strict=True):
            shares = -(-length // self.partition_bytes) if name.rpartition(".")[2].lower() in {*MANY_PAGES, *self.splitters} else 1
            if shares > 1:
                out += [Files([(root, path, document, k, shares)]) for k in range(shares)]
                continue
            if held and size + length > self.partition_bytes:
                out.append(Files(held))
                held, size = [], 0
            held.append((root, path, document, 0, 1))
            size += length
        return out + [Files(held)] * bool(held) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.string()), ("document", pa.string()), ("page_no", pa.int32()), ("path", pa.string()), ("content", pa.binary())])
        for root, path, document, share, shares in partition.files:
            store, _ = arrow_store(root)
            where = urlsplit(root)
            uri = f"{where.scheme}://{where.netloc}{path}" if "://" in root else f"file://{path}"
            with store.open_input_stream(path) as f:
                content = f.read()
            pages = split_pages(content, path.rpartition(".")[2].lower(), self.splitters)
            for k in page_range(len(pages), share, shares):
                # a slash is in no file's name, so a page's key is no other document's
                key = document if len(pages) == 1 else f"{document}/{k}"
                yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip((key, document, k, uri, pages[k]), schema, strict=True)], schema=schema)


def page_source(splitters: dict[str, Splitter] | None = None) -> type[DataSource]:
    """The data source ``quireflow_pages`` with splitters by suffix, to be registered with ``spark.dataSource.register``.

    Options: path (or files, a JSON list of paths), suffixes (comma-separated), names (stem or file), partition_bytes.
    """
    held = dict(splitters or {})

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "quireflow_pages"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> PageReader:
            o = self.options
            paths = json.loads(o["files"]) if "files" in o else [o["path"]]
            return PageReader(paths, (o.get("suffixes") or ",".join(SUFFIXES)).lower().split(","), o.get("names", "stem"), int(o.get("partition_bytes", PARTITION_BYTES)), held)

    return Pages


@dataclass
class Staged(WriterCommitMessage):
    """A task's folder below the staging folder, with its list of files; null if the task had none."""

    folder: str | None
    files: int


class MarkdownWriter(DataSourceArrowWriter):
    """Writes rows of (name, text) to root/name/name<suffix>.md."""

    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.suffix, self.batch = options["path"], options.get("suffix", ""), options.get("batch")
        self.name, self.text = options.get("name", "doc_id"), options.get("text", "markdown")
        self.job = uuid.uuid4().hex

    def _store(self):
        store, base = arrow_store(self.root)
        return store, base, f"{base}/.staging-{self.job}"

    def prepare(self) -> MarkdownWriter:
        store, _, staging = self._store()
        store.create_dir(staging, recursive=True)
        return self

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        from quireflow.sources.pages import file_name

        store, _, staging = self._store()
        folder, names = f"{staging}/{uuid.uuid4().hex}", []
        for b in iterator:
            for key, text in zip(b.column(b.schema.get_field_index(self.name)).to_pylist(), b.column(b.schema.get_field_index(self.text)).to_pylist(), strict=True):
                if not names:
                    # not with its parents: a task that outlives its job finds the staging folder gone
                    store.create_dir(folder, recursive=False)
                with store.open_output_stream(f"{folder}/{len(names)}") as f:
                    f.write((text or "").encode("utf-8", "surrogatepass"))
                names.append(file_name(key))
        if not names:
            return Staged(None, 0)
        with store.open_output_stream(f"{folder}/names") as f:
            f.write("\n".join(names).encode())
        return Staged(folder, len(names))

    def commit(self, messages: list[Staged | None]) -> None:
        """Gives the files their names, each at once, then removes what attempts that don't count have left."""
        store, base, staging = self._store()

        def show(item: tuple[str, int, str]) -> None:
            folder, k, name = item
            store.create_dir(f"{base}/{name}", recursive=True)
            store.move(f"{folder}/{k}", f"{base}/{name}/{name}{self.suffix}.md")

        with ThreadPoolExecutor(16) as pool:
            for m in messages:
                if m is not None and m.folder is not None:
                    with store.open_input_stream(f"{m.folder}/names") as f:
                        names = f.read().decode().split("\n")
                    list(pool.map(show, [(m.folder, k, n) for k, n in enumerate(names)]))
        self._clear(store, staging)
        if self.batch is not None:
            store.create_dir(f"{base}/.batches", recursive=True)
            with store.open_output_stream(f"{base}/.batches/{self.batch}") as f:
                f.write(b"")

    def abort(self, messages: list[Staged | None]) -> None:
        store, _, staging = self._store()
        self._clear(store, staging)

    @staticmethod
    def _clear(store, staging: str) -> None:
        from pyarrow import fs

        for _ in range(5):  # a task that is being ended may still put a file there
            try:
                if store.get_file_info(staging).type == fs.FileType.Directory:
                    store.delete_dir(staging)
            except OSError:
                time.sleep(0.2)
            else:
                return


class MarkdownSink(DataSource):
    """The sink ``quireflow_markdown``. Options: path, name and text (columns), suffix, batch (a mark that is left in ``.batches`` when the job has committed)."""

    @classmethod
    def name(cls) -> str:
        return "quireflow_markdown"

    def schema(self) -> str:
        return "doc_id string, markdown string"

    def writer(self, schema, overwrite: bool) -> MarkdownWriter:
        return MarkdownWriter(dict(self.options)).prepare()


def batch_done(root: str, batch: str) -> bool:
    """Whether a job with that mark has committed."""
    from pyarrow import fs

    store, base = arrow_store(root)
    return store.get_file_info(f"{base}/.batches/{batch}").type == fs.FileType.File


def register(spark: SparkSession, splitters: dict[str, Splitter] | None = None) -> None:
    """Makes both known to a session, whose executors get the package."""
    from quireflow.tables import ship

    ship(spark)
    spark.dataSource.register(page_source(splitters))
    spark.dataSource.register(MarkdownSink)
