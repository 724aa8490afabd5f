"""Files fetched from addresses, and a sink of one file for each row.

``fetched`` is a map over a table of addresses: each is tried a few times with growing pauses, and one that fails is
a row with its error. The sink (``write_files``) is a data source with commit: tasks write into a folder of
the job, and only when all have ended are whole files renamed into place; what a lost or doubled task left goes with that folder.

Stores are opened with pyarrow, so ``to`` is a path or address that it knows (file, hdfs, s3, gs).
"""

from __future__ import annotations

import re
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Attempts at an address, seconds that one may take, and the pause after the n-th in seconds for each n.
ATTEMPTS, TIMEOUT, PAUSE = 3, 60.0, 1.5
Opener = Callable[[str, float], bytes]


def opened(url: str, timeout: float) -> bytes:
    """The bytes at an address; a status of failure is an error."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as r:
        return r.read()


def fetched(rows: DataFrame, url: str = "url", attempts: int = ATTEMPTS, timeout: float = TIMEOUT, pause: float = PAUSE, opener: Opener = opened, tasks: int | None = None) -> DataFrame:
    """url, content, error, attempts: each distinct address of ``rows`` once; null addresses are left out.

    ``content`` or else ``error`` is null. Addresses are dealt by their host to ``tasks`` tasks, if told, so that one
    host is asked by one task at a time.
    """
    addresses = rows.select(F.col(url).alias("url")).where("url is not null").distinct()
    if tasks:
        addresses = addresses.repartition(tasks, F.regexp_extract("url", "^[a-z]+://([^/]*)", 1))

    def attempt(place: str) -> tuple[bytes | None, str | None, int]:
        error = None
        for n in range(1, attempts + 1):
            try:
                return opener(place, timeout), None, n
            except Exception as e:  # an address that fails is its own result, not the job's end
                error = f"{type(e).__name__}: {e}"
                if n < attempts:
                    time.sleep(pause * n)
        return None, error, attempts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place in b.column(0):  # a row at a time: files may be large
                content, error, n = attempt(place.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([place.as_py()]), pa.array([content], pa.binary()), pa.array([error], pa.string()), pa.array([n], pa.int32())], names=["url", "content", "error", "attempts"])

    return addresses.mapInArrow(run, "url string, content binary, error string, attempts int")


def address(path: str) -> str:
    """A path as an address: Hadoop writes local ones with one slash, and plain paths are local."""
    return f"file://{path}" if path.startswith("/") else re.sub("^file:/(?!/)", "file:///", path)


@dataclass
class Staged(WriterCommitMessage):
    folder: str


class FileWriter(DataSourceWriter):
    """Rows (name, content) as files ``name`` under a folder."""

    def __init__(self, to: str):
        self.to, self.job = to, f".writing-{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        store, base = fs.FileSystem.from_uri(self.to)
        return store, base.rstrip("/")

    def write(self, rows: Iterator) -> Staged:
        store, base = self._store()
        folder = f"{base}/{self.job}/{uuid.uuid4().hex}"  # of this attempt
        store.create_dir(folder)
        for r in rows:
            with store.open_output_stream(f"{folder}/{r.name}") as out:
                out.write(r.content)
        return Staged(folder)

    def commit(self, messages: list) -> None:
        store, base = self._store()

        def placed(info: fs.FileInfo) -> None:
            store.move(info.path, f"{base}/{info.base_name}")

        with ThreadPoolExecutor(16) as pool:
            for m in messages:
                if m is not None:
                    list(pool.map(placed, store.get_file_info(fs.FileSelector(m.folder))))
        store.create_dir(f"{base}/{self.job}")  # no task, no folder
        store.delete_dir(f"{base}/{self.job}")
        with store.open_output_stream(f"{base}/_SUCCESS"):
            pass

    def abort(self, messages: list) -> None:
        store, base = self._store()
        if store.get_file_info(f"{base}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{base}/{self.job}")


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "row_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options["path"])


def write_files(rows: DataFrame, to: str) -> None:
    """Each row (name, content) as one file under ``to``, in place of one of that name; of rows with one name the greatest content holds.

    Names may not have a slash. A run that fails leaves the files that were there.
    """
    rows.sparkSession.dataSource.register(Files)
    one = rows.groupBy("name").agg(F.max(F.col("content").cast("binary")).alias("content")).where("name is not null and content is not null")
    one.write.format("row_files").option("path", address(to)).mode("append").save()


def write_document_files(docs: DataFrame, to: str, name: str = "questionnaire_id") -> None:
    """Nested documents as one JSON file each, ``<id>.json``, nulls kept; documents without an id have no file."""
    text = F.to_json(F.struct(*[F.col(c) for c in docs.columns]), {"ignoreNullFields": "false"})
    write_files(docs.where(F.col(name).isNotNull()).select(F.concat(F.col(name).cast("string"), F.lit(".json")).alias("name"), F.concat(text, F.lit("\n")).cast("binary").alias("content")), to)


def download(entries: DataFrame, to: str, **options) -> DataFrame:
    """Fetch the files of ``entries`` (base, filename, url) into ``to``; returns base, url, error, attempts of each.

    What was fetched is stored beside ``to`` first, so nothing is fetched twice for the report.
    """
    spark = entries.sparkSession
    fetched(entries, **options).write.mode("overwrite").parquet(f"{to}-fetched")
    got = spark.read.parquet(f"{to}-fetched")
    named = entries.select("base", "filename", "url").join(got, "url")
    write_files(named.where("error is null").select(F.col("filename").alias("name"), "content"), to)
    return named.select("base", "url", "error", "attempts")
