"""WARC and WET archives as a Spark data source: one partition per file, records streamed, with an audit.

A record that cannot be read ends its file; what came before stays, and a last
row with ``record_type`` "error" and the reason in ``error`` tells that the file
is not whole.  audit() sums this up per file.
"""

from __future__ import annotations

import gzip
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siftwell.sources.files import find_files, open_file

SCHEMA = "url string, record_type string, http_content_type string, content binary, source_file string, record_no long, error string"


class Broken(Exception):
    """A record that cannot be read."""


def records(stream):
    """(headers, body) of each record; raises Broken where one is cut off or malformed."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise Broken("no record where one should begin")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        try:
            size = int(headers.get("content-length", ""))
        except ValueError:
            raise Broken("no length of content") from None
        body = stream.read(size)
        if len(body) < size:
            raise Broken(f"{len(body)} of {size} bytes of content")
        yield headers, body


def split_http(body: bytes) -> tuple[str | None, bytes]:
    """Content type and payload of an HTTP response block."""
    head, _, payload = body.partition(b"\r\n\r\n")
    kind = None
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-type":
            kind = value.strip().decode("latin-1")
    return kind, payload


def open_archive(path: str, compression: str = "auto"):
    import io

    with open_file(path) as f:
        magic = f.read(2)
    packed = compression == "gzip" or compression == "auto" and magic == b"\x1f\x8b"
    stream = open_file(path)
    return gzip.GzipFile(fileobj=stream) if packed else io.BufferedReader(stream)


def rows(path: str, types: set[str], compression: str = "auto"):
    n = 0
    try:
        with open_archive(path, compression) as stream:
            for headers, body in records(stream):
                n += 1
                kind = headers.get("warc-type", "")
                if types and kind not in types:
                    continue
                content_type, payload = split_http(body) if kind == "response" else (None, body)
                yield headers.get("warc-target-uri"), kind, content_type, payload, path, n, None
    except (Broken, EOFError, OSError, zlib.error) as e:
        yield None, "error", None, None, path, n + 1, f"{type(e).__name__}: {e}"


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = dict(options)

    def partitions(self):
        return [_File(p) for p in find_files(self.options["path"])]

    def read(self, partition):
        if partition is None:  # no file matched
            return
        types = {t for t in self.options.get("types", "response,conversion").split(",") if t}
        yield from rows(partition.path, types, self.options.get("compression", "auto"))


class WarcSource(DataSource):
    """``spark.read.format("warc").option("types", "response").load(path)``"""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def audit(archives: DataFrame, kept: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """(source_file, records, broken, error, kept) of each archive: what was read, what failed, and what a stage kept.

    ``kept`` holds the ``source_file`` of each document that came through.
    """
    per = archives.groupBy("source_file").agg(F.count_if(F.col("error").isNull()).alias("records"), F.count_if(F.col("error").isNotNull()).alias("broken"), F.max("error").alias("error"))
    if kept is None:
        return per
    return per.join(kept.groupBy("source_file").agg(F.count("*").alias("kept")), "source_file", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
