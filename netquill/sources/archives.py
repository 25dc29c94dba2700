"""Archives of posts as a data source: one partition an archive, read as a stream."""

from __future__ import annotations

import json
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "measurement_uid string, raw string"
#: posts that are passed on together, and the bytes of them after which they are
POSTS, BYTES = 1000, 4 << 20


def opened(path: str):
    """A stream of a file in a local folder or a store that Arrow's file systems reach."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return open(path, "rb")
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inside)


def posts(path: str) -> Iterator[tuple[str, str]]:
    """(name, content) of the JSON posts of an archive, one member held at a time."""
    with opened(path) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
        for member in tar:
            tar.members = []  # the archive's list of members would grow with it
            if not member.isfile() or not member.name.endswith(".post"):
                continue
            try:
                envelope = json.load(tar.extractfile(member))
            except ValueError:
                continue
            if envelope.get("format") == "json":
                yield member.name.rsplit("/", 1)[-1].removesuffix(".post"), json.dumps(envelope["content"])


class PostReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        uid, raw, size = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(uid, pa.string()), pa.array(raw, pa.string())], ["measurement_uid", "raw"])

        for name, content in posts(partition.value):
            uid.append(name)
            raw.append(content)
            size += len(content)
            if len(uid) >= POSTS or size >= BYTES:
                yield batch()
                uid, raw, size = [], [], 0
        if uid:
            yield batch()


class PostArchives(DataSource):
    """``spark.read.format("post_archives").option("paths", <JSON list>)``."""

    @classmethod
    def name(cls) -> str:
        return "post_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PostReader:
        return PostReader(json.loads(self.options["paths"]))
