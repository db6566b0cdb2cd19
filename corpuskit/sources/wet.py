"""WARC text shards as a DataFrame: ``spark.read.format("wet")``. One partition for each file; records stream out of it one by one."""

from __future__ import annotations

import glob
import gzip
import os
import re
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from corpuskit.schema import RECORD, BadInput, CorpusError

_NUMBER = re.compile(r"([0-9]+)(?:\.|$)")
_LENGTH = re.compile(r"[0-9]{1,18}")
#: Bytes of a body asked for at once: a header may claim any length, but memory is taken only for what is there.
AT_ONCE = 1 << 22


def shard_number(path: str) -> int:
    """The number before the first dot of the file's name."""
    m = _NUMBER.match(os.path.basename(path))
    if not m:
        raise BadInput(f"{path}: no shard number")
    return int(m[1])


def numbered(path: str) -> int | None:
    """``shard_number``, or None where the name has none."""
    try:
        return shard_number(path)
    except BadInput:
        return None


def shard_number_of(name: Column) -> Column:
    """The same of a column of file names; null where there is none."""
    return F.regexp_extract(name, r"^([0-9]+)(?:\.|$)", 1).try_cast("long")


def shards(path: str) -> list[str]:
    """Files of a folder, not of those in it; or the file itself; or what a pattern matches."""
    local = urlsplit(path).path if path.startswith("file:") else path
    if os.path.isdir(local):
        return sorted(e.path for e in os.scandir(local) if e.is_file())
    found = [local] if os.path.isfile(local) else sorted(glob.glob(local))
    if not found:
        raise BadInput(f"{path}: no such file or folder")
    return found


def _body(stream: BinaryIO, length: int) -> bytes:
    parts = []
    while length and (part := stream.read(min(length, AT_ONCE))):
        parts.append(part)
        length -= len(part)
    return b"".join(parts)


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(headers with lower-cased names, body, error). A record that can't be parsed is one with an error; reading goes on at the next that begins."""
    line = stream.readline()
    while True:
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            yield {}, b"", f"no record begins with {line[:40]!r}"
            while line and not line.startswith(b"WARC/"):
                line = stream.readline()
            continue
        headers: dict[str, str] = {}
        error, last = None, ""
        while True:
            line = stream.readline()
            if line in (b"\r\n", b"\n", b""):
                break
            if line[:1] in b" \t" and last:
                headers[last] += " " + line.strip().decode("utf-8", "replace")
                continue
            name, colon, value = line.partition(b":")
            if not colon:
                error = error or f"ill-formed header {line[:40]!r}"
                continue
            last = name.strip().decode("utf-8", "replace").lower()
            headers[last] = value.strip().decode("utf-8", "replace")
        length = headers.get("content-length", "")
        if not _LENGTH.fullmatch(length):
            yield headers, b"", error or "no content length"
            line = stream.readline()
            while line and not line.startswith(b"WARC/"):
                line = stream.readline()
            continue
        body = _body(stream, int(length))
        if len(body) < int(length):
            error = error or "the body ends early"
        yield headers, body, error
        line = stream.readline()


class ShardPartition(InputPartition):
    def __init__(self, path: str, shard_id: int) -> None:
        self.path, self.shard_id = path, shard_id


class WetReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path", "")
        self.mode = options.get("mode", "PERMISSIVE").upper()
        self.compression = options.get("compression", "gzip")
        self.wanted: set[int] | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("shard_id",):
                only = {f.value}
            elif isinstance(f, In) and f.attribute == ("shard_id",):
                only = set(f.value)
            else:
                yield f
                continue
            self.wanted = only if self.wanted is None else self.wanted & only

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in shards(self.path):
            try:
                number = shard_number(path)
            except CorpusError:
                if self.mode == "FAILFAST":
                    raise
                continue
            if self.wanted is None or number in self.wanted:
                out.append(ShardPartition(path, number))
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        assert isinstance(partition, ShardPartition)
        opened = open(partition.path, "rb") if self.compression == "none" else gzip.open(partition.path, "rb")
        place = 0
        with opened as stream:
            try:
                for headers, body, error in records(stream):
                    if error and self.mode == "FAILFAST":
                        raise BadInput(f"{partition.path}, record {place}: {error}")
                    if not (error and self.mode == "DROPMALFORMED"):
                        yield partition.shard_id, place, headers.get("warc-record-id"), headers, body.decode("utf-8", "replace"), error
                    place += 1
            except (OSError, EOFError) as e:  # a broken archive: what came before it counts
                if self.mode == "FAILFAST":
                    raise
                if self.mode == "PERMISSIVE":
                    yield partition.shard_id, place, None, {}, "", f"unreadable: {e}"


class WetSource(DataSource):
    """Options: path (a folder, file or pattern that every executor can read), mode (PERMISSIVE keeps bad records with ``error``, DROPMALFORMED, FAILFAST), compression (gzip or none)."""

    @classmethod
    def name(cls) -> str:
        return "wet"

    def schema(self) -> StructType:
        return RECORD

    def reader(self, schema: StructType) -> DataSourceReader:
        return WetReader(self.options)


def read_wet(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(WetSource)
    return spark.read.format("wet").options(**options).load(path)
