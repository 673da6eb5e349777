"""Files in the shared folder that tasks write and read without Spark's own formats.

A task writes each file under a name of its own attempt and hands the name on in its rows; only
names that reached the manifest are read again, so files of lost or repeated attempts do no
harm. The folder may be on any store that pyarrow reaches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession

from wearline.session import scratch


def folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a URI."""
    path = scratch(spark, label)
    return path if "://" in path else "file://" + path.removeprefix("file:")


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write(uri: str, data: bytes | bytearray, suffix: str) -> str:
    """Write a new file below the folder ``uri``; returns its URI."""
    store, path = _at(uri)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(data)
    return f"{uri}/{name}"


def write_parts(uri: str, parts: Iterable[bytes], suffix: str) -> str:
    """As ``write``, of parts that are made while it writes."""
    store, path = _at(uri)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with store.open_output_stream(f"{path}/{name}") as out:
        for part in parts:
            out.write(part)
    return f"{uri}/{name}"


def mapped(uri: str) -> pa.Buffer:
    """The file's bytes: mapped into memory where the store is a mounted one, else read."""
    store, path = _at(uri)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with store.open_input_file(path) as source:
        return source.read_buffer()


def open_at(uri: str):
    """The file for reading at any place."""
    store, path = _at(uri)
    return store.open_input_file(path)


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays one after the other, each from a multiple of eight bytes on, behind their list."""
    parts, listed, at = [], [], 0
    for name, a in arrays.items():
        listed.append([name, a.dtype.str, at, a.size])
        body = a.tobytes()
        body += bytes(-len(body) % 8)
        parts.append(body)
        at += len(body)
    head = json.dumps(listed).encode()
    head += b" " * (-len(head) % 8)
    return b"".join([len(head).to_bytes(8, "little"), head, *parts])


def unpack(body) -> dict[str, np.ndarray]:
    view = memoryview(body)
    size = int.from_bytes(view[:8], "little")
    listed = json.loads(bytes(view[8 : 8 + size]))
    return {n: np.frombuffer(view, np.dtype(t), count, 8 + size + at) for n, t, at, count in listed}


def listed(lines: DataFrame, uri: str) -> str:
    """A file below ``uri`` with the texts of a one-column frame, a line each; written by one task
    as it reads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (f"{line}\n".encode() for batch in batches for line in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_pydict({"uri": [write_parts(uri, parts, ".list")]})

    found = lines.repartition(1).mapInArrow(run, "uri string").first()
    return found[0] if found else ""


def lines(uri: str) -> list[str]:
    """What ``listed`` wrote."""
    return memoryview(mapped(uri)).tobytes().decode().splitlines() if uri else []
