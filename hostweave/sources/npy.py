"""Matrices in ``.npy`` files as a Spark data source, read in ranges of rows from any store that Arrow opens."""

from __future__ import annotations

import ast
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Header:
    kind: str
    shape: tuple[int, ...]
    by_column: bool
    start: int


def header(path: str) -> Header:
    """Type, shape and order of the matrix, and where its data begins."""
    store, place = pafs.FileSystem.from_uri(path)
    with store.open_input_file(place) as f:
        if f.read(6) != b"\x93NUMPY":
            raise ValueError(f"{path} is no .npy file")
        major = f.read(2)[0]
        size = struct.unpack("<H" if major == 1 else "<I", f.read(2 if major == 1 else 4))[0]
        found = ast.literal_eval(f.read(size).decode("latin1"))
        return Header(found["descr"], tuple(found["shape"]), found["fortran_order"], f.tell())


class NpySource(DataSource):
    """``format("npy")``: ``(id, embedding)`` of a two-dimensional matrix, stored by row or by column.

    Options: ``path`` (in a store that all executors reach), ``rows`` a partition.
    """

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return "id long, embedding array<float>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return NpyReader(self.options["path"], int(self.options.get("rows", 1 << 18)))


class Rows(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        self.start, self.end = start, end


class NpyReader(DataSourceReader):
    def __init__(self, path: str, rows: int) -> None:
        self.path, self.rows = path, rows
        shape = header(path).shape
        if len(shape) != 2:
            raise ValueError(f"a two-dimensional matrix is needed, not {len(shape)} dimensions")
        self.n = shape[0]

    def partitions(self) -> list[Rows]:
        return [Rows(a, min(self.n, a + self.rows)) for a in range(0, self.n, self.rows)]

    def read(self, partition: Rows) -> Iterator:
        import numpy as np
        import pyarrow as pa

        told = header(self.path)
        (n, dim), kind = told.shape, np.dtype(told.kind)
        store, place = pafs.FileSystem.from_uri(self.path)
        with store.open_input_file(place) as f:

            def values(first: int, count: int) -> np.ndarray:
                f.seek(told.start + first * kind.itemsize)
                return np.frombuffer(f.read(count * kind.itemsize), dtype=kind)

            for a in range(partition.start, partition.end, 8192):
                b = min(partition.end, a + 8192)
                rows = np.stack([values(j * n + a, b - a) for j in range(dim)], axis=1) if told.by_column else values(a * dim, (b - a) * dim)
                flat = pa.array(np.ascontiguousarray(rows, dtype=np.float32).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a) * dim + 1, dim, dtype=np.int32)), flat)
                yield pa.record_batch([pa.array(np.arange(a, b)), lists], ["id", "embedding"])
