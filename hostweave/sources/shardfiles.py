"""A Spark sink for checksummed Parquet shards: tasks stage files, the commit publishes them.

Each task attempt writes files of its own under ``_staging/<job>``, in any store that
Arrow opens, and returns what it wrote as its commit message. The commit moves the files
of the attempts that count to their names, writes ``manifest.json`` and removes the staging
folder; a failed job's files go with that folder. So neither a failed nor a repeated nor a
speculative attempt leaves a file that the manifest doesn't name.

This module imports nothing of the package, so that it can be sent to workers by value.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT_NAME = "hostweave_shards"


@dataclass
class Staged(WriterCommitMessage):
    """The files of one task attempt: where each is, and its entry for the manifest."""

    files: list[tuple[str, dict[str, Any]]]


class Hashed:
    """A stream that counts and digests what is written to it."""

    def __init__(self, stream: Any) -> None:
        self.stream, self.digest, self.size, self.closed = stream, hashlib.sha256(), 0, False

    def write(self, data: bytes) -> int:
        self.digest.update(data)
        self.size += len(data)
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()

    def tell(self) -> int:
        return self.size

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            self.stream.close()


def shard_table(rows: pa.Table, kind: str) -> pa.Table:
    """The shard's columns, vectors as fixed-size lists of the tier's type."""
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("embedding").chunks])
    dim = len(flat) // rows.num_rows
    lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.astype(kind)), dim)
    return pa.table({**{n: rows.column(n) for n in ("row_id", "host_key", "domain_key")}, "embedding": lists})


class ShardFile:
    """One shard's staged file of one tier, written row group by row group."""

    def __init__(self, store: pafs.FileSystem, path: str, dtype: str) -> None:
        self.path, self.dtype, self.writer = path, dtype, None
        self.out = Hashed(store.open_output_stream(path))

    def add(self, rows: pa.Table) -> None:
        table = shard_table(rows, self.dtype)
        self.writer = self.writer or pq.ParquetWriter(self.out, table.schema, compression="zstd")
        self.writer.write_table(table, row_group_size=len(table))

    def done(self) -> tuple[int, str]:
        self.writer.close()
        self.out.close()
        return self.out.size, self.out.digest.hexdigest()


class ShardSink(DataSource):
    """``format("hostweave_shards")``: rows ``(shard, row_id, host_key, domain_key, embedding)``, sorted by the first two in each partition.

    Options: ``path``; ``tiers``, a JSON object of folder names and value types; ``shards``
    and ``rows``, their numbers; ``manifest``, a JSON object that gets the key ``shards``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ShardWriter(dict(self.options))


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.uri, self.tiers = options["path"].rstrip("/"), json.loads(options["tiers"])
        self.shards, self.rows, self.manifest = int(options["shards"]), int(options["rows"]), json.loads(options["manifest"])
        self.job = uuid.uuid4().hex

    def place(self) -> tuple[pafs.FileSystem, str, str]:
        """The store, the target folder in it, and this job's staging folder."""
        store, root = pafs.FileSystem.from_uri(self.uri)
        return store, root, f"{root}/_staging/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, _, staging = self.place()
        store.create_dir(staging, recursive=True)
        files: list[tuple[str, dict[str, Any]]] = []
        open_files: dict[str, ShardFile] = {}
        now = first = count = None

        def end() -> None:
            for kind, f in open_files.items():
                size, digest = f.done()
                name = f"{kind}/emb-{now:05d}-of-{self.shards:05d}.parquet"
                files.append((f.path, {"kind": kind, "shard": now, "filename": name, "row_start": first, "row_end": first + count, "n_rows": count, "bytes": size, "sha256": digest}))

        for batch in iterator:
            shard = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if i == j:
                    continue
                if now != int(shard[i]):
                    end()
                    now, first, count = int(shard[i]), batch.column("row_id")[i].as_py(), 0
                    open_files = {kind: ShardFile(store, f"{staging}/{uuid.uuid4().hex}.parquet", dtype) for kind, dtype in self.tiers.items()}
                rows = pa.Table.from_batches([batch.slice(i, j - i)])
                count += j - i
                for f in open_files.values():
                    f.add(rows)
        end()
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root, staging = self.place()
        staged = sorted((f for m in messages if m for f in m.files), key=lambda f: (f[1]["kind"], f[1]["shard"]))
        for kind in self.tiers:
            if (n := sum(e["n_rows"] for _, e in staged if e["kind"] == kind)) != self.rows:
                raise ValueError(f"{kind} holds {n} rows, not {self.rows}")
            store.create_dir(f"{root}/{kind}", recursive=True)
        for path, entry in staged:
            store.move(path, f"{root}/{entry['filename']}")
        with store.open_output_stream(f"{root}/manifest.json") as out:
            out.write((json.dumps(self.manifest | {"shards": [e for _, e in staged]}, indent=2) + "\n").encode())
        self._clear(store, root, staging)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*self.place())

    @staticmethod
    def _clear(store: pafs.FileSystem, root: str, staging: str) -> None:
        """This job's staging folder goes, and what holds it once no other job stages there."""
        if store.get_file_info(staging).type != pafs.FileType.NotFound:
            store.delete_dir(staging)
        above = f"{root}/_staging"
        if store.get_file_info(above).type == pafs.FileType.Directory and not store.get_file_info(pafs.FileSelector(above)):
            store.delete_dir(above)
