"""Token-ID output: binary shards of one id array with Elias-Fano document boundaries.

A shard file holds the ids of its documents one after another (16 bits an id when the
vocabulary allows it, else 32), then the Elias-Fano coded boundaries (n + 1 values) and
the Elias-Fano coded document ids, then a JSON footer. Shards hold ascending ranges of
doc_id; ``_manifest.json`` lists the shards that a job committed, so files of failed or
repeated tasks are never read.

Defined cases: a null or empty text is one end id; rows of one doc_id keep the order of
their texts; rows with a null doc_id come first and are read back with a null doc_id; a very
long text is encoded whole and read back as a block of its own; an empty table gives a manifest
without shards; columns other than the two named are ignored.

The reader finds where its blocks of documents end by select on the boundaries, and unpacks
those of one block at a time; ``ShardFile.document`` reads one document by two selects.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from txrisk.llm.bpe import default_tokenizer, encoder
from txrisk.llm.elias_fano import EliasFano
from txrisk.llm.shared import ship, table, workspace
from txrisk.llm.textvec import slices

FORMAT = "efids"
MAGIC = b"EFIDS001"
READ_BYTES = 4 << 20


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Shard(WriterCommitMessage):
    part: int
    name: str
    docs: int
    tokens: int


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, tokenizer: str, end_id: int):
        self.path, self.tokenizer, self.end_id = path, tokenizer, end_id

    def write(self, batches: Iterator[pa.RecordBatch]) -> Shard:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(self.tokenizer)
        store, root = open_path(self.path)
        name = f"part-{part:05d}-{uuid.uuid4().hex}.{FORMAT}"
        counts, ids_of, nulls, tokens = [], [], 0, 0
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{name}") as out:
            out.write(MAGIC)
            for b in batches:
                doc_id = b.column(0)
                nulls += doc_id.null_count
                ids_of.append(doc_id.drop_null().to_numpy(zero_copy_only=False))
                for s in slices(b.column(1)):
                    ids, first = enc.encode(s)
                    out.write(np.insert(ids, first[1:], self.end_id).astype(enc.dtype).tobytes())
                    counts.append(np.diff(first) + 1)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            docs = np.concatenate(ids_of) if ids_of else np.zeros(0, np.int64)
            base = int(docs[0]) if docs.size else 0
            tokens = int(n.sum())
            bounds = EliasFano.build(np.concatenate([[0], np.cumsum(n)])).to_bytes()
            names = EliasFano.build(docs - base).to_bytes()
            foot = json.dumps({"docs": int(n.size), "tokens": tokens, "id_bytes": enc.dtype.itemsize, "nulls": nulls, "base": base, "bounds": len(bounds), "doc_ids": len(names)}).encode()
            out.write(bounds + names + foot + len(foot).to_bytes(4, "little"))
        return Shard(part, name, int(n.size), tokens)

    def commit(self, messages: list[Shard | None]) -> None:
        done = sorted((m for m in messages if m and m.docs), key=lambda m: m.part)
        store, root = open_path(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_manifest.json") as out:
            out.write(json.dumps([{"name": m.name, "docs": m.docs, "tokens": m.tokens} for m in done]).encode())

    def abort(self, messages: list[Shard | None]) -> None:
        """Uncommitted files are not in the manifest."""


class ShardFile:
    """Random access to one shard."""

    def __init__(self, path: str):
        store, name = open_path(path)
        self.file = store.open_input_file(name)
        size = self.file.size()
        self.file.seek(size - 4)
        n = int.from_bytes(self.file.read(4), "little")
        self.file.seek(size - 4 - n)
        self.info = json.loads(self.file.read(n))
        at = size - 4 - n - self.info["doc_ids"]
        self.file.seek(at)
        self.names = EliasFano.from_bytes(self.file.read(self.info["doc_ids"]))
        self.file.seek(at - self.info["bounds"])
        self.bounds = EliasFano.from_bytes(self.file.read(self.info["bounds"]))
        self.dtype = np.dtype(f"<u{self.info['id_bytes']}")

    def __len__(self) -> int:
        return self.info["docs"]

    def span(self, a: int, b: int) -> np.ndarray:
        """Ids a to b of the shard's array."""
        self.file.seek(len(MAGIC) + a * self.dtype.itemsize)
        return np.frombuffer(self.file.read((b - a) * self.dtype.itemsize), self.dtype)

    def document(self, i: int) -> np.ndarray:
        return self.span(self.bounds[i], self.bounds[i + 1])

    def block_end(self, i: int, size: int) -> int:
        """Where a block of whole documents from i on ends, of about ``size`` ids (one longer
        document is a block)."""
        return max(self.bounds.last_at_most(self.bounds[i] + size, i), i + 1)

    def doc_ids(self, a: int, b: int) -> pa.Array:
        """The ids of documents a to b; those without one come first."""
        nulls = self.info["nulls"]
        known = self.names.values(max(a - nulls, 0), max(b - nulls, 0)) + self.info["base"]
        return pa.concat_arrays([pa.nulls(max(0, min(b, nulls) - a), pa.int64()), pa.array(known, pa.int64())])


class ShardPart(InputPartition):
    def __init__(self, name: str, start: int):
        super().__init__(name)
        self.start = start


class ShardReader(DataSourceReader):
    def __init__(self, path: str, digest: bool):
        self.path, self.digest = path, digest

    def partitions(self) -> list[InputPartition]:
        store, root = open_path(self.path)
        with store.open_input_stream(f"{root}/_manifest.json") as f:
            shards = json.loads(f.read())
        start, parts = 0, []
        for m in shards:
            parts.append(ShardPart(m["name"], start))
            start += m["tokens"]
        return parts or [ShardPart("", 0)]

    def read(self, partition: ShardPart) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        f = ShardFile(f"{self.path}/{partition.value}")
        at = 0
        while at < len(f):
            to = f.block_end(at, READ_BYTES // f.dtype.itemsize)
            b = f.bounds.values(at, to + 1)
            ids = f.span(int(b[0]), int(b[-1])).astype("<u4")
            cols = [f.doc_ids(at, to), pa.array(b[:-1] + partition.start), pa.array(np.diff(b))]
            if self.digest:
                view, rel = memoryview(ids).cast("B"), ((b - b[0]) * 4).tolist()
                crc = [zlib.crc32(view[x:y]) for x, y in zip(rel[:-1], rel[1:], strict=True)]
                last = pa.array(crc, pa.int64())
            else:
                last = pa.ListArray.from_arrays(pa.array(b - b[0], pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.record_batch([*cols, last], names=["doc_id", "start", "n_tokens", "ids_crc32" if self.digest else "ids"])
            at = to


class TokenFiles(DataSource):
    """``format("efids")``: write (doc_id, text); read (doc_id, start, n_tokens, ids) or,
    with ``digest=true``, the crc32 of each document's ids instead of the ids."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        last = "ids_crc32 long" if self._digest() else "ids array<int>"
        return f"doc_id long, start long, n_tokens long, {last}"

    def _digest(self) -> bool:
        return self.options.get("digest", "false").lower() == "true"

    def reader(self, schema) -> ShardReader:
        return ShardReader(self.options["path"], self._digest())

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], self.options["tokenizer"], int(self.options.get("end_id", "0")))


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the shards in ascending id order.

    One shuffle by range of the id (its texts, compressed); a shard is encoded and written
    as its rows arrive, so a task holds one batch of texts and its shard's boundaries."""
    spark = docs.sparkSession
    ship(spark)
    spark.dataSource.register(TokenFiles)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = shards or max(1, rows.rdd.getNumPartitions())
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.write.format(FORMAT).mode("append").option("path", path).option("tokenizer", tokenizer or default_tokenizer()).option("end_id", end_id).save()


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    ship(spark)
    spark.dataSource.register(TokenFiles)
    return spark.read.format(FORMAT).option("path", path).option("digest", str(digest).lower()).load()


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, digest=True)
