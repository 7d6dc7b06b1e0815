"""Token ids in Arrow stream files of fixed-size-list batches.

Documents are range-partitioned and sorted by doc_id; each partition becomes one shard: a stream
file whose rows are equal-length sequences (``input_ids``: fixed-size list of the narrowest unsigned
type that holds the vocabulary; ``mask``: fixed-size list of booleans, false where the last sequence
is padded), and an index file (doc_id, start, n_tokens; start counts from the shard's first token).
All batches but the last have the same number of sequences, so sequence i is found by division and
read from a memory map without a copy. A file is written under a name of its own and renamed when
complete, so a lost or doubled attempt leaves no part of a file behind.

Defined cases: null and empty texts are one end id; null doc_ids come first; rows with the same
doc_id are ordered by a hash of their text; long texts span sequences and batches; an empty table
gives no documents. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Encoder, Vocabulary, read_text
from .common import ready, shared_folder
from .textarrays import chunks

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 64
#: Bytes of text encoded at once, pieces a worker keeps.
CHUNK, KEPT_PIECES = 1 << 22, 1 << 20


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def sequence_schema(width: int, vocabulary: int) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("input_ids", pa.list_(kind, width)), ("mask", pa.list_(pa.bool_(), width))])


class ShardWriter:
    """Packs a stream of ids into equal-length sequences, one Arrow stream file."""

    def __init__(self, sink, schema: pa.Schema, per_batch: int) -> None:
        self.width, self.kind = schema.field(0).type.list_size, schema.field(0).type.value_type
        self.schema, self.block = schema, per_batch * schema.field(0).type.list_size
        self.stream = pa.ipc.new_stream(sink, schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        if self.n_held >= self.block:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.block * self.block
            for at in range(0, whole, self.block):
                self.write(flat[at : at + self.block], self.block)
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def write(self, ids: np.ndarray, used: int) -> None:
        values = pa.array(ids.astype(self.kind.to_pandas_dtype()), self.kind)
        mask = pa.array(np.arange(len(ids)) < used)
        rows = [pa.FixedSizeListArray.from_arrays(v, self.width) for v in (values, mask)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(rows, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.width) * self.width, flat.dtype)
            padded[: len(flat)] = flat
            self.write(padded, len(flat))
        self.stream.close()


class Sequences:
    """A shard's sequences, read in place."""

    def __init__(self, fs: pafs.FileSystem, path: str) -> None:
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else pa.BufferReader(fs.open_input_file(path).read_buffer())
        self.batches = pa.ipc.open_stream(source).read_all().to_batches()
        self.per_batch = self.batches[0].num_rows if self.batches else 1
        self.width = self.batches[0].schema.field(0).type.list_size if self.batches else 1

    def _place(self, i: int) -> tuple[pa.RecordBatch, int]:
        return self.batches[i // self.per_batch], i % self.per_batch

    def sequence(self, i: int) -> np.ndarray:
        batch, row = self._place(i)
        return batch.column(0).values.to_numpy()[row * self.width : (row + 1) * self.width]

    def mask(self, i: int) -> np.ndarray:
        batch, row = self._place(i)
        return batch.column(1).values.slice(row * self.width, self.width).to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """n ids from a place on: a view within one batch, else joined views."""
        block, parts = self.per_batch * self.width, []
        while n > 0:
            values = self.batches[start // block].column(0).values.to_numpy()
            part = values[start % block : start % block + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def library_pieces(spec: str):
    """Encodes pieces with the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)
    library.no_truncation()
    library.no_padding()

    def encode_new(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[s:e].tobytes().decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64)

    return encode_new


class KeptEncoder(Encoder):
    """An encoder that serves many tasks and so keeps more pieces (about 40 MB) before it starts anew."""

    def clear(self) -> None:
        if not hasattr(self, "known") or len(self.known) > KEPT_PIECES:
            super().clear()


_ENCODERS: dict[str, tuple[Vocabulary, Encoder]] = {}


def kept_encoder(spec: str) -> tuple[Vocabulary, Encoder]:
    """The vocabulary and encoder of a tokenizer; a worker keeps them, with the pieces met so far, for its next tasks."""
    if spec not in _ENCODERS:
        vocabulary = Vocabulary(spec)
        _ENCODERS.clear()
        _ENCODERS[spec] = vocabulary, KeptEncoder(vocabulary, library_pieces(spec))
    return _ENCODERS[spec]


def _publish(fs: pafs.FileSystem, part: str, final: str) -> None:
    if not isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(final).type != pafs.FileType.NotFound:
        fs.delete_file(final)  # an earlier attempt's file, with the same content
    fs.move(part, final)


def write(docs: DataFrame, tokenizer: str, root: str, end_id: int = 0, sequence: int = SEQUENCE, per_batch: int = SEQUENCES_PER_BATCH) -> DataFrame:
    """Writes the shards below ``root``; returns shard, path, index, docs, tokens, start: one row per shard."""
    spark = ready(docs.sparkSession)
    spec = spark.sparkContext.broadcast(read_text(tokenizer))
    fs, place = open_store(root)
    fs.create_dir(place, recursive=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        shard, mine = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, place = open_store(root)
        names = [f"{place}/{kind}-{shard:06d}.arrow" for kind in ("tokens", "index")]
        vocabulary, encoder = kept_encoder(spec.value)
        index_schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("start", pa.int64()), ("n_tokens", pa.int64())])
        n_docs, writer = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                sinks = [fs.open_output_stream(f"{n}.{mine}") for n in names]
                writer = ShardWriter(sinks[0], sequence_schema(sequence, vocabulary.size), per_batch)
                index = pa.ipc.new_stream(sinks[1], index_schema)
            for lo, hi, data, offsets in chunks(batch.column(1), CHUNK):
                ids, places = encoder(data, offsets)
                counts = np.diff(places) + 1
                starts = writer.total + np.r_[0, np.cumsum(counts)[:-1]]
                writer.add(np.insert(ids, places[1:], end_id))
                index.write_batch(pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(starts), pa.array(counts)], schema=index_schema))
                n_docs += hi - lo
        if writer is not None:
            writer.close()
            index.close()
            for sink, name in zip(sinks, names, strict=True):
                sink.close()
                _publish(fs, f"{name}.{mine}", name)
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": names[:1], "index": names[1:], "docs": [n_docs], "tokens": [writer.total]})

    shape = "shard long, path string, index string, docs long, tokens long"
    written = sorted(ordered.mapInArrow(run, shape).collect(), key=lambda r: r["shard"])  # one row per shard
    rows, start = [], 0
    for r in written:
        rows.append((*r, start))
        start += r["tokens"]
    return spark.createDataFrame(rows, f"{shape}, start long")


def read(shards: DataFrame, root: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the files below ``root``."""
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(root)
        for batch in batches:
            for r in batch.to_pylist():
                sequences = Sequences(fs, r["path"])
                for index in pa.ipc.open_stream(fs.open_input_stream(r["index"])):
                    starts, counts = (index.column(c).to_numpy() for c in (1, 2))
                    sums = [zlib.crc32(sequences.tokens(s, n).astype("<u4").tobytes()) for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [index.column(0), pa.array(starts + r["start"]), index.column(2), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    return shards.repartition(parts, "shard").mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def new_root(spark: SparkSession) -> str:
    """A new folder for token files in the shared checkpoint folder."""
    ready(spark)
    return shared_folder(spark, "tokens")
