"""Token-id files: length-delimited binary records with masked checksums, and an offset index beside them.

A record is, little-endian: payload length (8 bytes), masked CRC-32 of these 8 bytes (4), payload, masked
CRC-32 of the payload (4), and a line feed. A payload is: bytes per id (1), whether the row has an id (1),
the row's id (8), then the token ids. A checksum is masked by a rotation and an addition, so that checksums
of data that hold checksums stay apart. Records stand in ascending order of the row's id, rows without one first,
within a file and over the files in the order of their names. ``records`` holds the files, ``index`` one
row per record with its file, offset and length, for reads in any order.

Files are written by Spark's own text writer with the records as raw lines, so its commit protocol keeps
retried and speculative tasks from leaving half or double files, on any store that Spark can write.
"""

from __future__ import annotations

import itertools
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cantogram.llm.bpe import Chunks, pieces, vocabulary
from cantogram.llm.workers import kept_with

Batches = Iterator[pa.RecordBatch]
INDEX = "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join([size, struct.pack("<I", masked(zlib.crc32(size))), payload, struct.pack("<I", masked(zlib.crc32(payload)))])


class LibraryEncoder:
    """The tokenizers library behind a memo: it encodes each distinct chunk of text once per worker."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.spaced = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(self.size)])
        self.chunks = Chunks(self._strings, added)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _strings(self, strings: list[str]) -> list[bytes]:
        """A space and letters begin with the one token that has a space, so many of them are encoded as one text."""
        words = [s[:1] == " " and s[1:].isalpha() for s in strings]
        joined = self._ids(["".join([s for s, w in zip(strings, words, strict=True) if w])])[0]
        starts = np.flatnonzero(self.spaced[joined]) * 4
        flat, ends = joined.tobytes(), [*starts[1:].tolist(), 4 * len(joined)]
        found = iter([flat[a:b] for a, b in zip(starts.tolist(), ends, strict=False)])
        rest = iter(self._ids([s for s, w in zip(strings, words, strict=True) if not w]))
        return [next(found) if w else next(rest).tobytes() for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.chunks.ids(texts)


def _records(held: Broadcast, end_id: int | None) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encoder = kept_with(held, LibraryEncoder)
        width = "<u2" if max(encoder.size - 1, end_id or 0) < 1 << 16 else "<u4"
        tail = b"" if end_id is None else np.array([end_id], dtype=width).tobytes()
        for batch in batches:
            for part in pieces(batch):
                flat, at = encoder.chunks.flat(part.column("text").fill_null(""))
                ids = np.frombuffer(flat, dtype="<u4").astype(width)
                heads = [struct.pack("<BBq", int(width[-1]), key is not None, key or 0) for key in part.column("doc_id").to_pylist()]
                frames = [framed(h + ids[a // 4 : b // 4].tobytes() + tail) for h, (a, b) in zip(heads, itertools.pairwise(at), strict=True)]
                yield pa.record_batch([pa.array(frames, pa.binary())], names=["record"])

    return run


def write_records(docs: DataFrame, path: str, vocabulary_path: str, end_id: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode each row of ``docs``, append ``end_id``, write ``path``/records and ``path``/index; gives the index.

    A null text is empty. Rows that repeat an id stand side by side, ordered by text; each is a record. Other
    columns are ignored. An empty table gives an index without rows.
    """
    spark = docs.sparkSession
    held = vocabulary(spark, vocabulary_path)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_records(held, end_id), "record binary").select(F.col("record").cast("string")).write.option("lineSep", "\n").text(f"{path}/records")
    scan_records(spark, path).write.parquet(f"{path}/index")
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _scanned(batches: Batches) -> Batches:
    for batch in batches:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            data, at, rows = memoryview(content.as_buffer()), 0, []
            file = name.rsplit("/", 1)[-1]
            while at < len(data):
                size = struct.unpack_from("<Q", data, at)[0]
                payload = data[at + 12 : at + 12 + size]
                crcs = struct.unpack_from("<I", data, at + 8)[0], struct.unpack_from("<I", data, at + 12 + size)[0]
                if crcs != (masked(zlib.crc32(data[at : at + 8])), masked(zlib.crc32(payload))):
                    raise ValueError(f"{name}: damaged record at {at}")
                width, has_id, key = struct.unpack_from("<BBq", payload)
                ids = np.frombuffer(payload[10:], dtype=f"<u{width}")
                rows.append((file, at, size + 16, key if has_id else None, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                at += size + 17
            types = [pa.string(), *[pa.int64()] * 5]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[c.split(" ")[0] for c in INDEX.split(", ")])


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Read the record files back, check every checksum, and give one index row per record. A file is one task's output."""
    files = spark.read.format("binaryFile").load(f"{path}/records").filter("length > 0").select("path", "content")
    return files.mapInArrow(_scanned, INDEX)


def with_starts(index: DataFrame) -> DataFrame:
    """Index rows with ``start``: the ids of all records before. Sums run within files; only one row per file is ordered in one task."""
    inside = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return own.join(before, "file").withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")


def token_digest(docs: DataFrame, path: str, vocabulary_path: str, end_id: int) -> DataFrame:
    index = write_records(docs, path, vocabulary_path, end_id)
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
