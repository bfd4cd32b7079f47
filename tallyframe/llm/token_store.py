"""Token ids in files: fixed-size blocks, stored as compressed planes, with an index.

Documents are range-partitioned by id and each task writes one shard in ascending id order. A
row of the table ``segments`` holds some whole documents, about ``SEGMENT_IDS`` ids. Its ids are
cut into blocks of ``BLOCK_IDS``; a block of unsigned 32-bit little-endian ids is transposed,
so that all first bytes (or all lowest bits) stand together, then all second ones, and every
such plane is compressed by itself with zstandard. The table ``index`` tells for each segment
where its ids start in the whole sequence. Both are Parquet tables, so writes are atomic and any
store Spark knows will do.

Nulls and empty texts hold the end id alone. Null ids come first, rows with equal ids are ordered
by text, repeated rows are stored one by one, an empty table makes empty files; other
columns are not read. A very long text makes a longer segment, never a cut one.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BLOCK_IDS = 65_536
SEGMENT_IDS = 1_000_000
#: Words a Python worker remembers, some 250 MB.
KNOWN_WORDS = 1_200_000
SEGMENTS = ("shard int, segment int, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
            "blocks array<struct<n_ids: int, planes: array<binary>>>")


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The planes of one block, each compressed; byte planes, or bit planes if ``bits``."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        flags = np.unpackbits(rows, axis=1, bitorder="little").T
        planes = [np.packbits(p, bitorder="little") for p in flags]
    else:
        planes = list(np.ascontiguousarray(rows.T))
    return [zstandard.compress(p.tobytes(), 3) for p in planes]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    plain = [np.frombuffer(zstandard.decompress(p), np.uint8) for p in planes]
    if len(plain) == 32:
        flags = np.stack([np.unpackbits(p, count=n_ids, bitorder="little") for p in plain], axis=1)
        rows = np.packbits(flags, axis=1, bitorder="little")
    else:
        rows = np.stack(plain, axis=1)
    return np.ascontiguousarray(rows).view("<u4").ravel()


class WordEncoder(dict):
    """Ids of texts whose tokenizer drops white space, so that words are encoded alone.

    Texts are split at blanks and line ends only; whatever else the tokenizer sees as space it
    meets inside a word. As a dictionary it knows the words it has met, as the bytes of their
    little-endian 32-bit ids; beyond a number of them it forgets them all at once.
    """

    def __init__(self, tokenizer_file: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        if len(self) > KNOWN_WORDS:
            self.clear()
        for text in texts:
            words = text.replace("\n", " ").split(" ") if text else ()
            yield b"".join(map(self.__getitem__, words))

    def __missing__(self, word: str) -> bytes:
        """Plain English words, with or without marks behind them, are one or two pre-tokens
        that no normalizer step changes but lower-casing; the model alone encodes them faster."""
        lower = word.lower()
        letters = lower.rstrip(".,")
        if letters.isascii() and letters.isalpha():
            found = self.model.tokenize(letters)
            if len(letters) < len(lower):
                found += self.model.tokenize(lower[len(letters):])
            ids = [t.id for t in found]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        self[word] = known = struct.pack(f"<{len(ids)}I", *ids)
        return known


_encoders: dict[str, WordEncoder] = {}


def _write(batches: Iterator[pa.RecordBatch], tokenizer_file: str, end_id: int, bits: bool
           ) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encode = _encoders.setdefault(tokenizer_file, WordEncoder(tokenizer_file))
    shard, segment = TaskContext.get().partitionId(), 0
    end = np.array([end_id], "<u4").tobytes()
    ids, lengths, parts, size = [], [], [], 0

    def row():
        every = np.frombuffer(b"".join(parts), "<u4")
        blocks = [{"n_ids": len(b), "planes": to_planes(b, bits)}
                  for b in (every[i:i + BLOCK_IDS] for i in range(0, len(every), BLOCK_IDS))]
        kind = pa.list_(pa.struct([("n_ids", pa.int32()), ("planes", pa.list_(pa.binary()))]))
        return pa.record_batch([
            pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), [len(every)],
            pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
            pa.array([blocks], kind)],
            ["shard", "segment", "n_ids", "doc_ids", "doc_lengths", "blocks"])

    for batch in batches:
        for id_, found in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
            ids.append(id_)
            parts += [found, end]
            lengths.append(len(found) // 4 + 1)
            size += lengths[-1]
            if size >= SEGMENT_IDS:
                yield row()
                segment += 1
                ids, lengths, parts, size = [], [], [], 0
    if ids:
        yield row()


def write_tokens(df: DataFrame, path: str, tokenizer_file: str, end_id: int,
                 id_column: str = "doc_id", text_column: str = "text", bits: bool = False) -> None:
    """Encode every text, append ``end_id`` and write ``path/segments`` and ``path/index``."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"),
                     F.crc32(text_column).alias("tie"))
    (rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")
     .select("id", "text")
     .mapInArrow(lambda b: _write(b, tokenizer_file, end_id, bits), SEGMENTS)
     .write.option("compression", "uncompressed").parquet(f"{path}/segments"))
    # One row per segment, then one per shard: the last sum runs over as many rows as tasks.
    sizes = df.sparkSession.read.schema(SEGMENTS).parquet(f"{path}/segments").select(
        "shard", "segment", "n_ids", F.size("doc_ids").alias("n_docs"))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("of_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("of_shard").over(before), F.lit(0)).alias("base"))
    (sizes.join(shards, "shard")
     .select("shard", "segment", (F.col("base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
             .alias("start"), "n_ids", "n_docs")
     .write.parquet(f"{path}/index"))


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard, segment, _, ids, lengths, blocks = (c[row].as_py() for c in batch.columns)
            every = np.concatenate([from_planes(b["planes"], b["n_ids"]) for b in blocks])
            starts = np.r_[0, np.cumsum(lengths)]
            parts = [every[a:b] for a, b in zip(starts, starts[1:])]
            out = {"shard": pa.array([shard] * len(ids), pa.int32()),
                   "segment": pa.array([segment] * len(ids), pa.int32()),
                   "id": pa.array(ids, pa.int64()), "at": starts[:-1],
                   "n_tokens": pa.array(lengths, pa.int64()),
                   "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64())}
            if with_ids:
                out["ids"] = pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(out)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` and, unless left out, ``ids`` of each document."""
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    kind = "shard int, segment int, id long, at long, n_tokens long, ids_crc32 long"
    docs = segments.mapInArrow(lambda b: _read(b, with_ids), kind + ", ids array<long>" * with_ids)
    index = spark.read.parquet(f"{path}/index").select("shard", "segment", F.col("start").alias("base"))
    return docs.join(index, ["shard", "segment"]).select(
        "id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)
