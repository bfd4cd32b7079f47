"""Token counts of whole texts with a SentencePiece model.

A BPE piece of these models never contains a space mark after another character, so a text
falls into pre-tokens (a run of spaces and what follows up to the next space) whose pieces do
not depend on their neighbours. Documents are taken in blocks of bounded size. A block keeps one
vocabulary of its pre-tokens and, for each document, which of them it has and how often, as
packed numbers. The vocabularies are dealt by pre-token, so that each distinct pre-token of
the corpus is met in one place and its pieces are counted there once. The counts go back to
their block, are joined to the frequencies, and are added up per document. No token id of a
document is ever made, and what is shuffled is one entry for each pre-token and block, not
for each word.

Nulls and empty texts have 0 bytes and 0 tokens; a null id is kept as it is; repeated rows
are counted one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.storage import cut

#: A block ends when its vocabulary or its list of pairs has reached this size.
BLOCK_VOCABULARY, BLOCK_PAIRS = 500_000, 4_000_000
MARKED = re.compile("[ ▁]+[^ ▁]*")
PACKED = "block string, part int, payload binary"
DOCS_PART = 2**31 - 1


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens without their first space, which the model puts in front by itself."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " " or "▁" in text:
        return [t[1:] for t in MARKED.findall(" " + text)]
    return text.split(" ")


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed; see :func:`unpack`."""
    out = [np.array([len(a) for a in arrays], "<i8").tobytes()]
    planes = b"".join(np.ascontiguousarray(a.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()
                      for a in arrays)
    return out[0] + zstandard.compress(planes, 1)


def unpack(data: bytes, arrays: int) -> list[np.ndarray]:
    sizes = np.frombuffer(data[:8 * arrays], "<i8")
    planes = np.frombuffer(zstandard.decompress(data[8 * arrays:]), np.uint8)
    out, at = [], 0
    for n in sizes:
        part = planes[at:at + 4 * n].reshape(4, n)
        out.append(np.ascontiguousarray(part.T).view("<i4").ravel())
        at += 4 * n
    return out


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Packed vocabularies (by part) and packed documents of each block."""
    from pyspark import TaskContext

    task = TaskContext.get()
    name = f"{task.stageId()}-{task.partitionId()}"
    schema = pa.schema([("block", pa.string()), ("part", pa.int32()), ("payload", pa.binary())])
    number = count()

    def flush(vocabulary, ids, sizes, lengths, places, often):
        block = f"{name}-{next(number)}"
        words = np.array(list(vocabulary), object)
        part_of = np.fromiter((hash_of(w) % parts for w in words), np.int64, len(words))
        order = np.argsort(part_of, kind="stable")
        for part, chosen in zip(*_runs(part_of[order], order)):
            text = "\n".join(w.replace("\\", "\\\\").replace("\n", "\\n") if "\\" in w or "\n" in w
                             else w for w in words[chosen]).encode()
            head = pack(chosen)
            payload = len(head).to_bytes(8, "little") + head + zstandard.compress(text, 1)
            yield pa.record_batch([[block], [int(part)], [payload]], schema)
        nulls = np.array([i is None for i in ids], np.int64)
        known = np.array([0 if i is None else i for i in ids], np.int64)
        head = pack(nulls, known & 0xFFFFFFFF, known >> 32, np.array(sizes), np.array(lengths),
                    *_steps(np.array(lengths), np.concatenate(places), np.concatenate(often)))
        yield pa.record_batch([[block], [DOCS_PART], [head]], schema)

    def fresh():
        seen = count()
        return defaultdict(seen.__next__), [], [], [], [], []

    state, pairs = fresh(), 0
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        sizes = batch.column(2).to_pylist()
        for i, id_ in enumerate(ids):
            found = Counter(pre_tokens(texts[i].as_py()))
            vocabulary = state[0]
            state[1].append(id_)
            state[2].append(sizes[i])
            state[3].append(len(found))
            state[4].append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
            state[5].append(np.fromiter(found.values(), np.int32, len(found)))
            pairs += len(found)
            if len(vocabulary) >= BLOCK_VOCABULARY or pairs >= BLOCK_PAIRS:
                yield from flush(*state)
                state, pairs = fresh(), 0
    if state[1]:
        yield from flush(*state)


def _steps(lengths: np.ndarray, places: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ascending order within each document, as steps from one to the next."""
    doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    order = np.argsort((doc << 32) | places)
    steps = np.diff(places[order], prepend=0)
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[starts] = places[order][starts]
    return steps, often[order]


def _places(lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    upto = np.cumsum(steps, dtype=np.int64)
    before = np.r_[0, upto][np.cumsum(lengths) - lengths]
    return upto - np.repeat(before, lengths)


def hash_of(word: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(word.encode())


def _runs(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], int)
    return keys[starts], np.split(order, starts[1:])


def _words(payload: bytes) -> tuple[np.ndarray, list[str]]:
    size = int.from_bytes(payload[:8], "little")
    places = unpack(payload[8:8 + size], 1)[0]
    text = zstandard.decompress(payload[8 + size:]).decode()
    words = text.split("\n")
    if "\\" in text:
        words = [re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], w) for w in words]
    return places, words


def _piece_counts(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    """One part of all vocabularies: count each distinct pre-token once, answer each block."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    mark = 1 if library.piece_to_id("▁") != library.unk_id() else 3
    known: dict[str, int] = {"": mark}
    for batch in batches:
        for block, part, payload in zip(*(c.to_pylist() for c in batch.columns)):
            places, words = _words(payload)
            new = [w for w in words if w not in known]
            for i in range(0, len(new), 10_000):
                some = new[i:i + 10_000]
                known.update(zip(some, map(len, library.encode(some, num_threads=1))))
            counts = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
            yield pa.record_batch([[block], pa.array([part], pa.int32()), [pack(places, counts)]],
                                  ["block", "part", "payload"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block, the documents after the counts of all parts."""
    name, found = None, []
    for batch in batches:
        for block, part, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if block != name:
                name, found = block, []
            if part != DOCS_PART:
                found.append(unpack(payload, 2))
                continue
            nulls, low, high, sizes, lengths, steps, often = unpack(payload, 7)
            places = _places(lengths.astype(np.int64), steps)
            table = np.zeros(sum(len(p) for p, _ in found), np.int64)
            for at, n in found:
                table[at] = n
            found = []
            upto = np.r_[0, np.cumsum(table[places] * often)]
            ends = np.cumsum(lengths.astype(np.int64))
            ids = (high.astype(np.int64) << 32) | (low.astype(np.int64) & 0xFFFFFFFF)
            yield pa.record_batch([pa.array(ids, mask=nulls.astype(bool)), sizes.astype(np.int64),
                                   upto[ends] - upto[ends - lengths]],
                                  ["id", "n_bytes", "n_tokens"])


def token_counts(df: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text",
                 parts: int | None = None) -> DataFrame:
    """``id, n_bytes, n_tokens`` for each row; ``model`` is a path that every executor has.

    ``parts`` is the number of places distinct pre-tokens are dealt to, by default the number
    of shuffle partitions.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    narrow = df.select(F.col(id_column).cast("long").alias("id"), text.alias("text"),
                       F.octet_length(text).alias("n_bytes"))
    packed = cut(narrow.mapInArrow(lambda b: _blocks(b, parts), PACKED), "pre-tokens")
    words = packed.where(F.col("part") != DOCS_PART).repartition(parts, "part")
    counts = words.mapInArrow(lambda b: _piece_counts(b, model), PACKED)
    docs = packed.where(F.col("part") == DOCS_PART)
    return (docs.unionByName(counts).repartition("block").sortWithinPartitions("block", "part")
            .mapInArrow(_sums, "id long, n_bytes long, n_tokens long"))
