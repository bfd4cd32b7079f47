"""Documents drawn by how far they resemble a target corpus (importance resampling).

Texts become words (``A-Z`` lowered; runs of digits, ``a-z`` and anything beyond ASCII). A task
reads its texts in blocks of bounded size. The distinct words of a block, each between two
delimiters, make an Aho-Corasick automaton whose entries carry the word's CRC and length. A scan
emits the payloads of a text in order; payloads of neighbours are put together without their
bytes, since the CRC of a joined string follows from the CRCs and the length of its parts. So each
distinct word of a block is hashed once, and a run of words costs one table look-up per word more.

A feature is a run of one to ``most`` words, its bucket the CRC modulo ``buckets``. Bucket sequences
are written once per document. The documents (``s`` of ``S``) and the target (``t`` of ``T``) are
counted per bucket, in the tasks first; the gain of a bucket is their smoothed log ratio, a
document's weight the floored mean of its gains. What reaches the driver is one number per bucket,
and one per distinct score. A seeded Gumbel draw is added to the weight; among documents
with at least ``least_words`` words the highest scores are drawn, ties by smaller id. The
rank is a count of rows in range partitions before and inside the own one, so no task sorts all.

Null texts and texts without words have no features and weight 0. Equal ids share a draw; a null id
draws as the empty string and comes first among ties; repeated rows have ranks of their own. Empty tables
give an empty result, an empty target gives gains by the documents alone. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.storage import cut

#: Bytes of text that share a dictionary.
BLOCK_BYTES = 4_000_000
#: Lower-case letters stay, capitals are lowered, bytes beyond ASCII stay, all else delimits.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
POLYNOMIAL = 0xEDB88320
#: Repeated rows are numbered in steps of at most so many.
STEP = 10_000


def folded(text: str | None) -> bytes:
    return (text or "").encode().translate(FOLDED)


def dictionary(words: Iterable[bytes]) -> ahocorasick.Automaton:
    """An automaton of delimiter-bounded words with ``length << 32 | crc`` as payloads."""
    machine = ahocorasick.Automaton()
    for word in words:
        machine.add_word(f" {word.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
    if len(machine):
        machine.make_automaton()
    return machine


def payloads(machine: ahocorasick.Automaton, data: bytes) -> np.ndarray:
    """The payloads of all words of a folded text, in order."""
    if not len(machine):
        return np.zeros(0, np.int64)
    return np.fromiter((p for _, p in machine.iter(f" {data.decode('latin-1')} ")), np.int64)


@lru_cache(4096)
def _after(length: int) -> np.ndarray:
    """Four tables by byte: what a CRC becomes when ``length`` zero bytes follow."""
    bit = np.array([POLYNOMIAL, *(1 << k for k in range(31))], np.uint32)  # one zero bit

    def through(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros_like(values)
        for k in range(32):
            out ^= np.where(values >> np.uint32(k) & np.uint32(1), operator[k], np.uint32(0))
        return out

    power, rest = bit, 8 * length
    result = np.array([1 << k for k in range(32)], np.uint32)
    while rest:
        if rest & 1:
            result = through(power, result)
        power, rest = through(power, power), rest >> 1
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([through(result, byte << np.uint32(8 * k)) for k in range(4)])


def joined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of two strings put together; ``lengths`` are the bytes of the second."""
    out = np.empty(len(first), np.uint32)
    for n in np.unique(lengths):
        at, tables = lengths == n, _after(int(n))
        crc = first[at]
        out[at] = (tables[0][crc & 255] ^ tables[1][crc >> 8 & 255]
                   ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24])
    return out ^ second


def composed(found: np.ndarray, most: int) -> np.ndarray:
    """CRCs of all runs of 1 to ``most`` neighbouring words joined by one space."""
    crc, lengths = (found & 0xFFFFFFFF).astype(np.uint32), found >> 32
    runs, out = crc, [crc]
    space = np.uint32(zlib.crc32(b" "))
    for size in range(2, most + 1):
        if len(runs) < 2:
            break
        last, of = crc[size - 1:], lengths[size - 1:]
        runs = joined(runs[:-1], joined(np.full(len(last), space), last, of), of + 1)
        out.append(runs)
    return np.concatenate(out)


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """A folded text in pieces of about ``size`` bytes that end between words."""
    at = 0
    while len(data) - at > size:
        end = data.rfind(b" ", at + 1, at + size)
        end = data.find(b" ", at + size) if end < 0 else end
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:]


def _scan(batches: Iterator[pa.RecordBatch], most: int, buckets: int, size: int) -> Iterator[pa.RecordBatch]:
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    for batch in batches:
        texts = batch.column(2)
        found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        block: list[tuple[int, bytes]] = []
        held = 0

        def look_up() -> None:
            words = {word for _, data in block for word in data.split()}
            machine = dictionary(words)
            for row, data in block:
                found[row].append(payloads(machine, data))
            block.clear()

        for row in range(batch.num_rows):
            for piece in _pieces(folded(texts[row].as_py()), size):
                block.append((row, piece))
                held += len(piece)
                if held >= size:
                    look_up()
                    held = 0
        look_up()
        counts, packed = [], []
        for parts in found:
            whole = np.concatenate(parts)
            counts.append(len(whole))
            packed.append((composed(whole, most) % np.uint32(buckets)).astype(kind).tobytes())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                               pa.array(packed, pa.binary())], ["id", "tie", "n_words", "buckets"])


def bucketed(df: DataFrame, id_column: str | None, text: str = "text", most: int = 1,
             buckets: int = 10_000, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, tie, n_words, buckets)``: the packed buckets of a document's features, in order."""
    own = F.col(f"`{text}`")
    key = F.col(f"`{id_column}`").cast("long") if id_column else F.lit(None).cast("long")
    return df.select(key.alias("id"), F.xxhash64(own).alias("tie"), own.alias("text")).mapInArrow(
        lambda b: _scan(b, most, buckets, block_bytes), "id long, tie long, n_words long, buckets binary")


def _unpacked(data: bytes, buckets: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if buckets <= 1 << 16 else "<u4")


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for data in batch.column(0):
            total += np.bincount(_unpacked(data.as_py(), buckets), minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.record_batch([some.astype(np.int64), total[some]], ["bucket", "n"])


def bucket_counts(packed: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """How many features each bucket holds: an array of ``buckets`` numbers."""
    rows = packed.select("buckets").mapInArrow(lambda b: _counted(b, buckets), "bucket long, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln)`` of the smoothed share in the target over the share in the source."""
    buckets, n, m = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (n + buckets) / ((s + 1.0) * (m + buckets))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, weights = [], []
        for data in batch.column(3):
            own = gain[_unpacked(data.as_py(), len(gain))]
            sizes.append(len(own))
            weights.append(int(own.sum()) // max(len(own), 1))
        yield pa.record_batch([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())],
                              ["id", "tie", "n_words", "n_features", "weight"])


def draw_of(key: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(df: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text",
           target_text: str = "text", most: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """``(id, tie, n_words, n_features, weight, score)`` of every row; ``tie`` is the text's digest."""
    packed = cut(bucketed(df, id_column, text, most, buckets), "buckets")
    wanted = bucketed(target, None, target_text, most, buckets)
    gain = gains(bucket_counts(packed, buckets), bucket_counts(wanted, buckets))
    return packed.mapInArrow(lambda b: _weighed(b, gain), "id long, tie long, n_words long, n_features long, "
                             "weight long").withColumn("score", F.col("weight") + draw_of(F.col("id"), seed))


def _bar(able: DataFrame, draws: int) -> int:
    """The lowest score that is drawn: of the distinct scores, whose range the logarithms bound."""
    found = able.groupBy("score").agg(F.count("*").alias("n")).toArrow().sort_by([("score", "descending")])
    upto = np.cumsum(found["n"].to_numpy())
    return found["score"][int(np.searchsorted(upto, draws))].as_py()


def ranked(scored: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Add ``rank`` to the drawn rows of a written table of :func:`scores`; null for the others."""
    able = scored.where(F.col("n_words") >= least_words)
    draws = able.count() * percent // 100
    if not draws:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = (F.col("n_words") >= least_words) & (F.col("score") >= _bar(able, draws))
    columns = scored.columns
    # Equal rows are one group with a number, so a row that is repeated very often is no long sort.
    order = [F.desc("score"), F.asc("id"), F.asc("tie"), F.asc("n_words")]
    groups = scored.where(high).groupBy(*columns).agg(F.count("*").alias("n"))
    dealt = cut(groups.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("part").agg(F.sum("n").alias("of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = sizes.select("part", F.coalesce(F.sum("of_part").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.join(starts, "part").withColumn(
        "first", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)) + 1)
    steps = first.withColumn("step", F.explode(F.expr(f"sequence(0L, (n - 1) div {STEP})")))
    numbered = steps.withColumn("at", F.explode(F.expr(
        f"sequence(first + step * {STEP}, first + least(n, (step + 1) * {STEP}) - 1)")))
    drawn = numbered.select(*columns, F.when(F.col("at") <= draws, F.col("at")).alias("rank"))
    return scored.where(~high).withColumn("rank", F.lit(None).cast("long")).unionByName(drawn)


def resampled(df: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text",
              target_text: str = "text", most: int = 1, buckets: int = 10_000, percent: int = 10,
              least_words: int = 20, seed: int = 2024) -> DataFrame:
    """Every row as ``(id, tie, n_words, n_features, weight, score, rank)``."""
    table = cut(scores(df, target, id_column, text, target_text, most, buckets, seed), "scores")
    return ranked(table, percent, least_words)


def drawn(df: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The drawn rows themselves; of rows with equal id and text all or none."""
    chosen = resampled(df, target, id_column, text, **how).where("rank is not null").select(
        F.col("id").alias("_i_id"), F.col("tie").alias("_i_tie")).distinct()
    return df.join(chosen, F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("_i_id"))
                   & (F.xxhash64(F.col(f"`{text}`")) == F.col("_i_tie")), "left_semi")
