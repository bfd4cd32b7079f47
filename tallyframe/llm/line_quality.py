"""Quality of documents from lines that a linear-chain conditional random field labels good or bad.

A document is the chain of its lines that hold more than blanks (one empty line if it has none).
Every line has features of its own shape (length, shares of capitals, symbols, marks, digits,
different words and words said twice in a row, and whether an earlier line is equal) and of the lines before and after it, each
cut into a few steps. The field has a weight per step, a weight for the first label and four
for neighbouring labels. Forward and backward passes give each line the probability of being good; the
mean over the lines, weighted by their length, is the document's score. With two labels both passes
are recursions on one log odds per line, taken for all documents of a batch at once.

The weights are fitted on labelled documents, whose lines all carry the label of the document.
At most about ``fit_rows`` of them are used, chosen by a hash of the id whatever the size of the
table. They are dealt by hash into a fixed number of parts; a part runs a few epochs of gradient
steps from the common weights, and the mean of the parts is the start of the next round, so a fit
does not depend on the number of executors, and a lost one costs a part of a round. Scoring is one
pass over the documents without a shuffle.

Null and empty texts have one empty line and a score like any other. A null id is a document of
its own and is never learnt from; ids with contradicting labels, or none of 0 and 1, are not learnt from;
repeated rows are scored one by one. Without labelled rows all weights are zero and scores one half;
an empty table gives an empty result. Nothing but the text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.storage import cut

#: Labelled documents that a fit uses at most, about; parts that fit side by side, and how.
FIT_ROWS, PARTS, ROUNDS, EPOCHS, BATCH, RATE, DECAY = 20_000, 8, 6, 6, 32, 0.2, 1e-5
#: Characters whose classes are counted at once.
BLOCK_CHARS = 2_000_000

# Character classes: 1 capital, 2 small, 3 digit, 4 blank, 5 stop, 6 mark, 7 symbol, 8 beyond ASCII.
CLASSES = np.full(129, 7, np.int64)
CLASSES[:33] = 4
CLASSES[10] = 0
CLASSES[127], CLASSES[128] = 4, 8
for _class, _chars in {1: range(65, 91), 2: range(97, 123), 3: range(48, 58), 5: b".?!", 6: b",;:'\"()-"}.items():
    CLASSES[list(_chars)] = _class

#: Steps of each feature; shares have one step more for "no such characters".
OWN = {"length": 16, "words": 16, "capitals": 12, "symbols": 12, "marks": 12, "digits": 12, "beyond": 12,
       "different": 12, "echoes": 12, "symbols_a_word": 12, "word_length": 16, "blanks": 12, "repeated": 2, "stop_at_end": 2}
AROUND = ("length", "capitals", "symbols", "different", "echoes", "symbols_a_word", "repeated")
STEPS = [*OWN.values(), *(OWN[n] + 1 for n in AROUND for _ in range(2))]  # one more: no such line
STARTS = np.r_[0, np.cumsum(STEPS)[:-1]]
SIZE = int(sum(STEPS))


def lines_of(text: str | None) -> list[str]:
    return [x for x in (text or "").split("\n") if x and not x.isspace()] or [""]


def _numbers(lines: list[str], docs: np.ndarray) -> np.ndarray:
    """Per line: characters of each class, words, different words, words equal to the one before,
    repeated, ends with a stop."""
    counts = np.zeros((len(lines), 9), np.int64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
    at, upto = 0, np.cumsum(lengths)
    while at < len(lines):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK_CHARS, "right")))
        codes = np.frombuffer(("\n".join(lines[at:end]) + "\n").encode("utf-32-le"), np.uint32)
        kinds = CLASSES[np.minimum(codes, 128)]
        kinds += np.repeat(np.arange(end - at) * 9, lengths[at:end])
        counts[at:end] = np.bincount(kinds, minlength=9 * (end - at)).reshape(-1, 9)
        at = end
    rest = np.zeros((len(lines), 5), np.int64)
    seen: set[str] = set()
    doc = -1
    for i, line in enumerate(lines):
        if docs[i] != doc:
            doc, seen = docs[i], set()
        words = line.split()
        rest[i] = len(words), len(set(words)), sum(map(eq, words, words[1:])), line in seen, line.rstrip()[-1:] in (".", "?", "!")
        seen.add(line)
    return np.hstack([counts, rest])


def _share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Tenths, and 11 where there is nothing to share."""
    return np.where(of > 0, np.minimum(10 * part // np.maximum(of, 1), 10), 11)


def features(lines: list[str], sizes: np.ndarray) -> np.ndarray:
    """One row per line with the weight numbers of its features; ``sizes`` are lines per document."""
    docs = np.repeat(np.arange(len(sizes)), sizes)
    n = _numbers(lines, docs)
    upper, small, digits, blanks, stops, marks, symbols, beyond = n[:, 1:9].T
    words, different, echoes, repeated, stop_at_end = n[:, 9:].T
    chars, letters = n[:, 1:9].sum(axis=1), upper + small + beyond
    per_word = np.maximum(words, 1)
    steps = {
        "length": np.minimum(np.log2(1 + chars).astype(np.int64), 15),
        "words": np.minimum(np.log2(1 + words).astype(np.int64), 15),
        "capitals": _share(upper, letters), "symbols": _share(symbols, chars),
        "marks": np.minimum(4 * (stops + marks) // per_word, 11), "digits": _share(digits, chars),
        "beyond": _share(beyond, letters), "different": _share(different, words), "echoes": _share(echoes, words),
        "symbols_a_word": np.minimum(2 * symbols // per_word, 11),
        "word_length": np.minimum(letters // per_word, 15), "blanks": _share(blanks, chars),
        "repeated": repeated, "stop_at_end": stop_at_end}
    edge = np.r_[True, docs[1:] != docs[:-1]]
    columns = list(steps.values())
    for name in AROUND:
        before, after = np.roll(steps[name], 1), np.roll(steps[name], -1)
        columns += [np.where(edge, OWN[name], before), np.where(np.roll(edge, -1), OWN[name], after)]
    return (np.stack(columns, axis=1) + STARTS).astype(np.int16)


@dataclass
class Field:
    """Weights of the features, of the first label, and of neighbouring labels (from, to)."""

    weights: np.ndarray
    first: float
    pairs: np.ndarray

    @staticmethod
    def zero() -> Field:
        return Field(np.zeros(SIZE), 0.0, np.zeros((2, 2)))

    def packed(self) -> np.ndarray:
        return np.r_[self.weights, self.first, self.pairs.ravel()]

    @staticmethod
    def unpacked(values: np.ndarray) -> Field:
        return Field(values[:SIZE].copy(), float(values[SIZE]), values[SIZE + 1:].reshape(2, 2).copy())


def passes(field: Field, own: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward log odds (with the line itself) and backward log odds of every line."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    (t00, t01), (t10, t11) = field.pairs
    left = -sizes[order]
    ahead, back = own.copy(), np.zeros(len(own))
    ahead[starts] += field.first
    longest = int(sizes.max(initial=0))
    for t in range(1, longest):
        here = starts[:np.searchsorted(left, -t)] + t
        odds = ahead[here - 1]
        ahead[here] += np.logaddexp(t01, t11 + odds) - np.logaddexp(t00, t10 + odds)
    for t in range(longest - 2, -1, -1):
        here = starts[:np.searchsorted(left, -t - 1)] + t
        odds = own[here + 1] + back[here + 1]
        back[here] = np.logaddexp(t10, t11 + odds) - np.logaddexp(t00, t01 + odds)
    return ahead, back


def _chance(odds: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -odds))


def gradient(field: Field, rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Of the log likelihood of the labels, one per line, in the order of ``Field.packed``."""
    own = field.weights[rows].sum(axis=1)
    ahead, back = passes(field, own, sizes)
    missed = labels - _chance(ahead + back)
    weights = np.bincount(rows.ravel(), np.repeat(missed, rows.shape[1]), SIZE)
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(own), bool)
    inner[starts] = False
    after = np.flatnonzero(inner)
    a, b = ahead[after - 1], own[after] + back[after]
    odds = np.stack([np.full(len(a), field.pairs[0, 0]), field.pairs[0, 1] + b, field.pairs[1, 0] + a,
                     field.pairs[1, 1] + a + b])
    chance = np.exp(odds - np.logaddexp.reduce(odds, axis=0)).sum(axis=1)
    was = np.bincount((2 * labels[after - 1] + labels[after]).astype(int), minlength=4)
    return np.r_[weights, missed[starts].sum(), was - chance]


def _improved(field: Field, docs: list[tuple[int, np.ndarray]], epochs: int) -> Field:
    """Gradient steps with rates that fall by what each weight has seen."""
    values, seen = field.packed(), np.full(SIZE + 5, 1e-8)
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(len(docs))
        for at in range(0, len(order), BATCH):
            some = [docs[i] for i in order[at:at + BATCH]]
            rows, sizes = np.concatenate([r for _, r in some]), np.array([len(r) for _, r in some])
            labels = np.repeat(np.array([y for y, _ in some], float), sizes)
            step = gradient(Field.unpacked(values), rows, sizes, labels) / len(rows) - DECAY * values
            seen += step * step
            values += RATE * step / np.sqrt(seen)
    return Field.unpacked(values)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for text in batch.column(4):
            lines = lines_of(text.as_py())
            packed.append(features(lines, np.array([len(lines)])).tobytes())
        yield pa.record_batch([*batch.columns[:4], pa.array(packed, pa.binary())],
                              ["part", "id", "tie", "label", "rows"])


def _fitted(batches: Iterator[pa.RecordBatch], field: Field, epochs: int) -> Iterator[pa.RecordBatch]:
    part, docs = None, []

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([len(docs)], pa.int64()), pa.array(
            [_improved(field, docs, epochs).packed()], pa.list_(pa.float64()))], ["n", "weights"])

    for batch in batches:
        for number, label, rows in zip(*(batch.column(c).to_pylist() for c in ("part", "label", "rows"))):
            if number != part and docs:
                yield done()
                docs = []
            part = number
            docs.append((label, np.frombuffer(rows, np.int16).reshape(-1, len(STEPS))))
    if docs:
        yield done()


def held_out(key: Column) -> Column:
    """A third of the ids, by the CRC of their text; labels of these are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
        fit_rows: int = FIT_ROWS) -> Field:
    """The field of the labelled documents; ``labels`` holds ids and 0 or 1."""
    key, mark = F.col(f"`{id_column}`"), F.col(f"`{label}`")
    known = labels.where(key.isNotNull() & mark.isin(0, 1)).groupBy(key.alias("_k_id")).agg(
        F.min(mark).cast("int").alias("label"), F.max(mark).cast("int").alias("most")).where("label = most").drop("most")
    share = fit_rows / max(known.count(), 1)
    some = known.where(F.pmod(F.xxhash64("_k_id"), F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30)))
    # About fit_rows ids at most, so the texts stay where they are.
    docs = df.select(key.alias("_k_doc"), F.col(f"`{text}`").alias("text"))
    chosen = docs.join(F.broadcast(some), F.col("_k_doc") == F.col("_k_id")).select(
        F.pmod(F.xxhash64("_k_id"), F.lit(PARTS)).cast("int").alias("part"), F.col("_k_id").cast("string").alias("id"),
        F.xxhash64("text").alias("tie"), "label", "text")
    table = cut(chosen.mapInArrow(_featured, "part int, id string, tie long, label int, rows binary"), "lines")
    dealt = table.repartition(PARTS, "part").sortWithinPartitions("part", "id", "tie")
    field = Field.zero()
    for _ in range(ROUNDS):
        found = dealt.mapInArrow(lambda b, f=field: _fitted(b, f, EPOCHS), "n long, weights array<double>").collect()
        if found:
            # Whichever order the parts come in, sums are the same.
            found.sort(key=lambda r: (r["n"], r["weights"]))
            field = Field.unpacked(np.average([r["weights"] for r in found], axis=0, weights=[r["n"] for r in found]))
    return field


def _chances(field: Field, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All lines of some documents, lines per document, and each line's probability of being good."""
    every = [lines_of(t.as_py()) for t in texts]
    sizes, lines = np.array([len(x) for x in every], np.int64), [x for own in every for x in own]
    own = field.weights[features(lines, sizes)].sum(axis=1) if lines else np.zeros(0)
    ahead, back = passes(field, own, sizes)
    return lines, sizes, _chance(ahead + back)


def _scored(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        lines, sizes, good = _chances(field, batch.column(batch.num_columns - 1))
        weight = np.fromiter(map(len, lines), np.float64, len(lines))
        weight = np.maximum(weight, 1)
        starts = np.cumsum(sizes) - sizes
        score = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
        yield pa.record_batch([*batch.columns[:-1], np.clip(score, 0, 1), pa.array(sizes)],
                              [*batch.schema.names[:-1], "score", "n_lines"])


def score(df: DataFrame, field: Field, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, tie, score, n_lines)`` of every row."""
    own = F.col(f"`{text}`")
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(own).alias("tie"), own.alias("text"))
    return rows.mapInArrow(lambda b: _scored(b, field), "id long, tie long, score double, n_lines long")


def _labelled(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, sizes, good = _chances(field, batch.column(1))
        starts = np.cumsum(sizes) - sizes
        number = np.arange(len(lines)) - np.repeat(starts, sizes)
        yield pa.record_batch([batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), pa.array(number),
                               pa.array(lines, pa.string()), good], ["id", "line", "text", "good"])


def line_labels(df: DataFrame, field: Field, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, line, text, good)``: every line that is not blank, and its probability of being good."""
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(lambda b: _labelled(b, field), "id long, line long, text string, good double")


def classified(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
               label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(id, tie, score, n_lines, held_out, predicted)``; fitted on the labels that are not held out."""
    learnt = labels.where(~held_out(F.col(f"`{id_column}`")))
    field = fit(df, learnt, id_column, text, label, fit_rows)
    return score(df, field, id_column, text).select(
        "*", held_out(F.col("id")).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted"))
