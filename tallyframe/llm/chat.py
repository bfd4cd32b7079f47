"""Conversations as training text, with a loss mask on tokens.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>\\n``. The control strings are special
tokens of the tokenizer, so no token crosses the border of a text. Inside roles and texts a
backslash is put between ``<`` and ``|`` (one more where there are some already), which makes
control strings ordinary text and is undone when reading back.

All turns are sorted over range partitions and rendered in pages; a page is encoded once, with offsets,
and its token spans are intersected with the spans of the assistant's texts by binary search. A page
ends with its conversation, after ``PAGE_TURNS`` turns, with the turn that fills ``PAGE_CHARS``, or with
its partition. So a long conversation is many pages, encoded in parallel, whatever its turn numbers are,
and no task holds more of it than a page. Control strings end a token, so the cuts change none.

Null roles and texts count as empty. Turns are ordered by their number (null first), then role and
text, so ties have one order and repeated rows stay repeated turns; rows with a null conversation are
one conversation; an empty table has an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
PAGE_TURNS = 64
PAGE_CHARS = 1 << 18
PAGE = ("conv long, page long, n_turns long, formatted string, n_tokens long, "
        "mask_starts array<long>, mask_ends array<long>")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The page and the starts and ends of the texts to learn from, in order."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        parts += [head, body, END, "\n"]
        if role == LEARNED_ROLE:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def token_mask(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens overlap one of the sorted, disjoint spans."""
    if not len(starts):
        return np.zeros(len(offsets), bool)
    last = np.searchsorted(starts, offsets[:, 1], "left") - 1  # last span that starts before the end
    return (last >= 0) & (ends[np.maximum(last, 0)] > offsets[:, 0])


def masked_spans(offsets: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged character spans of the masked tokens (several tokens may share a character)."""
    own = offsets[mask]
    if not len(own):
        return np.array([], np.int64), np.array([], np.int64)
    reach = np.maximum.accumulate(own[:, 1])
    first = np.r_[True, own[1:, 0] > reach[:-1]]
    return own[first, 0], reach[np.r_[first[1:], True]]


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(path)
    found.add_special_tokens([AddedToken(s, normalized=False) for s in (START, SEP, END)])
    return found


def _pages(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Sorted turns to rendered and encoded pages."""
    library = tokenizer(path)

    def encoded(key, turns):
        page, starts, ends = render(turns)
        offsets = np.array(library.encode(page, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        mask = token_mask(offsets, starts, ends)
        a, b = masked_spans(offsets, mask)
        return (*key, len(turns), page, len(offsets), a.tolist(), b.tolist())

    def batch_of(rows):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()),
                 pa.list_(pa.int64())]
        names = ["conv", "page", "n_turns", "formatted", "n_tokens", "mask_starts", "mask_ends"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    open_, part, number, chars, turns, rows = None, 0, 0, 0, [], []
    for batch in batches:
        for conv, part, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if turns and (conv != open_ or len(turns) >= PAGE_TURNS or chars >= PAGE_CHARS):
                rows.append(encoded((open_, (part << 40) + number), turns))
                number, chars, turns = number + 1, 0, []
                if len(rows) >= 200:
                    yield batch_of(rows)
                    rows = []
            open_ = conv
            chars += len(role) + len(text)
            turns.append((role, text))
    if turns:
        rows.append(encoded((open_, (part << 40) + number), turns))
    if rows:
        yield batch_of(rows)


def formatted(df: DataFrame, tokenizer_file: str, conv: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """``conv, page, n_turns, formatted, n_tokens, mask_starts, mask_ends`` for every page.

    The mask is given as spans of code points of the formatted text.
    """
    empty = F.lit("")
    rows = df.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     F.coalesce(F.col(f"`{role}`"), empty).alias("role"),
                     F.coalesce(F.col(f"`{text}`"), empty).alias("text"))
    order = ["conv", "turn", "role", "text"]
    # Ranges ascend with the partition, so its number and a counter give pages their order.
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv", F.spark_partition_id().alias("part"), "role", "text")
            .mapInArrow(lambda b: _pages(b, tokenizer_file), PAGE))


TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END) + "\n", re.DOTALL)
DIGEST = ("conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_tokens long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order to one row per conversation; only running digests are kept."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    seen, rows = False, []
    conv = n_turns = loss_chars = chars = n_tokens = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def row():
        return conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_tokens

    for batch in batches:
        for next_conv, text, tokens, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if seen and next_conv != conv:
                rows.append(row())
                n_turns = loss_chars = chars = n_tokens = 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            seen, conv = True, next_conv
            for role, body in TURN.findall(text):
                n_turns += 1
                turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            for a, b in zip(starts, ends):
                plain = unescape(text[a:b])
                loss_chars += len(plain)
                loss.update(plain.encode())
            chars += len(text)
            n_tokens += tokens
        if len(rows) >= 1000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
            rows = []
    if seen:
        rows.append(row())
    if rows:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def digests(pages: DataFrame) -> DataFrame:
    """What is read back from the pages of each conversation."""
    return (pages.select("conv", "page", "formatted", "n_tokens", "mask_starts", "mask_ends")
            .repartition("conv").sortWithinPartitions("conv", "page")
            .select("conv", "formatted", "n_tokens", "mask_starts", "mask_ends")
            .mapInArrow(_digests, DIGEST))
