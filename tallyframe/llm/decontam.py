"""Documents that hold benchmark items, found by spaced seeds.

Texts become runs of letters and digits in lower case, each as a 64-bit hash. A document holds an item
if at least ``SIMILARITY`` of the item's tokens agree on one alignment, that is if at most one in five
differs. Cut into groups of five, an item then has a group with one differing token at most, wherever the
differing ones stand. The masks read four of five tokens and ignore one, each of them another one, so one of them
reads only agreeing tokens: no placement of differing tokens is missed. Masked hashes of the items' groups
are joined to those of all windows of the documents. A hit fixes how item and document lie against each
other; the tokens in place are compared one by one over the whole item.

Items of fewer than five tokens say too little by themselves. A document holds such an item only if
one of its lines consists of it, token by token.

``excerpts`` finds documents that quote a part of an item, or all of it with words put in or left out.
There the places of an item (of five tokens or more) count that lie in runs of ``RUN`` or more agreeing
tokens, united over ``SHIFT + 1`` neighbouring alignments.

Documents are turned into tokens once for all masks, and again for lines if there are short items. Seeds are broadcast as
``(seed, item number, place, length)`` in blocks of about half ``BLOCK_SEEDS`` rows, dealt by hash of number and place,
whatever the size of benchmark or item; each block meets all documents. The items' tokens are joined
to the hits, by whichever join suits their size. Null texts match nothing, null ids are ids, repeated
rows give one result row, other columns are not read, empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.columns import fenced
from tallyframe.llm.storage import cut

SIMILARITY = 0.8
#: Tokens of an item that masks read together, and the places each mask reads. The mask that ignores the
#: first place is the first mask, one place further.
GROUP = 5
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
#: An excerpt has so many of the item's tokens, or ``SIMILARITY`` of a shorter item, in runs.
EXCERPT, RUN, SHIFT = 20, 3, 4
BLOCK_SEEDS = 200_000


def tokens(text: Column) -> Column:
    """Hashes of the runs of letters and digits; empty for null."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.coalesce(F.transform(found, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


def _needed(n: str) -> str:
    """SQL for the number of agreeing tokens that an item of ``n`` tokens needs."""
    return f"cast(ceil({n} * {SIMILARITY}D - 1e-9) as int)"


def _seeds(df: DataFrame, hashes: str, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """One row per window and mask with its place ``_w_at``, the mask's number and ``_w_seed``."""
    every, at = F.col(hashes), F.col("_w_at")
    windows = df.select("*", F.posexplode(every).alias("_w_at", "_w_token"))
    masked = [F.struct(F.lit(number).alias("_w_mask"), F.when(at + mask[-1] < F.size(every), F.xxhash64(
        F.lit(",".join(map(str, mask))), *[F.get(every, at + place) for place in mask])).alias("_w_seed"))
        for number, mask in enumerate(masks)]
    return windows.select("*", F.inline(F.array(*masked))).where("_w_seed is not null")


def _items(benchmark: DataFrame, item_column: str, item_text: str) -> DataFrame:
    """``(item_id, number, item, n_tokens)``; the number is a hash of id and tokens."""
    items = benchmark.select(F.col(f"`{item_column}`").alias("item_id"), tokens(F.col(f"`{item_text}`")).alias("item"))
    return cut(items.where(F.size("item") > 0).distinct().select(
        "item_id", F.xxhash64("item_id", "item").alias("number"), "item", F.size("item").alias("n_tokens")), "items")


def _documents(df: DataFrame, id_column: str, text: str) -> DataFrame:
    docs = fenced(df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("body")),
                  hashes=tokens(F.col("body")), tie=F.xxhash64("body"))
    return docs.select("id", "tie", "hashes")


def _hits(docs: DataFrame, items: DataFrame, whole: bool, runs: bool) -> DataFrame:
    """``(id, tie, number, n_tokens, item_at, start, run, part)`` of all seeds that meet.

    ``part`` has the document's tokens under the item for hits of masks, null for hits of runs.
    """
    masks = MASKS * whole + (tuple(range(RUN)),) * runs
    run = len(masks) - 1 if runs else -1
    long = items.where(F.col("n_tokens") >= GROUP)
    grouped = f"_w_at % {GROUP} = 0 and _w_at + {GROUP} <= n_tokens"
    shifted = f"_w_mask = 0 and _w_at % {GROUP} = 1 and _w_at + {GROUP - 1} <= n_tokens"
    sought = _seeds(long, "item", masks).where(f"_w_mask = {run} or {grouped} or {shifted}").select(
        F.col("_w_seed").alias("seed"), (F.col("_w_mask") == run).alias("run"), "number", "n_tokens",
        F.col("_w_at").alias("item_at"))
    total = long.agg(F.sum("n_tokens")).first()[0] or 0
    blocks = max(1, -(-2 * (whole + runs) * total // BLOCK_SEEDS))
    met = []
    for block in range(blocks):
        own = sought.where(F.pmod(F.xxhash64("number", "item_at"), F.lit(blocks)) == block)
        hits = _seeds(docs, "hashes", masks).join(F.broadcast(own), F.col("_w_seed") == F.col("seed"))
        start = F.col("_w_at") - F.col("item_at")
        part = F.when(~F.col("run"), F.slice("hashes", F.greatest(start, F.lit(0)) + 1, F.col("n_tokens")))
        met.append(hits.select("id", "tie", "number", "n_tokens", "item_at", start.alias("start"), "run", part.alias("part")))
    return reduce(DataFrame.unionByName, met)


def _agreeing(hits: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, tie, item_id, n_match, n_tokens, at)``: the best place of each item that is held."""
    known = items.select("item_id", "number", "item")
    first = F.least(F.col("start"), F.lit(0))
    n_match = F.size(F.filter("item", lambda x, i: F.get(F.col("part"), i + first) == x))
    found = hits.join(known, "number").select(
        "id", "tie", "item_id", n_match.cast("long").alias("n_match"), F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("start").cast("long").alias("at")).where(F.col("n_match") >= F.col("n_tokens") * SIMILARITY)
    return found.groupBy("id", "tie", "item_id", "n_tokens").agg(
        F.max("n_match").alias("n_match"), F.max_by("at", F.struct("n_match", -F.col("at"))).alias("at"))


def _lines(df: DataFrame, items: DataFrame, id_column: str, text: str) -> DataFrame | None:
    """Short items that a line consists of, ``at`` null; None if no item is short."""
    short = items.where(F.col("n_tokens") < GROUP)
    if short.isEmpty():
        return None
    body = F.col(f"`{text}`")
    lines = df.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(body).alias("tie"),
                      F.explode(F.split(body, "\n")).alias("line"))
    lines = fenced(lines, words=tokens(F.col("line"))).where(F.size("words").between(1, GROUP - 1))
    held = lines.join(short, F.col("words") == F.col("item"))
    return held.select("id", "tie", "item_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                       F.col("n_tokens").cast("long").alias("n_match"), F.lit(None).cast("long").alias("at")).distinct()


def leaks(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
          item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(id, tie, item_id, n_tokens, n_match, at)``: the best place of each held item.

    ``tie`` is a digest of the document's text, for tables whose ids repeat.
    """
    items = _items(benchmark, item_column, item_text)
    found = _agreeing(_hits(_documents(df, id_column, text), items, True, False), items)
    lines = _lines(df, items, id_column, text)
    return found if lines is None else found.unionByName(lines)


def _quoted(hits: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, tie, item_id, n_places, n_tokens)`` from the hits of runs."""
    # A run counts for all alignments that it is at most SHIFT behind.
    keys = ["id", "tie", "number", "n_tokens", "first"]
    runs = hits.select(*keys[:-1], "item_at", F.explode(F.sequence(F.col("start") - SHIFT, F.col("start"))).alias("first"))
    places = runs.groupBy(*keys).agg(F.collect_set("item_at").alias("runs"))
    needed = F.least(F.lit(EXCERPT), F.expr(_needed("n_tokens")))
    places = places.where(F.size("runs") * RUN >= needed)
    every = F.flatten(F.transform("runs", lambda x: F.sequence(x, x + (RUN - 1))))
    places = places.withColumn("n_places", F.size(F.array_distinct(every)).cast("long"))
    return places.where(F.col("n_places") >= needed).join(items.select("item_id", "number"), "number").groupBy(
        "id", "tie", "item_id", F.col("n_tokens").cast("long").alias("n_tokens")).agg(F.max("n_places").alias("n_places"))


def excerpts(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
             item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(id, tie, item_id, n_tokens, n_places)``: most places of an item in runs on close alignments."""
    items = _items(benchmark, item_column, item_text)
    return _quoted(_hits(_documents(df, id_column, text), items, False, True), items)


def without_leaks(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                  text: str = "text", with_excerpts: bool = False) -> DataFrame:
    """The rows that hold no item, nor an excerpt of one if that is asked for."""
    items = _items(benchmark, "item_id", "text")
    hits = cut(_hits(_documents(df, id_column, text), items, True, with_excerpts), "hits")
    held = _agreeing(hits.where("not run"), items).select("id", "tie")
    lines = _lines(df, items, id_column, text)
    if lines is not None:
        held = held.unionByName(lines.select("id", "tie"))
    if with_excerpts:
        held = held.unionByName(_quoted(hits.where("run"), items).select("id", "tie"))
    held = cut(held.distinct(), "leaks")
    held = held.select(F.col("id").alias("_w_id"), F.col("tie").alias("_w_tie"))
    return df.join(held, F.col(f"`{id_column}`").eqNullSafe(F.col("_w_id"))
                   & (F.xxhash64(F.col(f"`{text}`")) == F.col("_w_tie")), "left_anti")
