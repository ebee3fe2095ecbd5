"""Packing token pieces into sequences: best fit improved by a grouping genetic algorithm.

Pieces are dealt at random over blocks of bounded size. Each block is packed by several
islands. An island's individuals are whole packings; a child takes well-filled sequences of
one parent as they are, loses the other parent's sequences that hold any of their pieces,
and best-fits the pieces so displaced. After each epoch every island passes its best packing
to the next one. What a block cannot fill stands in a sequence or two that no island of it can
improve: the pieces of ill-filled sequences of all blocks are therefore dealt anew and packed
together, the same way, until few are left.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from ordermetrics.llm import words as w
from ordermetrics.llm.scratch import Scratch

CAPACITY = 1024
END = 2
BLOCK = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
# Generations without a better packing after which an island stops.
PATIENCE = 8
# Sequences filled less are taken apart and their pieces dealt anew.
ILL_FILLED = 0.97
DEALS = 3
WELL_FILLED = 0.98
# The vocabulary's added token; inside a text, too, its string is this id.
ADDED = {"<|endoftext|>": 50256}

# A longer run of white space exhausts the stack of the ranks' pattern.
LONG_SPACE = 100_000

_encoders: dict[str, tiktoken.Encoding] = {}
_tokenizers: dict[str, Tokenizer] = {}


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of ``path`` as ranks, and its added token."""
    if path not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens=ADDED)
    return _encoders[path]


def token_ids(text: str, vocabulary: str) -> list[int]:
    """The text's ids; the ranks are several times as fast as the same vocabulary as JSON."""
    if len(text) > LONG_SPACE and any(
            run.end() - run.start() > LONG_SPACE for run in re.finditer(r"\s+", text)):
        path = public_tokenizers.path(vocabulary.removesuffix(".tiktoken") + ".json")
        if path not in _tokenizers:
            _tokenizers[path] = Tokenizer.from_file(str(path))
        return _tokenizers[path].encode(text, add_special_tokens=False).ids
    return encoder(public_tokenizers.path(vocabulary)).encode(text, allowed_special="all")


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY, end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each text's tokens and an end token.

    Only texts of more than ``capacity`` tokens are cut, into pieces of that length; the
    first piece takes what is left over. A null or empty text is the end token alone.
    The string of an added token inside a text is that token, as ``tokenizers`` has it.
    Texts of any length, also of white space alone, are encoded whole. Repeated rows and ids
    are documents of their own; other columns are not read.
    """
    def run(batches):
        for batch in batches:
            for first, stop, _, _ in w.slices(batch, text_col):
                texts = w.strings(batch, text_col).slice(first, stop - first).to_pylist()
                ids = batch.column(id_col).slice(first, stop - first).cast(pa.int64()).to_pylist()
                rows = []
                for doc, text in zip(ids, texts):
                    tokens = np.array(token_ids(text, vocabulary) + [end], "<u4")
                    short = len(tokens) % capacity or capacity
                    cuts = [0, *range(short, len(tokens) + 1, capacity)]
                    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                        rows.append((doc, i, a, b - a, zlib.crc32(tokens[a:b].tobytes()),
                                     tokens[a:b].tolist() if with_ids else None))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[2:5]),
                    *([pa.array(columns[5], pa.list_(pa.int32()))] if with_ids else [])], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return docs.select(id_col, text_col).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
        + ", ids array<int>" * with_ids)


def best_fit(
    lengths: np.ndarray, order: np.ndarray, bin_of: np.ndarray, free: list[int], capacity: int,
) -> None:
    """Put the pieces of ``order`` into the fullest sequence that takes them, or a new one."""
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for number, room in enumerate(free):
        at[room].append(number)
        mask |= 1 << room
    for item in order.tolist():
        size = int(lengths[item])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            number = at[room].pop()
            if not at[room]:
                mask &= ~(1 << room)
        else:
            room, number = capacity, len(free)
            free.append(capacity)
        bin_of[item] = number
        free[number] = room - size
        at[room - size].append(number)
        mask |= 1 << (room - size)


def fitness(lengths: np.ndarray, bin_of: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones next to emptier ones; smaller is better."""
    fill = np.bincount(bin_of, weights=lengths) / capacity
    return int((fill > 0).sum()), -float((fill * fill).sum())


def crossover(
    lengths: np.ndarray, mother: np.ndarray, father: np.ndarray, capacity: int, draw,
) -> np.ndarray:
    """The mother's packing with some of the father's well-filled sequences put in whole."""
    fill = np.bincount(father, weights=lengths)
    good = np.flatnonzero(fill >= WELL_FILLED * capacity)
    if not len(good):
        good = np.argsort(fill)[-max(1, len(fill) // 4):]
    chosen = np.zeros(len(fill), bool)
    chosen[draw.choice(good, max(1, len(good) // 2), replace=False)] = True
    injected = chosen[father]
    lost = np.zeros(mother.max() + 1, bool)
    lost[mother[injected]] = True
    displaced = np.flatnonzero(lost[mother] & ~injected)
    child = np.full(len(mother), -1)
    child[injected] = father[injected]
    kept = ~lost[mother]
    child[kept] = mother[kept] + len(fill)
    used = child >= 0
    _, child[used] = np.unique(child[used], return_inverse=True)
    free = (capacity - np.bincount(child[used], weights=lengths[used])).astype(int).tolist()
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    best_fit(lengths, order, child, free, capacity)
    return child


def evolve(
    lengths: np.ndarray, seeds: list[np.ndarray], capacity: int, draw,
) -> np.ndarray:
    """The best packing of one island after its generations."""
    bound = -(-int(lengths.sum()) // capacity)
    people = list(seeds)
    while len(people) < POPULATION:
        noise = draw.normal(0, 0.02 * capacity * (len(people) > 0), len(lengths))
        packing = np.zeros(len(lengths), np.int64)
        best_fit(lengths, np.argsort(-(lengths + noise), kind="stable"), packing, [], capacity)
        people.append(packing)
    scored = sorted(((fitness(lengths, x, capacity), i, x) for i, x in enumerate(people)))
    turn, stale = 0, 0
    while stale < PATIENCE and scored[0][0][0] > bound:
        a, b = draw.choice(len(scored), 2, replace=False)
        child = crossover(lengths, scored[min(a, b)][2], scored[max(a, b)][2], capacity, draw)
        best = scored[0][0]
        scored.append((fitness(lengths, child, capacity), POPULATION + turn, child))
        scored = sorted(scored)[:POPULATION]
        turn, stale = turn + 1, 0 if scored[0][0] < best else stale + 1
    return scored[0][2]


def _epoch(frame: DataFrame, epoch: int, capacity: int) -> DataFrame:
    """(block, island, sizes, best, count): one epoch of every island, from its elites."""
    def run(parts):
        for part in parts:
            for row in part.itertuples():
                draw = np.random.default_rng([row.block, row.island, epoch])
                sizes = np.asarray(row.sizes)
                seeds = [np.asarray(x, np.int64) for x in row.elites]
                best = evolve(sizes, seeds, capacity, draw)
                yield pd.DataFrame({
                    "block": [row.block], "island": [row.island], "sizes": [sizes],
                    "best": [best], "count": [fitness(sizes, best, capacity)[0]]})

    return frame.mapInPandas(
        run, "block bigint, island int, sizes array<bigint>, best array<bigint>, count bigint")


def _evolved(
    scratch: Scratch, rest: DataFrame, capacity: int, block: int, islands: int, epochs: int, deal: int,
) -> DataFrame:
    """(block, best, item) of the rows of ``rest`` (item): one deal over blocks, packed."""
    blocks = max(1, -(-rest.count() // block))
    dealt = rest.select(
        F.pmod(F.xxhash64("item._row", F.lit(deal)), F.lit(blocks)).alias("block"), "item")
    held = scratch.keep(dealt.groupBy("block").agg(
        F.sort_array(F.collect_list("item"), asc=False).alias("items")), f"blocks-{deal}")

    state = held.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.expr("transform(items, x -> x.length)").alias("sizes"),
        F.expr("CAST(array() AS ARRAY<ARRAY<BIGINT>>)").alias("elites"))
    for epoch in range(epochs):
        found = scratch.keep(_epoch(state, epoch, capacity), f"epoch-{deal}-{epoch}")
        guests = found.select(
            "block", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"),
            F.col("best").alias("guest"))
        state = found.join(guests, ["block", "island"]).select(
            "block", "island", "sizes", F.array("best", "guest").alias("elites"))
    best = found.groupBy("block").agg(F.min_by("best", F.struct("count", "island")).alias("best"))
    return held.join(best, "block").select("block", F.explode(
        F.arrays_zip("items", "best")).alias("x")).select(
        "block", "x.best", F.col("x.items").alias("item"))


def pack(
    items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS,
    epochs: int = EPOCHS, deals: int = DEALS,
) -> DataFrame:
    """The rows of ``items`` with sequence_id and offset; ``length`` is at most ``capacity``.

    Sequences hold at most ``capacity`` tokens, without gaps from offset 0. Full pieces are
    sequences of their own. Blocks hold about ``block`` pieces whatever the ids are, so
    repeated rows are no larger task. Of each deal but the last, ill-filled sequences are
    taken apart and their pieces, from all blocks, are the next deal. Other columns of
    ``items`` are carried, whatever their names but sequence_id and offset are. An empty
    table gives an empty one. Runs Spark jobs when called.
    """
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    names = items.columns
    stored = scratch.keep(items, "items")
    full = stored.filter(F.col("length") >= capacity).select(
        *names, (F.monotonically_increasing_id() * (deals + 1) + deals).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    rest = stored.filter(F.col("length") < capacity).withColumn(
        "_row", F.monotonically_increasing_id()).select(
        F.struct("length", "_row", F.struct(*names).alias("row")).alias("item"))
    for deal in range(deals):
        placed = scratch.keep(
            _evolved(scratch, rest, capacity, block, islands, epochs, deal), f"placed-{deal}")
        fill = placed.groupBy("block", "best").agg(F.sum("item.length").alias("fill"))
        ill = fill.filter(F.col("fill") < ILL_FILLED * capacity).select("block", "best")
        if deal < deals - 1 and placed.select("block").distinct().limit(2).count() > 1:
            done = placed.join(ill, ["block", "best"], "left_anti")
            rest = scratch.keep(placed.join(ill, ["block", "best"], "left_semi").select("item"), f"rest-{deal}")
            full = full.unionByName(_placed(done, names, deal, deals + 1))
        else:
            return full.unionByName(_placed(placed, names, deal, deals + 1))
    return full


def _placed(placed: DataFrame, names: list[str], deal: int, every: int) -> DataFrame:
    before = Window.partitionBy("block", "best").orderBy("item._row").rowsBetween(
        Window.unboundedPreceding, -1)
    number = (F.col("block") * 65536 + F.col("best")) * every + deal
    return placed.withColumn(
        "offset", F.coalesce(F.sum("item.length").over(before), F.lit(0)).cast("bigint"),
    ).select(*(F.col(f"item.row.{n}").alias(n) for n in names), number.alias("sequence_id"), "offset")
