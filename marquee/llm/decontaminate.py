"""Benchmark passages in training texts, found with suffix arrays of the training side.

Each slice of the documents is a shard with a suffix array of its own: the places from which at least the
shortest window could still match, sorted by the words that follow. Every test suffix that begins a window is
looked up by binary search; the found range gives all places of the window, and runs of windows on one diagonal
give the longest verbatim matches. The benchmark is the stated query set: it is broadcast in blocks of bounded
size, and a block is searched in every shard.

Defined cases: null texts have no words; an item of fewer than 13 words, but not none, is one window; an item
without words never occurs; a null item id is written as an empty string; repeated items count once per id;
repeated documents are judged each; an empty benchmark hits nothing. Columns other than ids and texts are not
read, and ``clean`` returns all columns of its input whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import words as W
from marquee.llm.registry import query

WINDOW = 13
#: Text of the benchmark that one block may hold; it bounds what is broadcast.
BLOCK_BYTES = 32 << 20


class Block(NamedTuple):
    """A block of the benchmark: its items as word codes from 1 on, and its distinct windows."""

    vocabulary: pa.Array
    items: list[str]
    codes: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    sizes: np.ndarray
    owners: np.ndarray
    owner_first: np.ndarray
    places: np.ndarray


def block_of(items: list[str], texts: list[str | None]) -> Block:
    """Index the items of a block: distinct windows, and for each window the item places where it begins."""
    words = W.split(pa.array(texts, pa.string()), W.FOLDED)
    codes = words.codes.astype(np.int64) + 1
    counts = np.diff(words.first)
    starts = W.spread(words.first[:-1], np.where(counts == 0, 0, np.maximum(counts - WINDOW + 1, 1)))
    item = np.searchsorted(words.first, starts, "right") - 1
    sizes = np.minimum(counts[item], WINDOW)
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int64)])
    table = padded[starts[:, None] + np.arange(WINDOW)] * (np.arange(WINDOW) < sizes[:, None])
    windows, which = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(windows) + 1))
    return Block(words.vocabulary, items, codes, words.first, windows, (windows > 0).sum(1), item[order], first, starts[order])


def _packed(table: np.ndarray, bits: int) -> np.ndarray:
    """Several word codes in one integer, earlier words in the higher places."""
    per = 63 // bits
    width = -(-table.shape[1] // per)
    out = np.zeros((len(table), width), np.int64)
    for i in range(table.shape[1]):
        out[:, i // per] |= table[:, i] << (bits * (per - 1 - i % per))
    return out


def _lower(suffixes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key the first sorted suffix that is not below it, all keys in step."""
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(suffixes), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        less, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for c in range(suffixes.shape[1]):
            a, b = suffixes[mid, c], keys[open_, c]
            less |= equal & (a < b)
            equal &= a == b
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    return low


def occurrences(words: W.Words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(places, windows): where in the shard a window of the block stands. A place holds one window of each size."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(block.windows) or not len(words.codes):
        return none
    known = pc.index_in(words.vocabulary, value_set=block.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    codes = known[words.codes]
    # How far each word lies before the next one that no item has, or before the end of its text.
    here = np.arange(len(codes))
    ends = np.repeat(words.first[1:], np.diff(words.first))
    gaps = np.append(np.flatnonzero(codes == 0), len(codes))
    reach = np.minimum(ends, gaps[np.searchsorted(gaps, here)]) - here
    places = np.flatnonzero(reach >= block.sizes.min())
    if not len(places):
        return none
    bits = (len(block.vocabulary) + 1).bit_length()
    padded = np.concatenate([codes, np.zeros(WINDOW, np.int64)])
    suffixes = _packed(padded[places[:, None] + np.arange(WINDOW)] * (np.arange(WINDOW) < reach[places, None]), bits)
    order = np.lexsort(suffixes.T[::-1])
    array, suffixes = places[order], suffixes[order]
    low = _lower(suffixes, _packed(block.windows, bits))
    full = np.where(np.arange(WINDOW) < block.sizes[:, None], block.windows, (1 << bits) - 1)
    # No word has the code of all ones. One more than the key itself ends the range of a window of full size.
    beyond = _packed(full, bits)
    beyond[:, -1] += 1
    high = _lower(suffixes, beyond)
    counts = np.maximum(high - low, 0)
    return array[W.spread(low, counts)], np.repeat(np.arange(len(counts)), counts)


def blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> list[Block]:
    """The benchmark in blocks of at most about ``limit`` bytes; their number grows with the benchmark alone."""
    texts = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // max(1, limit // 2)) or 1
    out = []
    for b in range(n):
        rows = texts.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).collect() if n > 1 else texts.collect()
        out.append(block_of([r.i for r in rows], [r.t for r in rows]))
    return out


def _found(part: pa.RecordBatch, text_col: str, held: list) -> tuple[W.Words, np.ndarray, list[list[str]]]:
    """Words of a slice, marks of hit words, and the sorted item ids of every row."""
    words = W.split(W.named(part, text_col), W.FOLDED)
    marks = np.zeros(len(words.codes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(part.num_rows)]
    for block in held:
        at, window = occurrences(words, block.value)
        size = block.value.sizes[window]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + size, -1)
        row = np.searchsorted(words.first, at, "right") - 1
        pairs = W.distinct(row << 32 | window)
        row, window = pairs >> 32, pairs & 0xFFFFFFFF
        counts = block.value.owner_first[window + 1] - block.value.owner_first[window]
        owner = block.value.owners[W.spread(block.value.owner_first[window], counts)]
        for r, i in zip(np.repeat(row, counts).tolist(), owner.tolist()):
            items[r].add(block.value.items[i])
    return words, np.cumsum(marks[:-1]) > 0, [sorted(s) for s in items]


def _broadcast(benchmark: DataFrame, item_col: str, text_col: str, limit: int = BLOCK_BYTES) -> list:
    return [benchmark.sparkSession.sparkContext.broadcast(b) for b in blocks(benchmark, item_col, text_col, limit)]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, items): the verdict on every document."""
    held = _broadcast(benchmark, item_col, "text", block_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            words, hit, items = _found(part, text_col, held)
            n, n_hit = np.diff(words.first), W.per_row(hit, words.first)
            yield pa.RecordBatch.from_arrays([
                W.named(part, id_col), pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(list(map(len, items)), pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
                pa.array((n_hit > 0) & (20 * n_hit >= n)), pa.array(items, pa.list_(pa.string())),
            ], [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_hit bigint, n_items bigint, "
                                                    "items_sha256 string, contaminated boolean, items array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item_id, doc_word, item_word, n_words): the longest verbatim matches that hold a window, with their places."""
    held = _broadcast(benchmark, item_col, "text", block_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            words = W.split(W.named(part, text_col), W.FOLDED)
            ids = W.named(part, id_col)
            for block in (b.value for b in held):
                at, window = occurrences(words, block)
                counts = block.owner_first[window + 1] - block.owner_first[window]
                spot = W.spread(block.owner_first[window], counts)
                at, size, place, owner = np.repeat(at, counts), np.repeat(block.sizes[window], counts), block.places[spot], block.owners[spot]
                order = np.lexsort((at, at - place, owner))
                at, size, place, owner = at[order], size[order], place[order], owner[order]
                row = np.searchsorted(words.first, at, "right") - 1
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
                begin = np.flatnonzero(new)
                length = np.diff(np.append(begin, len(at))) - 1 + size[begin]
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(row[begin])), pa.array([block.items[i] for i in owner[begin].tolist()], pa.string()),
                    pa.array(at[begin] - words.first[row[begin]], pa.int64()), pa.array(place[begin] - block.first[owner[begin]], pa.int64()),
                    pa.array(length, pa.int64()),
                ], [id_col, "item_id", "doc_word", "item_word", "n_words"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, item_id string, doc_word bigint, item_word bigint, n_words bigint")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    held = _broadcast(benchmark, item_col, "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            words, hit, _ = _found(part, text_col, held)
            n, n_hit = np.diff(words.first), W.per_row(hit, words.first)
            yield part.filter(pa.array((n_hit == 0) | (20 * n_hit < n)))

    return docs.mapInArrow(run, docs.schema)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT item_id, least(len(ws), 13) AS size, ws[i:i + least(len(ws), 13) - 1] AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
dw AS (SELECT doc_id, i, size, ws[i:i + size - 1] AS w FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes)),
hit AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN win ON dw.w = win.w),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, i + unnest(range(size)) AS p FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op3_decontaminate", SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every document holds benchmark passages."""
    docs, benchmark = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark).drop("items")
