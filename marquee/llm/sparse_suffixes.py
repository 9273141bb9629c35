"""Verbatim repeats with a sparse suffix array over all documents.

Only suffixes at content-selected (minimiser) positions are kept, so a repeated passage keeps the same ones in every
document. They are sorted over the whole corpus by their first DEPTH words, then by the words to their left, then by
document; within the array every suffix is compared with its nearest neighbour of another document and with the first
suffix that begins alike, and a match of the first DEPTH words is extended to the left and right on the texts until a
word differs. Suffixes and left contexts are
sorted as 64-bit hashes, which puts equal ones side by side just as their words would.

Any repeat of at least MIN_WORDS words holds a kept suffix with DEPTH words to go. Many documents can begin alike there, and
which of them stand side by side says nothing of words beyond the two contexts. So windows of MIN_WORDS words around such
suffixes that lie in no repeat found so are linked to the first document with the same whole window: any stretch of so many
words that an earlier document holds is found, however many documents share a part of it.

The array is split by ranges of the
full sort order, so a passage that very many documents share is spread over tasks; the last and first rows of adjoining
parts are compared as well.

Words are [^\\x20\\x09-\\x0D]+ with A-Z lowered. A repeat belongs to the larger id of a pair and names the smaller one.

Defined cases: null and empty texts have no repeats; repeats inside one document are not looked for; a repeated id is
one document; a null id is left out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marquee.llm import columns, graph, words as W
from marquee.llm.registry import query
from marquee.session import materialize

MIN_WORDS = 50
#: Words of the k-mers that select positions, k-mers of a window, and words by which suffixes are sorted.
K, WINDOW, DEPTH = 8, 24, 26
LEFT = 24
#: What pairs a suffix with another one, or tells that nothing before it begins alike.
NEAREST, FIRST, LONE = -1, -2, -3
#: More words than a text can have.
FAR = 1 << 33


def suffixes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(g, left, x, pos): kept suffixes with the hash of their first DEPTH words and of the LEFT words before them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            words = W.split(W.named(part, text_col), W.LOWERED)
            hashed = W.hashes(words.vocabulary)[words.codes]
            at = W.minimisers(words.first, hashed, K, WINDOW)
            row = np.searchsorted(words.first, at, "right") - 1
            whole = at + DEPTH <= words.first[row + 1]
            at, row = at[whole], row[whole]
            # Left contexts cut short by the head of a text differ from whole ones by their size.
            before = np.minimum(at - words.first[row], LEFT)
            behind = np.concatenate([np.zeros(LEFT, np.uint64), hashed])
            left = np.zeros(len(at), np.uint64)
            for i in range(1, LEFT + 1):
                left = np.where(i <= before, (left ^ behind[at + LEFT - i]) * np.uint64(0x9E3779B97F4A7C15), left)
                left ^= left >> np.uint64(29)
            yield pa.RecordBatch.from_arrays([
                pa.array(W.runs(hashed, DEPTH)[at].view(np.int64)), pa.array(W.mixed(left ^ before.astype(np.uint64)).view(np.int64)),
                W.named(part, id_col).take(pa.array(row)), pa.array(at - words.first[row], pa.int32()),
            ], ["g", "left", "x", "pos"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).where(F.col(id_col).isNotNull()).mapInArrow(run, f"g bigint, left bigint, x {kind}, pos int")


def neighbours(array: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(x, pos, y, at) and (g, x, pos).

    First each suffix with others before it in the array that begin alike in another document: the nearest and the first;
    then every suffix that begins as another one does, and a few more.
    """
    kind = dict(array.dtypes)["x"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the last row of another document before the current run of one document, and that run's first
        carried = None  # the first row of the current run of equal beginnings
        ends = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            table = now if held is None else pa.concat_tables([held, now])
            skip = 0 if held is None else len(held)
            ends = [ends[0] if ends else now.slice(0, 1), now.slice(len(now) - 1)]
            g, x = table["g"].to_numpy(), table["x"].to_numpy()
            begin = columns.runs_of(g, x)
            start = np.repeat(begin, np.diff(np.append(begin, len(g))))
            own = np.arange(skip, len(g))
            other = start[own] - 1
            good = (other >= 0) & (g[other] == g[own])
            alike = columns.runs_of(g)
            top = table.take(pa.array(alike))
            if carried is not None and carried["g"][0].as_py() == g[0]:
                top = pa.concat_tables([carried, top.slice(1)])
            which = np.repeat(np.arange(len(alike)), np.diff(np.append(alike, len(g))))[own]
            heads = top.take(pa.array(which))
            apart = np.flatnonzero((heads["x"].to_numpy() != x[own]) & ~(good & (other == alike[which])))
            carried = top.slice(len(alike) - 1)
            # What begins a stretch has none before it; the last stretch of a batch can go on in the next one.
            size = np.diff(np.append(alike, len(g)))
            size[-1] += 1
            lone = table.take(pa.array(own[~good & (size[which] > 1)]))
            pairs = ((NEAREST, table.take(pa.array(own[good])), table.take(pa.array(other[good]))), (FIRST, table.take(pa.array(own[apart])), heads.take(pa.array(apart))), (LONE, lone, lone))
            for tag, mine, theirs in pairs:
                found = pa.Table.from_arrays([mine["x"], mine["pos"], theirs["x"], theirs["pos"], mine["g"], pa.array(np.full(len(mine), tag), pa.int32())],
                                             ["x", "pos", "y", "at", "g", "edge"])
                yield from found.combine_chunks().to_batches()
            keep = sorted({max(int(begin[-1]) - 1, 0), int(begin[-1])})
            held = table.take(pa.array(keep))
        for i, row in enumerate(ends):
            yield from pa.Table.from_arrays([row["x"], row["pos"], row["x"], row["pos"], row["g"], pa.array([2 * part + i], pa.int32())],
                                            ["x", "pos", "y", "at", "g", "edge"]).combine_chunks().to_batches()

    ranged = array.repartitionByRange("g", "left", "x", "pos").sortWithinPartitions("g", "left", "x", "pos")
    met = materialize(ranged.mapInArrow(run, f"x {kind}, pos int, y {kind}, at int, g bigint, edge int"), "suffix-neighbours")
    # Two rows for each part of the array.
    order = Window.orderBy("edge")
    seams = met.where("edge >= 0").select("x", "pos", "g", *(F.lag(c).over(order).alias(n) for c, n in (("x", "y"), ("pos", "at"), ("g", "before"))))
    pairs = met.where(F.col("edge").isin(NEAREST, FIRST)).select("x", "pos", "y", "at").unionByName(seams.where("g = before and x <> y").select("x", "pos", "y", "at"))
    return pairs, met.where(f"edge <> {FIRST}").select("g", "x", "pos")


def _rows(lists: pa.ListArray) -> np.ndarray:
    """The row of each value of the flattened lists; null counts as empty."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())


def open_windows(alike: DataFrame, found: DataFrame, docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(g, x, pos): windows of ``min_words`` words outside the repeats ``found``, around suffixes that begin alike.

    The first document with a window has no earlier one, so no repeat of its own covers it there: windows inside repeats
    can be left out on both sides.
    """
    kind = dict(alike.dtypes)["x"]
    reach = min_words - DEPTH
    end = F.col("start") + F.col("n_words")
    spans = found.groupBy(F.col(id_col).alias("x")).agg(F.collect_list(F.struct("start", end.alias("end"), F.col("to_end").alias("last"))).alias("spans"))

    def outside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, known = W.named(batch, "places"), W.named(batch, "spans")
            row, at = _rows(places), places.flatten()
            pos, span = at.field("pos").to_numpy().astype(np.int64), known.flatten()
            begin, ends = span.field("start").to_numpy().astype(np.int64), span.field("end").to_numpy().astype(np.int64)
            ends = np.where(span.field("last").to_numpy(zero_copy_only=False), FAR - 1, ends)
            # Rows lie FAR apart on one axis; of the spans that begin early enough, the one that ends last decides.
            base = _rows(known) * FAR
            order = np.argsort(base + begin)
            begin, ends = (base + begin)[order], np.maximum.accumulate((base + ends)[order])
            before = np.searchsorted(begin, row * FAR + np.maximum(pos - reach, 0), "right")
            reached = np.concatenate([[-1], ends])[before]
            keep = pa.array(np.flatnonzero(reached < row * FAR + pos + min_words))
            yield pa.RecordBatch.from_arrays([at.field("g").take(keep), W.named(batch, "x").take(pa.array(row)).take(keep), at.field("pos").take(keep)], ["g", "x", "pos"])

    # One row for each document: its spans are met once, not by every suffix.
    listed = alike.groupBy("x").agg(F.collect_list(F.struct("g", "pos")).alias("places")).join(spans, "x", "left")
    outside = materialize(listed.mapInArrow(outside, f"g bigint, x {kind}, pos int"), "suffix-open")
    lists = columns.heads(outside).groupBy("x").agg(F.collect_set("pos").alias("at"))
    held = materialize(lists.join(spans, "x", "left").select(F.col("x").alias("id"), "at", "spans"), "suffix-open-documents")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            words = W.split(W.named(part, text_col), W.LOWERED)
            hashed = W.hashes(words.vocabulary)[words.codes]
            marked = np.zeros(len(words.codes) + 1, np.int64)
            covered = marked.copy()
            for i, (places, known) in enumerate(zip(W.named(part, "_at"), W.named(part, "_spans").to_pylist())):
                low, high = int(words.first[i]), int(words.first[i + 1]) - min_words
                at = places.values.to_numpy() + low
                first, last = np.maximum(at - reach, low), np.minimum(at, high)
                np.add.at(marked, first[first <= last], 1)
                np.add.at(marked, last[first <= last] + 1, -1)
                for v in known or ():
                    first, last = v["start"] + low, min(v["end"] + low - min_words, high)
                    if first <= last:
                        covered[first] += 1
                        covered[last + 1] -= 1
            at = np.flatnonzero((np.cumsum(marked[:-1]) > 0) & (np.cumsum(covered[:-1]) == 0))
            row = np.searchsorted(words.first, at, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(W.runs(hashed, min_words)[at].view(np.int64)), W.named(part, "_x").take(pa.array(row)), pa.array(at - words.first[row], pa.int32())], ["g", "x", "pos"])

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    texts = graph.touched(named, "id", held.select("id")).join(held, "id")
    return texts.select(F.col("id").alias("_x"), F.col("text").alias(text_col), F.col("at").alias("_at"), F.col("spans").alias("_spans")).mapInArrow(run, f"g bigint, x {kind}, pos int")


def maximal(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(start in x, start in y, words) of the longest matches through the given places, one for each."""
    out = set()
    for d in np.unique(p - q).tolist():
        low, high = max(0, d), min(len(x), len(y) + d)
        on = p[p - q == d] - low
        on = on[(on >= 0) & (on < high - low)]
        differ = np.concatenate([[-1], np.flatnonzero(x[low:high] != y[low - d:high - d]), [max(0, high - low)]])
        i = np.searchsorted(differ, on)
        for a, b in set(zip((differ[i - 1] + 1).tolist(), differ[i].tolist())):
            if b - a >= min_words:
                out.add((a + low, a + low - d, b - a))
    return sorted(out)


def ahead(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """As ``maximal`` in order of the places, but a place inside a match that an earlier one gave adds none.

    A text of one repeated word has as many diagonals as places.
    """
    out, reached = [], 0
    for at in np.lexsort((q, p)).tolist():
        if p[at] + min_words > reached:
            found = maximal(x, y, p[at:at + 1], q[at:at + 1], min_words)
            out += found
            reached = max([reached, *(s + n for s, _, n in found)])
    return sorted(set(out))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, start, n_words, other_id, other_start): verbatim repeats of at least ``min_words`` words."""
    # Ranges are sampled in a pass of their own, so what they divide is written first.
    pairs, alike = neighbours(materialize(suffixes(docs, id_col, text_col), "suffix-array"))
    first = materialize(matched(pairs, docs, id_col, text_col, min_words, maximal), "suffix-repeats")
    windows = materialize(open_windows(alike, first, docs, id_col, text_col, min_words), "suffix-open-windows")
    windows = materialize(columns.heads(windows), "suffix-windows")
    pairs = columns.pairs_with_first(windows).select("x", "pos", F.col("head_x").alias("y"), F.col("head_pos").alias("at"))
    return first.unionByName(matched(pairs, docs, id_col, text_col, min_words, ahead)).drop("to_end")


def matched(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, min_words: int, pick: Callable) -> DataFrame:
    """The repeats through the places (x, pos, y, at) that ``pick`` takes, and whether they go on to the end of the text."""
    forward = F.col("x") > F.col("y")
    turned = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"), F.when(forward, F.struct("pos", F.col("at").alias("q")))
                          .otherwise(F.struct(F.col("at").alias("pos"), F.col("pos").alias("q"))).alias("place"))
    # At most as many places as a document has words.
    found = materialize(turned.groupBy("a", "b").agg(F.collect_set("place").alias("places")), "suffix-pairs")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, "text_a", W.SLICE_BYTES // 2, "text_b"):
            # Pairs that share a document stand together; its text is cut into words once.
            (at_a, texts_a), (at_b, texts_b) = (W.once(W.named(part, c)) for c in ("text_a", "text_b"))
            a, b = W.split(texts_a, W.LOWERED), W.split(texts_b, W.LOWERED)
            left, right = W.hashes(a.vocabulary)[a.codes], W.hashes(b.vocabulary)[b.codes]
            places = W.named(part, "places")
            place, bounds = places.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy())]).tolist()
            ps, qs = (place.field(n).to_numpy().astype(np.int64) for n in ("pos", "q"))
            out = []
            for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                p, q = ps[lo:hi], qs[lo:hi]
                x = left[a.first[at_a[i]]:a.first[at_a[i] + 1]]
                for s, t, n in pick(x, right[b.first[at_b[i]]:b.first[at_b[i] + 1]], p, q, min_words):
                    out.append((i, s, n, t, s + n == len(x)))
            cols = [np.array(c, np.int64) for c in zip(*out)] or [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([W.named(part, "a").take(pa.array(cols[0])), pa.array(cols[1]), pa.array(cols[2]), W.named(part, "b").take(pa.array(cols[0])), pa.array(cols[3]), pa.array(cols[4] > 0)],
                                             [id_col, "start", "n_words", "other_id", "other_start", "to_end"])

    texts = graph.with_texts(found, docs.where(F.col(id_col).isNotNull()), id_col, text_col).select("a", "b", "places", "text_a", "text_b")
    return texts.mapInArrow(run, f"`{id_col}` {kind}, start bigint, n_words bigint, other_id {kind}, other_start bigint, to_end boolean")


@query("op8_sparse_suffixes")
def op8_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim repeats of 50 words and more between documents."""
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
