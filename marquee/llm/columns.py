"""Rows that share a key, met as streams: no key's rows are ever gathered in one place."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def runs_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in sorted columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def heads(cells: DataFrame) -> DataFrame:
    """The rows of ``cells`` (g, x, …) whose ``g`` occurs twice, each with the first row of its stretch as ``head_*``.

    Rows are dealt out by ranges of (g, x), so a very frequent ``g`` goes to several tasks as several stretches. A
    stretch that touches the end of a partition is always returned, also with one row.
    """
    names = cells.columns

    def close(table: pa.Table, carried: pa.Table | None, first: bool, last: bool) -> tuple[pa.Table, pa.Table | None, pa.Table]:
        """(head of the last run, rows held back, rows to return)."""
        g = table["g"].to_numpy()
        begin = runs_of(g)
        size = np.diff(np.append(begin, len(g)))
        top = table.take(pa.array(begin))
        known = carried is not None and carried["g"][0].as_py() == g[0]
        if known:
            top = pa.concat_tables([carried, top.slice(1)])
        keep = size > 1
        keep[0] |= known or first
        keep[-1] |= last
        at = np.flatnonzero(np.repeat(keep, size))
        which = pa.array(np.repeat(np.arange(len(begin)), size)[at])
        rows = table.take(pa.array(at))
        for n in names[1:]:
            rows = rows.append_column(f"head_{n}", top[n].take(which))
        # A single last row waits until it is known whether another one follows.
        return top.slice(len(begin) - 1), None if keep[-1] else table.slice(len(g) - 1), rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = carried = None
        first = True
        for batch in batches:
            if batch.num_rows:
                now = pa.Table.from_batches([batch])
                carried, held, rows = close(now if held is None else pa.concat_tables([held, now]), carried, first, last=False)
                first = False
                yield from rows.combine_chunks().to_batches()
        if held is not None:
            yield from close(held, carried, first=False, last=True)[2].combine_chunks().to_batches()

    kinds = dict(cells.dtypes)
    ranged = cells.repartitionByRange("g", "x").sortWithinPartitions("g", "x")
    return ranged.mapInArrow(run, ", ".join([f"{n} {kinds[n]}" for n in names] + [f"head_{n} {kinds[n]}" for n in names[1:]]))


def pairs_with_heads(shared: DataFrame) -> DataFrame:
    """From ``heads``: every row with its head, and the heads of later stretches of a key with the first one."""
    extra = [c for c in shared.columns if not c.startswith("head_") and c not in ("g", "x")]
    rows = shared.where("x <> head_x")
    tops = shared.select("g", *(F.col(f"head_{c}").alias(c) for c in ["x", *extra])).distinct()
    # One row per stretch: a key has more than one only where it crosses the end of a partition.
    low = tops.groupBy("g").agg(F.min("x").alias("head_x"), F.count("*").alias("n")).where("n > 1").select("g", "head_x")
    top = tops.select("g", F.col("x").alias("head_x"), *(F.col(c).alias(f"head_{c}") for c in extra))
    linked = tops.join(low, "g").where("x <> head_x").join(top, ["g", "head_x"])
    return rows.unionByName(linked.select(*rows.columns))


def pairs_with_first(shared: DataFrame) -> DataFrame:
    """From ``heads``: every row with the first row of its whole key, however many stretches the key has."""
    extra = [c for c in shared.columns if not c.startswith("head_") and c not in ("g", "x")]
    head = F.struct(*(F.col(f"head_{c}").alias(c) for c in ["x", *extra]))
    low = shared.groupBy("g").agg(F.min(head).alias("_low"), F.max(head).alias("_high")).where("_low <> _high").select("g", "_low")
    # A key has several stretches only where it crosses the end of a partition: one row per partition at most.
    met = shared.join(F.broadcast(low), "g", "left")
    firsts = [F.coalesce(f"_low.{c}", f"head_{c}").alias(f"head_{c}") for c in ["x", *extra]]
    return met.select("g", "x", *extra, *firsts).where("x <> head_x")


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of sorted rows cut so that no group is split; what is held back is one group at most."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        table = now if held is None else pa.concat_tables([held, now])
        cut = int(runs_of(*(table[k].to_numpy() for k in keys))[-1])
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if held is not None:
        yield held
