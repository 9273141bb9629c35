"""Connected components and text lookups for pairs of documents, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.session import materialize

#: Words of 64 bits in the filter of ``touched``: 2 MB, whatever the number of ids.
FILTER_WORDS = 1 << 18


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours go to its least neighbour, then its smaller ones too."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
    large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Alternates stars to the larger and to the smaller side until nothing changes. Each round is written to the
    shared folder, so no round is computed twice and none depends on a single executor.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), label)
    mark = _mark(now)
    while mark[0]:
        now = materialize(_stars(now), label)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _place(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return F.pmod(h, F.lit(FILTER_WORDS)), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")


def touched(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids`` (column ``id``), and a few more that the filter lets through.

    The ids become bits of a filter of fixed size, which alone is broadcast. With very many ids it lets more through,
    and the join that follows decides.
    """
    word, bit = _place(F.col("id"))
    held = ids.select(word.alias("_word"), F.expr("1").cast("long").alias("_one"), bit.alias("_bit"))
    held = held.groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", "_one", "_bit")).alias("_bits"))
    word, bit = _place(F.col(id_col))
    marked = docs.select("*", word.alias("_word"), bit.alias("_bit")).join(F.broadcast(held), "_word")
    return marked.where(F.call_function("shiftright", "_bits", "_bit").bitwiseAND(F.lit(1).cast("long")) == 1).drop("_word", "_bit", "_bits")


def with_texts(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``pairs`` (a, b, …) with the texts of both sides as ``text_a`` and ``text_b``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = touched(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "id", ids)
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
