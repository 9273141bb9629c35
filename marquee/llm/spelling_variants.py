"""Spelling variants: words one edit apart, found by pivotal bigram prefixes, and each word's more common form.

Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lowered (one run in 199 by a crc32 of its
document and text loses one code point, as the contract fixes), kept with at least 6 code points and 5 occurrences.

Candidate search (edit distance one, bigrams): bigrams are ordered by how often they occur in the word list
(rarest first, then by text; at most 90 x 90 of them, so the order table is small by construction). A word's
prefix is its first three positional bigrams in that order, widened to every occurrence of a bigram ranked no
later than the third; its two pivots are disjoint bigrams of the prefix of least total frequency, chosen by
dynamic programming. One edit destroys at most one of two disjoint bigrams, so a word within one edit of ``r``
holds a pivot of ``r`` at a position shifted by at most one; of the two words, the one whose prefix ends no later
in the order has that pivot in the other's prefix. The edit lies wholly on one side of that pivot, so the text from the
word's other end through the pivot is the same in both. Joining every pivot against every prefix on (a hash of that text,
length within one) therefore yields every near pair, and ``levenshtein`` verifies each candidate.

Defined cases: null texts have no runs; a null doc_id keeps its runs unchanged (no crc32 is defined for it);
empty tables give no rows; repeated rows count each; runs of any length are read whole. A word with no near word
has n_near 0, no form, and itself as root. Forms only point to words of at least five times the count, so
following them ends; the root is found by repeated joins, as many as the longest chain. Word tables grow with the
documents and are compact as files, so no join broadcasts one. Columns other than id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marquee.llm.registry import query
from marquee.session import materialize

# Fixed values of the contract.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY, MIN_LENGTH, MIN_COUNT, FORM_RATIO = 199, 6, 5, 5
#: Edits allowed, gram length, and so the prefix length q * edits + 1 and the number of pivots edits + 1.
EDITS, Q = 1, 2
PREFIX, PIVOTS = Q * EDITS + 1, EDITS + 1


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of every word of at least MIN_LENGTH code points and MIN_COUNT occurrences."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(LETTERS), 0)).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.select("run", F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run"))).alias("h"))
    word = F.when(F.col("h") % DROP_EVERY == 0, F.concat(F.expr("substring(run, 1, CAST(h % char_length(run) AS INT))"),
                                                         F.expr("substring(run, CAST(h % char_length(run) AS INT) + 2)"))).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).where(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def gram_order(words: DataFrame) -> DataFrame:
    """(g, rank): bigrams by rising frequency over the word list, ties by text."""
    grams = words.select(F.explode(F.expr("transform(sequence(0, char_length(word) - 2), i -> substring(word, i + 1, 2))")).alias("g"))
    counted = grams.groupBy("g").agg(F.count("*").alias("f"))
    # At most 90 x 90 bigrams exist over the alphabet, so one ordering task is bounded.
    return counted.select("g", "f", F.row_number().over(Window.orderBy("f", "g")).alias("rank"))


def pivots(ranked: list[tuple[int, int, int]], count: int = PIVOTS, width: int = Q) -> list[tuple[int, int, int]]:
    """``count`` pairwise disjoint grams of least total frequency among ``ranked`` ((freq, rank, pos) each).

    Dynamic programme over the grams in position order: ``best[j][c]`` is the cheapest choice of ``c`` grams
    among the first ``j + 1`` that uses gram ``j`` last.
    """
    grams = sorted(ranked, key=lambda t: t[2])
    inf = (float("inf"), ())
    best = [[inf] * (count + 1) for _ in grams]
    for j, (f, r, p) in enumerate(grams):
        best[j][1] = ((f, r), (j,))
        for c in range(2, count + 1):
            for i in range(j):
                if grams[i][2] + width <= p and best[i][c - 1][0] != float("inf"):
                    cost = (best[i][c - 1][0][0] + f, best[i][c - 1][0][1] + r)
                    if best[j][c][0] == float("inf") or cost < best[j][c][0]:
                        best[j][c] = (cost, best[i][c - 1][1] + (j,))
    options = [b[count] for b in best if b[count][0] != float("inf")]
    return [grams[j] for j in min(options)[1]] if options else []


def signatures(words: DataFrame, order: DataFrame) -> DataFrame:
    """(word, kind, g, p, len): the widened prefix ('x') and the pivots ('v') of every word."""
    table = {r["g"]: (r["f"], r["rank"]) for r in order.collect()}  # bounded: at most 8,100 bigrams
    held = words.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for b in batches:
            out: dict[str, list] = {"word": [], "kind": [], "g": [], "p": [], "len": []}
            for w in b.column(0).to_pylist():
                grams = [(*known[w[i:i + Q]], i) for i in range(len(w) - Q + 1)]
                first = sorted(grams, key=lambda t: (t[1], t[2]))[:PREFIX]
                last = first[-1][1]
                prefix = [t for t in grams if t[1] <= last]
                for kind, chosen in (("x", prefix), ("v", pivots(first))):
                    for f, r, p in chosen:
                        out["word"].append(w)
                        out["kind"].append(kind)
                        out["g"].append(w[p:p + Q])
                        out["p"].append(p)
                        out["len"].append(len(w))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("word", pa.string()), ("kind", pa.string()), ("g", pa.string()), ("p", pa.int32()), ("len", pa.int32())]))

    return words.select("word").mapInArrow(run, "word string, kind string, g string, p int, len int")


def candidates(sig: DataFrame) -> DataFrame:
    """(a, b): distinct words that may be one edit apart, from their signatures; every near pair in one order at least."""
    # The edit lies wholly right or wholly left of a pivot that outlives it: the text on its other side, pivot included, stays.
    sides = F.explode(F.array(F.xxhash64(F.lit("head"), F.expr(f"left(word, p + {Q})")), F.xxhash64(F.lit("tail"), F.expr("substring(word, p + 1)")))).alias("side")
    piv = sig.where("kind = 'v'").select(F.col("word").alias("a"), "len", sides)
    pre = sig.where("kind = 'x'").select(F.col("word").alias("b"), F.col("len").alias("size"), sides)
    pre = pre.select("b", "side", F.explode(F.sequence(F.col("size") - EDITS, F.col("size") + EDITS)).alias("len"))
    # Sizes are told before the rows are exploded, so neither side is left to the planner to broadcast.
    return piv.hint("merge").join(pre, ["side", "len"]).where("a <> b").select("a", "b").distinct()


def near_pairs(words: DataFrame, label: str = "variants") -> DataFrame:
    """(a, b) for every ordered pair of distinct words one insertion, deletion or replacement apart."""
    found = candidates(materialize(signatures(words, gram_order(words)), label))
    close = found.where(F.levenshtein("a", "b", EDITS) == EDITS)
    both = close.unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    return materialize(both, label)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "variants") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every counted word."""
    words = materialize(word_counts(docs, id_col, text_col), label)
    pairs = near_pairs(words, label)
    partner = pairs.hint("merge").join(words.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b")
    best = partner.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct(F.negative("nb").alias("m"), F.col("b").alias("b"))).alias("best"))
    table = words.hint("merge").join(best.withColumnRenamed("a", "word"), "word", "left")
    strong = F.col("best").isNotNull() & (-F.col("best.m") >= FORM_RATIO * F.col("n"))
    table = table.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(strong, F.col("best.b")).alias("form"), F.when(strong, -F.col("best.m")).cast("long").alias("form_n"))
    table = materialize(table, label)
    forms = table.where("form IS NOT NULL").select(F.col("word").alias("root"), F.col("form").alias("up"))
    roots = table.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        stepped = roots.hint("merge").join(forms, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved"))
        stepped = materialize(stepped, label)
        if not stepped.where("moved").limit(1).count():
            break
        roots = stepped.select("word", "root")
    return table.hint("merge").join(stepped.select("word", "root"), "word").select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every counted word of all documents with its near words, more common form and root."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
