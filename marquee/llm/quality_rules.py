"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule. A
policy is a named, versioned mask over those bits, so that policies can be changed, compared and ablated
without reading a text again.

Defined cases: a null text has no words and fails the word minimum; an empty table gives an empty ledger;
repeated rows give repeated ledger rows; columns other than id and text are neither read nor able to clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.llm import words as W
from marquee.llm.registry import query

WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals"]
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))

#: Rule name -> test on the measurements; the bit of a rule is its place in this table.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "capitals": "100 * n_capitals > 30 * n_letters",
}


def mask(*names: str) -> int:
    """Bits of the named rules."""
    return sum(1 << list(RULES).index(n) for n in names)


class Policy(NamedTuple):
    name: str
    version: int
    mask: int


BASE = Policy("base", 1, mask("few_words", "repeated_words"))
STRICT = Policy("strict", 1, mask(*RULES))


def _repeats(words: W.Words) -> np.ndarray:
    """Marks words in windows that occur twice or more in their text."""
    marks = np.zeros(len(words.codes) + 1, np.int64)
    at = W.within(words.first, WINDOW)
    if len(at):
        row = (np.searchsorted(words.first, at, "right") - 1).astype(np.uint64)
        keys = W.runs(W.hashes(words.vocabulary)[words.codes], WINDOW)[at] ^ W.mixed(row + np.uint64(1))
        order = np.argsort(keys)
        same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
        again = at[np.union1d(order[same], order[same + 1])]
        np.add.at(marks, again, 1)
        np.add.at(marks, again + WINDOW, -1)
    return np.cumsum(marks[:-1]) > 0


def _lines(raw: bytes, offsets: np.ndarray, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines that hold a word, and those of them that equal an earlier line."""
    data = np.frombuffer(raw, np.uint8)
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    row = np.searchsorted(offsets, begin, "right") - 1
    # A break that ends a text opens an empty line at the place where the next text begins; sizes come from what follows.
    end = np.append(begin[1:], offsets[-1])
    size = end - begin - (data[np.maximum(end - 1, 0)] == 10) * (end > begin) if len(data) else end - begin
    held = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    codes, _ = W.encoded(W.packed(data[data != 10], size))
    row, codes = np.minimum(row, len(offsets) - 2)[held], codes[held].astype(np.int64)
    rows = len(offsets) - 1
    total = np.bincount(row, minlength=rows)
    distinct = np.unique(row.astype(np.int64) << 32 | codes) >> 32
    return total, total - np.bincount(distinct, minlength=rows)


def _measure(column: pa.Array) -> dict[str, np.ndarray]:
    raw, offsets = W.text_bytes(column)
    words = W.split(column, W.PLAIN)
    data = np.frombuffer(raw, np.uint8)
    points = (data & 0xC0) != 0x80
    spaces = ~W.PLAIN.inside[data]
    capital = (data >= 65) & (data <= 90)
    # Latin capitals beyond ASCII: a C3 byte, then 80 to 9E (without the multiplication sign).
    wide = np.zeros(len(data), bool)
    lead = np.zeros(len(data), bool)
    lead[1:] = data[:-1] == 0xC3
    wide[lead] = (data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)
    letter = capital | ((data >= 97) & (data <= 122)) | (points & (data >= 0xC0))
    n_lines, n_dup = _lines(raw, offsets, words)
    return {
        "n_words": np.diff(words.first),
        "word_chars": W.per_row(points & ~spaces, offsets),
        "n_symbols": W.per_row(_SYMBOL[data], offsets),
        "n_dup_lines": n_dup,
        "n_repeat_words": W.per_row(_repeats(words), words.first),
        "n_lines": n_lines,
        "n_letters": W.per_row(letter, offsets),
        "n_capitals": W.per_row(capital | wide, offsets),
    }


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, ``failed``): one row per document, bit ``i`` of ``failed`` set if rule ``i`` fails."""
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            found = _measure(W.named(part, text_col))
            yield pa.RecordBatch.from_arrays([W.named(part, id_col), *(pa.array(found[m], pa.int64()) for m in MEASURES)], [id_col, *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    measured = docs.select(id_col, text_col).mapInArrow(measure, f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    return measured.withColumn("failed", failed_bits())


def failed_bits() -> Column:
    bits = [F.when(F.expr(test), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, test in enumerate(RULES.values())]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(book: DataFrame, policies: list[Policy]) -> DataFrame:
    """(policy, version, rule, kept, kept_without): rows a policy keeps, and keeps if one of its rules is dropped.

    The ledger is counted once per distinct bit pattern; at most two to the number of rules are left after that.
    """
    cases = [(p.name, p.version, r, p.mask, p.mask & ~mask(r)) for p in policies for r in RULES if p.mask & mask(r)]
    table = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("policy", "version", "rule", "full", "rest"), c))) for c in cases))
    counts = book.groupBy("failed").agg(F.count("*").alias("n"))
    told = counts.select("failed", "n", F.explode(table).alias("c")).select("failed", "n", "c.*")
    kept = lambda m: F.sum(F.when(F.col("failed").bitwiseAND(F.col(m).cast("long")) == 0, F.col("n")).otherwise(0))
    return told.groupBy("policy", "version", "rule").agg(kept("full").alias("kept"), kept("rest").alias("kept_without"))


def keep(docs: DataFrame, policy: Policy = STRICT, text_col: str = "text") -> DataFrame:
    """The documents a policy keeps, with all their columns."""
    tests = [test for i, test in enumerate(RULES.values()) if policy.mask >> i & 1]

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            # The tests are plain arithmetic over the measurements and read the same in SQL and here.
            found = _measure(W.named(part, text_col))
            failed = np.zeros(part.num_rows, bool)
            for test in tests:
                failed |= eval(test, {"__builtins__": {}}, found)
            yield part.filter(pa.array(~failed))

    return docs.mapInArrow(choose, docs.schema)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i:i + 4] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest(range(5)) AS p FROM r) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
    length(regexp_replace(t, '[^A-Za-z\x{00C0}-\x{10FFFF}]', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^A-Z\x{00C0}-\x{00D6}\x{00D8}-\x{00DE}]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 3 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 12 * n_words THEN 16 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 30 * n_letters THEN 64 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""


@query("op2_quality_rules", SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, base verdict and the strict policy's verdict of every document."""
    book = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return book.select("doc_id", *MEASURES[:5], (~passes(BASE)).alias("base_failed"), passes(STRICT).alias("kept"), "failed")
