"""Token counts by greedy longest match, in one linear walk per word and without building the pieces.

The vocabulary becomes a trie over bytes. For every trie node the table holds where to go on when no longer match
is possible (its failure link) and how many tokens are complete by then (its popped count), so a word's count is a
sum over one pass. A word that cannot be cut into tokens counts as one unknown token.

Words are [^\\x20\\x09-\\x0D]+ with A-Z lowered. Counts are made once per distinct word of a slice.

Defined cases: a null or empty text has no tokens; an empty table gives no rows; repeated rows are counted each;
columns other than id and text are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, words as W
from marquee.llm.registry import query

#: Stands after the last byte of a word.
END = 256
ROOT, UNKNOWN = 0, -1


def word_end_vocabulary(data: bytes, mark: str = "</w>") -> list[tuple[int, ...]]:
    """Tokens of a vocabulary file as byte sequences; the end mark of a token becomes END."""
    byte_of = {c: b for b, c in enumerate(bpe.byte_characters())}
    out = []
    for token in json.loads(data)["model"]["vocab"]:
        ends = token.endswith(mark)
        body = token.removesuffix(mark) if ends else token
        if all(c in byte_of for c in body) and (body or ends):
            out.append((*(byte_of[c] for c in body), *([END] if ends else [])))
    return out


class Automaton:
    """Trie with failure links and popped counts."""

    def __init__(self, tokens: Iterable[tuple[int, ...]]):
        self.next: dict[int, int] = {}
        complete = [False]
        parents: list[tuple[int, int]] = [(ROOT, 0)]
        depth = [0]
        for token in tokens:
            node = ROOT
            for symbol in token:
                edge = node << 9 | symbol
                if edge not in self.next:
                    self.next[edge] = len(complete)
                    parents.append((node, symbol))
                    complete.append(False)
                    depth.append(depth[node] + 1)
                node = self.next[edge]
            complete[node] = node != ROOT
        self.fail, self.popped = [UNKNOWN] * len(complete), [0] * len(complete)
        for node in sorted(range(1, len(complete)), key=depth.__getitem__):
            if complete[node]:
                # The whole path is a token: pop it and start anew.
                self.fail[node], self.popped[node] = ROOT, 1
                continue
            parent, symbol = parents[node]
            at, count = self.fail[parent], self.popped[parent]
            while at != UNKNOWN and (at << 9 | symbol) not in self.next:
                count += self.popped[at]
                at = self.fail[at]
            if at != UNKNOWN:
                self.fail[node], self.popped[node] = self.next[at << 9 | symbol], count

    def count(self, word: bytes) -> int:
        """Tokens of one word. Each step goes down an edge or up a failure link, so the walk is linear."""
        node, total = ROOT, 0
        step, fail, popped = self.next, self.fail, self.popped
        for symbol in (*word, END):
            while (to := step.get(node << 9 | symbol)) is None:
                total += popped[node]
                node = fail[node]
                if node == UNKNOWN:
                    return 1
            node = to
        while node != ROOT:
            total += popped[node]
            node = fail[node]
            if node == UNKNOWN:
                return 1
        return total


@lru_cache(maxsize=2)
def automaton(data: bytes) -> Automaton:
    return Automaton(word_end_vocabulary(data))


def count(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, longest_word_tokens) of every document."""
    held = bpe.vocabulary(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(held.value)
        for part in W.slices(batches, text_col):
            words = W.split(W.named(part, text_col), W.LOWERED)
            per_word = np.fromiter(map(machine.count, words.vocabulary.to_pylist()), np.int64, len(words.vocabulary))[words.codes]
            most = np.zeros(part.num_rows, np.int64)
            np.maximum.at(most, words.row(), per_word)
            yield pa.RecordBatch.from_arrays([W.named(part, id_col), pa.array(np.diff(words.first), pa.int64()), pa.array(W.per_row(per_word, words.first)), pa.array(most)],
                                             [id_col, "n_words", "n_tokens", "longest_word_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint, longest_word_tokens bigint")


@query("op7_piece_counts")
def op7_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy token counts of every document under the word-end vocabulary."""
    return count(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
