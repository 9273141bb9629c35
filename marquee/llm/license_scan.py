"""Licence passages found through a positional index of rare licence words.

The index holds, for every word of the templates, the templates and positions it stands at. One pass over the
corpus counts in how many documents each licence word occurs; that gives the inverse document frequencies. In a
document the rarest words of each template are looked up, their postings are turned into relative positions (place
in the text minus place in the template), and positions that enough rare words agree on are verified: the words of
the template are compared in place, and its key phrase must stand there word for word.

A template of at most ``PHRASE`` words is its own key phrase and must stand whole. A longer one may differ in a
fifth of its words outside the key phrase.

Defined cases: a null or empty text has no words, no places, empty labels and score 0; an empty table gives no
rows; repeated rows are judged each; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import words as W
from marquee.llm.registry import query

ANCHORS = 3
PHRASE = 6
LEAST_SHARE = 0.8


class Template(NamedTuple):
    label: str
    text: str
    key: str = ""
    base: bool = False


#: The phrases and labels that count in any case, then passages of common licences.
TEMPLATES = [
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("epl", "eclipse public license"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("all-rights-reserved", "all rights reserved"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "permission to use copy modify and or distribute"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
             "license as published by the free software foundation", "under the terms of the gnu general public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
]


class Index(NamedTuple):
    vocabulary: pa.Array
    codes: list[np.ndarray]
    keys: list[np.ndarray]

    def anchors(self, counts: dict[str, int]) -> list[np.ndarray]:
        """Places of each template's rarest words, by how few documents hold them; ties go to the later place."""
        known = [counts.get(w.decode(), 0) for w in self.vocabulary.to_pylist()]
        return [np.array(sorted(range(len(c)), key=lambda i: (known[c[i] - 1], -i))[:ANCHORS]) for c in self.codes]


def index_of(templates: list[Template]) -> Index:
    """Word codes from 1 on of every template, and where its key phrase stands."""
    words = W.split(pa.array([t.text for t in templates], pa.string()), W.FOLDED)
    codes = [words.codes[a:b].astype(np.int64) + 1 for a, b in zip(words.first, words.first[1:])]
    keys = []
    for t, c in zip(templates, codes):
        at, size = 0, len(c)
        if len(c) > PHRASE:
            phrase, size = t.key.split(), len(t.key.split())
            at = next(i for i in range(len(c)) if t.text.split()[i:i + size] == phrase)
        keys.append(np.arange(at, at + size))
    return Index(words.vocabulary, codes, keys)


def licence_codes(words: W.Words, index: Index) -> np.ndarray:
    """The licence-word code of each word of a slice, 0 for others."""
    known = pc.index_in(words.vocabulary, value_set=index.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    return known[words.codes]


def word_counts(docs: DataFrame, index: Index, text_col: str = "text") -> dict[str, int]:
    """In how many documents each licence word stands; at most as many entries as the templates have words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.vocabulary) + 1, np.int64)
        for part in W.slices(batches, text_col):
            words = W.split(W.named(part, text_col), W.FOLDED)
            codes = licence_codes(words, index)
            at = np.flatnonzero(codes)
            row = np.searchsorted(words.first, at, "right") - 1
            total += np.bincount(W.distinct(row << 32 | codes[at]) & 0xFFFFFFFF, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in index.vocabulary.to_pylist()], pa.string()), pa.array(total[1:])], ["word", "n"])

    found = docs.select(text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in found.collect()}


def places(words: W.Words, codes: np.ndarray, template: np.ndarray, key: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, shares): where a template stands in a slice, and the share of its words that agree."""
    size = len(template)
    relative = [np.flatnonzero(codes == template[a]) - a for a in anchors]
    starts = np.sort(np.concatenate(relative))
    need = len(anchors) if size <= PHRASE else max(1, len(anchors) - 1)
    begin = np.flatnonzero(np.diff(starts, prepend=np.iinfo(np.int64).min) != 0)
    starts = starts[begin][np.diff(np.append(begin, len(starts))) >= need]
    # The key phrase has to lie inside one text; words of a longer template beyond the text's ends count as different.
    starts = starts[(starts + key[0] >= 0) & (starts + key[-1] < len(codes))]
    row = np.searchsorted(words.first, starts + key[0], "right") - 1
    inside = (starts[:, None] + np.arange(size) >= words.first[row, None]) & (starts[:, None] + np.arange(size) < words.first[row + 1, None])
    equal = inside & (codes[np.clip(starts[:, None] + np.arange(size), 0, max(len(codes) - 1, 0))] == template)
    share = equal.mean(1) if len(starts) else np.zeros(0)
    good = equal[:, key].all(1) & (share >= (1.0 if size <= PHRASE else LEAST_SHARE))
    return starts[good], share[good]


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, passages) of every document.

    ``passages`` lists (label, start, share) of everything found; the score is the largest share of a template's
    words that stand in place, 0 without a passage.
    """
    index = index_of(templates)
    anchors = index.anchors(word_counts(docs, index, text_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text_col):
            words = W.split(W.named(part, text_col), W.FOLDED)
            codes = licence_codes(words, index)
            n = part.num_rows
            n_base, low, high, score = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64), np.zeros(n)
            base: list[set[str]] = [set() for _ in range(n)]
            every: list[set[str]] = [set() for _ in range(n)]
            passages: list[list[dict]] = [[] for _ in range(n)]
            for t, template, key, own in zip(templates, index.codes, index.keys, anchors):
                at, share = places(words, codes, template, key, own)
                row = np.searchsorted(words.first, at + key[0], "right") - 1
                start = at - words.first[row]
                np.maximum.at(score, row, share)
                if t.base:
                    np.add.at(n_base, row, 1)
                    np.minimum.at(low, row, start)
                    np.maximum.at(high, row, start)
                for r, s, x in zip(row.tolist(), start.tolist(), share.tolist()):
                    every[r].add(t.label)
                    passages[r].append({"label": t.label, "start": s, "share": x})
                    if t.base:
                        base[r].add(t.label)
            absent = n_base == 0
            yield pa.RecordBatch.from_arrays([
                W.named(part, id_col), pa.array(np.diff(words.first), pa.int64()), pa.array(n_base), pa.array(low, mask=absent), pa.array(high, mask=absent),
                pa.array([",".join(sorted(s)) for s in base], pa.string()), pa.array([",".join(sorted(s)) for s in every], pa.string()), pa.array(score),
                pa.array(passages, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))),
            ], [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "passages"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                                    "base_labels string, labels string, score double, passages array<struct<label:string,start:bigint,share:double>>")


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("passages")
