"""Byte-level BPE with the tokenizers library over Arrow batches.

A rank file becomes a vocabulary and merges over a byte-to-character table. Texts are cut at places where the
splitting pattern always ends a match; each distinct stretch of a slice is encoded once by the library and its
ids are laid out again in the order of the text. Decoding looks ids up in the
reversed byte table, so that a character split over several ids comes back whole.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows keep their order within a task and
repeated rows are encoded each; columns other than id and text are neither read nor able to clash. Special
tokens in a text count as plain text.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from marquee.llm import words as W
from marquee.llm.registry import query

#: Distinct stretches after which a worker begins a new table of their ids; the one before is still looked up.
REMEMBERED = 200_000
#: Stretches given to the library at once.
ENCODED = 4096


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (chr(0x100 + i) for i in range(256))
    return [chr(b) if b in plain else next(rest) for b in range(256)]


def from_ranks(data: bytes, pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    """A tokenizer that merges as the rank file says: always the pair whose joint token has the lowest rank."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    chars = byte_characters()
    as_text = lambda token: "".join(chars[b] for b in token)
    merges = [
        (as_text(token[:i]), as_text(token[i:]))
        for token in sorted(ranks, key=ranks.__getitem__) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
    ]
    made = Tokenizer(models.BPE(vocab={as_text(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    made.decoder = decoders.ByteLevel()
    return made


class Codec:
    """Encodes and decodes slices of texts; one per worker process and vocabulary."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        self.tokenizer = Tokenizer.from_str(data.decode()) if data[:1] == b"{" else from_ranks(data)
        self.tokenizer.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        size = self.tokenizer.get_vocab_size()
        tokens: list[bytes] = [b""] * size
        for text, i in self.tokenizer.get_vocab().items():
            tokens[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
        self.size = size
        self.token_length = np.fromiter(map(len, tokens), np.int64, size)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        #: Ids as bytes: objects without references, which the garbage collector does not walk.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and where those of each text begin."""
        raw, offsets = W.text_bytes(column)
        data = np.frombuffer(raw, np.uint8)
        marks = _cuts(data)
        marks[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        begin = np.flatnonzero(marks)
        codes, distinct = W.encoded(W.packed(data, np.diff(begin, append=len(raw))))
        stretches = W.as_bytes(distinct)
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        ids = list(map(known.get, stretches))
        missing = [i for i, v in enumerate(ids) if v is None]
        new = []
        for i in missing:
            found = before.get(stretches[i])
            if found is None:
                new.append(i)
            else:
                ids[i] = known[stretches[i]] = found
        for at in range(0, len(new), ENCODED):
            some = new[at:at + ENCODED]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([stretches[i].decode() for i in some], add_special_tokens=False)):
                ids[i] = known[stretches[i]] = array("I", e.ids).tobytes()
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        each = counts[codes]
        out = flat[W.spread((np.cumsum(counts) - counts)[codes], each)]
        ends = np.concatenate([[0], np.cumsum(each)])
        return out, ends[np.searchsorted(begin, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ``ids``, and where those of each id begin."""
        length = self.token_length[ids]
        return self.token_bytes[W.spread(self.token_start[ids], length)], np.concatenate([[0], np.cumsum(length)])


def _cuts(data: np.ndarray) -> np.ndarray:
    """Marks places where a match of the splitting pattern surely ends, whatever follows.

    These are: a space or line break that stands alone between visible characters, the place after such a line
    break, and a mark of punctuation after a Latin letter. Only bytes are looked at, so characters whose lead byte is
    C2 or E1 to E3 count as neither visible nor letters, as some of them are white space.
    """
    cut = np.zeros(len(data), bool)
    if len(data) < 3:
        return cut
    ascii_visible = (data > 0x20) & (data < 0x7F)
    folded = data | 0x20
    letter = (folded >= 0x61) & (folded <= 0x7A) & (data < 0x7F)
    mark = ascii_visible & ~letter & ~((data >= 0x30) & (data <= 0x39))
    starts_visible = ascii_visible | ((data >= 0xC3) & (data <= 0xDF)) | (data >= 0xE4)
    second = np.zeros(len(data), bool)
    second[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    # C3 80 to C3 BF are letters but for the signs of multiplication and division.
    latin = np.zeros(len(data), bool)
    latin[1:] = second[1:] & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    ends_visible = ascii_visible | second
    alone = ends_visible[:-2] & starts_visible[2:]
    cut[1:-1] = alone & ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A))
    cut[2:] |= alone & (data[1:-1] == 0x0A)
    cut[1:] |= (letter[:-1] | latin[:-1]) & mark[1:]
    return cut


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    return Codec(data)


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast; such files hold a few MB."""
    data = Path(path).read_bytes()
    if len(data) > 64 << 20:
        raise ValueError(f"{path} is no vocabulary file: {len(data)} bytes")
    return spark.sparkContext.broadcast(data)


def _split_by(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids, starts, ends): token ids and the characters of the text that each covers, in code points.

    A token that holds part of a character covers that character. With ``decoded`` the ids of every text are decoded
    again, and one that does not give the bytes of its text ends the run with an error.
    """
    held = vocabulary(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(held.value)
        for part in W.slices(batches, text_col):
            texts = W.named(part, text_col)
            ids, bounds = use.encode(texts)
            raw, offsets = W.text_bytes(texts)
            if decoded:
                back, places = use.decode(ids)
                if not np.array_equal(places[bounds], offsets) or back.tobytes() != raw:
                    data, cut = back.tobytes(), places[bounds].tolist()
                    wrong = [i for i in range(part.num_rows) if data[cut[i]:cut[i + 1]] != raw[offsets[i]:offsets[i + 1]]]
                    raise ValueError(f"decoded ids differ from the text: {W.named(part, id_col).take(pa.array(wrong[:10], pa.int64())).to_pylist()}")
            seen = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
            at = np.concatenate([[0], np.cumsum(use.token_length[ids])])
            base = np.repeat(seen[offsets[:-1]], np.diff(bounds))
            starts, ends = seen[np.minimum(at[:-1] + 1, len(raw))] - 1 - base, seen[at[1:]] - base
            lists = [_split_by(pa.array(v, pa.int32()), bounds) for v in (ids, starts, ends)]
            yield pa.RecordBatch.from_arrays([W.named(part, id_col), *lists], [id_col, "ids", "starts", "ends"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) from the ``ids`` column of ``encode``; null ids give an empty text."""
    held = vocabulary(tokens.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(held.value)
        for batch in batches:
            texts = [use.decode(np.asarray(ids or [], np.int64))[0].tobytes().decode(errors="replace") for ids in W.named(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([W.named(batch, id_col), pa.array(texts, pa.string())], [id_col, "text"])

    return tokens.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each text, encoded and decoded again."""
    held = vocabulary(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(held.value)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for part in W.slices(batches, text_col):
            ids, bounds = use.encode(W.named(part, text_col))
            back, at = use.decode(ids)
            packed = memoryview(ids.astype("<u4").tobytes())
            plain, ends = memoryview(back.tobytes()), at[bounds].tolist()
            cut = (bounds * 4).tolist()
            yield pa.RecordBatch.from_arrays([
                W.named(part, id_col), pa.array(np.diff(bounds), pa.int64()),
                pa.array([sha(packed[a:b]) for a, b in zip(cut, cut[1:])], pa.string()),
                pa.array([sha(plain[a:b]) for a, b in zip(ends, ends[1:])], pa.string()),
            ], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
