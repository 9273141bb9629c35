"""Token ids in files of independent zstandard frames with a seek table at the end.

A file holds whole documents in ascending id order: data frames first, then two skippable frames, the document
directory and the seek table. The table follows the public seekable format: compressed and decompressed size and
a checksum for every frame, closed by a footer of fixed size. A reader fetches the tail, then decompresses only
the frames of the documents it is asked for, and checks each against its checksum.

Files are written under a name of their own attempt and then moved to the final name, so a lost or repeated task
leaves a whole file or none. Folders are reached through ``pyarrow.fs`` by the scheme of their address.

Defined cases: a null or empty text is a document that holds the end id alone; equal ids stand in the order of
their texts; a null id comes first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marquee.llm import bpe, words as W
from marquee.llm.registry import query
from marquee.session import materialize, scratch_path

#: Fixed values of the seekable format: skippable-frame mark, footer mark, descriptor for "with checksums".
SKIPPABLE, SEEKABLE, CHECKED = 0x184D2A5E, 0x8F92EAB1, 0x80
DIRECTORY = 0x184D2A50
ENTRY, FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
FRAME_IDS = 1 << 16
END_ID = 0


class Frame(NamedTuple):
    at: int
    size: int
    plain: int
    check: int


class Writer:
    """Collects documents and writes a frame whenever enough ids have come together."""

    def __init__(self, out, width: int):
        self.out, self.kind = out, np.dtype("<u2") if width <= 1 << 16 else np.dtype("<u4")
        self.squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.lengths: list[np.ndarray] = []
        self.per_frame: list[int] = []
        self.held: list[np.ndarray] = []
        self.held_sizes: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append documents: their ids one after another, and how many each has."""
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            to = min(len(sizes), int(np.searchsorted(ends, done + FRAME_IDS - self.n_held)) + 1)
            self.held.append(ids[done:ends[to - 1]])
            self.held_sizes.append(sizes[at:to])
            self.n_held += int(ends[to - 1] - done)
            at = to
            if self.n_held >= FRAME_IDS:
                self.flush()

    def flush(self) -> None:
        if not self.held_sizes:
            return
        plain = np.concatenate(self.held).astype(self.kind).tobytes()
        small = self.squeeze.compress(plain)
        self.out.write(small)
        self.frames.append((len(small), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.lengths.extend(self.held_sizes)
        self.per_frame.append(sum(map(len, self.held_sizes)))
        self.held, self.held_sizes, self.n_held = [], [], 0

    def close(self) -> None:
        self.flush()
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0)
        told = self.squeeze.compress(struct.pack("<BII", self.kind.itemsize, len(self.per_frame), len(lengths))
                                     + np.asarray(self.per_frame, "<u4").tobytes() + lengths.astype("<u4").tobytes())
        self.out.write(struct.pack("<II", DIRECTORY, len(told)) + told)
        table = b"".join(ENTRY.pack(*f) for f in self.frames)
        # The directory counts as a frame of no content, so that places in the file still add up.
        table += ENTRY.pack(len(told) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER.size) + table + FOOTER.pack(len(self.frames) + 1, CHECKED, SEEKABLE))


class Reader:
    """Documents of one file by their place in it."""

    def __init__(self, source):
        self.source = source
        self.expand = zstandard.ZstdDecompressor()
        size = source.size()
        count, flags, mark = FOOTER.unpack(self._fetch(size - FOOTER.size, FOOTER.size))
        if mark != SEEKABLE or flags != CHECKED:
            raise ValueError("no seek table at the end of the file")
        table = self._fetch(size - FOOTER.size - count * ENTRY.size, count * ENTRY.size)
        entries = [ENTRY.unpack_from(table, i * ENTRY.size) for i in range(count)]
        places = np.concatenate([[0], np.cumsum([e[0] for e in entries])]).tolist()
        self.frames = [Frame(p, *e) for p, e in zip(places, entries[:-1])]
        told = self.expand.decompress(self._fetch(places[-2], entries[-1][0])[8:])
        width, n_frames, n_docs = struct.unpack_from("<BII", told)
        self.kind = np.dtype(f"<u{width}")
        self.per_frame = np.frombuffer(told, "<u4", n_frames, 9).astype(np.int64)
        self.lengths = np.frombuffer(told, "<u4", n_docs, 9 + 4 * n_frames).astype(np.int64)

    def _fetch(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def frame(self, i: int) -> np.ndarray:
        f = self.frames[i]
        plain = self.expand.decompress(self._fetch(f.at, f.size), max_output_size=f.plain)
        if len(plain) != f.plain or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != f.check:
            raise ValueError(f"frame {i} fails its checksum")
        return np.frombuffer(plain, self.kind)

    def document(self, place: int) -> np.ndarray:
        """Ids of one document; decompresses its frame only."""
        ends = np.cumsum(self.per_frame)
        i = int(np.searchsorted(ends, place, "right"))
        first = ends[i] - self.per_frame[i]
        at = int(self.lengths[first:place].sum())
        return self.frame(i)[at:at + int(self.lengths[place])]


def write(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of ``docs`` below ``folder``; returns (file, part, doc_ids, n_tokens), a row per written batch.

    Rows are dealt out by ranges of the id before they are encoded, so a file holds a stretch of the ids and the
    names of the files follow their order.
    """
    held = bpe.vocabulary(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = bpe.codec(held.value)
        context = TaskContext.get()
        number = context.partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        name = f"shard-{number:06d}.zst"
        own = f"{root}/.{name}.{context.taskAttemptId()}"
        store.create_dir(root, recursive=True)
        rows = 0
        with store.open_output_stream(own) as out:
            writer = Writer(out, use.size)
            for part in W.slices(batches, text_col):
                ids, bounds = use.encode(W.named(part, text_col))
                ids, sizes = np.insert(ids, bounds[1:], END_ID), np.diff(bounds) + 1
                writer.add(ids, sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * part.num_rows, pa.string()), pa.array(np.full(part.num_rows, number), pa.int32()),
                    pa.array(np.arange(rows, rows + part.num_rows), pa.int64()), W.named(part, id_col), pa.array(sizes, pa.int64()),
                ], ["file", "part", "place", id_col, "n_tokens"])
                rows += part.num_rows
            writer.close()
        if store.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:  # an earlier attempt's whole file
            store.delete_file(f"{root}/{name}")
        store.move(own, f"{root}/{name}")

    kind = docs.schema[id_col].dataType.simpleString()
    dealt = docs.select(id_col, text_col).repartitionByRange(id_col).sortWithinPartitions(id_col, text_col)
    return dealt.mapInArrow(run, f"file string, part int, place bigint, `{id_col}` {kind}, n_tokens bigint")


def read(index: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files, read back frame by frame.

    ``index`` is what ``write`` returned, stored. Rows of one file come together by a shuffle of (file, place, id).
    """
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    starts = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        reader, name, frame, ids, at, place = None, None, -1, None, 0, 0
        for batch in batches:
            out = []
            for file, wanted in zip(W.named(batch, "file").to_pylist(), W.named(batch, "place").to_pylist()):
                if file != name:
                    if reader is not None:
                        reader.source.close()
                    reader, name, frame, place = Reader(store.open_input_file(f"{root}/{file}")), file, -1, -1
                    ends, bounds = np.cumsum(reader.per_frame).tolist(), np.concatenate([[0], np.cumsum(reader.lengths)])
                i = frame if frame >= 0 and ends[frame] - reader.per_frame[frame] <= wanted < ends[frame] else int(np.searchsorted(ends, wanted, "right"))
                if i != frame:
                    frame, ids, at = i, reader.frame(i), int(bounds[ends[i] - reader.per_frame[i]])
                own = ids[int(bounds[wanted]) - at:int(bounds[wanted + 1]) - at]
                out.append((int(bounds[wanted]), len(own), zlib.crc32(own.astype("<u4").tobytes())))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([W.named(batch, "part"), W.named(batch, id_col), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["part", id_col, "inside", "n_tokens", "ids_crc32"])

    kind = index.schema[id_col].dataType.simpleString()
    placed = index.select("file", "part", "place", id_col).repartition("file").sortWithinPartitions("file", "place")
    found = placed.mapInArrow(run, f"part int, `{id_col}` {kind}, inside bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(starts, "part").select(id_col, (F.col("inside") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, size and checksum as read back from the written files."""
    folder = scratch_path(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = materialize(write(docs, folder, public_tokenizers.path("byte_bpe_50k.json")), "token-index")
    return read(index, folder)
