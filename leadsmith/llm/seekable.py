"""Token ids in zstandard files of independent frames with a trailing seek table.

A file holds documents in ascending id order.  Every document is a zstandard frame of its
ids (little-endian unsigned 32-bit; a document of more than ``FRAME_IDS`` ids spans several
frames, one without ids has none).  A skippable frame with the document index follows (ids,
lengths, first frames), then the seek table of the published seekable format: compressed and
decompressed size and the low 32 bits of the content's XXH64 for every frame.  Any zstandard
reader can decompress the file; ours opens the tail, finds the frames of the documents asked
for and decompresses and checks only those.

Writing: one range partitioning by id, then one streaming pass that encodes and writes a
file per partition (several, if it is large) into the shared folder.  A retried task writes another file, and only
files named in the manifest count.  Tokens before a file are a running sum over the
manifest, one row per file.

Defined results: a null text is empty and holds the end id alone; rows with equal ids are
all written, ordered by the hash of their text; a null id comes first; empty input gives no
file and no row; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadsmith.llm.common import shared_folder
from leadsmith.llm.tokens import tokenizer

FRAME_IDS = 1 << 20
#: A task starts another file after so many documents or ids, so that a file's index stays small.
FILE_DOCS, FILE_IDS = 1 << 20, 1 << 28
# fixed values of the seekable format
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Stands for a null id in the document index.
NO_ID = -2**63


def filesystem(uri: str):
    """(file system, path) of a folder or file URI, for any store pyarrow reaches."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class Writer:
    """Writes documents one after another; nothing but the index is held."""

    def __init__(self, out, level: int = 3):
        self.out, self.compressor = out, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames, self.docs = array("I"), array("q")  # three numbers each
        self.n_docs = self.n_frames = self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.extend((NO_ID if doc_id is None else doc_id, len(ids) // 4, self.n_frames))
        self.n_docs, self.n_ids = self.n_docs + 1, self.n_ids + len(ids) // 4
        for at in range(0, len(ids), 4 * FRAME_IDS):
            raw = ids[at:at + 4 * FRAME_IDS]
            packed = self.compressor.compress(raw)
            self.out.write(packed)
            self.frames.extend((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.n_frames += 1

    def close(self) -> None:
        index = struct.pack("<Q", self.n_docs) + np.array(self.docs, "<i8").reshape(-1, 3).T.tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.frames.extend((len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = np.array(self.frames, "<u4").reshape(-1, 3)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, table.nbytes + 9) + table.tobytes()
                       + struct.pack("<IBI", len(table), CHECKSUM_FLAG, SEEK_MAGIC))


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source, self.decompressor = source, zstandard.ZstdDecompressor()
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        self.table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(-1, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        index = self._at(int(self.starts[n - 1]), int(self.table[n - 1, 0]))[8:]
        count = struct.unpack("<Q", index[:8])[0]
        self.ids, self.lengths, self.first = np.frombuffer(index[8:], "<i8").reshape(3, count)

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def document(self, i: int) -> bytes:
        """Ids of the i-th document of the file, from its frames alone."""
        last = self.first[i] + -(-int(self.lengths[i]) // FRAME_IDS)
        out = []
        for f in range(int(self.first[i]), int(last)):
            raw = self.decompressor.decompress(self._at(int(self.starts[f]), int(self.table[f, 0])))
            if len(raw) != self.table[f, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[f, 2]:
                raise ValueError(f"frame {f} does not match its checksum")
            out.append(raw)
        return b"".join(out)


MANIFEST = "part int, seq int, path string, n_docs long, n_ids long, first_id long, last_id long"


def write(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = 1, files: int | None = None,
          id_col: str = "doc_id", text_col: str = "text", file_docs: int = FILE_DOCS, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode and write all documents; the manifest, one row per file, with the ids before each file."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = int(end_id).to_bytes(4, "little")
    keyed = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    ordered = keyed.repartitionByRange(files, "i", "h").sortWithinPartitions("i", "h").drop("h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        out = writer = None
        seq, task = 0, TaskContext.get().partitionId()

        def closed() -> pd.DataFrame:
            writer.close()
            out.close()
            own = writer.docs[::3]
            return pd.DataFrame([(task, seq, path if folder.startswith(("/", "file:")) else f"{folder}/{path.rsplit('/', 1)[1]}",
                                  writer.n_docs, writer.n_ids, own[0], own[-1])],
                                columns=["part", "seq", "path", "n_docs", "n_ids", "first_id", "last_id"])
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                if writer is None and len(part):
                    store, path = filesystem(f"{folder}/{uuid.uuid4().hex}.ids.zst")
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(path, compression=None)
                    writer = Writer(out)
                for i, ids in zip(part["i"], tokenizer(vocabulary, "word").encode(list(part["t"]))):
                    writer.add(None if pd.isna(i) else int(i), ids + end)
                if writer and (writer.n_docs >= file_docs or writer.n_ids >= file_ids):
                    yield closed()
                    seq, writer = seq + 1, None
        if writer:
            yield closed()
    rows = sorted(map(tuple, ordered.mapInPandas(run, MANIFEST).collect()))
    before, out = 0, []
    for r in rows:
        out.append((*r, before))
        before += r[4]
    return spark.createDataFrame(out, MANIFEST + ", ids_before long")


def read(spark: SparkSession, manifest: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of all documents or of those asked for."""
    some = None if wanted is None else np.unique(np.fromiter(wanted, np.int64))
    if some is not None:
        near = F.lit(False) if not len(some) else (F.col("first_id") <= int(some[-1])) & (F.col("last_id") >= int(some[0]))
        manifest = manifest.where(near)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                store, path = filesystem(r.path)
                with store.open_input_file(path) as source:
                    f = Reader(source)
                    start = r.ids_before + np.concatenate([[0], np.cumsum(f.lengths)])
                    at = np.arange(len(f.ids)) if some is None else np.flatnonzero(np.isin(f.ids, some))
                    for group in np.array_split(at, max(1, -(-len(at) // 256))):
                        yield pd.DataFrame({"doc_id": pd.array([None if f.ids[i] == NO_ID else int(f.ids[i]) for i in group], "Int64"),
                                            "start": start[group], "n_tokens": f.lengths[group], "ids": [f.document(int(i)) for i in group]})
    spread = manifest.repartition(max(1, manifest.count()))  # a file a task
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def written_and_read(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files read back."""
    return read(docs.sparkSession, write(docs, vocabulary)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
