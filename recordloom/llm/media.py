"""Media columns: payloads live in tar shards under their digest; rows carry digest, shard, offset and length, and metadata columns are filled by reading
the first bytes of a member only.

The medium is a PNG image of one row of 8-bit grey samples, a sample for each byte of the payload: lossless, compressed, and with width, height and depth in its first
HEADER bytes. Each writing task appends to its own shards and stores a payload once; of several tasks that met the same payload, the copy in the
first shard is the one that all rows refer to. A shard counts only once its rows are committed, so a task that is lost and run again leaves at
most an unused file.

Defined cases: a null text is an empty payload, which is 64 zero bytes; equal texts have equal digests, places and features; a null doc_id is kept; an
empty table writes no shard; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, stored

UNIT = 64
HEADER = 33
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SHARD_BYTES = 1 << 28
PLACED = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"


def payload_of(text: bytes | None) -> bytes:
    text = text or b""
    return text + bytes(max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    head = struct.pack(">IIBBBBB", len(payload), 1, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(b"\0" + payload, 6)) + _chunk(b"IEND", b"")


def png_header(first: bytes) -> tuple[int, int, int, int]:
    """width, height, bits of a sample, colour kind, from the first HEADER bytes."""
    if first[:8] != SIGNATURE or first[12:16] != b"IHDR":
        raise ValueError("no PNG image")
    return struct.unpack(">IIBB", first[16:26])


def from_png(data: bytes) -> bytes:
    width, height, depth, kind = png_header(data)
    if (height, depth, kind) != (1, 8, 0):
        raise ValueError("not a row of 8-bit grey samples")
    at, packed = 8, []
    while at < len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        if name == b"IDAT":
            packed.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    out = zlib.decompress(b"".join(packed))
    if out[:1] != b"\0" or len(out) != width + 1:
        raise ValueError("samples are missing")
    return out[1:]


class ShardWriter:
    """Members appended to tar files of about SHARD_BYTES each."""

    def __init__(self, folder: str, part: int):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.uri, self.part, self.n, self.out = folder, part, 0, None
        self.own = uuid.uuid4().hex[:12]

    def add(self, name: str, data: bytes) -> tuple[str, int, int]:
        """Shard, offset of the data, length."""
        if self.out is None:
            self.name = f"shard-{self.part:06d}-{self.n:04d}-{self.own}.tar"
            self.fs.create_dir(self.folder, recursive=True)
            self.out, self.at = self.fs.open_output_stream(f"{self.folder}/{self.name}"), 0
        info = tarfile.TarInfo(name)
        info.size = len(data)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        offset = self.at + len(head)
        fill = -len(data) % 512
        self.out.write(head + data + bytes(fill))
        self.at = offset + len(data) + fill
        place = (f"{self.uri}/{self.name}", offset, len(data))
        if self.at >= SHARD_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.out, self.n = None, self.n + 1


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, known = ShardWriter(folder, TaskContext.get().partitionId()), {}
        names = [x.split()[0] for x in PLACED.split(", ")]
        for batch in batches:
            rows = []
            for x in batch.column(1).cast(pa.binary()):
                text = x.as_py()
                payload = payload_of(text)
                key = hashlib.sha256(payload).digest()
                if key not in known:
                    image = to_png(payload)
                    digest = hashlib.sha256(image).hexdigest()
                    known[key] = (digest, *writer.add(f"{digest}.png", image))
                rows.append((len(text or b""), *known[key]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)
        writer.close()

    return run


def write_shards(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows, members): rows are doc_id, n_bytes, digest; members give the place of every digest, once."""
    placed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_written(folder), PLACED), "placed")
    members = placed.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")
    return placed.select("doc_id", "n_bytes", "digest"), members


class ShardReader:
    """Ranges of shards; the shard read last stays open."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            if self.file is not None:
                self.file.close()
            where, path = fs.FileSystem.from_uri(shard)
            self.name, self.file = shard, where.open_input_file(path)
        return self.file.read_at(length, offset)


def fill_metadata(members: DataFrame) -> DataFrame:
    """members with width, height, depth, from HEADER bytes of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader()
        for batch in batches:
            heads = [png_header(reader.read(s, o, HEADER)) for s, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            more = [pa.array([h[i] for h in heads], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *more], ["digest", "shard", "offset", "length", "width", "height", "depth"])

    near = members.select("digest", "shard", "offset", "length").repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    return near.mapInArrow(run, "digest string, shard string, offset long, length long, width long, height long, depth long")


READ = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_back(members: DataFrame) -> DataFrame:
    """Per digest, from the stored bytes: the payload's size and checksums, the image's, and the feature: image size, and counts of samples by their top two bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        reader, names = ShardReader(), [x.split()[0] for x in READ.split(", ")]
        for batch in batches:
            rows = []
            for shard, offset, length, width, height, depth in zip(*(batch.column(i).to_pylist() for i in range(1, 7)), strict=True):
                image = reader.read(shard, offset, length)
                payload = from_png(image)
                counts = np.bincount(np.frombuffer(payload, np.uint8) >> 6, minlength=4)
                feature = f"{width}x{height}x{depth}:" + ",".join(map(str, counts.tolist()))
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(image), hashlib.sha256(image).hexdigest(), feature))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return fill_metadata(members).mapInArrow(run, READ)


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, and what read_back() found for the document's digest."""
    rows, members = write_shards(docs, new_folder(docs.sparkSession, "media"))
    found = stored(read_back(members), "found")
    return rows.join(found, "digest").select("doc_id", "n_bytes", *[x.split()[0] for x in READ.split(", ")][1:])
