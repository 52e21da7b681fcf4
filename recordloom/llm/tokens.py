"""Token ids as a compact binary stream: canonical Huffman codes of limited length from the counts of the whole corpus, written in segments that decode
alone, with a bit offset for every STRIDE ids. A segment is a row of a Parquet folder: (part, seq) order it, doc_ids and n_tokens say what it
holds, points has the bit offsets, bits the codes. The code book is a table of (id, length); canonical codes follow from the lengths.

Defined cases: a null text is an empty text, which is the end id alone; a null doc_id comes first; equal ids are ordered by the texts' checksums, and
equal rows give equal ids; an empty table writes no segment and an empty code book; further columns are ignored. A long text is one
segment of many blocks, so that only the text itself bounds memory.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, stored

END_ID = 0
SEGMENT = 1 << 17
STRIDE = 256
MAX_BITS = 16
#: The pattern by which byte-level BPE cuts a text, for texts of SAFE characters only, where Python's classes agree with Unicode's.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNSAFE = re.compile("[^\t\n\r -~\u00a0-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u024f]")
PLAIN = b"\t\n\r" + bytes(range(32, 127))  # what is safe of ASCII
SPECIAL = "<|endoftext|>"
#: A space before a space or a line's end, and these others anywhere, belong to a run that is cut as a whole.
MARKS = tuple(".,;:!?")
LOOSE = ("  ", " \n", "\t", "\r", "\u00a0")


def byte_letters() -> str:
    """The letters by which byte-level vocabularies write the 256 bytes: printable Latin-1 characters stand for themselves, the others for characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return "".join(chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256))


class WordCache:
    """Ids of whole texts from the tokenizers library, which is asked once for each distinct piece. A text is cut at its spaces; a unit, the space with what follows it, is
    encoded with other new units in one call, a line each. Merges reach across neither a space nor a line's end, so the ids are those of the whole text. Units of letters are one
    piece each, so the library's model gets them without its search for pieces."""

    MOST = 700_000

    def __init__(self, path: str, dtype: type):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.encoder, self.dtype = Tokenizer.from_file(path), dtype
        self.byte_letters = byte_letters()
        model = Tokenizer.from_file(path).model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # each word comes once
        self.of_letters = Tokenizer(model)  # no merge joins a letter and a line's end, as the vocabulary's own pieces part them; lines() counts the ends
        self.of_letters.pre_tokenizer = pre_tokenizers.Split(self.byte_letters[10], "merged_with_previous")
        self.units: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.marks = dict(zip(MARKS, self.whole(list(MARKS)), strict=True))
        self.line_end = self.encoder.encode("\n", add_special_tokens=False).ids

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def lines(self, texts: list[str], letters: bool = False) -> list[bytes]:
        """Ids of each text, none of which holds a line's end or begins or ends a run of spaces. letters: each is letters alone, behind a space at most."""
        out: list[bytes] = []
        encoder = self.of_letters if letters else self.encoder
        for i in range(0, len(texts), 2000):
            group = texts[i : i + 2000]
            joined = "\n".join(group) + "\n"
            if letters:
                joined = codecs.charmap_decode(joined.encode(), "strict", self.byte_letters)[0]
            ids = np.array(encoder.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(ids == self.line_end[0])
            if len(self.line_end) != 1 or len(ends) != len(group):
                out.extend(self.whole(group))
                continue
            raw, size = ids.tobytes(), ids.itemsize
            ends = (ends * size).tolist()
            out.extend([raw[a:b] for a, b in zip([0, *(e + size for e in ends[:-1])], ends, strict=True)])
        return out

    def of_pieces(self, texts: list[str]) -> list[bytes]:
        """Texts of safe characters, piece by piece."""
        found = [PIECES.findall(x) for x in texts]
        new = {p for x in found for p in x}.difference(self.pieces)
        kinds: tuple[list[str], list[str], list[str]] = ([], [], [])
        for p in new:
            kinds[0 if p.lstrip(" ").isalpha() else 2 if p.isspace() else 1].append(p)
        self.pieces.update(zip(kinds[0], self.lines(kinds[0], letters=True), strict=True))
        self.pieces.update(zip(kinds[1], self.lines(kinds[1]), strict=True))
        self.pieces.update(zip(kinds[2], self.whole(kinds[2]), strict=True))
        known = self.pieces.__getitem__
        return [b"".join(map(known, x)) for x in found]

    def learn(self, new: set[str]) -> None:
        """Ids of new units: letters; letters with a mark behind them, which is a piece of its own; anything else of one line; what holds a line's end."""
        letters, marked, lines, broken = set(), [], [], []
        for u in new:
            if u.isalpha():
                letters.add(u)
            elif u[-1:] in self.marks and u[:-1].isalpha():
                marked.append(u)
            elif "\n" in u:
                broken.append(u)
            else:
                lines.append(u)
        letters.update([u[:-1] for u in marked])
        stems = list(letters.difference(self.units))
        units, mark = self.units, self.marks
        units.update(zip(stems, self.lines([" " + u for u in stems], letters=True), strict=True))
        for u in marked:
            units[u] = units[u[:-1]] + mark[u[-1]]
        units.update(zip(lines, self.lines([" " + u for u in lines]), strict=True))
        units.update(zip(broken, self.of_pieces([" " + u for u in broken]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.units) > self.MOST:
            self.units = {"": b""}
        if len(self.pieces) > self.MOST // 4:
            self.pieces.clear()
        out: list[bytes | None] = [None] * len(texts)
        cut: dict[int, list[str]] = {}
        loose: list[int] = []
        for i, x in enumerate(texts):
            if SPECIAL in x or (x.encode().translate(None, PLAIN) if x.isascii() else UNSAFE.search(x)):
                continue
            if x[-1:] == " " or any(c in x for c in LOOSE):
                loose.append(i)
            else:
                cut[i] = x.split(" ")
        firsts = self.of_pieces([x[0] for x in cut.values()])
        met: set[str] = set()
        for x in cut.values():
            x[0] = ""  # the first has no space before it; no other unit is empty, as runs of spaces are loose
            met.update(x)
        self.learn(met.difference(self.units))
        unit = self.units.__getitem__
        for (i, x), first in zip(cut.items(), firsts, strict=True):
            out[i] = first + b"".join(map(unit, x))
        for i, ids in zip(loose, self.of_pieces([texts[i] for i in loose]), strict=True):
            out[i] = ids
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.whole([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out  # type: ignore[return-value]


@functools.lru_cache(1)
def word_cache(path: str, dtype: type) -> WordCache:
    """One for each Python worker, which keeps it from task to task."""
    return WordCache(path, dtype)


RAW = "part int, seq int, first long, doc_ids array<bigint>, n_tokens array<bigint>, ids binary"
WRITTEN = "part int, seq int, first long, doc_ids array<bigint>, n_tokens array<bigint>, points binary, bits binary"


def _tokenised(path: str, wide: bool):
    dtype = np.uint32 if wide else np.uint16
    end = np.array([END_ID], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path, dtype)
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        ids, counts, blobs, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([first], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())), pa.array([b"".join(blobs)], pa.binary()),
            ], [x.split()[0] for x in RAW.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [(x or b"").decode("utf-8", "replace") for x in some.column(1).cast(pa.binary()).to_pylist()]
                for doc_id, blob in zip(some.column(0).to_pylist(), cache.encode(texts), strict=True):
                    ids.append(doc_id)
                    blobs.append(blob + end)
                    counts.append(len(blobs[-1]) // dtype().itemsize)
                    held += counts[-1]
                    if held >= SEGMENT:
                        yield segment()
                        first, seq, ids, counts, blobs, held = first + held, seq + 1, [], [], [], 0
        if ids:
            yield segment()

    return run


def tokenised(docs: DataFrame, path: str, wide: bool = False) -> DataFrame:
    """Segments of raw ids in ascending order of doc_id: (part, seq) is that order. wide: for vocabularies of over 65,536 ids."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("c"), F.monotonically_increasing_id().alias("at"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("c"), F.col("at")]  # at: many equal rows are dealt to many tasks
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(_tokenised(path, wide), RAW)


def id_counts(segments: DataFrame, wide: bool = False) -> list[tuple[int, int]]:
    """(id, count) over all segments; as many as the vocabulary has at most."""
    dtype = np.uint32 if wide else np.uint16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0):
                n = np.bincount(np.frombuffer(x.as_py(), dtype))
                if len(n) > len(total):
                    n[: len(total)] += total
                    total = n
                else:
                    total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    return sorted((r[0], r[1]) for r in segments.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n")).collect())


def code_lengths(counts: list[tuple[int, int]], most: int = MAX_BITS) -> dict[int, int]:
    """Lengths of the best prefix code of which none is over most bits, by package-merge; ties go by id."""
    by_count = sorted(counts, key=lambda x: (x[1], x[0]))
    n = len(by_count)
    if n <= 1:
        return {i: 1 for i, _ in by_count}
    if n > 1 << most:
        raise ValueError(f"{n} ids don't fit into codes of {most} bits")
    weight = np.array([c for _, c in by_count], np.int64)
    kinds, items = [], weight
    single = np.ones(n, bool)
    for _ in range(most - 1):
        kinds.append(single)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        order = np.argsort(both, kind="stable")
        items, single = both[order], order < n
    kinds.append(single)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for single in reversed(kinds):
        k = int(single[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    return {i: int(b) for (i, _), b in zip(by_count, lengths, strict=True)}


class Codes:
    """Canonical codes of some lengths: shorter codes first, equal lengths by id."""

    def __init__(self, lengths: dict[int, int]):
        top = max(lengths, default=0) + 1
        self.length, self.code = np.zeros(top, np.uint64), np.zeros(top, np.uint64)
        self.table = np.zeros(1 << MAX_BITS, np.int64)  # the next MAX_BITS bits -> id * 32 + length
        code = last = at = 0
        for bits, i in sorted((b, i) for i, b in lengths.items()):
            code, last = code << (bits - last), bits
            self.code[i], self.length[i] = code, bits
            span = 1 << (MAX_BITS - bits)
            self.table[at : at + span] = i * 32 + bits
            at += span
            code += 1

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Bit offsets of every STRIDE-th id, and the bits, in words of 32 bits with the first bit on top."""
        bits = self.length[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        word, shift = (starts >> np.uint64(5)).astype(np.int64), starts & np.uint64(31)
        value = self.code[ids] << (np.uint64(64) - shift - bits)
        n = int(ends[-1] + np.uint64(31)) // 32 if len(ids) else 0
        words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n + 1)[: n + 1]  # bits don't overlap, so sums are exact
        words[1:] += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 2)[1 : n + 1]
        return starts[::STRIDE].astype(np.uint64), words[:n].astype(np.uint32).astype(">u4").tobytes()

    def decode(self, points: np.ndarray, bits: bytes, n: int, first: int = 0) -> np.ndarray:
        """The n ids from the block first on; blocks of STRIDE ids are read side by side, each from its own bit offset."""
        words = np.concatenate([np.frombuffer(bits, ">u4").astype(np.uint64), np.zeros(2, np.uint64)])
        pair = (words[:-1] << np.uint64(32)) | words[1:]
        at = points[first : first + -(-n // STRIDE)].astype(np.int64)
        out = np.empty((len(at), STRIDE), np.int64)
        last = len(pair) - 1
        for i in range(STRIDE):
            if i == n - (len(at) - 1) * STRIDE and len(at):  # the last block has ended
                at = at[:-1]
            if not len(at):
                break
            got = self.table[((pair[np.minimum(at >> 5, last)] >> (np.uint64(64 - MAX_BITS) - (at & 31).astype(np.uint64))) & np.uint64((1 << MAX_BITS) - 1)).astype(np.int64)]
            out[: len(at), i] = got >> 5
            at = at + (got & 31)
        return out.reshape(-1)[:n]


def encoded(segments: DataFrame, lengths: dict[int, int], wide: bool = False) -> DataFrame:
    dtype = np.uint32 if wide else np.uint16
    book = segments.sparkSession.sparkContext.broadcast(lengths)  # of the vocabulary's size at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(book.value)
        for batch in batches:
            for i in range(batch.num_rows):
                points, bits = codes.encode(np.frombuffer(batch.column(5)[i].as_py(), dtype))
                kept = [batch.column(c).slice(i, 1) for c in range(5)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([points.astype("<u8").tobytes()], pa.binary()), pa.array([bits], pa.binary())], [x.split()[0] for x in WRITTEN.split(", ")])

    return segments.mapInArrow(run, WRITTEN)


def write_stream(docs: DataFrame, path: str, folder: str, wide: bool = False) -> None:
    """Writes folder/segments and folder/codes."""
    spark = docs.sparkSession
    raw = stored(tokenised(docs, path, wide), "ids")
    lengths = code_lengths(id_counts(raw, wide))
    encoded(raw, lengths, wide).write.option("compression", "none").parquet(f"{folder}/segments")
    spark.createDataFrame(sorted(lengths.items()), "id int, length int").coalesce(1).write.parquet(f"{folder}/codes")


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the written files: doc_id, start, n_tokens, ids_crc32, and the ids if asked for. Starts of parts are sums of the parts before,
    one number a part."""
    segments = spark.read.schema(WRITTEN).parquet(f"{folder}/segments")
    lengths = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/codes").collect()}
    sums = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    base, at = {}, 0
    for part, n in sorted((r[0], r[1]) for r in segments.groupBy("part").agg(F.sum(sums)).collect()):
        base[part], at = at, at + n
    shared = spark.sparkContext.broadcast((lengths, base))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, parts = Codes(shared.value[0]), shared.value[1]
        for batch in batches:
            for i in range(batch.num_rows):
                part, _, first, doc_ids, counts, points, bits = (batch.column(c)[i].as_py() for c in range(7))
                n = np.array(counts, np.int64)
                ends = np.cumsum(n)
                ids = codes.decode(np.frombuffer(points, "<u8"), bits, int(ends[-1]))
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), counts, strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(ends - n + first + parts[part], pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array(np.split(ids, ends[:-1]), pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return segments.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, wide: bool = False) -> DataFrame:
    folder = new_folder(docs.sparkSession, "stream")
    write_stream(docs, path, folder, wide)
    return read_documents(docs.sparkSession, folder)
