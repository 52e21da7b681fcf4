"""SentencePiece encoding and decoding by a Viterbi pass that words share. The distinct marked words of a batch are sorted, which is the order of a
depth-first walk of their trie; the forward values of a prefix stay on a stack, and a word starts where it leaves the word before it.

For a unigram model the forward value of a position is the best sum of scores up to it. The scores of a merge (BPE) model don't add up: there, the
forward value is the last piece of the prefix's encoding. It is unique, and pieces follow each other in an encoding exactly if the merges of the
two alone give the two, so one pass over the prefixes gives the model's own result.

Defined cases: a null text is an empty text and has no ids; a mark (U+2581) in a text is a space, as in the public library, so it decodes to a space and
round_trip is false; characters outside the vocabulary become bytes; repeated rows give equal rows; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"


class Model:
    """Pieces and scores of a model file. merges: a BPE model."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], merges: bool = True, unknown: int = 0):
        self.pieces, self.byte_ids, self.merges, self.unknown = pieces, byte_ids, merges, unknown
        self.longest = max(map(len, pieces), default=1)
        inside = {c for p in pieces if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a mark behind a letter; words can't be encoded by themselves")
        bars = "".join(c for c in "\n\t\r" if c not in inside)
        self.bars = re.compile(f"([{re.escape(bars)}])") if bars else None  # characters that no merge reaches across
        self.heads = {p[:i] for p in pieces for i in range(1, len(p) + 1)}
        self.steps: dict[str, tuple[str, list[tuple[str, int, dict[str, bool]]]]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}  # by the second piece, then the first; "": at a word's start
        self.n_pairs = 0
        self.stored: dict[str, bytes] = {}
        self.floor = min((s for _, s in pieces.values()), default=0.0) - 10

    @classmethod
    def load(cls, path: str) -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, {}
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[sp.id_to_piece(i)] = (i, sp.get_score(i))
        ranked = all(float(s).is_integer() for _, s in pieces.values())  # merge models score pieces by their rank, unigram models by a log probability
        return cls(pieces, byte_ids, merges=ranked, unknown=sp.unk_id())

    def merged(self, text: str) -> list[str]:
        """Best pair first, leftmost of equals, until no pair is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                x = self.pieces.get(parts[i] + parts[i + 1])
                if x and (best is None or x[1] > best):
                    best, at = x[1], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: str, b: str, known: dict[str, bool]) -> bool:
        """Whether b comes next to a, or at the start where a is empty; remembered in known."""
        if self.n_pairs > 1_000_000:
            self.n_pairs = 0
            for x in self.pairs.values():
                x.clear()
        self.n_pairs += 1
        out = known[a] = self.merged(a + b) == ([a, b] if a else [b])
        return out

    def step(self, seen: str) -> tuple[str, list[tuple[str, int, dict[str, bool]]]]:
        """The longest end of seen that begins a piece, and the pieces that seen ends with, the longest first and the last character in any case, with their lengths and what is known
        to stand before them. The start of a word's step holds what may yet become a piece, so that no other beginning is looked at."""
        if len(self.steps) > 500_000:
            self.steps.clear()
        at = 0
        while at < len(seen) and seen[at:] not in self.heads:
            at += 1
        ends = [seen[i:] for i in range(at, len(seen)) if seen[i:] in self.pieces]
        if not ends or len(ends[-1]) > 1:
            ends.append(seen[-1])
        out = self.steps[seen] = seen[at:], [(t, len(t), self.pairs.setdefault(t, {})) for t in ends]
        return out

    def ids(self, piece: str) -> list[int]:
        x = self.pieces.get(piece)
        if x:
            return [x[0]]
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]

    def packed(self, pieces: list[str]) -> bytes:
        """The ids of pieces, as 32-bit integers."""
        try:
            return b"".join([self.stored[p] for p in pieces])
        except KeyError:
            self.stored.update({p: np.array(self.ids(p), np.int32).tobytes() for p in pieces})
            return b"".join([self.stored[p] for p in pieces])


def encode_sorted(model: Model, words: list[str]) -> list[list[str]]:
    """Pieces of each of the sorted words."""
    out: list[list[str]] = []
    last: list[str] = [""]  # last[i]: the last piece of the best encoding of the first i characters
    score: list[float] = [0.0]
    state: list[str] = [""]  # state[i]: the longest end of the first i characters that begins a piece
    before, pieces, steps, step, follows = "", model.pieces, model.steps, model.step, model.follows
    for word in words:
        n, same = len(word), 0
        while same < n and same < len(before) and word[same] == before[same]:
            same += 1
        del last[same + 1 :], score[same + 1 :], state[same + 1 :]
        now = state[same]
        for i in range(same + 1, n + 1):
            seen = now + word[i - 1]
            now, ends = steps.get(seen) or step(seen)
            state.append(now)
            if model.merges:
                for t, size, known in ends:
                    a = last[i - size]
                    fits = known.get(a)
                    if fits is None:
                        fits = follows(a, t, known)
                    if fits:
                        break
                last.append(t)
                score.append(0.0)
            else:
                best, piece = float("-inf"), ""
                for t, size, _ in ends:
                    x = pieces.get(t)
                    s = score[i - size] + (x[1] if x else model.floor)
                    if s > best:
                        best, piece = s, t
                last.append(piece)
                score.append(best)
        at, parts = n, []
        while at:
            parts.append(last[at])
            at -= len(last[at])
        out.append(parts[::-1])
        before = word
    return out


class Encoder:
    """Ids of texts; words met before are looked up, new ones go through the shared pass together."""

    MOST = 700_000

    def __init__(self, model: Model):
        self.model = model
        self.words: dict[str, bytes] = {}  # by the word without its mark

    def learn(self, words: set[str]) -> None:
        bars = self.model.bars
        cut = {w: [x for x in bars.split(MARK + w) if x] for w in words if bars.search(w)} if bars else {}
        new = {MARK + w for w in words if w not in cut}
        new.update(p for x in cut.values() for p in x)
        new = sorted(new)
        packed = self.model.packed
        ids = {p: packed(pieces) for p, pieces in zip(new, encode_sorted(self.model, new), strict=True)}
        for w in words:
            self.words[w] = b"".join([ids[p] for p in cut[w]]) if w in cut else ids[MARK + w]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.MOST:
            self.words.clear()
        cut = []
        for x in texts:
            if not x:
                cut.append([])
            elif MARK in x or "  " in x or x[0] == " " or x[-1] == " ":
                cut.append([w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + x.replace(" ", MARK))])
            else:
                cut.append(x.split(" "))
        met = set()
        for x in cut:
            met.update(x)
        self.learn({w for w in met if w not in self.words})
        word = self.words.__getitem__
        return [b"".join(map(word, x)) for x in cut]


class Decoder:
    def __init__(self, model: Model):
        size = 1 + max([model.unknown, *(i for i, _ in model.pieces.values()), *model.byte_ids.values()])
        self.bytes = [b""] * size
        self.bytes[model.unknown] = " ⁇ ".encode()
        for p, (i, _) in model.pieces.items():
            self.bytes[i] = p.replace(MARK, " ").encode()
        for b, i in model.byte_ids.items():
            self.bytes[i] = bytes([b])

    def decode(self, ids: np.ndarray) -> bytes:
        out = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return out[1:] if out[:1] == b" " else out  # the mark before the first word


@functools.lru_cache(2)
def coders(path: str) -> tuple[Encoder, Decoder]:
    """One pair for each Python worker, which keeps what it has learned from task to task."""
    model = Model.load(path)
    return Encoder(model), Decoder(model)


SCHEMA = "doc_id long, n_pieces long, ids array<int>, decoded_crc32 long, round_trip boolean"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, their number, the checksum of the bytes that the ids decode to, and whether those are the text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coders(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                raw = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
                ids = [np.frombuffer(x, np.int32) for x in encoder.encode([x.decode("utf-8", "replace") for x in raw])]
                back = [decoder.decode(x) for x in ids]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([zlib.crc32(x) for x in back], pa.int64()), pa.array([x == y for x, y in zip(back, raw, strict=True)], pa.bool_()),
                ], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def decode_documents(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = coders(path)[1]
        for batch in batches:
            texts = [decoder.decode(np.array(x.as_py() or [], np.int32)).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
