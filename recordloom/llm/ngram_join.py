"""Documents that share n-grams, joined at a Jaccard bound by a blocked sparse product of the document by n-gram incidence.

The columns of the incidence (n-gram codes) are dealt into blocks; a block adds up its columns, drops those of one document, which no pair can
share, and returns the rest with their document counts. A document of n n-grams of which fewer than ceil(0.75 n) are left has no partner. Of the
others, only the rarest columns are multiplied: with size(x) columns left, the first size(x) - ceil(0.75 n) + 1 in the order of counts; two
linked documents share at least one of those. The product is not written out in full for a column of many documents: each document meets the
column's centre first, and only those whose component then still differs from the centre's meet the rest. Before a pair is made, an upper bound of its overlap
drops it. All documents have their columns in one order, so at the first column that two share, neither shares one that comes before: the overlap is no more
than what either has from there on. A linked pair keeps the bound at that column, whatever it does at later ones, so nothing is lost; pairs that meet at
a passage of many documents, behind columns of their own, go. Pairs meet by bands of sizes besides the column. Overlaps of the pairs that
remain are counted over all columns. So all links between different components are seen, while a column of m documents doesn't
cost m * m pairs.

Columns of very many documents (over max(1000, 4 * all / CELLS) by a count sketch of fixed size) skip the counting and sort last.
Rows of a column of over WIDE documents are dealt into SALTS parts by document, and its centre goes to each part. Where the rest of a column meets the others,
ODD_PARTS parts do: rows of the rest go to each.

Documents with the same set of n-grams are one class from the start. Codes of n-grams and classes have 64 bits, of which at least 48 take part in a
comparison beside the block; a false match of two codes is the only inexactness.

Defined cases: a null or empty text has no n-gram, is linked with nothing and is its own component; fewer than five words are one n-gram, the
whole sequence; equal rows are linked; a null doc_id never is the smallest one unless the component has no other; an empty table gives an empty result;
further columns are ignored by components_of() and kept by one_each().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, stored

SIZE = 5
CELLS = 1 << 21
CHUNK = 1 << 11
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
HOT = (1 << 31) - 1
WIDE, SALTS, ODD_PARTS = 1000, 64, 8
BATCH_NGRAMS = 1 << 21
M1, M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit codes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def codes(text: bytes, words: _Words, size: int = SIZE) -> np.ndarray:
    """Sorted distinct codes of a text's n-grams."""
    w = text.translate(LOWER).split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), seed=len(w))], np.uint64)
    c = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    out = np.zeros(len(w) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * M1 + c[i : i + len(out)]
        out ^= out >> np.uint64(32)
        out *= M2
        out ^= out >> np.uint64(29)
    return np.unique(out)


def class_of(set_: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(set_.tobytes()) - (1 << 63)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document (doc_id, n, cls), and the task's count sketch over its distinct classes (chunk, cells)."""
    words, seen, cells = _Words(), set(), np.zeros(CELLS, np.int32)
    names = ["doc_id", "n", "cls", "chunk", "cells"]
    for batch in batches:
        n, cls = [], []
        for x in batch.column(1).cast(pa.binary()):
            s = codes(x.as_py() or b"", words)
            n.append(len(s))
            cls.append(class_of(s) if len(s) else None)
            if len(s) and cls[-1] not in seen:
                seen.add(cls[-1])
                np.add.at(cells, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
        k = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
    if seen:
        k = CELLS // CHUNK
        parts = [cells[i * CHUNK : (i + 1) * CHUNK].tobytes() for i in range(k)]
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(range(k), pa.int32()), pa.array(parts, pa.binary())], names)


def _hot_cells(sketch: DataFrame, over: float) -> bytes:
    """One bit a cell: counted more than so often. Chunks are added up as a stream, so that the number of tasks doesn't matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(CHUNK, np.int64)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(total > over).tobytes()], pa.binary())], ["chunk", "bits"])

        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if chunk != at:
                    if at is not None:
                        yield row()
                    at, total = chunk, np.zeros(CHUNK, np.int64)
                total += np.frombuffer(cells.as_py(), np.int32)
        if at is not None:
            yield row()

    out = np.zeros((CELLS // CHUNK, CHUNK // 8), np.uint8)
    for chunk, bits in sketch.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "chunk int, bits binary").collect():  # CELLS bits
        out[chunk] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


def _postings(hot: bytes, shift: int):
    """Rows (block, blob): a blob holds a batch's documents that have n-grams of the block: number, classes, counts, low and high parts of the codes."""
    blocks = 1 << shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        is_hot = np.unpackbits(np.frombuffer(hot, np.uint8)).astype(bool)
        sets, classes, held = [], [], 0

        def out() -> pa.RecordBatch:
            s, c = np.concatenate(sets), np.array(classes, np.int64)
            doc = np.repeat(np.arange(len(sets), dtype=np.int64), [len(x) for x in sets])
            block = (s & np.uint64(blocks - 1)).astype(np.int64)
            very = is_hot[(s & np.uint64(CELLS - 1)).astype(np.int64)]
            block[very] = blocks + (c[doc[very]] & (blocks - 1))  # these only pass through, dealt by document
            order = np.argsort(block, kind="stable")
            s, doc, block = s[order], doc[order], block[order]
            at = np.flatnonzero(np.diff(block, prepend=-1))
            ids, blobs = [], []
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(s)], strict=True):
                who, n = np.unique(doc[a:b], return_counts=True)
                x = s[a:b] if block[a] >= blocks else s[a:b] >> np.uint64(shift)
                high = (x >> np.uint64(32)).astype(np.uint32 if block[a] >= blocks else np.uint16)
                ids.append(int(block[a]))
                blobs.append(np.int32(len(who)).tobytes() + c[who].tobytes() + n.astype(np.uint32).tobytes() + x.astype(np.uint32).tobytes() + high.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["block", "blob"])

        for batch in batches:
            for x in batch.column(0).cast(pa.binary()):
                s = codes(x.as_py() or b"", words)
                if len(s) and (k := class_of(s)) not in seen:
                    seen.add(k)
                    sets.append(s)
                    classes.append(k)
                    held += len(s)
                    if held >= BATCH_NGRAMS:
                        yield out()
                        sets, classes, held = [], [], 0
        if sets:
            yield out()

    return run


def _shared_columns(shift: int):
    """(cls, h, df) of a block's columns that two or more classes have."""
    blocks = 1 << shift

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        hot = block >= blocks
        width = np.uint32 if hot else np.uint16
        hs, cs = [], []
        for x in table.column("blob"):
            b = x.as_buffer()
            k = int(np.frombuffer(b, np.int32, 1)[0])
            c, n = np.frombuffer(b, np.int64, k, 4), np.frombuffer(b, np.uint32, k, 4 + 8 * k)
            total, at = int(n.sum()), 4 + 12 * k
            low, high = np.frombuffer(b, np.uint32, total, at), np.frombuffer(b, width, total, at + 4 * total)
            hs.append(low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)))
            cs.append(np.repeat(c, n))
        h, c = np.concatenate(hs), np.concatenate(cs)
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])  # a class that several tasks met
        h, c = h[new], c[new]
        if hot:
            df = np.full(len(h), HOT, np.int32)
        else:
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            n = np.diff(np.r_[start, len(h)])
            df = np.repeat(np.minimum(n, HOT - 1), n).astype(np.int32)
            h = (h << np.uint64(shift)) | np.uint64(block)
            keep = df > 1
            h, c, df = h[keep], c[keep], df[keep]
        return pa.table({"cls": pa.array(c, pa.int64()), "h": pa.array(h.view(np.int64)), "df": pa.array(df, pa.int32())})

    return run


def _may_link(x: str, y: str) -> Column:
    """Whether the overlap of x and y, by the columns that they have left, may reach the bound."""
    left = F.least(F.col(f"{x}n") - F.col(f"{x}alone"), F.col(f"{y}n") - F.col(f"{y}alone"))
    return 175 * left >= 75 * (F.col(f"{x}n") + F.col(f"{y}n"))


def _band(n: Column) -> Column:
    """A number that grows with n >= 1, by one for each factor of 4/3."""
    return F.floor(F.log(n) / F.log(F.lit(4 / 3))).cast("int")


def _late_pairs(ys: DataFrame, xs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different roots that share a column (h, part) and may be linked if it is the first that they share. ys, xs: h, part, cls, root, n, rest, with rest the columns
    of the document from h on. The size of a partner lies between 3/4 n, as it holds the overlap, and 7/3 rest - n."""
    least = F.ceil(F.col("n") * 3 / 4)
    most = F.greatest(least, F.floor(F.col("rest") * 7 / 3) - F.col("n"))
    xs = xs.withColumn("band", F.explode(F.sequence(_band(least), _band(most))))
    x, y = xs.select(*[F.col(c).alias(f"x{c}") for c in xs.columns]), ys.withColumn("band", _band(F.col("n")))
    y = y.select(*[F.col(c).alias(f"y{c}") for c in y.columns])
    met = reduce(and_, [F.col(f"y{c}") == F.col(f"x{c}") for c in ("h", "part", "band")])
    may = 175 * F.least("xrest", "yrest") >= 75 * (F.col("xn") + F.col("yn"))
    return y.join(x, met & (F.col("yroot") != F.col("xroot")) & may).select(F.least("ycls", "xcls").alias("a"), F.greatest("ycls", "xcls").alias("b")).distinct()


def _parts(wide: str, n: int) -> Column:
    """A row for each of n parts of a column."""
    return F.explode(F.when(F.col(wide), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0))))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), root being the smallest node of its component, by large and small stars in turn."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    state = mark(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        new = stored(small, "edges")
        then, state = state, mark(new)
        release(now)
        now = new
        if then == state:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _linked(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (a, b) whose overlap, counted over all shared columns, reaches the bound."""
    left = lists.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("hs").alias("ha"))
    right = lists.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("hs").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= 75 * (F.col("na") + F.col("nb") - both)).select("a", "b")


def components_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = stored(rows.mapInArrow(_first_pass, "doc_id long, n long, cls long, chunk int, cells binary"), "first")
    base = first.where("chunk is null").select("doc_id", "n", "cls")
    classes = base.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    total = base.agg(F.sum("n")).first()[0] or 0
    shift = max(6, min(16, int(total >> 21).bit_length()))
    hot = _hot_cells(first.where("chunk is not null").select("chunk", "cells"), max(1000, 4 * total / CELLS))
    shared = rows.select("text").mapInArrow(_postings(hot, shift), "block int, blob binary").groupBy("block").applyInArrow(_shared_columns(shift), "cls long, h long, df int")
    lists = shared.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("xs"))
    kept = classes.join(lists, "cls").where(100 * F.size("xs") >= 75 * F.col("n"))
    lists = kept.select("cls", "n", (F.col("n") - F.size("xs")).alias("alone"), F.col("xs.h").alias("hs"), F.size(F.filter("xs", lambda x: x["df"] <= WIDE)).alias("narrow"))
    lists = stored(lists, "lists")
    need = F.expr("cast((3 * n + 3) div 4 as int)")
    first_columns = lists.select("cls", "n", "alone", "narrow", F.posexplode(F.slice("hs", F.lit(1), F.size("hs") - need + 1)).alias("place", "h"))
    wide = F.col("place") >= F.col("narrow")  # one answer for all rows of a column
    columns = stored(first_columns.select("cls", "n", "alone", "place", "h", wide.alias("wide"), F.when(wide, F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")), "columns")
    centre = columns.groupBy("h").agg(F.min(F.struct("alone", "cls", "n")).alias("c"), F.count(F.lit(1)).alias("m"), F.max("wide").alias("c_wide")).where("m > 1")
    centre = centre.select("h", F.col("c.cls").alias("c"), F.col("c.n").alias("cn"), F.col("c.alone").alias("calone"), _parts("c_wide", SALTS).alias("salt"))
    star = columns.join(centre, ["h", "salt"]).where((F.col("cls") != F.col("c")) & _may_link("", "c"))
    tested = stored(star.select(F.least("cls", "c").alias("a"), F.greatest("cls", "c").alias("b")).distinct(), "tested")
    links = stored(_linked(tested, lists), "links")
    roots = stored(connected(links), "roots")
    # columns whose documents are not all in the centre's component: the rest of them meet all others
    at = columns.join(roots, F.col("cls") == F.col("node"), "left")
    at = at.select("h", "wide", "salt", "cls", "n", (F.col("n") - F.col("alone") - F.col("place")).alias("rest"), F.coalesce("root", "cls").alias("root"))
    c_at = centre.join(roots, F.col("c") == F.col("node"), "left").select("h", "salt", "c", F.coalesce("root", "c").alias("c_root"))
    at = stored(at.join(c_at, ["h", "salt"]), "at")
    names = ["cls", "root", "n", "rest"]
    odd = at.where("root != c_root").select("h", "wide", *names)
    open_ = odd.select("h", "wide").distinct().select("h", _parts("wide", SALTS).alias("salt"))
    ys = at.join(open_, ["h", "salt"], "left_semi").where("cls != c").select("h", (F.col("salt") % ODD_PARTS).alias("part"), *names)
    xs = odd.select("h", _parts("wide", ODD_PARTS).alias("part"), *names)
    more = _late_pairs(ys, xs).join(tested, ["a", "b"], "left_anti")
    more = stored(more, "more")
    late = stored(_linked(more, lists), "links")
    for done in (more, at, columns, lists, tested):
        release(done)
    if late.limit(1).count():
        roots = stored(connected(links.unionByName(late)), "roots")
    release(links)
    release(late)
    # only linked classes need their component's smallest id; one component may hold a third of them, so they meet it in parts
    linked = roots.withColumnRenamed("node", "cls").join(classes, "cls").select("cls", "rep", "root", F.pmod(F.xxhash64("cls"), F.lit(ODD_PARTS)).cast("int").alias("salt"))
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id")).select("root", "component_id", F.explode(F.sequence(F.lit(0), F.lit(ODD_PARTS - 1))).alias("salt"))
    of_linked = linked.join(least, ["root", "salt"]).select("cls", "component_id")
    by_class = classes.join(of_linked, "cls", "left").select("cls", F.coalesce("component_id", "rep").alias("component_id"))
    some = base.where("cls is not null").join(by_class, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(base.where("cls is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, that of the smallest id, all columns kept. Of several rows with that id one stays; rows without an id,
    which can't be named, all stay. Texts move once, to meet the ids that stay, by the same plan at any size."""
    found = stored(components_of(docs), "components")
    chosen = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("chosen_id")).agg(F.count(F.lit(1)).alias("m"))
    chosen = stored(chosen, "chosen")
    release(found)
    row = F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), row)
    met = lambda some: rows.join(some.select("chosen_id").hint("shuffle_hash"), F.col("row_id") == F.col("chosen_id"), "left_semi")
    held = met(chosen.where("m = 1")).select("row.*")
    if chosen.where("m > 1").limit(1).count():
        several = met(chosen.where("m > 1")).groupBy("row_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        held = held.unionByName(several.select("row.*"))
    return held.unionByName(docs.where("doc_id is null"))
