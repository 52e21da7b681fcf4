"""Candidate pairs: cosine top-k, exact keys, MinHash bands, nearest vectors, and their union."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import text as T
from .postings import MERGE, ONE, packed, rarest

PRIME = (1 << 31) - 1


def blocks(canon: DataFrame, by_country: bool = True) -> DataFrame:
    """entity_id, source, block. Targets lie in their country's block; source-1 records of a country without targets look into the block of all targets, in
    which every target lies as well if there is such a country."""
    if not by_country:
        return canon.select("entity_id", "source", F.lit("*").alias("block"))
    with_targets = canon.where("source > 1").select(F.col("country_n").alias("c")).distinct()
    s1 = canon.where("source = 1").join(with_targets, F.col("country_n") == F.col("c"), "left").select("entity_id", "source", F.coalesce("c", F.lit("*")).alias("block"))
    targets = canon.where("source > 1").select("entity_id", "source", "country_n")
    orphans = s1.where("block = '*'").select("block").distinct()
    everywhere = targets.join(F.broadcast(orphans), F.lit(True)).select("entity_id", "source", "block")  # one row at most on the right
    return s1.unionByName(targets.select("entity_id", "source", F.col("country_n").alias("block"))).unionByName(everywhere)


class _Grams:
    """The grams of a tile's queries and targets as numbers, and exact cosines of their pairs by sums of whole numbers."""

    def __init__(self, left: pa.Table, right: pa.Table):
        sides = [(side["grams"].combine_chunks(), side["ws"].combine_chunks()) for side in (left, right)]
        self.q_ends, self.t_ends = (np.concatenate([[0], np.cumsum(pc.list_value_length(g).to_numpy(zero_copy_only=False), dtype=np.int64)]) for g, _ in sides)
        self.q_w, self.t_w = (pc.list_flatten(w).to_numpy(zero_copy_only=False).astype(np.int64) for _, w in sides)
        flat = [pc.list_flatten(g) for g, _ in sides]
        if pa.types.is_integer(flat[0].type):
            q, t = (x.to_numpy(zero_copy_only=False) for x in flat)
            met = np.intersect1d(q, t)
            q_at, t_at = (np.minimum(np.searchsorted(met, x), max(len(met) - 1, 0)) for x in (q, t))
            q_in, t_in = (met[at] == x if len(met) else np.zeros(len(x), bool) for at, x in ((q_at, q), (t_at, t)))
        else:
            codes = pa.concat_arrays(flat).dictionary_encode().indices.to_numpy().astype(np.int64)
            q, t = codes[: len(flat[0])], codes[len(flat[0]) :]
            met = np.intersect1d(q, t)
            q_in, t_in = np.isin(q, met), np.isin(t, met)
            q_at, t_at = np.searchsorted(met, q), np.searchsorted(met, t)
        self.n = len(met)  # grams of both sides; others add nothing
        self.q_ends, self.t_ends = (np.concatenate([[0], np.cumsum(kept)])[ends] for kept, ends in ((q_in, self.q_ends), (t_in, self.t_ends)))
        self.q_code, self.q_w, self.t_code, self.t_w = q_at[q_in], self.q_w[q_in], t_at[t_in], self.t_w[t_in]

    def batch(self, wide: int) -> int:
        """Queries whose rows of grams and of so many scores are held at once."""
        return max(1, min(512, (1 << 24) // max(wide, self.n, 1)))

    def rows(self, start: int, end: int) -> np.ndarray:
        """Weights of the queries start to end by gram."""
        out = np.zeros((end - start, self.n), np.int32)
        x = slice(self.q_ends[start], self.q_ends[end])
        out[np.repeat(np.arange(end - start), np.diff(self.q_ends[start : end + 1])), self.q_code[x]] = self.q_w[x]
        return out

    def dots(self, rows: np.ndarray, q: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Sums of products of rows q and targets t."""
        sizes, flat, out = np.diff(self.t_ends)[t], rows.reshape(-1), np.empty(len(t), np.int64)
        held = np.cumsum(sizes) >> 20
        for part in np.split(np.arange(len(t)), np.flatnonzero(np.diff(held)) + 1) if len(t) else []:
            n = sizes[part]
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(self.t_ends[t[part]] - (ends - n), n)
            made = np.concatenate([[0], np.cumsum(flat[np.repeat(q[part] * self.n, n) + self.t_code[at]] * self.t_w[at])])
            out[part] = made[ends] - made[ends - n]
        return out


class _Near:
    """Nearly the cosines of a tile, in single precision: at most the share miss off. Grams that the same targets have in the same proportion are one column, frequent columns are a
    matrix product, and the others are added up from their lists."""

    def __init__(self, grams: _Grams, targets: int, often: float = 0.04, most: int = 512):
        order = np.argsort(grams.t_code << 32 | np.repeat(np.arange(targets), np.diff(grams.t_ends)))
        self.t = np.repeat(np.arange(targets), np.diff(grams.t_ends))[order]
        w, code = grams.t_w[order] / ONE, grams.t_code[order]
        self.ends = np.searchsorted(code, np.arange(grams.n + 1))
        first, count = self.ends[:-1], np.diff(self.ends)
        marks = np.random.default_rng(0).integers(0, 1 << 63, targets, dtype=np.uint64)
        shape = np.stack([np.add.reduceat(marks[self.t], first), count.astype(np.uint64)], 1) if grams.n else np.empty((0, 2), np.uint64)
        _, head, group = np.unique(shape, axis=0, return_index=True, return_inverse=True)
        head = head[group.reshape(-1)]
        against = np.arange(len(code)) - first[code] + first[head[code]]
        lead = np.maximum(w[first], 1e-300)
        same = (self.t == self.t[against]) & (np.abs(w / lead[code] - w[against] / lead[head[code]]) <= 1e-7 * w / lead[code])
        one = np.logical_and.reduceat(same, first) if grams.n else np.empty(0, bool)
        head = np.where(one, head, np.arange(grams.n))
        self.w = w.astype(np.float32)
        queries = len(grams.q_ends) - 1
        key = np.repeat(np.arange(queries), np.diff(grams.q_ends)) << 32 | head[grams.q_code]
        order = np.argsort(key, kind="stable")
        key, value = key[order], (grams.q_w / ONE * (lead / lead[head])[grams.q_code])[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        value = np.add.reduceat(value, start).astype(np.float32) if len(key) else value.astype(np.float32)
        q, column = key[start] >> 32, key[start] & 0x7FFFFFFF
        used = np.unique(column)
        used = used[np.argsort(-count[used], kind="stable")][:most]
        used = used[count[used] >= often * targets]
        place = np.full(grams.n, -1)
        place[used] = np.arange(len(used))
        self.often = np.zeros((len(used), targets), np.float32)
        mine = place[code] >= 0
        self.often[place[code[mine]], self.t[mine]] = self.w[mine]
        mine = place[column] >= 0
        self.asked = np.zeros((queries, len(used)), np.float32)
        self.asked[q[mine], place[column[mine]]] = value[mine]
        self.column, self.value = column[~mine], value[~mine]
        self.q, self.q_ends = q[~mine], np.searchsorted(q[~mine], np.arange(queries + 1))
        self.miss = (len(used) + int(np.diff(grams.q_ends).max(initial=0)) + 16) * 2.0**-22 + 1e-6

    def scores(self, start: int, end: int) -> np.ndarray:
        out = self.asked[start:end] @ self.often
        flat, at = out.reshape(-1), np.arange(self.q_ends[start], self.q_ends[end])
        sizes = self.ends[self.column[at] + 1] - self.ends[self.column[at]]
        for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(sizes) >> 20)) + 1) if len(at) else []:
            first = self.ends[self.column[part]]
            n = self.ends[self.column[part] + 1] - first
            ends = np.cumsum(n)
            there = np.arange(ends[-1]) + np.repeat(first - (ends - n), n)
            np.add.at(flat, np.repeat((self.q[part] - start) * out.shape[1], n) + self.t[there], np.repeat(self.value[part], n) * self.w[there])
        return out


def _tile_product(k: int, least: float, schema: pa.Schema):
    """The k best partners of every left record among the right ones, by sums of whole numbers; partners of equal score in the order of their ids. Nearly right cosines tell which
    partners may be among the best, and theirs are made exactly."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.sort_by("t")
        grams = _Grams(left, right)
        near, n, found = _Near(grams, right.num_rows), right.num_rows, []
        step = grams.batch(n)
        for start in range(0, left.num_rows, step):
            end = min(start + step, left.num_rows)
            scores = near.scores(start, end)
            best = scores
            if n > 4096:  # the k-th best of 1024 maxima is at most that of all
                best = scores[:, :1024].copy()
                for i in range(1024, n - 1023, 1024):
                    np.maximum(best, scores[:, i : i + 1024], out=best)
            bound = np.partition(best, -k, axis=1)[:, -k] if best.shape[1] > k else np.zeros(len(best), np.float32)
            cut = (np.maximum(bound.astype(np.float64), least) * (1 - 2 * near.miss)).astype(np.float32)
            at = np.flatnonzero(scores >= cut[:, None])
            q, t = at // n, at % n
            exact = grams.dots(grams.rows(start, end), q, t) / float(ONE * ONE)
            q, t, exact = (x[exact >= least] for x in (q, t, exact))
            order = np.lexsort((t, -exact, q))
            q, t, exact = q[order], t[order], exact[order]
            kept = np.arange(len(q)) - np.searchsorted(q, q) < k
            found.append((q[kept] + start, t[kept], exact[kept]))
        q, t, exact = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([left["q"].take(pa.array(q)), right["t"].take(pa.array(t)), pa.array(exact)], schema=schema)

    return run


QUERIES, TARGETS = 20_000, 40_000  # of a tile: a record's grams move once for each tile of its row or column


def _tiles(placed: DataFrame, queries: int, targets: int) -> DataFrame:
    count = lambda c, part: F.ceil(F.count_if(F.expr(c)) / part).cast("int")
    return placed.groupBy("block").agg(count("source = 1", queries).alias("m"), count("source > 1", targets).alias("n")).where("m > 0 and n > 0")


def _mine(key: str, n: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(n)).cast("int")


def _every(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _dealt(postings: DataFrame, placed: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries (q) and targets (t) of each tile with their grams and weights."""
    rows = packed(postings).select("entity_id", "grams", "ws").join(placed.hint(MERGE), "entity_id").join(tiles, "block")
    a = rows.where("source = 1").select("block", _mine("entity_id", "m").alias("i"), _every("n").alias("j"), F.col("entity_id").alias("q"), "grams", "ws")
    b = rows.where("source > 1").select("block", _every("m").alias("i"), _mine("entity_id", "n").alias("j"), F.col("entity_id").alias("t"), "grams", "ws")
    return a, b.select(*[F.col(c).alias(c) for c in b.columns])  # columns of their own, as both sides come from the same rows


def top_cosine(postings: DataFrame, placed: DataFrame, k: int, least: float = 0.15, part: int | None = None) -> DataFrame:
    """q, t, score: the k best targets of every source-1 record in its block, by cosine of at least least, then by id; exact. A block is cut into tiles of about QUERIES by TARGETS
    records (or part by part): each is one sparse product in bounded memory, a few of its rows at a time, and passes on its best k of a query. So no pair is shuffled but those, a
    record moves once for each tile of its row or column, and a gram that most records of a block share is spread over all of the block's tiles."""
    a, b = _dealt(postings, placed, _tiles(placed, part or QUERIES, part or TARGETS))
    kind = placed.schema["entity_id"].dataType
    ids = to_arrow_type(kind)
    run = _tile_product(k, least, pa.schema([("q", ids), ("t", ids), ("score", pa.float64())]))
    best = a.groupBy("block", "i", "j").cogroup(b.groupBy("block", "i", "j")).applyInArrow(run, f"q {kind.simpleString()}, t {kind.simpleString()}, score double")
    return top_scored(best, "score", k)


def _pair_dots(columns: list[str], schema: pa.Schema):
    """Pairs with the cosine of the two records beside them, by sums of whole numbers."""

    def grams_of(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        sizes = batch[f"sizes_{side}"]
        at = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(sizes), 0).to_numpy(zero_copy_only=False))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.list_flatten(sizes).to_numpy(zero_copy_only=False), dtype=np.int64)])
        text = b"".join(x for x in batch[f"grams_{side}"].to_pylist() if x)
        return at, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(text)]), pc.list_flatten(batch[f"ws_{side}"]).to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 2000) for whole in batches for i in range(0, whole.num_rows, 2000)):  # so that the arrays below stay small
            dots = np.zeros(batch.num_rows, np.int64)
            at_a, grams_a, ws_a = grams_of(batch, "a")
            at_b, grams_b, ws_b = grams_of(batch, "b")
            if len(at_a) and len(at_b):
                codes = pa.concat_arrays([grams_a, grams_b]).dictionary_encode().indices.to_numpy().astype(np.int64)
                a, b = (at_a << 32) + codes[: len(at_a)], (at_b << 32) + codes[len(at_a) :]
                order = np.argsort(a)
                a, ws_a = a[order], ws_a[order]
                place = np.minimum(np.searchsorted(a, b), len(a) - 1)
                met = a[place] == b
                np.add.at(dots, at_b[met], ws_a[place[met]] * ws_b[met])
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in columns], pa.array(dots / float(ONE * ONE))], schema=pa.schema([*[batch.schema.field(c) for c in columns], *schema]))

    return run


def _tile_cosines(schema: pa.Schema):
    """Pairs of a tile with their cosine, 0 where a record has no grams."""

    def run(pairs: pa.Table, records: pa.Table) -> pa.Table:
        left, right = (records.filter(c) for c in (records["mine"], pc.invert(records["mine"])))
        pairs = pa.Table.from_struct_array(pairs["pair"])
        dots = np.zeros(pairs.num_rows, np.int64)
        q, t = (pc.fill_null(pc.index_in(pairs[c], value_set=side["id"].combine_chunks()), -1).to_numpy() for c, side in (("q", left), ("t", right)))
        both = np.flatnonzero((q >= 0) & (t >= 0))
        if len(both):
            grams = _Grams(left, right)
            both = both[np.argsort(q[both], kind="stable")]
            q, t = q[both].astype(np.int64), t[both]
            step = grams.batch(0)
            for start in range(0, left.num_rows, step):
                end = min(start + step, left.num_rows)
                at = slice(*np.searchsorted(q, [start, end]))
                dots[both[at]] = grams.dots(grams.rows(start, end), q[at] - start, t[at])
        return pa.table([*[pairs[c] for c in schema.names[:-1]], pa.array(dots / float(ONE * ONE))], schema=schema)

    return run


def pair_cosine(pairs: DataFrame, postings: DataFrame, name: str, placed: DataFrame | None = None) -> DataFrame:
    """pairs (q, t) with the exact cosine, 0 where nothing is shared. Each record's grams are one text, with their sizes and weights beside it, so that a pair meets two short
    rows instead of maps or postings, and the work of a pair grows with its grams, not with their product. Where placed is given, each pair's records must lie in one block, as candidates
    do: then pairs without grams go to the tiles of top_cosine, and no grams are moved for a pair."""
    out = StructType([*pairs.schema.fields, StructField(name, DoubleType())])
    if placed is not None:
        tiles = _tiles(placed, QUERIES, TARGETS)
        a, b = _dealt(postings, placed, tiles)
        side = lambda rows, key, mine: rows.select("block", "i", "j", F.col(key).alias("id"), F.lit(mine).alias("mine"), "grams", "ws")
        records = side(a, "q", True).unionByName(side(b, "t", False))
        blocks_ = placed.where("source = 1").select(F.col("entity_id").alias("key"), "block").hint(MERGE)
        rows = pairs.select(F.struct(*pairs.columns).alias("pair"), F.col("q").alias("key")).join(blocks_, "key", "left").join(tiles, "block", "left")
        rows = rows.select(F.col("block").alias("block"), _mine("key", "m").alias("i"), _mine("pair.t", "n").alias("j"), "pair")
        run = _tile_cosines(pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out]))
        return rows.groupBy("block", "i", "j").cogroup(records.groupBy("block", "i", "j")).applyInArrow(run, out)
    xs = packed(postings).withColumn("grams", F.col("grams").cast("array<string>"))
    columns = {"grams": F.array_join("grams", "").cast("binary"), "sizes": F.transform("grams", lambda g: F.octet_length(g).cast("short")), "ws": F.col("ws")}
    records = xs.select("entity_id", *[c.alias(n) for n, c in columns.items()])
    side = lambda key, x: records.select(F.col("entity_id").alias(key), *[F.col(n).alias(f"{n}_{x}") for n in columns]).hint(MERGE)
    both = pairs.join(side("t", "b"), "t", "left").join(side("q", "a"), "q", "left")
    return both.mapInArrow(_pair_dots(pairs.columns, pa.schema([(name, pa.float64())])), out)


def record_keys(weighted: DataFrame) -> DataFrame:
    """entity_id, source, key: code and start of the rarest name token; acronym and number; first eight characters of the name without blanks."""
    rare = F.substring(rarest(F.array_distinct(F.col("core")), F.col("w")), 1, 3)
    none = F.array().cast("array<string>")
    pc = F.when(rare.isNotNull(), F.transform("codes", lambda c: F.concat_ws("|", F.lit("pc"), c, rare))).otherwise(none)
    an = F.when(F.length("acr") >= 2, F.transform("nums", lambda c: F.concat_ws("|", F.lit("an"), F.col("acr"), c))).otherwise(none)
    cn = F.when(F.length("nospace") >= 6, F.array(F.concat_ws("|", F.lit("cn"), F.substring("nospace", 1, 8)))).otherwise(none)
    return weighted.select("entity_id", "source", F.explode(F.array_distinct(F.concat(pc, an, cn))).alias("key"))


def fan_out(keys: DataFrame, placed: DataFrame, cap: int) -> DataFrame:
    """block, key, n of the targets' keys that at most cap targets of the block share; others are dropped whole."""
    return keys.where("source > 1").select("entity_id", "key").join(placed.select("entity_id", "block").hint(MERGE), "entity_id").groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= cap)


def key_pairs(keys: DataFrame, placed: DataFrame, cap: int = 100) -> DataFrame:
    """q, t that share a key which isn't dropped. The cap is applied before the join, so no key makes more than cap pairs a record."""
    rows = keys.select("entity_id", "source", "key").join(placed.select("entity_id", "block").hint(MERGE), "entity_id")
    kept = fan_out(keys, placed, cap).select("block", "key")
    a = rows.where("source = 1").select(F.col("entity_id").alias("q"), "block", "key")
    b = rows.where("source > 1").join(kept.hint(MERGE), ["block", "key"], "left_semi").select(F.col("entity_id").alias("t"), "block", "key")
    return a.join(b.hint(MERGE), ["block", "key"]).select("q", "t").distinct()


def coefficients(n: int, seed: int) -> list[tuple[int, int]]:
    """Pairs (a, b) of n affine hash functions modulo PRIME, by a linear rule from the seed."""
    out, x = [], seed * 2654435761 % PRIME + 1
    for _ in range(n):
        a = x = x * 48271 % PRIME
        b = x = x * 48271 % PRIME
        out.append((a, b))
    return out


def band_keys(canon: DataFrame, text: str, bands: int, rows: int, seed: int, sizes: tuple[int, ...] = (3, 4)) -> DataFrame:
    """entity_id, source, key for every MinHash band of the record's set of grams; records without text have none."""
    grams = F.transform(F.array_distinct(T.char_grams(F.col(text), sizes)), T.number_of)
    sets = canon.select("entity_id", "source", grams.alias("g")).where("size(g) > 0")
    coefs = coefficients(bands * rows, seed)

    def least_of(a: int, b: int) -> Column:
        return F.array_min(F.transform("g", lambda x: (x * a + b) % PRIME))

    least = [least_of(a, b) for a, b in coefs]
    keys = F.array(*[F.concat_ws("-", F.lit(f"{text}{i}"), *least[i * rows : (i + 1) * rows]) for i in range(bands)])
    return sets.select("entity_id", "source", F.explode(keys).alias("key"))


def top_scored(pairs: DataFrame, score: str, k: int) -> DataFrame:
    best = W.partitionBy("q").orderBy(F.desc(score), "t")
    return pairs.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, part: int = 2000, kind: str = "long") -> DataFrame:
    """q, t, score: the k largest inner products of normalised vectors (id, v), exact. queries is a stated set of rows, met by all rows in blocks: parts of about part queries
    meet parts of about part rows as one matrix product, and each block passes on its best k of a query."""
    import pandas as pd

    n, m = max(1, -(-vectors.count() // part)), max(1, -(-queries.count() // part))
    side = lambda df, other, mine, name: df.select(
        F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("o"), F.pmod(F.xxhash64("id"), F.lit(mine)).cast("int").alias(name), F.col("id").alias("id"), F.transform("v", lambda x: x.cast("double")).alias("v")
    )
    a = side(queries, n, m, "i").select("i", F.col("o").alias("j"), "id", "v")
    b = side(vectors, m, n, "j").select(F.col("o").alias("i"), "j", "id", "v")

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"q": [], "t": [], "score": []})
        u, w = (np.vstack(z["v"].to_numpy()) for z in (x, y))
        u, w = (z / np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-300) for z in (u, w))
        scores = np.round(u @ w.T, 6)
        qs, ts = x["id"].to_numpy(), y["id"].to_numpy()
        out = []
        for q, row in zip(qs, scores, strict=True):
            best = [i for i in np.lexsort((ts, -row))[: k + 1] if ts[i] != q][:k]
            out.append(pd.DataFrame({"q": q, "t": ts[best], "score": row[best]}))
        return pd.concat(out)

    blocks_ = a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInPandas(product, f"q {kind}, t {kind}, score double")
    return top_scored(blocks_, "score", k)


VIEWS = ("name", "full", "key", "lsh", "dense")


def union_views(views: dict[str, DataFrame]) -> DataFrame:
    """q, t, a 0/1 flag for each view, sc_dense, n_views. Absent views are 0."""
    out = None
    for view, pairs in views.items():
        flags = [F.lit(int(v == view)).alias(f"found_{v}") for v in VIEWS]
        score = F.col("score").cast("double") if view == "dense" else F.lit(0.0)
        rows = pairs.select("q", "t", *flags, score.alias("sc_dense"))
        out = rows if out is None else out.unionByName(rows)
    merged = out.groupBy("q", "t").agg(*[F.max(f"found_{v}").alias(f"found_{v}") for v in VIEWS], F.max("sc_dense").alias("sc_dense"))
    return merged.withColumn("n_views", sum((F.col(f"found_{v}") for v in VIEWS), F.lit(0)))
