"""Weights of tokens and character n-grams, as long tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

MERGE = "merge"  # the hint of joins both of whose sides grow with the records: their rows never go through the driver, however small they look when packed
ONE = 1 << 30  # the length of a record's weights, in the units they are stored in


def all_tokens() -> Column:
    return F.array_distinct(F.concat(T.words(F.col("name_n")), T.words(F.col("addr_n"))))


def country_idf(canon: DataFrame) -> DataFrame:
    """country_n, token, df, idf over all records of a country: ln((N + 1) / (df + 1)) + 1."""
    df = canon.select("country_n", F.explode(all_tokens()).alias("token")).groupBy("country_n", "token").agg(F.count(F.lit(1)).alias("df"))
    n = canon.groupBy("country_n").agg(F.count(F.lit(1)).alias("n"))
    return df.join(n, "country_n").select("country_n", "token", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def with_weights(canon: DataFrame) -> DataFrame:
    """canon with w, a map from each of the record's tokens to its weight; names, addresses and landmarks look their tokens up in it."""
    idf = country_idf(canon)
    tokens = canon.select("entity_id", "country_n", F.explode(all_tokens()).alias("token"))
    w = tokens.join(idf.hint(MERGE), ["country_n", "token"]).groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "idf"))).alias("w"))
    empty = F.create_map().cast("map<string,double>")
    return canon.join(w.hint(MERGE), "entity_id", "left").withColumn("w", F.coalesce("w", empty))


def rarest(tokens: Column, w: Column) -> Column:
    """The token of the largest weight, the first of the alphabet among equals; null without tokens."""
    order = F.array_sort(F.transform(tokens, lambda t: F.struct((-w[t]).alias("a"), t.alias("t"))))
    return F.try_element_at(order, F.lit(1))["t"]


def gram_postings(canon: DataFrame, text: str, sizes: tuple[int, ...] = (3, 4)) -> DataFrame:
    """entity_id, source, country_n, gram, w: sublinear counts times ln((1 + N) / (1 + df)) + 1, rows of length ONE, as whole numbers, so that sums don't depend on their order. N counts all
    records, those without text too; it is one row, joined to the counts."""
    tf = canon.select("entity_id", "source", "country_n", F.explode(T.char_grams(F.col(text), sizes)).alias("gram")).groupBy("entity_id", "source", "country_n", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    df = df.join(canon.agg(F.count(F.lit(1)).alias("n")), F.lit(True))
    raw = tf.join(df.hint(MERGE), "gram").withColumn("u", (1 + F.log("tf")) * (F.log((1.0 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = raw.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("norm"))
    return raw.join(norm.hint(MERGE), "entity_id").select("entity_id", "source", "country_n", "gram", F.round(F.col("u") / F.col("norm") * ONE).cast("long").alias("w"))


def _coded_grams(texts: pa.Array, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, gram and count of each gram that a row has, ordered by row and gram. A gram of 3 or 4 ASCII characters is the number that its bytes make."""
    padded = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), " ", "").cast(pa.large_binary())
    ends = np.frombuffer(padded.buffers()[1], np.int64)[padded.offset : padded.offset + len(padded) + 1]
    text = np.frombuffer(padded.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(padded) else np.empty(0, np.uint8)
    if (text > 127).any():
        raise ValueError("grams are made of normalised texts, which are ASCII")
    row = np.repeat(np.arange(len(padded), dtype=np.int64), np.diff(ends))
    keys = []
    for n in sizes:
        if len(text) < n:
            continue
        count = len(text) - n + 1
        inside = np.ones(count, bool)  # all but the outer characters are of a word, so the gram lies in one word with its blanks
        for i in range(1, n - 1):
            inside &= text[i : i + count] != 32
        at = np.flatnonzero(inside)
        code = np.zeros(len(at), np.int64)
        for i in range(n):
            code = code << 8 | text[at + i]
        keys.append(row[at] << 32 | code)
    every = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    return every[first] >> 32, (every[first] & 0x7FFFFFFF).astype(np.int32), np.diff(np.append(first, len(every)))


def packed_postings(canon: DataFrame, text: str, sizes: tuple[int, ...] = (3, 4)) -> DataFrame:
    """entity_id, source, country_n, grams, ws: the grams of gram_postings and their weights, one row for each record. No gram is moved: records are read twice, for the counts of grams (normalised
    texts have 37 characters, so at most 37^3 + 37^4 grams of 3 and 4, however many records there are) and for the weights. Other sizes are packed from gram_postings."""
    if not set(sizes) <= {3, 4} or len(set(sizes)) < len(sizes):
        return packed(gram_postings(canon, text, sizes))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, n = np.unique(_coded_grams(batch[0], sizes)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n.astype(np.int64))], names=["gram", "n"])

    df = canon.select(text).mapInArrow(counts, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("df")).toArrow().sort_by("gram")
    grams, n_records = df["gram"].to_numpy(), canon.count()
    idf = np.log((1.0 + n_records) / (1 + df["df"].to_numpy())) + 1
    known = canon.sparkSession.sparkContext.broadcast((grams, idf))

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, idf = known.value
            row, gram, tf = _coded_grams(batch[3], sizes)
            u = (1 + np.log(tf)) * idf[np.searchsorted(grams, gram)]
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            square = np.concatenate([[0.0], u * u])
            norm = np.sqrt(np.add.reduceat(square, np.minimum(ends[:-1] + 1, len(u)))) if batch.num_rows else np.empty(0)
            w = np.floor(u / norm[row] * ONE + 0.5).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (gram, w)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["entity_id", "source", "country_n", "grams", "ws"])

    kinds = ", ".join(f"{c} {canon.schema[c].dataType.simpleString()}" for c in ("entity_id", "source", "country_n"))
    rows = canon.select("entity_id", "source", "country_n", text).mapInArrow(weights, f"{kinds}, grams array<int>, ws array<int>")
    return rows.where("size(grams) > 0")


def packed(postings: DataFrame) -> DataFrame:
    """One row for each record, with the lists grams and ws, of postings of either form."""
    if "grams" in postings.columns:
        return postings
    kept = [c for c in ("source", "country_n") if c in postings.columns]
    rows = postings.groupBy("entity_id", *kept).agg(F.collect_list(F.struct("gram", F.col("w").cast("int").alias("w"))).alias("xs"))
    return rows.select("entity_id", *kept, F.col("xs.gram").alias("grams"), F.col("xs.w").alias("ws"))
