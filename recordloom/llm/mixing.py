"""Mixing sources to target weights by pivotal dependent rounding. Every document of a source gets the same expected number of copies, target / size
of the source; its whole part is certain, and its fraction is decided by duels: two fractional documents move words between them, at random
but without bias, until one of them is whole. The sum of words never changes in a duel, so a source misses its target by half of the last
open document at most. Duels run in a tree: buckets of about FAN_IN documents each leave one open document, and these meet on the next level.

Only DataFrame functions are used. Randomness is a hash of the document and the level, so that reruns and repeated tasks agree.

Defined cases: a null text has size 0; documents of size 0 take nothing; a null source is a source, the last one; equal rows are told apart by
a running number, and may get different numbers of copies; an empty table gives an empty result. Other columns are ignored by mix_plan() and kept by
mixed().
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import n_words, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
FAN_IN = 48
EPS = 1e-9
CHUNK = 4096


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from (source, size). With level x, a source gets min(most * its size, x * its weight), and x is such that all get
    share of the whole: the sources that reach their limit are those with the least limit / weight, so x is found by running sums in that
    order, which is what resharing the excess until none is above comes to."""
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = by_source.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))).withColumn("w", weights)  # a row a source
    order = W.orderBy((F.col("source_size") / F.col("w")), "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    level = (F.sum(F.col("source_size")).over(W.partitionBy()) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most) / F.sum("w").over(rest)
    free = ranked.withColumn("level", level).withColumn("at", F.row_number().over(order)).withColumn("fits", F.col("level") * F.col("w") <= F.col("source_size") * most)
    first = F.min(F.when(F.col("fits"), F.struct("at", "level"))).over(W.partitionBy())
    x = first["level"]
    return free.withColumn("x", x).select("source", "source_size", "n", F.least(F.col("source_size") * most, F.coalesce(F.col("x") * F.col("w"), F.col("source_size") * most)).alias("target"))


def _unit(*of: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*of), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _duel(a: Column, b: Column, level: int) -> Column:
    """(won: the decided of the two, and the other if both are decided; open: what stays). a, b: struct(doc_id, size, dup, p, key)."""
    up = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])  # words that can move from b to a
    down = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))  # and from a to b
    first = _unit(a["key"], b["key"], F.lit(level)) * (up + down) < down
    moved = F.when(first, up).otherwise(-down)
    near = lambda x: F.when(x < EPS, 0.0).when(x > 1 - EPS, 1.0).otherwise(x)
    return F.struct(a.withField("p", near(a["p"] + moved / a["size"])).alias("a"), b.withField("p", near(b["p"] - moved / b["size"])).alias("b"))


def _whole(x: Column) -> Column:
    return (x["p"] == 0.0) | (x["p"] == 1.0)


def _fold(units: Column, level: int, kind: str) -> Column:
    """units one by one against the open one. done: all decided; open: at most one."""
    none = F.lit(None).cast(kind)
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), none.alias("open"))

    def step(acc: Column, u: Column) -> Column:
        let = F.transform(F.array(_duel(acc["open"], u, level)), lambda d: F.struct(
            F.concat(acc["done"], F.filter(F.array(d["a"], d["b"]), _whole)).alias("done"),
            F.when(~_whole(d["a"]), d["a"]).when(~_whole(d["b"]), d["b"]).otherwise(none).alias("open"),
        ))
        return F.when(acc["open"].isNull(), F.struct(acc["done"].alias("done"), u.alias("open"))).otherwise(F.element_at(let, 1))

    return F.aggregate(units, start, step)


def decided(units: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """units: source, n (rows of the source, about), doc_id, size > 0, dup, p in (0, 1). Returns them with p 0 or 1. Each level writes what it decided and carries one open unit for
    each bucket, so that level k works on about 1/fan_in**k of the units."""
    kind = "struct<doc_id:bigint,size:bigint,dup:bigint,p:double,key:bigint>"
    most = units.agg(F.max("n")).first()[0] or 0
    rows = units.select(
        "source", F.ceil(F.col("n") / fan_in).alias("buckets"),
        F.struct("doc_id", "size", "dup", "p", F.xxhash64("doc_id", "size", "dup").alias("key")).cast(kind).alias("u"),
    )
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("u.key"), F.col("buckets")))
    parts, level, width = [], 0, max(1, -(-most // fan_in))
    while True:
        folded = rows.groupBy("source", "bucket").agg(F.sort_array(F.collect_list("u")).alias("us"))
        out = stored(folded.select("source", "bucket", _fold(F.col("us"), level, kind).alias("f")).select("source", "bucket", "f.done", "f.open"), f"duels{level}")
        parts.append(out.select("source", F.explode("done").alias("u")))
        still = out.where("open is not null")
        if width == 1:  # one open unit a source at most, with nothing left to meet: the nearer whole number
            last = F.col("open").withField("p", F.when(F.col("open.p") < 0.5, 0.0).otherwise(1.0))
            parts.append(still.select("source", last.alias("u")))
            break
        rows = still.select("source", F.floor(F.col("bucket") / fan_in).alias("bucket"), F.col("open").alias("u"))
        level, width = level + 1, -(-width // fan_in)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("source", "u.doc_id", "u.size", "u.dup", "u.p")


def _numbered(alike: DataFrame) -> DataFrame:
    """alike with dup = 0 ... m - 1. Many equal rows are dealt out in chunks first, so that no task makes them all and no array holds more than a chunk of them."""
    few = alike.where(F.col("m") <= CHUNK).withColumn("dup", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    chunks = alike.where(F.col("m") > CHUNK).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / CHUNK))))
    chunks = chunks.repartition("doc_id", "source", "size", "chunk")
    last = F.least(F.col("m"), (F.col("chunk") + 1) * CHUNK) - 1
    return few.unionByName(chunks.withColumn("dup", F.explode(F.sequence(F.col("chunk") * CHUNK, last))).drop("chunk"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source, dup, source_size, target, copies for every row of docs (doc_id, text, source). Rows alike in id, source and size are one
    row with a count until they are numbered by dup, so that a third of all rows may be alike."""
    sizes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words("text").alias("size")), "sizes")
    targets = stored(source_targets(sizes), "targets")
    alike = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    rows = _numbered(alike).join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).select(
        "doc_id", "source", "size", "dup", "source_size", "target", "n",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"),
    )
    rows = rows.withColumn("whole", F.floor(F.col("ratio") + EPS)).withColumn("p", F.col("ratio") - F.col("whole"))
    open_ = (F.col("p") > EPS) & (F.col("size") > 0)
    names = ["doc_id", "source", "size", "dup"]
    duels = decided(rows.where(open_).select(*names, "p", "n")).select(*names, F.col("p").cast("long").alias("more"))
    settled = rows.where(~open_).select(*names, F.lit(0).cast("long").alias("more"))
    return settled.unionByName(duels).join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).select(
        *names, "source_size", "target", (F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + EPS)).otherwise(0) + F.col("more")).cast("long").alias("copies")
    )


def _times(rows: DataFrame) -> DataFrame:
    """rows (row, times) as often as times says, in chunks."""
    chunks = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / CHUNK))))
    n = F.least(F.lit(CHUNK).cast("long"), F.col("times") - F.col("chunk") * CHUNK)
    return chunks.select("row", F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("copy")).select("row.*")


def mixed(docs: DataFrame) -> DataFrame:
    """docs as the mix holds them: each row as often as it was taken, all columns kept. Documents without words, which no target counts, stay once.

    Texts move once, to meet the narrow plan by id and source, by the same plan at any size. Rows that share their id and source are counted by their values, so that
    equal rows are one until they are given out, and numbered in salted parts of a key."""
    names = docs.columns
    plan = stored(mix_plan(docs), "plan")
    key = ["doc_id", "source"]
    by_key = plan.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.max(F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))).cast("long").alias("times"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.struct(*[f"`{c}`" for c in names]).alias("row"))
    met = lambda left, right, on: (left.alias("r").join(right.hint("shuffle_hash").alias("t"), reduce(and_, [F.col(f"t.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on])))
    out = _times(met(rows, by_key.where("m = 1 and times > 0"), key).select("r.row", "t.times"))
    if not plan.where("dup > 0").limit(1).count() and not by_key.where("m > 1").limit(1).count():
        return out
    again = met(rows, by_key.where("m > 1"), key).select("r.*").groupBy(*key, "row").agg(F.count(F.lit(1)).alias("c"))
    again = again.withColumn("size", n_words(F.col("row")["text"]))
    key = [*key, "size"]
    totals = plan.groupBy(*key).agg(*[F.count(F.when(F.col("copies") == c, 1)).alias(f"n{c}") for c in (1, 2)], F.count(F.lit(1)).alias("m"))
    again = stored(met(again, totals, key).select("r.*", "t.n1", "t.n2", F.pmod(F.xxhash64("r.row"), F.ceil(F.col("t.m") / CHUNK)).alias("salt")), "again")
    before = F.sum("c").over(W.partitionBy(*key).orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    starts = again.groupBy(*key, "salt").agg(F.sum("c").alias("c")).withColumn("start", F.coalesce(before, F.lit(0))).drop("c")
    within = F.sum("c").over(W.partitionBy(*key, "salt").orderBy(F.xxhash64("row")).rowsBetween(W.unboundedPreceding, -1))
    again = met(again, starts, [*key, "salt"]).select("r.*", "t.start").withColumn("first", F.col("start") + F.coalesce(within, F.lit(0)))
    upto = lambda n: F.greatest(F.lit(0), F.least(F.col("first") + F.col("c"), n) - F.col("first"))
    times = F.when(F.col("size") == 0, F.col("c")).otherwise(upto(F.col("n2")) + upto(F.col("n2") + F.col("n1")))
    return out.unionByName(_times(again.withColumn("times", times.cast("long")).where("times > 0")))
