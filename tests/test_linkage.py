import glob
import os
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from recordloom.config import Config
from recordloom.oracle import ORACLE
from recordloom.operators import blocking, evaluate
from recordloom.plans import linkage
from recordloom.queries import QUERIES, Data
from recordloom.sources import sinks, synth, tables
from recordloom.streaming import incremental

DIR = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", ["records_source", "norm_records", "rare_core_token", "char_gram_tfidf_topk_name", "exact_key_candidates", "lsh_band_candidates", "pair_set_features", "pair_structure_features", "pair_jaro_winkler", "pair_token_ratios", "pair_cosines", "entity_features", "collective_similarity", "sampled_split", "oof_fold_assignment", "collective_windows", "expected_f_decision", "macro_f_by_country", "truth_explode", "abbrev_mining", "error_samples", "dense_knn_topk"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df, sql = QUERIES[name](spark, DIR), con.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(sql.columns)
    at = [sql.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in sql.fetchall())


def test_every_query_runs(spark):
    assert set(ORACLE) <= set(QUERIES) <= set(__spark_entry__.queries())
    for name in sorted(set(QUERIES) - set(ORACLE)):
        assert QUERIES[name](spark, DIR).count() > 0, name


def written(spark, folder, split):
    rows = synth.records(spark, DIR)
    for n in (1, 2, 3):
        part = rows.where(f"source = {n}").select("entity_id", "business_name", "business_address", "country").toPandas()
        part.to_csv(f"{folder}/{split}_source{n}.tsv", sep="\t", index=False)
    s1 = rows.where("source = 1").selectExpr("entity_id as q")
    truth = synth.truth(rows).selectExpr("s1_id as q", "t_id as t")
    sinks.id_lists(s1, truth, "matched_entity_ids").toPandas().to_csv(f"{folder}/{split}_ground_truth.tsv", sep="\t", index=False)


def test_whole_run(spark, tmp_path):
    for split in ("train", "test"):
        written(spark, tmp_path, split)
    cfg = Config(stage2_folds=2, n_folds=2, rounds=2, depth=2, blocker="both")
    out = linkage.run(spark, f"file://{tmp_path}", f"file://{tmp_path}/out", cfg)
    assert out["macro_f"] > 0.6 and out["test_macro_f"] > 0.6 and set(out["faults"].values()) == {0}
    assert set(out["test_by_country"]) == set(out["by_country"]) and out["test_blocking"]["completeness"] >= out["test_blocking_pruned"]["completeness"] > 0.5
    assert spark.read.csv(f"file://{tmp_path}/out/matching_results.tsv", sep="\t", header=True).count() == 150


def test_held_out_records_and_new_truth(spark, tmp_path, monkeypatch):
    """No fit, curve or decision sees a record of the held-out country, only they are judged; another ground truth gives other labels; a scorer's column reaches the model."""
    written(spark, tmp_path, "train")
    out = canonical_countries(spark)
    country = sorted(set(out.values()))[0]
    held = {q for q, c in out.items() if c == country}
    seen = []
    for name in ("isotonic",):
        real = getattr(linkage.model, name)
        monkeypatch.setattr(linkage.model, name, lambda rows, raw, real=real: (seen.append({r[0] for r in rows.where("is_pool").select("q").distinct().collect()}), real(rows, raw))[1])
    fits, trained = linkage.model.out_of_fold, []
    monkeypatch.setattr(linkage.model, "out_of_fold", lambda rows, names, *a: (trained.append((set(names), {r[0] for r in rows.where("is_pool").select("q").distinct().collect()})), fits(rows, names, *a))[1])
    tuned, sizes = linkage.structure.tuned, []
    monkeypatch.setattr(linkage.structure, "tuned", lambda pairs, none, truth, some, *a: (sizes.append({r[0] for r in some.select("q").collect()} | {r[0] for r in pairs.select("q").collect()}), tuned(pairs, none, truth, some, *a))[1])
    cfg = Config(stage2_folds=2, n_folds=2, rounds=1, depth=2, holdout_country=country)
    scorer = lambda asked: asked.select("q", "t", F.levenshtein("text_a", "text_b").alias("ce_logit"))
    first = linkage.run(spark, f"file://{tmp_path}", f"file://{tmp_path}/out", cfg, False, scorer)
    assert held and first["n_judged"] == len(held) and len(trained) == 3 and len(sizes) == 1
    assert all(not held & x for x in (*seen, *(x for _, x in trained), *sizes)) and "ce_logit" in trained[1][0]
    assert set(first["by_country"]) == {country} and set(first["recall_by_view"]) == {"name", "full", "key", "lsh", "dense"} and first["expected_pairs_lost"] >= 0
    path = next(tmp_path.glob("train_ground_truth.tsv"))
    lines = path.read_text().split("\n")
    path.write_text("\n".join([lines[0], *(line.split("\t")[0] + "\t" for line in lines[1:] if line)]) + "\n" + lines[1].split("\t")[0] + "\tS2-0\n")
    assert tables.split_files(spark, f"file://{tmp_path}", "train")[3][0] == "train_ground_truth.tsv"
    seen_y = []
    monkeypatch.setattr(linkage.evaluate, "view_recall", lambda rows, real: seen_y.append(real.count()) or evaluate.view_recall(rows, real))
    monkeypatch.setattr(linkage.model, "out_of_fold", lambda rows, *a: seen_y.append(rows.where("y = 1").count()) or (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        linkage.run(spark, f"file://{tmp_path}", f"file://{tmp_path}/out", cfg, False)
    assert seen_y[-1] <= 1  # the stored labels of the first truth aren't taken


def canonical_countries(spark):
    return {r[0]: r[1] for r in Data(spark, DIR).canon.where("source = 1").select("entity_id", "country_n").collect()}


def test_dense_view(spark):
    d = Data(spark, DIR)
    ids = sorted(r[0] for r in d.records.select("entity_id").collect())
    vectors = spark.createDataFrame([(x, [float(i % 13), float(i % 7) + 1, 1.0]) for i, x in enumerate(ids)], "entity_id string, v array<double>")
    split = linkage.Split(d.weighted, d.grams("name_n"), d.grams("full_n"), d.placed, vectors)
    got = linkage.dense_views(split, Config(k_dense=3))["dense"].collect()
    assert len(got) == 3 * d.s1.count() and all(r["q"].startswith("S1") and not r["t"].startswith("S1") for r in got)
    pairs = linkage.retrieved(split, Config(use_dense=True, k_dense=3))
    assert pairs.where("found_dense = 1").count() == len(got) and pairs.where("found_dense = 1 and sc_dense <= 0").count() == 0
    with pytest.raises(ValueError):
        linkage.retrieved(split, Config(blocker="none"))


def test_tsv(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('entity_id\tbusiness_name\tcountry \n a \t"Joe ""X"" Co"\tNA\nb\t\t\n')
    rows = tables.as_records(tables.read_tsv(spark, f"file://{path}"), 2).orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [("a", 'Joe "X" Co', "", "NA", 2), ("b", "", "", "", 2)]


def test_stream_finds_what_arrives(spark, tmp_path):
    d = Data(spark, DIR)
    index = d.weighted.where("source = 1")
    arrived = d.records.where("source = 2").select("entity_id", "business_name", "business_address", "country", "source")
    arrived.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(arrived.schema).parquet(f"file://{tmp_path}/in")
    incremental.matching(stream, index, f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination()
    found = {tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/out").select("q", "t").collect()}
    truth = {(f"S1-{k}", f"S2-{k}") for k in range(150) if k % 10 in (1, 5)}
    assert len(found & truth) > 0.8 * len(truth)


def test_faults(spark):
    s1, t = spark.createDataFrame([("a",), ("b",)], "q string"), spark.createDataFrame([("x",)], "t string")
    c = spark.createDataFrame([("a", "x"), ("b", "")], "source1_entity_id string, candidate_entity_ids string")
    m = spark.createDataFrame([("a", "x,z"), ("a", "")], "source1_entity_id string, matched_entity_ids string")
    got = {r[0]: r[1] for r in sinks.faults(s1, t, c, m).collect()}
    assert got == {"missing row": 1, "repeated row": 1, "unknown record": 0, "unknown target": 1, "match without candidate": 1}


@pytest.mark.parametrize("part", [3, 2000])
def test_top_cosine_by_tiles(spark, part):
    """Tiles of any size give what all pairs give: many equal scores, a block without targets, a record in two blocks, one without grams."""
    one = blocking.ONE
    records = [(f"e{i:02d}", 1 if i % 2 else 2 + i % 3 // 2, "b" if i % 5 else "c") for i in range(40)] + [("lone", 1, "d"), ("bare", 1, "b"), ("bare2", 2, "b")]
    weights = {e: {f"g{(int(e[1:]) * k) % 7}": one // (2 + k) for k in range(1, 4)} for e, _, _ in records if e[1:].isdigit()}
    weights["lone"] = {"g1": one}
    placed = records + [("e02", 2, "c")]
    postings = spark.createDataFrame([(e, g, w) for e, gs in weights.items() for g, w in gs.items()], "entity_id string, gram string, w long")
    got = blocking.top_cosine(postings, spark.createDataFrame(placed, "entity_id string, source int, block string"), 4, 0.15, part)
    wanted = []
    for q, source, block in placed:
        if source == 1:
            dots = [(sum(w * weights.get(t, {}).get(g, 0) for g, w in weights.get(q, {}).items()) / float(one * one), t) for t, s, b in placed if s > 1 and b == block]
            wanted += [(q, t, score) for score, t in sorted((x for x in dots if x[0] >= 0.15), key=lambda x: (-x[0], x[1]))[:4]]
    assert sorted(map(tuple, got.collect())) == sorted(wanted) and wanted
    assert blocking.top_cosine(postings.limit(0), spark.createDataFrame(placed, "entity_id string, source int, block string"), 4).count() == 0


def test_joins_of_records_are_not_broadcast(spark, tmp_path):
    """Rows that grow with the records don't go through the driver, at the default size up to which Spark broadcasts."""
    from recordloom.operators import blocking, evaluate, postings

    rows = [(f"{s}-{i}", s, "x", f"name {i % 7} word{i % 3}", f"{i} main street") for i in range(30) for s in (1, 2)]
    spark.createDataFrame(rows, "entity_id string, source int, country_n string, name_n string, addr_n string").write.parquet(f"{tmp_path}/canon")
    canon = spark.read.parquet(f"{tmp_path}/canon")
    grams = postings.gram_postings(canon, "name_n")
    pairs = blocking.top_cosine(grams, blocking.blocks(canon, by_country=False), 3)
    cosines = blocking.pair_cosine(pairs.select("q", "t"), grams, "p1")
    truth = spark.createDataFrame([("1-0", "2-0")], "s1_id string, t_id string")
    assert cosines.count() == pairs.count() > 0
    for made, keys in ((grams, ("gram", "entity_id")), (postings.with_weights(canon), ("token", "entity_id")), (cosines, ("gram", "entity_id", "q", "t")), (evaluate.labelled(pairs, truth), ("q",))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        met = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
        assert not [x for x in met if any(f"{k}#" in x for k in keys)], met
        assert "SortMergeJoin" in plan


def test_pair_cosine_grows_with_the_grams_of_a_pair(spark):
    """Two records of 60,000 grams take seconds, not the product of their grams; grams of any characters and size, absent records and null ids too."""
    n, began = 60_000, time.time()
    rows = spark.range(2 * n).selectExpr(f"if(id < {n}, 'q', 't') as entity_id", f"id % {n} + if(id < {n}, 0, 7) as i")
    grams = rows.selectExpr("entity_id", "if(i % 3 = 0, concat(i, 'é'), cast(i as string)) as gram", "1 + (i * 31 + if(entity_id = 'q', 5, 11)) % 1009 as w").unionByName(
        spark.createDataFrame([("s", "", 3), ("s", "a b", 5), ("u", "", 7), ("u", "a b\n", 11)], "entity_id string, gram string, w long")
    )
    pairs = spark.createDataFrame([("q", "t", 1), ("s", "u", 2), ("q", "u", 3), ("q", "nobody", 4), (None, "t", 5)], "q string, t string, n int")
    got = {r["n"]: r["p1"] for r in blocking.pair_cosine(pairs, grams, "p1").collect()}
    one = float(1 << 60)
    assert got == {1: sum((1 + (i * 31 + 5) % 1009) * (1 + (i * 31 + 11) % 1009) for i in range(7, n)) / one, 2: 21 / one, 3: 0.0, 4: 0.0, 5: 0.0}
    assert time.time() - began < 45


def test_truth_and_rendered_records_are_not_broadcast(spark, tmp_path):
    """The ground truth, which gives labels, and the rendered records: only the nations go through the driver."""
    made = synth.records(spark, DIR)
    made.write.parquet(f"{tmp_path}/records")
    stored = spark.read.parquet(f"{tmp_path}/records")
    assert stored.count() > 0 and synth.truth(stored).count() > 0
    for rows, key in ((made, "s_suppkey"), (synth.truth(stored), "true_id")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan) if not x.startswith("c_nationkey#")]
        assert re.search(rf"SortMergeJoin \[{key}#", plan)


def test_packed_grams_and_their_pairs(spark):
    """Packed postings are the long ones, and pairs that go to the tiles get the cosines of pairs that meet their grams: absent records, nulls and further columns too."""
    from recordloom.operators import postings

    d = Data(spark, DIR)
    for text, sizes in (("full_n", (3, 4)), ("name_n", (2, 3))):
        long = {(r["entity_id"], r["gram"]): r["w"] for r in postings.gram_postings(d.canon, text, sizes).collect()}
        got, repeated = {}, 0
        for r in postings.packed_postings(d.canon, text, sizes).collect():
            for g, w in zip(r["grams"], r["ws"], strict=True):
                name = g if isinstance(g, str) else g.to_bytes(4, "big").lstrip(b"\0").decode()
                repeated += (r["entity_id"], name) in got
                got[r["entity_id"], name] = w
        assert not repeated and got.keys() == long.keys() and max(abs(got[x] - long[x]) for x in got) <= 1
    pairs = d.key_pairs.withColumn("n", F.lit(7)).unionByName(spark.createDataFrame([("S1-1", "nobody", 8), ("S1-1", None, 9)], "q string, t string, n int"))
    grams = d.grams("name_n")
    tiled, joined = (sorted((str(x) for x in blocking.pair_cosine(pairs, grams, "p1", *placed).collect())) for placed in ((d.placed,), ()))
    assert tiled == joined and len(tiled) == pairs.count()
    plan = blocking.pair_cosine(pairs, grams, "p1", d.placed)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_tile_of_many_targets():
    """A tile holds a few rows of scores at a time, and its best are those of all exact scores: common grams, grams that always come together, repeated records."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, m, k = 30_000, 600, 5
    every = [np.unique(np.concatenate([[1, 2, 3], 10 + 3 * rng.integers(0, 8, 1).repeat(3) + [0, 1, 2], rng.integers(100, 900, 5)])) for _ in range(n + m - 300)]
    every += every[:300]
    ws = [(rng.integers(1, 5, len(x)) if i % 3 else np.full(len(x), 2)).astype(np.float64) for i, x in enumerate(every)]
    ws[-300:] = ws[:300]
    ws = [np.floor(w / np.sqrt((w * w).sum()) * blocking.ONE) for w in ws]
    table = lambda key, at: pa.table({key: [f"{key}{i:05d}" for i in at], "grams": pa.array([every[i] for i in at], pa.list_(pa.int32())), "ws": pa.array([ws[i] for i in at], pa.list_(pa.int32()))})
    left, right = table("q", range(n, n + m)), table("t", range(n))
    schema = pa.schema([("q", pa.string()), ("t", pa.string()), ("score", pa.float64())])
    tracemalloc.start()
    got = blocking._tile_product(k, 0.15, schema)(left, right).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 230e6, peak  # a score for each pair of the tile alone has 144e6 bytes, twice
    dense = np.zeros((n, 900), np.int64)
    for i in range(n):
        dense[i, every[i]] = ws[i]
    for i in (n, n + 5, n + m - 300, n + m - 1):
        row = np.zeros(900, np.int64)
        row[every[i]] = ws[i]
        score = dense @ row / float(blocking.ONE**2)
        best = np.lexsort((np.arange(n), -score))[:k]
        assert [(r["t"], r["score"]) for r in got if r["q"] == f"q{i:05d}"] == [(f"t{j:05d}", score[j]) for j in best if score[j] >= 0.15]
