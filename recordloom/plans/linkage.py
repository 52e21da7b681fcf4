"""The whole linkage: candidates, two stages of models, structure, decision, files."""

from __future__ import annotations

import argparse
import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import norm_text
from ..operators import blocking, evaluate, features, model, normalise, postings, structure
from ..sources import sinks, tables
from ..sources.stages import stage


@dataclasses.dataclass
class Split:
    """Weighted canonical records, their n-gram postings and blocks."""

    weighted: DataFrame
    name: DataFrame
    full: DataFrame
    placed: DataFrame
    vectors: DataFrame | None = None

    @property
    def s1(self) -> DataFrame:
        return self.weighted.where("source = 1").select(F.col("entity_id").alias("q"))


def prepared(records: DataFrame, cfg: Config, folder: str, tag: str, rewrites: dict[str, str] | None = None, by_country: bool = True, vectors: DataFrame | None = None) -> Split:
    """Records normalised and indexed, stored. Weights come from the split's own records."""
    spark, key = records.sparkSession, {"tag": tag, "rewrites": rewrites, "ngrams": cfg.ngrams, "sample": cfg.sample, "seed": cfg.seed}
    weighted = stage(spark, folder, "weighted", lambda: postings.with_weights(normalise.canonical(records, rewrites)), **key)
    name = stage(spark, folder, "grams_name", lambda: postings.packed_postings(weighted, "name_n", cfg.ngrams), **key)
    full = stage(spark, folder, "grams_full", lambda: postings.packed_postings(weighted, "full_n", cfg.ngrams), **key)
    return Split(weighted, name, full, blocking.blocks(weighted, by_country), vectors)


Blocker = Callable[[Split, Config], dict[str, DataFrame]]


def tfidf_views(split: Split, cfg: Config) -> dict[str, DataFrame]:
    return {"name": blocking.top_cosine(split.name, split.placed, cfg.k_name, cfg.threshold), "full": blocking.top_cosine(split.full, split.placed, cfg.k_full, cfg.threshold)}


def lsh_views(split: Split, cfg: Config) -> dict[str, DataFrame]:
    bands = [blocking.band_keys(split.weighted, text, cfg.lsh_bands, cfg.lsh_rows, cfg.seed + i) for i, text in enumerate(("name_n", "full_n"))]
    pairs = blocking.key_pairs(bands[0].unionByName(bands[1]), split.placed, cfg.lsh_cap)
    scored = blocking.pair_cosine(blocking.pair_cosine(pairs, split.name, "cn"), split.full, "cf").withColumn("score", F.greatest("cn", "cf"))
    return {"lsh": blocking.top_scored(scored, "score", cfg.k_lsh)}


def dense_views(split: Split, cfg: Config) -> dict[str, DataFrame]:
    """The k_dense targets nearest to each source-1 record by the vectors (entity_id, v) of the split. Source-1 records are the queries, all targets are met in blocks."""
    if split.vectors is None:
        raise ValueError("use_dense needs a table of vectors beside the split's files")
    v = split.vectors.join(split.weighted.select("entity_id", "source"), "entity_id").select(F.col("entity_id").alias("id"), "v", "source")
    return {"dense": blocking.nearest(v.where("source > 1").drop("source"), v.where("source = 1").drop("source"), cfg.k_dense, kind="string")}


#: Retrieval by name of Config.blocker; further ones may be added.
BLOCKERS: dict[str, Blocker] = {"tfidf": tfidf_views, "lsh": lsh_views, "both": lambda split, cfg: tfidf_views(split, cfg) | lsh_views(split, cfg)}


def retrieved(split: Split, cfg: Config) -> DataFrame:
    """q, t, flags, n_views, both cosines, from the views of the blocker that cfg names, dense ones if cfg.use_dense, and exact keys always."""
    if cfg.blocker not in BLOCKERS:
        raise ValueError(f"no blocker {cfg.blocker}; there are {sorted(BLOCKERS)}")
    views = dict(BLOCKERS[cfg.blocker](split, cfg))
    if cfg.use_dense:
        views |= dense_views(split, cfg)
    views["key"] = blocking.key_pairs(blocking.record_keys(split.weighted), split.placed, cfg.key_cap)
    pairs = blocking.union_views(views)
    return blocking.pair_cosine(blocking.pair_cosine(pairs, split.name, "cos_name"), split.full, "cos_full")


def cheap(pairs: DataFrame, split: Split) -> DataFrame:
    return features.with_context(features.with_pair_features(pairs, split.weighted, features.CHEAP))


def complete(pairs: DataFrame, split: Split) -> DataFrame:
    rest = tuple(f for f in features.FEATURES if f not in pairs.columns)
    out = features.with_pair_features(pairs, split.weighted, rest)
    return features.with_collective(features.with_competition(out), split.weighted)


STAGE3 = tuple(f for g, fs in features.GROUPS.items() if g != "cross_encoder" for f in fs)


PairScorer = Callable[[DataFrame], DataFrame]


def with_pair_scores(pairs: DataFrame, weighted: DataFrame, scorer: PairScorer | None) -> DataFrame:
    """pairs with ce_logit from a scorer, which gets (q, t, text_a, text_b) and returns (q, t, ce_logit): a cross encoder, say. Without one there is no such column."""
    if scorer is None:
        return pairs
    text = weighted.select("entity_id", F.format_string("[COL] name [VAL] %s [COL] address [VAL] %s", "raw_name", "raw_addr").alias("text"))
    asked = pairs.select("q", "t").join(text.select(F.col("entity_id").alias("q"), F.col("text").alias("text_a")), "q").join(text.select(F.col("entity_id").alias("t"), F.col("text").alias("text_b")), "t")
    return pairs.join(scorer(asked.select("q", "t", "text_a", "text_b")).select("q", "t", F.col("ce_logit").cast("double").alias("ce_logit")), ["q", "t"], "left").na.fill(0.0, ["ce_logit"])


def run(spark: SparkSession, data_dir: str, out_dir: str, cfg: Config | None = None, test: bool = True, scorer: PairScorer | None = None) -> dict:
    """Trains on the train split, answers the test split, writes files to out_dir; returns the metrics. With cfg.holdout_country the records of that country are held out: no model, curve, bound or
    decision sees them, and only they are evaluated; without it the out-of-fold answers of all are. scorer: see with_pair_scores()."""
    cfg = cfg or Config()
    folder = f"{out_dir}/stages"
    records, truth = tables.load_split(spark, data_dir, "train", cfg.sample, cfg.seed)
    if truth is None:
        raise ValueError("the train split has no ground truth")
    real, sizes = tables.truth_pairs(truth), tables.truth_sizes(truth).withColumnRenamed("s1_id", "q")
    source_files = tables.split_files(spark, data_dir, "train")
    rewrites = {r["short"]: r["long"] for r in normalise.mined_abbreviations(records, real, cfg.mined_min_count).collect()}  # a dictionary of short words
    split = prepared(records, cfg, folder, f"train{source_files}", rewrites)
    found = evaluate.switches(split.weighted, real, sizes).first()
    block = found["country_block"] if cfg.country_block is None else cfg.country_block
    hard = found["hard_assign"] if cfg.hard_assign is None else cfg.hard_assign
    kmax = max(cfg.kmax, found["kmax"])
    split = prepared(records, cfg, folder, f"train{source_files}", rewrites, block, tables.vectors(spark, data_dir, "train") if cfg.use_dense else None)
    key = {"files": source_files, "cfg": dataclasses.asdict(cfg), "block": block, "rewrites": rewrites}

    def cheap_rows() -> DataFrame:
        return cheap(evaluate.labelled(retrieved(split, cfg), real), split)

    rows = stage(spark, folder, "cheap", cheap_rows, **key)
    held = None
    if cfg.holdout_country:
        held = split.weighted.where(F.col("country_n") == norm_text(F.lit(cfg.holdout_country))).select(F.col("entity_id").alias("q"), F.lit(True).alias("held"))
        if not held.limit(1).count():
            raise ValueError(f"no records of {cfg.holdout_country}")
        rows = rows.join(held, "q", "left").withColumn("held", F.coalesce("held", F.lit(False)))
    rows = model.with_folds(rows, cfg.stage2_folds, cfg.seed, F.col("held") if held is not None else None)
    metrics: dict = {"blocking": evaluate.blocking_stats(rows, real, split.s1.agg(F.count(F.lit(1)).alias("n")), split.weighted.where("source > 1").agg(F.count(F.lit(1)).alias("n"))).first().asDict()}
    names2 = features.active(features.CHEAP, cfg.drop_groups)
    scored, model2, parts2 = model.out_of_fold(rows, names2, "raw1", cfg.stage2_folds, cfg.rounds, cfg.depth, cfg.neg_rate, cfg.seed)
    scored = stage(spark, folder, "stage2", lambda: scored, **key)
    iso1 = model.isotonic(scored, "raw1")
    scored = model.calibrated(scored, iso1, "raw1", "p1")
    eps = structure.choose_eps(scored.where("is_pool"), cfg.prune_recall, cfg.eps_floor, cfg.eps_ceiling).first()["eps"]
    kept = structure.pruned(scored, eps, kmax)
    counts = (split.s1.agg(F.count(F.lit(1)).alias("n")), split.weighted.where("source > 1").agg(F.count(F.lit(1)).alias("n")))
    lost = scored.where("is_pool").join(kept.select("q", "t"), ["q", "t"], "left_anti").agg(F.coalesce(F.sum("p1"), F.lit(0.0)))
    metrics |= {
        "recall_by_view": {r["view"]: r["recall"] for r in evaluate.view_recall(rows.drop("y"), real).collect()}, "expected_pairs_lost": lost.first()[0],
        "blocking_pruned": evaluate.blocking_stats(kept, real, *counts).first().asDict(),
    }
    third = stage(spark, folder, "complete", lambda: with_pair_scores(complete(kept, split), split.weighted, scorer), **key, scorer=getattr(scorer, "__name__", str(scorer)), eps=eps, kmax=kmax)
    third = third.drop("fold").withColumn("fold", model.fold_of(F.col("q"), cfg.n_folds, cfg.seed))
    names3 = features.active(tuple(f for f in (*STAGE3, *features.GROUPS["cross_encoder"]) if f in third.columns), cfg.drop_groups)
    scored3, model3, parts3 = model.out_of_fold(third, names3, "p3_raw", cfg.n_folds, cfg.rounds, cfg.depth, 1.0, cfg.seed)
    scored3 = stage(spark, folder, "stage3", lambda: scored3, **key, eps=eps, kmax=kmax)
    iso3 = model.isotonic(scored3, "p3_raw")
    answered = structure.shared_out(model.calibrated(scored3, iso3, "p3_raw", "p3"), hard)
    answered = stage(spark, folder, "answered", lambda: answered, **key, eps=eps, kmax=kmax, hard=hard)
    entities = structure.entity_table(answered, split.s1).join(sizes, "q").withColumn("y", (F.col("n") == 0).cast("int")).withColumn("t", F.lit(""))
    if held is not None:
        entities = entities.join(held, "q", "left")
    entities = model.with_folds(entities, cfg.n_folds, cfg.seed, F.coalesce("held", F.lit(False)) if held is not None else None).drop("held")
    names1 = [c for c in entities.columns if c not in ("q", "t", "y", "n", "fold", "is_pool")]
    none, model1, parts1 = model.out_of_fold(entities, names1, "pe", cfg.n_folds, cfg.rounds, cfg.depth, 1.0, cfg.seed)
    none = stage(spark, folder, "none", lambda: none.select("q", "pe"), **key, eps=eps, kmax=kmax, hard=hard)
    pool, judged = (sizes, sizes) if held is None else (sizes.join(held, "q", "left_anti"), sizes.join(held, "q", "left_semi"))
    grid = structure.tuned(answered.join(pool.select("q"), "q", "left_semi"), none, real, pool, cfg.temperatures, cfg.scales, cfg.thresholds, cfg.beta).orderBy("g").collect()  # the settings
    best = grid[0]
    for row in grid[1:]:
        if row["f"] > best["f"] + 1e-9:
            best = row

    def choose(pairs: DataFrame, pe: DataFrame) -> DataFrame:
        if best["policy"] == "threshold":
            return structure.over_threshold(pairs, best["tau"])
        return structure.decided(pairs, pe, best["temperature"], best["scale"], cfg.beta).select("q", "t")

    selected = choose(answered, none)
    per = structure.macro_f_by(selected, real, judged, cfg.beta)
    base = structure.macro_f_by(structure.over_threshold(answered, 0.5), real, judged, cfg.beta)
    country = split.weighted.select(F.col("entity_id").alias("q"), "country_n")
    metrics |= {
        "eps": eps, "kmax": kmax, "hard_assign": hard, "country_block": block, "decision": best.asDict(), "macro_f": per.agg(F.avg("f")).first()[0],
        "by_country": {r[0]: r[1] for r in per.join(country, "q").groupBy("country_n").agg(F.avg("f")).collect()}, "rewrites": len(rewrites),
        "macro_f_of_threshold": base.agg(F.avg("f")).first()[0], "n_judged": judged.count(),
    }
    answered.select("q", "t", "y", "p1", "p3", "p").write.mode("overwrite").parquet(f"{out_dir}/train_oof_pairs.parquet")
    gains = spark.createDataFrame(model.importances(model3, names3, features.GROUPS), "feature string, group string, gain double")
    metrics["gain_by_group"] = {r["group"]: r["share"] for r in evaluate.gain_by_group(gains).collect()}
    sinks.write_csv(gains, f"{out_dir}/feature_importance.csv")
    sinks.write_text(spark, f"{out_dir}/error_samples.txt", "\n".join(f"{r[0]}\t{r[1]}\t{r[2]}" for r in evaluate.errors(selected, real).collect()))  # 400 lines at most
    if test and tables.exists(spark, f"{data_dir}/test_source1.tsv"):
        records, truth = tables.load_split(spark, data_dir, "test")
        files = tables.split_files(spark, data_dir, "test")
        split = prepared(records, cfg, folder, f"test{files}", rewrites, block, tables.vectors(spark, data_dir, "test") if cfg.use_dense else None)
        rows = stage(spark, folder, "test_cheap", lambda: cheap(retrieved(split, cfg), split), **key, test=files)
        rows = model.calibrated(model.applied(model2, parts2, rows, "raw1"), iso1, "raw1", "p1")
        third = with_pair_scores(complete(structure.pruned(rows, eps, kmax), split), split.weighted, scorer)
        scored = model.calibrated(model.applied(model3, parts3, third, "p3_raw"), iso3, "p3_raw", "p3")
        answered = stage(spark, folder, "test_answered", lambda: structure.shared_out(scored, hard), **key, test=files, eps=eps, kmax=kmax, hard=hard)
        pe = model.applied(model1, parts1, structure.entity_table(answered, split.s1), "pe").select("q", "pe")
        selected = stage(spark, folder, "test_selected", lambda: choose(answered, pe), **key, test=files, eps=eps, kmax=kmax, hard=hard, best=best.asDict())
        candidates, matches = sinks.id_lists(split.s1, answered, "candidate_entity_ids"), sinks.id_lists(split.s1, selected, "matched_entity_ids")
        sinks.write_tsv(candidates, f"{out_dir}/candidate_pairs.tsv")
        sinks.write_tsv(matches, f"{out_dir}/matching_results.tsv")
        answered.select("q", "t", "p1", "p3", "p").write.mode("overwrite").parquet(f"{out_dir}/test_scored_pairs.parquet")
        targets = split.weighted.where("source > 1").select(F.col("entity_id").alias("t"))
        metrics["test_pairs"], metrics["test_pairs_pruned"] = rows.count(), answered.count()
        metrics["faults"] = {r[0]: r[1] for r in sinks.faults(split.s1, targets, candidates, matches).collect()}
        if truth is not None:
            real = tables.truth_pairs(truth)
            per = structure.macro_f_by(selected, real, tables.truth_sizes(truth).withColumnRenamed("s1_id", "q"), cfg.beta)
            country = split.weighted.select(F.col("entity_id").alias("q"), "country_n")
            metrics["test_macro_f"] = per.agg(F.avg("f")).first()[0]
            metrics["test_by_country"] = {r[0]: r[1] for r in per.join(country, "q").groupBy("country_n").agg(F.avg("f")).collect()}
            counts = (split.s1.agg(F.count(F.lit(1)).alias("n")), targets.agg(F.count(F.lit(1)).alias("n")))
            metrics["test_blocking"], metrics["test_blocking_pruned"] = (evaluate.blocking_stats(x, real, *counts).first().asDict() for x in (rows, answered))
    sinks.write_metrics(spark, f"{out_dir}/metrics.json", metrics)
    return metrics


def main(args: list[str] | None = None) -> None:
    """A flag for every setting of Config."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data-dir", default="dataset")
    parser.add_argument("--out-dir", default="output")
    parser.add_argument("--no-test", action="store_true")
    for f in dataclasses.fields(Config):
        flag = "--" + f.name.replace("_", "-")
        if isinstance(f.default, tuple):
            parser.add_argument(flag, nargs="*", type=type(f.default[0]) if f.default else str, default=list(f.default))
        elif isinstance(f.default, bool) or f.name in ("hard_assign", "country_block"):
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            parser.add_argument(flag, type=str if f.default is None else type(f.default), default=f.default)
    given = vars(parser.parse_args(args))
    data, out, skip = (given.pop(k) for k in ("data_dir", "out_dir", "no_test"))
    cfg = Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
    spark = SparkSession.builder.appName("recordloom").getOrCreate()
    print(run(spark, data, out, cfg, not skip))


if __name__ == "__main__":
    main()
