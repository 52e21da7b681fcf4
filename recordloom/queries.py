"""One query for each operator of the linkage engine, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .functions import strings as S
from .functions import text as T
from .operators import blocking, evaluate, features, model, normalise, postings, structure
from .sources import sinks, synth, tables
from .sources.stages import stage, work_folder

CFG = Config()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


class Data:
    """The records of a folder and what is derived from them. Each step is a stored stage, written once for a state of the input files, so that a query's plan starts at
    the last step it needs, and a lost executor costs one step at most."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.files = tables.fingerprint(spark, [f"{sf_dir}/{t}.parquet" for t in ("customer", "supplier", "nation")])

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return stage(self.spark, work_folder(self.spark), name.replace(" ", "_"), make, dir=self.dir, files=self.files, cfg=asdict(CFG))

    @property
    def records(self) -> DataFrame:
        return self._once("records", lambda: synth.records(self.spark, self.dir))

    @property
    def truth(self) -> DataFrame:
        return self._once("truth", lambda: synth.truth(self.records))

    @property
    def s1(self) -> DataFrame:
        return self.records.where("source = 1").select(F.col("entity_id").alias("q"))

    @property
    def sizes(self) -> DataFrame:
        n = self.truth.groupBy(F.col("s1_id").alias("q")).agg(F.count(F.lit(1)).cast("int").alias("n"))
        return self._once("sizes", lambda: self.s1.join(n.hint(postings.MERGE), "q", "left").na.fill(0))

    @property
    def canon(self) -> DataFrame:
        return self._once("canon", lambda: normalise.canonical(self.records))

    @property
    def weighted(self) -> DataFrame:
        return self._once("weighted", lambda: postings.with_weights(self.canon))

    @property
    def placed(self) -> DataFrame:
        return self._once("placed", lambda: blocking.blocks(self.canon))

    def grams(self, text: str) -> DataFrame:
        return self._once(f"grams {text}", lambda: postings.packed_postings(self.canon, text, CFG.ngrams))

    @property
    def keys(self) -> DataFrame:
        return self._once("keys", lambda: blocking.record_keys(self.weighted))

    @property
    def key_pairs(self) -> DataFrame:
        return self._once("key_pairs", lambda: blocking.key_pairs(self.keys, self.placed, CFG.key_cap))

    @property
    def name_pairs(self) -> DataFrame:
        return self._once("name_pairs", lambda: blocking.top_cosine(self.grams("name_n"), self.placed, CFG.k_name, CFG.threshold))

    @property
    def full_pairs(self) -> DataFrame:
        return self._once("full_pairs", lambda: blocking.top_cosine(self.grams("full_n"), self.placed, CFG.k_full, CFG.threshold))

    @property
    def views(self) -> DataFrame:
        return self._once("views", lambda: blocking.union_views({"name": self.name_pairs, "full": self.full_pairs, "key": self.key_pairs}))

    @property
    def cosines(self) -> DataFrame:
        """Candidates with both cosines."""
        one = lambda: blocking.pair_cosine(blocking.pair_cosine(self.views.select("q", "t"), self.grams("name_n"), "cos_name", self.placed), self.grams("full_n"), "cos_full", self.placed)
        return self._once("cosines", one)

    @property
    def scored(self) -> DataFrame:
        """Candidates with the name's cosine in the place of a probability."""
        return self._once("scored", lambda: blocking.pair_cosine(self.views.select("q", "t"), self.grams("name_n"), "p1", self.placed))


def r6(c: str | Column, name: str | None = None) -> Column:
    out = F.round(F.col(c).cast("double") if isinstance(c, str) else c, 6)
    return out.alias(name or c) if isinstance(c, str) or name else out


@query
def records_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).records.drop("true_id")


@query
def norm_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Data(spark, sf_dir).canon
    return c.select("entity_id", "source", "country_n", "name_n", "addr_n", "full_n", "core_text", "addr_core", T.joined(F.col("codes")).alias("codes"), T.joined(F.col("nums")).alias("nums"))


@query
def norm_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", T.norm_text(F.col("text")).alias("text_n"))


@query
def abbrev_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).canon.select("entity_id", "name_n", "addr_n")


@query
def landmark_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).canon.select("entity_id", "addr_core", "landmark")


@query
def digit_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).canon.select("entity_id", T.joined(F.col("codes")).alias("codes"), T.joined(F.col("nums")).alias("nums"))


@query
def acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).canon.select("entity_id", "core_text", "suffix", "acr", "nospace", "first_tok")


@query
def phonetic_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).canon.select("entity_id", T.joined(F.col("phon")).alias("phon"), "phon_first")


@query
def phonetic_metaphone(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = normalise.canonical(synth.records(spark, sf_dir), coder="metaphone")
    return c.select("entity_id", T.joined(F.col("phon")).alias("phon"), "phon_first")


@query
def idf_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.country_idf(Data(spark, sf_dir).canon).select("country_n", "token", "df", r6("idf"))


@query
def rare_core_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Data(spark, sf_dir).weighted
    # weights equal to 9 places are equal, so that both engines break the same ties
    return w.select("entity_id", postings.rarest(F.array_distinct("core"), F.transform_values("w", lambda k, v: F.round(v, 9))).alias("token"))


@query
def char_gram_tfidf_topk_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).name_pairs.select("q", "t", r6("score"))


@query
def char_gram_tfidf_topk_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).full_pairs.select("q", "t", r6("score"))


@query
def exact_key_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).key_pairs


@query
def key_fanout_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return blocking.fan_out(d.keys, d.placed, CFG.key_cap)


@query
def lsh_band_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    bands = blocking.band_keys(d.canon, "name_n", CFG.lsh_bands, CFG.lsh_rows, CFG.seed)
    return blocking.key_pairs(bands, d.placed, CFG.lsh_cap)


@query
def candidate_union_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).views.select("q", "t", *[f"found_{v}" for v in blocking.VIEWS], "sc_dense", "n_views")


@query
def blocking_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    n1, n2 = (d.records.where(c).agg(F.count(F.lit(1)).alias("n")) for c in ("source = 1", "source > 1"))
    out = evaluate.blocking_stats(d.views, d.truth, n1, n2)
    return out.select("n_pairs", r6("avg_cand"), r6("reduction_ratio"), r6("completeness"), r6("precision"))


@query
def per_view_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return evaluate.view_recall(d.views, d.truth).select("view", "n_pairs", "hits", r6("recall"))


@query
def eda_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return evaluate.switches(d.canon, d.truth, d.sizes).select(r6("agreement"), r6("uniqueness"), r6("singletons"), "largest", "country_block", "hard_assign", "kmax")


@query
def match_count_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.match_counts(Data(spark, sf_dir).sizes)


def _features(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    d = Data(spark, sf_dir)
    return features.with_pair_features(d.views.select("q", "t"), d.weighted, names).select("q", "t", *[r6(n) for n in names])


SET_FEATURES = (*features.GROUPS["name_token"], *features.GROUPS["address_token"], *features.GROUPS["numeric"], "phon_jac")
STRUCTURE_FEATURES = (*features.GROUPS["name_structure"], "phon_first_equal", "core_equal", "len_ratio", "ntok_diff", *features.GROUPS["missingness"])


@query
def pair_set_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, SET_FEATURES)


@query
def pair_structure_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, STRUCTURE_FEATURES)


@query
def pair_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, ("lev_name", "lev_addr"))


@query
def pair_prefix_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, ("prefix_sim",))


@query
def pair_jaro_winkler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, ("jw_name", "jw_nospace"))


@query
def pair_token_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, ("tsr_name", "tsort_name", "partial_name", "tsr_addr", "partial_addr"))


@query
def pair_cosines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).cosines.select("q", "t", r6("cos_name"), r6("cos_full"))


@query
def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.with_context(Data(spark, sf_dir).cosines)
    return out.select("q", "t", "n_cand", "cos_name_rank", r6("cos_name_margin"), "cos_full_rank", r6("cos_full_margin"))


@query
def competition_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.with_competition(Data(spark, sf_dir).scored)
    return out.select("q", "t", "p1_rank", r6("p1_margin"), "rev_rank", "rev_n", r6("rev_margin"), "mutual_best")


@query
def collective_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_sibling(Data(spark, sf_dir).scored).select("q", "t", F.coalesce("sib", F.lit("")).alias("sib"), r6("sib_p"), "n_confident")


@query
def collective_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return features.with_collective(d.scored, d.canon).select("q", "t", r6("sib_full_tsr"), r6("sib_name_jw"), r6("sib_p"), r6("sib_evidence"), "n_confident")


@query
def prune_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.pruned(Data(spark, sf_dir).scored, 0.3, CFG.kmax).select("q", "t", r6("p1"))


def _shared(spark: SparkSession, sf_dir: str, hard: bool) -> DataFrame:
    return structure.shared_out(Data(spark, sf_dir).scored, hard, "p1")


@query
def structural_assign_soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, False).select("q", "t", r6("p"))


@query
def structural_assign_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, True).select("q", "t", r6("p"))


@query
def entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of both cosines as probability, the whole text's as the raw one."""
    d = Data(spark, sf_dir)
    rows = features.with_competition(d.cosines.withColumn("p1", (F.col("cos_name") + F.col("cos_full")) / 2))
    rows = features.with_pair_features(rows, d.weighted, ("wjac_name", "code_agree", "num_agree"))
    s1 = d.records.where("source = 1").select(F.col("entity_id").alias("q"))
    out = structure.entity_table(rows, s1, "p1", "cos_full")
    return out.select("q", *[r6(c) for c in out.columns if c != "q"])


@query
def decide_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.over_threshold(Data(spark, sf_dir).scored, 0.7, "p1")


NONE_PE = 0.3


@query
def expected_f_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name's cosine as probability, the best CFG.kmax candidates, and P(no match) 0.3 for all."""
    rows = structure.pruned(Data(spark, sf_dir).scored, 0.3, CFG.kmax).select("q", "t", F.round("p1", 6).alias("p"))
    none = rows.select("q").distinct().withColumn("pe", F.lit(NONE_PE))
    return structure.decided(rows, none, beta=CFG.beta).select("q", "t")


def _macro(spark: SparkSession, sf_dir: str) -> tuple[Data, DataFrame]:
    d = Data(spark, sf_dir)
    return d, structure.macro_f_by(structure.over_threshold(d.scored, 0.7, "p1"), d.truth, d.sizes, CFG.beta)


@query
def macro_f_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _macro(spark, sf_dir)[1].agg(r6(F.avg("f"), "macro_f"), F.count(F.lit(1)).alias("n_records"))


@query
def macro_f_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, per = _macro(spark, sf_dir)
    return per.join(d.canon.select(F.col("entity_id").alias("q"), "country_n").hint(postings.MERGE), "q").groupBy("country_n").agg(r6(F.avg("f"), "macro_f"), F.count(F.lit(1)).alias("n_records"))


@query
def grid_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    rows = structure.pruned(d.scored, 0.3, CFG.kmax).select("q", "t", F.round("p1", 6).alias("p"))
    none = rows.select("q").distinct().withColumn("pe", F.lit(NONE_PE))
    return structure.tuned(rows, none, d.truth, d.sizes, CFG.temperatures, CFG.scales, CFG.thresholds, CFG.beta).select("policy", "temperature", "scale", "tau", r6("f"))


@query
def choose_eps_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return structure.choose_eps(evaluate.labelled(d.scored, d.truth), CFG.prune_recall, CFG.eps_floor, CFG.eps_ceiling).select(r6("eps"))


@query
def id_list_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    s1 = d.records.where("source = 1").select(F.col("entity_id").alias("q"))
    return sinks.id_lists(s1, d.key_pairs, "candidate_entity_ids")


@query
def truth_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    s1 = d.records.where("source = 1").select(F.col("entity_id").alias("q"))
    lists = sinks.id_lists(s1, d.truth.select(F.col("s1_id").alias("q"), F.col("t_id").alias("t")), "matched_entity_ids")
    return tables.truth_pairs(lists)


@query
def abbrev_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return normalise.mined_abbreviations(d.records, d.truth, CFG.mined_min_count, similar=False)


@query
def error_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    return evaluate.errors(structure.over_threshold(d.scored, 0.7, "p1"), d.truth)


@query
def submission_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold's answer against exact-key candidates: what isn't among them is a fault."""
    d = Data(spark, sf_dir)
    s1 = d.records.where("source = 1").select(F.col("entity_id").alias("q"))
    targets = d.records.where("source > 1").select(F.col("entity_id").alias("t"))
    matches = sinks.id_lists(s1, structure.over_threshold(d.scored, 0.7, "p1"), "matched_entity_ids")
    return sinks.faults(s1, targets, sinks.id_lists(s1, d.key_pairs, "candidate_entity_ids"), matches)


@query
def dense_knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: vectors whose id is divisible by 20."""
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return blocking.nearest(v, v.where("id % 20 = 0"), CFG.k_dense).select("q", "t", "score")


@query
def sampled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    lists = sinks.id_lists(d.records.where("source = 1").select(F.col("entity_id").alias("q")), d.truth.select(F.col("s1_id").alias("q"), F.col("t_id").alias("t")), "matched_entity_ids")
    return tables.sampled(d.records.drop("true_id"), lists, 0.25, CFG.seed)[0]


@query
def cross_encoder_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as the text that a pair model or a sentence model would read."""
    c = Data(spark, sf_dir).canon
    pair = F.format_string("[COL] name [VAL] %s [COL] address [VAL] %s", "raw_name", "raw_addr")
    return c.select("entity_id", pair.alias("pair_text"), F.concat(F.lit("query: "), F.concat_ws(" | ", "raw_name", "raw_addr")).alias("dense_text"))


@query
def oof_fold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.with_folds(Data(spark, sf_dir).key_pairs, CFG.n_folds, CFG.seed)


def _training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple[str, ...]]:
    """All candidates with the features of the first model, labels and folds, as the plan trains on them; wjac_all is for the curve alone."""
    d = Data(spark, sf_dir)
    found = d.views.join(d.cosines.hint(postings.MERGE), ["q", "t"])
    made = lambda: evaluate.labelled(features.with_context(features.with_pair_features(found, d.weighted, (*features.CHEAP, "wjac_all"))), d.truth)
    return model.with_folds(d._once("training", made), CFG.stage2_folds, CFG.seed), features.active(features.CHEAP, CFG.drop_groups)


@query
def gbt_oof_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, names = _training(spark, sf_dir)
    return model.out_of_fold(rows, names, "raw", CFG.stage2_folds, CFG.rounds, CFG.depth, CFG.neg_rate, CFG.seed)[0].select("q", "t", "y", "fold", "raw")


@query
def isotonic_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _training(spark, sf_dir)
    fitted = model.isotonic(rows, "wjac_all")
    return model.calibrated(rows, fitted, "wjac_all", "p").select("q", "t", "y", "wjac_all", "p")
