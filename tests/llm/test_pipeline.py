import collections
import random

import corpus_pipeline
import sentencepiece
from recordloom.llm import mixing, ngram_join, quality
from recordloom.llm.queries import tokenizer_file

DIR = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = corpus_pipeline.documents(spark, DIR)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {i for i, t in rows.items() if quality.measurements(t.encode())[0] >= 20}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "n-gram Jaccard join", "mixing sources", "SentencePiece"]
    kept = stages["quality rules"](spark, docs, DIR)
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and ids <= good
    one = stages["n-gram Jaccard join"](spark, kept, DIR)
    least = {r["doc_id"] for r in ngram_join.components_of(kept).where("doc_id = component_id").collect()}
    assert {r[0] for r in one.select("doc_id").collect()} == least and one.columns == docs.columns
    mixed = collections.Counter(r[0] for r in stages["mixing sources"](spark, one, DIR).select("doc_id").collect())
    assert set(mixed) <= least and max(mixed.values()) <= 2
    last = corpus_pipeline.run(spark, DIR)
    assert collections.Counter(r["doc_id"] for r in last.collect()) == mixed


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))


def passes(text):
    """The production rules, each by its SQL over the measurements."""
    values = dict(zip(quality.MEASURES, quality.measurements(None if text is None else text.encode()), strict=True))
    return not any(eval(rule, {}, values) for rule in quality.RULES.values())


def least_of_groups(rows):
    """Of each group that shares shingles the row of the smallest id; rows without an id all stay."""
    sets = []
    for r in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]).encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    return set(least.values())


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, empty, long and repeated rows, clashing names, and no rows at all, against a plain version of each stage; the mix is random, so its plan is taken."""
    rng = random.Random(12)
    base, long = words(rng, 60), words(rng, 5000)
    near = " ".join([*base.split()[:-1], "zz"])
    odd = [(1, base, "en", "s1"), (2, base, "en", "s1"), (3, near, None, "s2"), (4, None, None, None), (5, "", "en", "s2"), (7, long, "de", None), (11, long + " x", "de", "s1"), (None, base, "en", "s1"), (13, words(rng, 40), "en", "s1")]
    odd += [odd[-1]] * 3 + [(None, words(rng, 30), "en", None), (14, "A " * 30, "en", "s1"), (15, "\u00e9 #$% x\x0by", "en", "s1")]
    odd += [(20 + i, words(rng, rng.randrange(15, 50)), "en", rng.choice(["s1", "s2", "s3"])) for i in range(60)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, chosen_id long, times int"
    docs = spark.createDataFrame([(*r, 1, 2, "x", 3, 9) for r in odd], schema)
    docs.write.parquet(f"{tmp_path}/sf/documents.parquet")
    good = [r for r in docs.collect() if passes(r["text"])]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, "")
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, good)) and kept.columns == docs.columns
    least = least_of_groups(good)
    one = stages["n-gram Jaccard join"](spark, kept, "")
    assert collections.Counter(r["doc_id"] for r in one.collect()) == collections.Counter([*least, *(None for r in good if r["doc_id"] is None)])
    plan = collections.Counter()
    for r in mixing.mix_plan(one).collect():
        plan[r["doc_id"], r["source"], r["size"]] += r["copies"]
    out = corpus_pipeline.run(spark, f"{tmp_path}/sf").collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    texts = collections.defaultdict(set)
    for r in one.collect():
        texts[r["doc_id"]].add(tuple(sp.encode(r["text"])))
    assert sum(plan.values()) == len(out) and all(tuple(r["ids"]) in texts[r["doc_id"]] for r in out)
    want = collections.Counter()
    for (doc_id, _, _), n in plan.items():
        want[doc_id] += n
    assert +want == collections.Counter(r["doc_id"] for r in out)
    docs.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
