import pytest
from pyspark.sql import functions as F

from recordloom.sources import generator, tables


def plain_copies(truth):
    return {r["source1_entity_id"]: [x for x in r["matched_entity_ids"].split(",") if x] for r in truth.collect()}


def test_shares_ids_and_truth(spark):
    records, truth = generator.build(spark, "train", 4000, ("US", "India"))
    rows, lists = records.collect(), plain_copies(truth)
    ids = [r["entity_id"] for r in rows]
    assert len(ids) == len(set(ids)) and all(r["business_name"] and r["business_address"] for r in rows)
    assert {r["entity_id"] for r in rows if r["source"] == 1} == set(lists) and len(lists) == 4000
    matched = [x for xs in lists.values() for x in xs]
    assert len(matched) == len(set(matched)) and set(matched) <= {r["entity_id"] for r in rows if r["source"] > 1}
    assert all(x[:3] == f"S{r['source']}-" for r in rows for x in [r["entity_id"]])
    for k, share in enumerate(generator.MATCHES):
        assert abs(sum(len(x) == k for x in lists.values()) / 4000 - share) < 0.03
    country = {r["entity_id"]: r["country"] for r in rows}
    assert set(country.values()) == {"US", "India"} and all(country[q] == country[t] for q, ts in lists.items() for t in ts)
    assert abs(sum(x.startswith("S2") for x in matched) / len(matched) - generator.IN_SECOND) < 0.03
    others = set(ids) - set(matched) - set(lists)
    assert abs(sum(x.startswith("S2") for x in others) / 4000 - generator.HARD_NEGATIVE) < 0.03
    assert abs(sum(x.startswith("S3") for x in others) / 4000 - generator.OTHER_NEGATIVE) < 0.03


def test_rows_depend_on_neither_partitions_nor_size(spark):
    def of(n, parts):
        old = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", parts)
        try:
            return sorted(tuple(r) for r in generator.build(spark, "test", n, ("US", "France"), 3)[0].collect())
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if old is None else spark.conf.set("spark.sql.leafNodeDefaultParallelism", old)

    many = of(300, 7)
    assert many == of(300, 2) and set(of(100, 3)) <= set(many)
    assert many != sorted(tuple(r) for r in generator.build(spark, "test", 300, ("US", "France"), 4)[0].collect())
    assert of(0, 1) == []
    with pytest.raises(ValueError):
        generator.build(spark, "train", 1, ("Atlantis",))


def test_mistypes_are_one_edit(spark):
    texts = spark.range(600).withColumn("text", F.element_at(F.array(*map(F.lit, ("Pâtisserie", "abcd", "abc", ""))), (F.col("id") % 4 + 1).cast("int")))
    seen = {"same": 0, "less": 0, "more": 0}
    for r in texts.select("text", generator.mistyped(F.col("text"), generator.chooser(1, "x", F.lit(0)), "t").alias("out")).collect():
        text, out = r
        if len(text) < 4:
            assert text == out
            continue
        assert text[0] == out[0]
        places = range(1, len(text) - 1)
        less, more = {text[:i] + text[i + 1 :] for i in places}, {text[:i] + chr(c) + text[i:] for i in places for c in range(97, 123)}
        swapped = {text[:i] + text[i + 1] + text[i] + text[i + 2 :] for i in places}
        assert out in less | more | swapped
        seen["less" if len(out) < len(text) else "more" if len(out) > len(text) else "same"] += 1
    assert seen["less"] > 80 and seen["more"] > 80 and seen["same"] > 30


def test_files_are_what_a_split_reads(spark, tmp_path):
    generator.write_split(spark, f"file://{tmp_path}", "test", 50, ("US", "India", "France"))
    records, truth = tables.load_split(spark, f"file://{tmp_path}", "test")
    made, told = generator.build(spark, "test", 50, ("US", "India", "France"))
    assert sorted(map(tuple, records.collect())) == sorted(map(tuple, made.collect()))
    assert sorted(map(tuple, truth.collect())) == sorted(map(tuple, told.collect()))
