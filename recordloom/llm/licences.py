"""Licence scans: a trained classifier of paragraphs, sparse logistic regression on word n-grams, tells licence families; its probabilities are calibrated, so that what
looks like a licence but isn't surely one family is "unknown"; a comparison with the family's templates confirms a prediction.

Every n-gram of the vocabulary holds an anchor, a word of the templates that isn't common speech. A paragraph without an anchor therefore has no feature and is no
licence, which is what lets a pattern of the anchors stand before the rest without changing a result. Paragraphs are consecutive lines that aren't empty, as of a
wrapped notice, and each line by itself, as of a notice within prose. A line that is surely of a family has that one; a family that only its paragraph shows goes to
the paragraph's other lines with anchors. Equal paragraphs, by their words, are classified once. Training takes a fixed number of rows made from the templates (VARIANTS of each) on the driver; scanning uses
DataFrame functions only.

Defined cases: a null or empty text has no licence (empty families, 0 paragraphs); equal rows give equal rows; a document's lines are counted as often as they occur;
an empty table gives an empty result; a null doc_id is kept; further columns are ignored.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Notices by which works name their licence, by family, and ordinary sentences that share words with them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is distributed under the terms of the Apache License 2.0.",
        "Released under the Apache Software License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Distributed under the terms of the MIT license.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "Released under the simplified BSD license.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GPL v2 or later.",
        "Released under the GNU GPL.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL v3 or later.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License.",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL v3.",
        "Released under the terms of the GNU Affero General Public License.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "Licensed under the MPL 2.0.",
        "Released under the Mozilla Public License.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution ShareAlike License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the Creative Commons Attribution NonCommercial License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Available under the Creative Commons Attribution NoDerivs License.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the EPL 2.0.",
        "Released under the Eclipse Public License.",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC license.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Licensed under the Boost Software License.",
    ),
    "public-domain": (
        "Dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "No copyright: this work is in the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2020 Example Incorporated. All rights reserved.",
        "No part of this publication may be reproduced or transmitted without the prior written permission of the copyright holder. All rights reserved.",
        "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.",
    ),
}
ORDINARY = (
    "The driver renewed a license at the office in March.", "He lost his fishing licence near the lake.", "The Apache people lived in the south-west.", "An Apache helicopter landed behind the school.",
    "Researchers at MIT built a robot.", "Er kam mit dem Zug und ging mit seiner Frau nach Hause.", "Mit der Zeit wird alles besser.", "All children have rights, and reserved seats are at the front.",
    "The table was reserved for all guests.", "A gnu is a large antelope of the general plains.", "The general public was not amused.", "She has a creative mind and commons sense.", "They met in the commons after lunch.",
    "Source and binary stars are observed in various forms.", "Conditions are met with or without a change of course.", "Permission was granted to any person over twelve.", "The file was copied free of charge by the office.",
    "Public libraries are free for any person.", "The foundation was published by the press.", "Her attribution of the painting was wrong.", "The international version is sold in France.", "The domain of the function is public knowledge.",
    "Software and documentation were delivered late.", "You may not use the lift in a fire.", "Terms and conditions of trade were discussed.", "Confidential talks were held on the copying of art.", "No part of the road may be closed without notice.",
    "The licensed practitioner saw twenty patients.", "Version two of the play was released on Friday.", "The works of Shakespeare are performed here.", "This library opens at nine and the source of the river is near.", "The holder of the cup won again.",
    "Driving license needed for this job.", "The eclipse was seen by the public of the whole country.", "A boost of the program was granted for any purpose.", "Any person may distribute the fee among the members.",
    "Mozilla was the name of a lizard in the story.", "A lesser known general signed the public letter.",
)
COMMON = frozenset(
    "a about above after all an and any are as at available be behind by can copy code conditions charge deal except file files following for form forms free from general granted have he her his holder in international into is it"
    " later library may met no not of office on or out over part person project prior program provided published public released source style subject terms text that the their they this to under use version was were with without work works written you".split()
)
VARIANTS = 40
HELD_OUT = 5
MOST_UNSEEN = 0.1
NAMES = ("Acme Corp", "the authors", "Jane Doe", "Example GmbH", "the project contributors", "Smith & Sons")


@dataclass(frozen=True)
class Model:
    """weights: n-gram -> a weight for each class; classes[0] is "none". scale: the calibration of the logits. least: probability below which a licence is unknown."""

    classes: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]
    scale: float
    least: float
    anchors: tuple[str, ...]


def tokens_of(text: str) -> list[str]:
    return re.findall(r"[a-z0]+", re.sub(r"[0-9]+", "0", text.lower()))


def grams_of(tokens: list[str]) -> list[str]:
    two = [f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)]
    return list(dict.fromkeys(tokens + two))


def anchor_words() -> tuple[str, ...]:
    return tuple(sorted({t for x in TEMPLATES.values() for y in x for t in tokens_of(y) if len(t) > 1 and t not in COMMON}))


def features(tokens: list[str], anchors: frozenset) -> list[str]:
    return [g for g in grams_of(tokens) if not anchors.isdisjoint(g.split(" "))]


def _varied(text: str, rng: random.Random) -> str:
    words = text.split()
    if len(words) > 4:
        words = [w for w in words if rng.random() > 0.06]
    text = " ".join(words)
    if rng.random() < 0.3:
        text = f"Copyright (c) {rng.randrange(1990, 2025)} {rng.choice(NAMES)}. {text}"
    if rng.random() < 0.2:
        text = f"{text} See the file for details."
    if rng.random() < 0.1:
        text = text.upper()
    return text


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _fitted(x: np.ndarray, y: np.ndarray, n_classes: int, l1: float, rounds: int) -> np.ndarray:
    """Weights of a multinomial logistic regression with an L1 penalty by accelerated proximal steps; classes weigh alike. The last row is the bias."""
    want = np.eye(n_classes)[y]
    share = np.array([1 / max(1, (y == c).sum()) for c in range(n_classes)])[y][:, None] * len(y) / n_classes
    w = v = np.zeros((x.shape[1], n_classes))
    step, t = 1.0 / (0.5 * (x * x).sum(1).max() * share.max()) * 4, 1.0
    for _ in range(rounds):
        g = x.T @ ((_softmax(x @ v) - want) * share) / len(y)
        new = v - step * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * l1, 0)
        t, was = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v, w = new + (was - 1) / t * (new - w), new
    w[-1, 0] = max(w[-1, 0], w[-1, 1:].max() + 2.0)  # without any feature: none
    return w


def confirmed(words: list[str], family: str, known: frozenset, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> bool:
    """Whether at least half the anchored n-grams of some template of the family are among those of the words."""
    have = set(features(words, known))
    return any(2 * len(have.intersection(s)) >= len(s) > 0 for t in templates[family] for s in [features(tokens_of(t), known)])


def train(seed: int = 7, l1: float = 2e-4, rounds: int = 400) -> Model:
    """Fits the classifier. One variant in HELD_OUT is kept, by which the logits are scaled. least, below which a licence is unknown, is the least bound that passes at most
    MOST_UNSEEN of the notices of families that a fit has never seen: each family is left out once, and its notices are held against a fit of the others."""
    rng, anchors = random.Random(seed), anchor_words()
    known, classes = frozenset(anchors), ("none", *sorted(TEMPLATES))
    rows = [(_varied(t, rng) if v else t, classes.index(c), v) for c, x in TEMPLATES.items() for t in x for v in range(VARIANTS)]
    rows += [(_varied(t, rng) if v % 3 == 1 else t, 0, v) for t in ORDINARY for v in range(VARIANTS)]
    words = [tokens_of(t) for t, _, _ in rows]
    sets = [features(w, known) for w in words]
    vocabulary = {g: i for i, g in enumerate(sorted({g for s in sets for g in s}))}
    x, y = np.zeros((len(rows), len(vocabulary) + 1)), np.array([c for _, c, _ in rows])
    x[:, -1] = 1
    for i, s in enumerate(sets):
        x[i, [vocabulary[g] for g in s]] = 1
    held = np.array([v % HELD_OUT == HELD_OUT - 1 for _, _, v in rows])
    w = _fitted(x[~held], y[~held], len(classes), l1, rounds)
    logits, truth = x[held] @ w, y[held]
    scales = np.linspace(0.4, 4, 37)
    loss = [-np.log(np.maximum(_softmax(s * logits)[np.arange(len(truth)), truth], 1e-12)).mean() for s in scales]
    scale = float(scales[int(np.argmin(loss))])
    unseen, n_unseen = [], 0
    for c in range(1, len(classes)):
        fit = _fitted(x[~held & (y != c)][::3], y[~held & (y != c)][::3], len(classes), l1, rounds // 4)
        own = np.flatnonzero(held & (y == c))
        q = _softmax(scale * (x[own] @ fit))
        n_unseen += len(own)
        unseen += [float(row.max()) for i, row in zip(own, q, strict=True) if row.argmax() not in (0, c) and confirmed(words[i], classes[row.argmax()], known)]
    least = next((float(c) for c in np.linspace(0.5, 0.98, 25) if sum(u >= c for u in unseen) <= MOST_UNSEEN * n_unseen), 0.98)
    kept = {g: tuple(float(f) for f in w[i]) for g, i in vocabulary.items() if np.abs(w[i]).max() > 0}
    return Model(classes, kept, tuple(float(f) for f in w[-1]), scale, least, anchors)


def predict(model: Model, text: str) -> tuple[str, float]:
    """Plain form of what scan() computes, without the comparison of templates."""
    z = np.array(model.bias)
    for g in grams_of(tokens_of(text)):
        if g in model.weights:
            z = z + np.array(model.weights[g])
    p = _softmax(model.scale * z[None])[0]
    return model.classes[int(p.argmax())], float(p.max())


def _tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(F.lower(line), "[0-9]+", "0"), F.lit("([a-z0]+)"), 1)


def any_of(words: tuple[str, ...]) -> str:
    """A pattern for any of the words that tells them apart letter by letter, so that a place in a text is left at the first letter that begins none; 0 stands for digits."""
    heads: dict[str, list[str]] = {}
    for w in sorted(words):
        heads.setdefault(w[:1], []).append(w[1:])
    rest = [("[0-9]+" if h == "0" else h) + any_of(tuple(x)) for h, x in heads.items() if h]
    return ("(?:" + "|".join(rest) + ")" + ("?" if "" in heads else "")) if rest else ""


def _near(tokens: Column, model: Model) -> Column:
    """The anchors among the tokens with the token before and after each, which is all that n-grams with an anchor are made of. Two tokens that meet where others are left out are
    no anchors, so no n-gram of the vocabulary is made up."""
    is_anchor = lambda t: F.coalesce(t.isin(*model.anchors), F.lit(False))
    return F.filter(tokens, lambda t, i: is_anchor(t) | is_anchor(F.get(tokens, i - 1)) | is_anchor(F.get(tokens, i + 1)))


def lines_of(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, code of the text, paragraph number, line number and the words near anchors of each line that holds an anchor, and line 0 for each paragraph of several lines with one.
    A paragraph's words are those of its lines with anchors, each with the last word before and the first word after it; a bar parts lines."""
    gate = f"(?i)(?<![a-z]){any_of(model.anchors)}(?![a-z])"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike(gate))
    rows = rows.select("doc_id", F.xxhash64("text").alias("code"), F.posexplode(F.split("text", r"\n(?:[^\S\n]*\n)+")).alias("paragraph", "block"))
    rows = rows.select("doc_id", "code", "paragraph", F.filter(F.split("block", "\n"), lambda x: x.rlike("[A-Za-z0-9]")).alias("lines"))
    word = lambda at: F.regexp_extract(F.lower(at), "[a-z0-9]+", 0)
    before = lambda i: F.when(i > 0, F.reverse(word(F.reverse(F.get("lines", i - 1))))).otherwise("")
    after = lambda i: F.coalesce(word(F.get("lines", i + 1)), F.lit(""))
    held = F.transform("lines", lambda x, i: F.when(x.rlike(gate), F.struct((i + 1).alias("at"), _tokens(x).alias("own"), _tokens(before(i)).alias("before"), _tokens(after(i)).alias("after"))))
    rows = rows.select("doc_id", "code", "paragraph", (F.size("lines") > 1).alias("several"), F.filter(held, lambda x: x.isNotNull()).alias("held")).where(F.size("held") > 0)
    one = F.transform("held", lambda x: F.struct(x["at"].alias("at"), F.array_join(_near(x["own"], model), " ").alias("words")))
    with_ends = F.transform("held", lambda x: F.concat(x["before"], x["own"], x["after"]))
    one = F.filter(one, lambda x: x["words"] != "")
    rows = rows.select("doc_id", "code", "paragraph", "several", one.alias("one"), with_ends.alias("ends")).where(F.size("one") > 0)
    whole = F.array_join(F.transform("ends", lambda x: F.array_join(_near(x, model), " ")), " | ")
    whole = F.filter(F.array(F.struct(F.lit(0).alias("at"), whole.alias("words"))), lambda x: F.col("several"))
    return rows.select("doc_id", "code", "paragraph", F.explode(F.concat(whole, "one")).alias("x")).select("doc_id", "code", "paragraph", "x.at", "x.words")


def classified(words: DataFrame, model: Model) -> DataFrame:
    """words, family, p of each distinct paragraph that isn't "none". The tables of weights and templates have the vocabulary's size and are broadcast."""
    spark, k = words.sparkSession, len(model.classes)
    weights = spark.createDataFrame([(g, *w) for g, w in sorted(model.weights.items())], ", ".join(["gram string", *(f"w{i} double" for i in range(k))]))
    tokens = F.split("words", " ")
    pairs = F.when(F.size(tokens) > 1, F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1)))).otherwise(F.array().cast("array<string>"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    grams = words.select("words").distinct().repartition(n).select("words", F.explode(F.array_distinct(F.concat(tokens, pairs))).alias("gram"))
    sums = grams.join(F.broadcast(weights), "gram").groupBy("words").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(k)])
    logits = F.array(*[F.lit(model.scale) * (F.col(f"w{i}") + model.bias[i]) for i in range(k)])
    scored = sums.select("words", logits.alias("z")).withColumn("m", F.array_max("z"))
    scored = scored.withColumn("p", F.lit(1.0) / F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("m")))).withColumn("best", F.element_at(F.array(*[F.lit(c) for c in model.classes]), F.array_position("z", F.col("m")).cast("int")))
    found = scored.where("best != 'none'").select("words", "best", "p")
    # confirmation: of some template of the family at least half the anchored n-grams are there
    known = frozenset(model.anchors)
    parts = [(c, i, len(s), g) for c, x in TEMPLATES.items() for i, t in enumerate(x) for s in [features(tokens_of(t), known)] for g in s]
    templates = spark.createDataFrame(parts, "best string, template int, n int, gram string")
    again = found.select("words", "best", F.explode(F.array_distinct(F.concat(tokens, pairs))).alias("gram"))
    share = again.join(F.broadcast(templates), ["best", "gram"]).groupBy("words", "best", "template", "n").agg(F.count(F.lit(1)).alias("hits")).groupBy("words").agg(F.max(F.col("hits") / F.col("n")).alias("share"))
    sure = (F.col("p") >= model.least) & (F.coalesce(F.col("share"), F.lit(0.0)) >= 0.5)
    return found.join(share, "words", "left").select("words", F.when(sure, F.col("best")).otherwise("unknown").alias("family"), "p")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_licence_lines, families (sorted, distinct), and a map of lines by family, for every row of docs (doc_id, text)."""
    model = model or train()
    lines = stored(lines_of(docs, model), "lines")
    families = stored(classified(lines, model), "families")
    hits = lines.join(families, "words", "left").groupBy("doc_id", "code", "paragraph", "at").agg(F.first("family").alias("family"))  # lines of equal rows are one
    whole = F.col("at") == 0
    parts = hits.groupBy("doc_id", "code", "paragraph").agg(
        F.max(F.when(whole, F.col("family"))).alias("of_all"), F.collect_set(F.when(~whole, F.col("family"))).alias("own"), F.collect_list(F.when(~whole, F.struct("family"))).alias("lines")
    )
    more = F.when(F.col("of_all") == "unknown", F.size("own") == 0).otherwise(~F.array_contains("own", F.col("of_all")))  # what no line shows by itself
    family = F.when(more & F.coalesce(F.col("line.family"), F.lit("unknown")).eqNullSafe("unknown"), F.col("of_all")).otherwise(F.col("line.family"))
    hits = parts.select("*", F.explode("lines").alias("line")).select("doc_id", "code", family.alias("family")).where("family is not null")
    by_family = hits.groupBy("doc_id", "code", "family").agg(F.count(F.lit(1)).alias("n"))
    by_doc = by_family.groupBy("doc_id", "code").agg(F.sum("n").alias("n_licence_lines"), F.sort_array(F.collect_list(F.struct("family", "n"))).alias("found"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("code")).alias("r")
    out = rows.join(by_doc.alias("h"), F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.code") == F.col("h.code")), "left")
    none = F.array().cast("array<struct<family:string,n:bigint>>")
    return out.select("r.doc_id", F.coalesce("n_licence_lines", F.lit(0)).cast("long").alias("n_licence_lines"), F.col("found"),).withColumn("found", F.coalesce("found", none)).select(
        "doc_id", "n_licence_lines", F.col("found.family").alias("families"), F.map_from_entries("found").alias("lines_by_family")
    )
