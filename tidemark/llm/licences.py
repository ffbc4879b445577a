"""Licence notices in documents, found by a trained classifier of paragraphs and confirmed by templates."""

from __future__ import annotations

import json
import math
import re
import string
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.native_words import bounded, digest
from tidemark.session import save

UNKNOWN = "unknown"
#: How notices of each family are worded.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is licensed under the terms of the Apache License 2.0.",
        "Released under the Apache 2.0 license.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Licensed under the GNU General Public License version 2 or later.",
        "Distributed under the GPL version 3 license.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "This work is released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
        "Licensed under the GNU Affero General Public License version 3.",
    ],
    "ISC": [
        "Licensed under the ISC license.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "EPL": [
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ],
}
#: What all unknown paragraphs weigh at most beside the copies of notices, copies of a notice with words left out, share of words that must agree.
BACKGROUND, VARIANTS, AGREE = 6, 12, 0.6
#: Steps of the bound for one unit of log-odds; beyond 35 units odds are not told apart.
STEPS = 100
#: Share of the words and pairs of a notice that a run of lines must hold.
HOLDS = 0.9
#: What a licence says, of a known family or not.
SAYS = (
    r"(?i)\b(?:licen[sc]ed under|public licen[sc]e|licen[sc]e agreement|under the terms of (?:the|this)(?: [\w.-]+){0,5} licen[sc]e|rights reserved"
    r"|permission (?:is|to use)(?: [\w,]+){0,12}? granted|permission to use, copy|redistribution and use|may be (?:freely )?redistributed|public domain)\b"
)
#: Each way of ``SAYS`` holds one of these within a word, so texts without any are not matched with it.
SAID = ("licen", "reserved", "permission", "redistribution", "redistributed", "domain")
#: Letters, digits, + and -, and dots inside words. Possessive: no stack grows with the length of a run, and nothing is tried twice.
WORD = r"(?:[\p{L}\p{N}+-]++|[.](?=\w))++"


@dataclass(frozen=True)
class Classifier:
    """Weights of each n-gram for each class, most of them none; families[0] is unknown."""

    families: tuple[str, ...]
    weights: dict[str, list[float]]
    intercepts: list[float]
    least: float


def _lower(text: Column | str) -> Column:
    """A-Z lower-cased; where all is ASCII the built-in lower() does just that, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _words(line: Column | str) -> Column:
    """Runs of letters, digits, dots inside words, + and -, lower-cased in A-Z."""
    return F.regexp_extract_all(_lower(line), F.lit(WORD), F.lit(0))


def _lines(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(*more, F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("paragraph", "line"))


def _paragraphs(docs: DataFrame, *more: str) -> DataFrame:
    """``paragraph, words`` of every paragraph (line) with words, counted from 0, and the columns ``more``."""
    return _lines(docs, *more).select(*more, "paragraph", _words("line").alias("words")).where("size(words) > 0")


def _grams(words: Column, of: list[str] | None = None) -> Column:
    """The single words and pairs of words of an array, once each; of all, or of those in ``of``."""
    if of is not None:
        begins = sorted({gram.split(" ")[0] for gram in of if " " in gram})
        # The last word has no next one and is then a single word, which is there already if it is one of ``of``.
        pairs = F.transform(words, lambda w, i: F.when(w.isin(begins), F.concat_ws(" ", w, F.get(words, i + 1))))
        return F.array_distinct(F.concat(F.filter(words, lambda w: w.isin(of)), F.filter(pairs, lambda g: g.isin(of))))
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    return F.array_distinct(F.concat(words, F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>"))))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, where ``value`` is computed once however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of a few given rows."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _templates(spark: SparkSession, notices: dict[str, list[str]]) -> DataFrame:
    rows = [{"doc_id": n, "family": f, "text": t} for f, texts in notices.items() for n, t in enumerate(texts)]
    return _paragraphs(_table(spark, rows, "doc_id bigint, family string, text string"), "doc_id", "family")


def _vocabulary(spark: SparkSession, notices: dict[str, list[str]]) -> list[str]:
    """The words and pairs of words of the given notices."""
    return sorted(r[0] for r in _templates(spark, notices).select(F.explode(_grams(F.col("words")))).distinct().collect())  # as many as the notices have


def _signs(of: str | Column, *names: str) -> list[Column]:
    """96 bits of hashes, as two columns."""
    return [sign.alias(name) for sign, name in zip((F.xxhash64(of), F.hash(F.lit("b"), of)), names)]


def features(docs: DataFrame, notices: dict[str, list[str]] | None = None) -> DataFrame:
    """All that ``learn`` and ``licence_paragraphs`` ask of each different line, so that one cut of the texts into words serves both."""
    return _features(docs, _vocabulary(docs.sparkSession, notices or NOTICES))


def _features(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``h, g, words_h, words_g, n, grams`` of each different line with words.

    These are signs of the line and of its words, the number of different words and
    the n-grams of the vocabulary. A line without any of these is only counted, as
    its words: ``h``, ``g`` and ``n`` are 0.
    """
    text = F.col("text").cast("string")
    # Split inside the generator: a filter on exploded lines would split them twice.
    lines = F.transform(F.split(text, "\n"), lambda line: F.struct(*_signs(line, "h", "g"), _words(line).alias("words")))
    lines = docs.select(F.explode(F.filter(lines, lambda line: F.size(line["words"]) > 0)).alias("line")).select("line.*")
    grams = F.sort_array(_once(F.col("words"), lambda words: _grams(words, vocabulary)))
    lines = lines.select("h", "g", *_signs("words", "words_h", "words_g"), F.size(F.array_distinct("words")).alias("n"), grams.alias("grams"))
    met = [F.when(F.size("grams") > 0, F.col(name)).otherwise(0).alias(name) for name in ("h", "g", "n")]
    return save(lines.select(*met, "words_h", "words_g", "grams").distinct(), "features")


def learn(docs: DataFrame, notices: dict[str, list[str]] | None = None, lines: DataFrame | None = None) -> Classifier:
    """A classifier of the families in ``notices`` and of unknown paragraphs.

    The features are the words and pairs of words that occur in notices. Each
    notice teaches with ``VARIANTS`` copies in which a fifth of the words is left
    out. The unknown class learns from all paragraphs of all documents, each
    different one once, except those like a notice; together they weigh no more
    than ``BACKGROUND`` times the copies. A quarter of them, by a hash, is set
    aside to calibrate: a family must be more likely than it seems for all but one
    in a thousand of these (rounded up to a step of the log-odds), and than one
    half. The fit prefers weights of nothing, so few n-grams remain.

    Paragraphs are told apart by 96 bits of hashes. Those with the same features
    are one weighted row, so only features, numbers and hashes move. ``lines`` are
    the ``features`` of these documents and notices, if they are known.
    """
    spark = docs.sparkSession
    notices = notices or NOTICES
    families = (UNKNOWN, *sorted(notices))
    templates = save(_templates(spark, notices), "notices")
    vocabulary = _vocabulary(spark, notices)
    seeds = F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("seed")
    left = F.filter("words", lambda w, i: (F.col("seed") == 0) | (F.pmod(F.xxhash64(w, i, "seed"), F.lit(5)) > 0))
    positive = templates.select("words", "family", seeds).select("family", left.alias("words"))

    plain = _plain(_features(docs, vocabulary) if lines is None else lines, templates)
    copies, total = positive.count(), plain.where("not aside").agg(F.sum("many")).first()[0] or 0
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    weight = F.col("many") * min(1.0, BACKGROUND * copies / max(total, 1))
    rows = positive.select("family", _grams(F.col("words")).alias("grams"), F.lit(1.0).alias("weight"))
    rows = rows.unionByName(plain.where("not aside").select(F.lit(UNKNOWN).alias("family"), "grams", weight.alias("weight")))
    rows = save(rows.select(label.alias("label"), "grams", "weight"), "training")
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True)
    fit = LogisticRegression(maxIter=30, regParam=0.002, elasticNetParam=0.9, family="multinomial", standardization=False, weightCol="weight")
    model = fit.fit(vectors.transform(rows))
    matrix = model.coefficientMatrix.toArray()
    weights = {g: matrix[:, k].tolist() for k, g in enumerate(vocabulary) if matrix[:, k].any()}
    found = Classifier(families, weights, model.interceptVector.toArray().tolist(), 0.5)
    return Classifier(families, weights, found.intercepts, _bound(plain.where("aside"), found))


def _plain(lines: DataFrame, templates: DataFrame) -> DataFrame:
    """``grams, aside, many``: how many different paragraphs that are not like a notice have these n-grams of the vocabulary."""
    ground = lines.select("words_h", "words_g", "n", "grams").distinct()  # lines may differ in marks alone
    ground = ground.groupBy("grams", "n", (F.pmod("words_h", F.lit(4)) == 0).alias("aside")).agg(F.count("*").alias("many"))
    ground = ground.withColumn("ones", F.size(F.filter("grams", lambda gram: ~F.contains(gram, F.lit(" ")))))
    known = templates.agg(F.collect_set(F.array_distinct("words")).alias("notices"))  # one row with the few given notices

    def like(notice: Column) -> Column:  # all words of a notice are in the vocabulary; most paragraphs have too few of it for any
        alike = lambda both: both / (F.col("n") + F.size(notice) - both) >= AGREE / 2
        return alike(F.least("ones", F.size(notice))) & alike(F.size(F.array_intersect("grams", notice)))

    plain = ground.crossJoin(F.broadcast(known)).where(~F.exists("notices", like))
    return save(plain.groupBy("grams", "aside").agg(F.sum("many").alias("many")), "background")


def _bound(aside: DataFrame, classifier: Classifier) -> float:
    """The chance of a notice that one in a thousand paragraphs set aside exceeds at most, one half at least."""
    total = aside.agg(F.sum("many")).first()[0] or 0
    seems = _scored(aside.select(F.monotonically_increasing_id().alias("row"), "many", "grams"), F.col("grams"), ["row", "many"], classifier)
    odds = F.ln(F.col("notice") / F.greatest(1 - F.col("notice"), F.lit(1e-15)))
    steps = seems.where("notice > 0.5").groupBy(F.ceil(odds * STEPS).cast("int").alias("step")).agg(F.sum("many").alias("many"))
    left = total // 1000
    for step, many in sorted(steps.collect(), reverse=True):  # 35 * STEPS at most
        if many > left:
            return 1 / (1 + math.exp(-step / STEPS))
        left -= many
    return 0.5


def _scored(rows: DataFrame, grams: Column, key: list[str], classifier: Classifier) -> DataFrame:
    """The chance of a notice, and of each class, for rows with an n-gram that has a weight."""
    classes = range(len(classifier.families))
    weights = _table(rows.sparkSession, [{"gram": g, "w": w} for g, w in classifier.weights.items()], "gram string, w array<double>")
    hits = rows.select(*key, F.explode(grams).alias("gram")).join(F.broadcast(weights), "gram")
    sums = hits.groupBy(*key).agg(*(F.sum(F.col("w")[k]).alias(f"s{k}") for k in classes))
    lean = F.array(*(F.col(f"s{k}") + classifier.intercepts[k] for k in classes))
    share = lambda parts: F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda a, b: a + b))
    odds = lambda lean: _once(F.array_max(lean), lambda most: F.transform(lean, lambda x: F.exp(x - most)))
    parts = sums.select(*key, _once(lean, lambda lean: _once(odds(lean), share)).alias("p"))
    return parts.select(*key, "p", (1 - F.col("p")[0]).alias("notice"))


def _needed(spark: SparkSession, notices: dict[str, list[str]]) -> tuple[list[str], str]:
    """A pattern that every run holding ``HOLDS`` of a notice matches, and every run that ``SAYS`` so; before it, pieces one of which is in each match.

    Of each notice, those with a piece in ``SAID`` and then the longest first, so
    many words that a run without any of them lacks too many of the notice's words
    and pairs.
    """
    needed: set[str] = set()
    for (words,) in sorted(_templates(spark, notices).select("words").collect()):  # the few given notices
        grams = {*((w,) for w in words), *zip(words, words[1:])}
        for word in ["", *sorted(set(words) - needed, key=lambda w: (not any(p in w for p in SAID), -len(w), w))]:
            needed |= {word} - {""}
            if sum(needed.isdisjoint(g) for g in grams) < HOLDS * len(grams):
                break
    pieces = sorted(p for p in {*needed, *SAID} if not any(q != p and q in p for q in {*needed, *SAID}))
    return pieces, rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(re.escape(w) for w in sorted(needed))})|{SAYS}"


def _runs(docs: DataFrame, pieces: list[str], needed: str, *more: str) -> DataFrame:
    """``first, last, run``: each run of lines that are not blank, as one text, if it matches ``needed``; a text with none of ``pieces`` has none."""
    lines = F.split(F.col("text").cast("string"), "\n")
    blank = lambda lines: F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~F.get(lines, i).rlike(r"\S"))
    ends = lambda lines: F.concat(F.array(F.lit(-1)), blank(lines), F.array(F.size(lines)))

    def run(lines: Column, ends: Column, k: Column) -> Column:
        first, last = F.get(ends, k - 1) + 1, F.get(ends, k) - 1
        text = F.array_join(F.slice(lines, first + 1, F.greatest(last - first + 1, F.lit(0))), " ")
        return F.struct(first.alias("first"), last.alias("last"), text.alias("run"))

    runs = lambda lines: _once(ends(lines), lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda k: run(lines, e, k)))
    text = F.col("text").cast("string")
    some = docs.where(_once(_lower(text), lambda low: reduce(or_, (F.contains(low, F.lit(p)) for p in pieces))))  # cheaper than the pattern
    found = some.where(F.translate(text, "\n", " ").rlike(needed)).select(*more, F.explode(_once(lines, runs)).alias("r"))
    return found.select(*more, "r.*").where("last >= first").where(F.col("run").rlike(needed))


def _held(docs: DataFrame, notices: dict[str, list[str]], *more: str) -> DataFrame:
    """The notice that each run of lines holds most of, and whether the run ``says`` what licences say."""
    templates = _templates(docs.sparkSession, notices).select("family", _grams(F.col("words")).alias("grams"))
    known = templates.agg(F.collect_list(F.struct("family", "grams")).alias("known"), F.array_distinct(F.flatten(F.collect_list("grams"))).alias("all"))
    plain = F.filter(_words("run"), lambda w: w.rlike(r"[\p{L}\p{N}]"))
    runs = _runs(docs, *_needed(docs.sparkSession, notices), *more).select(*more, "first", "last", F.col("run").rlike(SAYS).alias("says"), plain.alias("words"))
    met = runs.where("size(words) > 0").crossJoin(F.broadcast(known))  # one row with the few given notices
    share = lambda t, grams: F.size(F.array_intersect(grams, t["grams"])) / F.size(t["grams"])
    judged = lambda t, g: F.struct(share(t, g).alias("share"), F.size(t["grams"]).alias("n"), t["family"].alias("family"), t["grams"].alias("grams"))
    held = _once(F.col("words"), lambda words: F.array_intersect(_grams(words), F.col("all")))
    best = _once(held, lambda grams: F.array_max(F.transform("known", lambda t: judged(t, grams))))
    return met.select(*more, "first", "last", "says", best.alias("best"))


def licence_paragraphs(docs: DataFrame, classifier: Classifier, notices: dict[str, list[str]] | None = None, lines: DataFrame | None = None) -> DataFrame:
    """``doc_id, paragraph, last, family, probability, likeness, confirmed`` of what looks like a notice.

    ``paragraph`` and ``last`` are its first and last line, counted from 0. Two
    kinds of paragraphs are looked at:

    - *Lines* are classified by their words and pairs of words. One without an
      n-gram that has a weight, or no more likely a notice than the calibrated
      bound, gives no row. The others are compared with all notices of the
      likeliest family: ``likeness`` is the highest share of common words, and
      ``confirmed`` says whether it reaches ``AGREE``.
    - *Runs* of lines that are not blank, so notices may be wrapped and stand in
      longer texts. ``likeness`` is the highest share of a notice's words and
      pairs that the run holds, ``confirmed`` from ``HOLDS`` on; ``probability``
      is null. A run gives no row for a family that one of its lines confirms,
      and takes the place of lines that are not confirmed for that family or that
      are pieces of its notice.
      A run that says what licences say but holds no notice is of the family
      ``unknown`` and not confirmed, unless one of its lines is confirmed or it
      is a single line that has a row already.

    Null and empty texts have no paragraphs. Rows that repeat a doc_id are
    classified each; other columns are not read.

    The weights are as many as the notices have n-grams, so they are broadcast.
    Equal lines score alike, so only different lines are scored, told apart by 96
    bits of hashes: ``lines`` are the ``features`` of these documents and notices,
    made here if they are not given. Only sums move, one row for each line that
    meets a weight, reduced in its own task. A second pass over the texts meets
    the lines found, which are broadcast if a count finds them few.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text", digest().alias("sha"))
    lines = _features(docs, list(classifier.weights)) if lines is None else lines
    seems = _scored(lines, F.col("grams"), ["h", "g"], classifier).where(F.col("notice") > classifier.least)
    seems = save(seems.select("h", "g", "p"), "notices")
    families = F.array(*map(F.lit, classifier.families))
    likely = F.expr("array_max(slice(p, 2, size(p)))")
    found = _lines(texts, "doc_id", "sha").select("doc_id", "sha", "paragraph", "line", *_signs("line", "h", "g"))
    found = found.join(bounded(seems, seems.count()), ["h", "g"])
    found = found.select("doc_id", "sha", "paragraph", _words("line").alias("words"), likely.alias("probability"), families[(F.array_position("p", likely) - 1).cast("int")].alias("family"))
    held = _templates(spark, notices or NOTICES).groupBy("family").agg(F.collect_list("words").alias("notices"))  # the few given notices
    best = F.array_max(F.transform("notices", lambda n: F.size(F.array_intersect("words", n)) / F.size(F.array_union("words", n))))
    lines = (
        found.join(F.broadcast(held), "family")
        .select("*", F.col("paragraph").alias("last"), F.coalesce(best, F.lit(0.0)).alias("likeness"), _grams(F.col("words")).alias("grams"))
        .withColumn("own", F.array_max(F.transform("notices", lambda n: F.size(F.array_intersect("grams", _grams(n))) / F.size(_grams(n)))))
        .select("doc_id", "sha", "paragraph", "last", "family", "probability", "likeness", (F.col("likeness") >= AGREE).alias("confirmed"), "grams", "own")
    )
    lines = save(lines, "lines")
    runs = save(_held(texts, notices or NOTICES, "doc_id", "sha").where(F.col("says") | (F.col("best.share") >= HOLDS)), "runs")
    sure = F.col("best.share") >= HOLDS
    runs = runs.select(
        "doc_id", "sha", F.col("first").alias("paragraph"), "last", F.when(sure, F.col("best.family")).otherwise(UNKNOWN).alias("family"),
        F.lit(None).cast("double").alias("probability"), F.col("best.share").alias("likeness"), sure.alias("confirmed"), "best.grams",
    )
    a, b = lines.alias("a"), runs.alias("b")
    inside = F.expr("a.doc_id <=> b.doc_id AND a.sha = b.sha AND a.paragraph BETWEEN b.paragraph AND b.last")
    # A line that is most likely a piece of the notice that its run holds.
    piece = F.expr(f"b.confirmed AND a.own < {HOLDS} AND size(array_intersect(a.grams, b.grams)) >= {AGREE} * size(a.grams)")
    whole = b.join(a, inside & ~piece & F.expr("a.confirmed AND (a.family = b.family OR NOT b.confirmed) OR NOT b.confirmed AND b.paragraph = b.last"), "left_anti")
    parts = a.join(b, inside & (piece | F.expr("NOT a.confirmed AND b.confirmed AND a.family = b.family")), "left_anti")
    return parts.drop("own").unionByName(whole).drop("sha", "grams")
