"""Licence scans: normalised text against licence templates by the Dice coefficient of word bigrams.

Built from Spark's own expressions alone.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Common wordings by which texts state their licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "MIT",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "Apache-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
)

LEAST_DICE = 0.8
#: Words too frequent to tell a licence by.
COMMON = frozenset("a an and any are as at be by for from in is it may not of on or that the this to use with you".split())
#: What parts words: anything but letters and digits.
NO_WORD = r"[^\p{L}\p{N}]+"
#: A text's units are its lines, the sentences of its lines, its paragraphs, and the sentences that run over lines.
SENTENCE_GAP = r"(?<=[.!?])[\x20\x09-\x0D]+"
PARAGRAPH_GAP = r"\n[\x20\x09-\x0D]*\n"
#: What sentences do not run over: lines without a word, such as those of comment marks.
BREAK = r"\n(?:[^\p{L}\p{N}\n]*\n)+"


def normalised_words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    spaced = F.btrim(F.regexp_replace(F.lower(text), NO_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    # The last word has no neighbour; concat_ws leaves it single.
    return F.array_distinct(F.filter(pairs, lambda p: F.contains(p, F.lit(" "))))


def key_words(least: float = LEAST_DICE) -> list[str]:
    """Words of which every unit that reaches `least` with some template contains one.

    Such a unit shares at least n * least / (2 - least) of a template's n bigrams. Words are taken, frequent ones
    last and longer ones first, until fewer bigrams than that are without one of them.
    """
    keys: set[str] = set()
    for _, text in TEMPLATES:
        words = _plain_words(text)
        pairs = set(zip(words, words[1:], strict=False))
        needed = least_shared(len(pairs), least)
        own = set()
        for word in sorted(set(words), key=lambda w: (w in COMMON, -len(w), w)):
            if sum(not own & set(p) for p in pairs) < needed:
                break
            own.add(word)
        keys |= own
    return sorted(keys)


def templates(spark: SparkSession) -> DataFrame:
    """(template, licence, template_words, n_template, template_bigrams): the fixed templates, a few dozen short rows."""
    rows = [(i, licence, text) for i, (licence, text) in enumerate(TEMPLATES)]
    words = normalised_words(F.col("text"))
    found = spark.createDataFrame(rows, "template int, licence string, text string").select(
        "template", "licence", F.size(words).alias("template_words"), bigrams(words).alias("template_bigrams")
    )
    return found.withColumn("n_template", F.size("template_bigrams"))


def least_shared(n_bigrams: int, least: float) -> int:
    """The bigrams of a template's `n_bigrams` that whatever reaches `least` shares with it."""
    return ceil(n_bigrams * least / (2 - least) - 1e-9)


def may_state(text: Column, least: float) -> Column:
    """Whether a text has one of the key words, without which nothing in it reaches `least` with a template."""
    # Words part as in `normalised_words`, but for those behind a letter of more than 16 bits, where too many are found.
    # One pass over the text looks for all of them, letter by letter.
    by_letter = {c: "|".join(w[1:] for w in own) for c, own in groupby(key_words(least), key=lambda w: w[0])}
    begins = rf"(?=[{''.join(by_letter)}])(?<![\p{{L}}\p{{N}}])"
    words = "|".join(f"{c}(?:{rest})" for c, rest in by_letter.items())
    return F.rlike(F.lower(text), F.lit(rf"{begins}(?:{words})(?![\p{{L}}\p{{N}}])"))


def possible_templates(least: float) -> Column:
    """The templates of which the column `words` may hold a window: it has a key word, and both words of enough bigrams."""
    texts = [_plain_words(text) for _, text in TEMPLATES]
    all_words = sorted({w for words in texts for w in words})
    place = {w: i for i, w in enumerate(all_words)}
    keys = set(key_words(least))
    cases = []
    for t, words in enumerate(texts):
        pairs = sorted(set(zip(words, words[1:], strict=False)))
        key = " OR ".join(f"b[{place[w]}]" for w in sorted(keys & set(words)))
        both = " + ".join(f"int(b[{place[x]}] AND b[{place[y]}])" for x, y in pairs)
        cases.append(f"CASE WHEN ({key}) AND {both} >= {least_shared(len(pairs), least)} THEN {t} END")
    listed = f"array({', '.join(repr(w) for w in all_words)})"
    held = f"transform(array(array_intersect(words, {listed})), own -> transform({listed}, w -> array_contains(own, w)))[0]"
    found = f"filter(array({', '.join(cases)}), t -> t IS NOT NULL)"
    return F.expr(f"transform(array({held}), b -> {found})[0]")


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """`of(value)`, with the value computed once."""
    return F.transform(F.array(value), of)[0]


def windows(df: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """(id, template, licence, dice, unit): stretches of the words of `text` that state a licence, whatever is around them.

    A window has as many words as a template and begins with one of its bigrams, or ends the text; a shorter text is one as a
    whole. Of windows that share a word of the text only the nearest one to its template counts, of equally near ones that of the first template,
    then the first; one that loses to another counts nowhere.
    """
    # A text counts once for an id, so that repeated rows fold in the tasks.
    worded = df.where(may_state(F.col("text"), least)).select("id", "text", normalised_words(F.col("text")).alias("words"))
    met = (
        worded.where(F.size("words") >= 2)
        .select("id", F.sha2("text", 256).alias("own_text"), "words", F.explode(possible_templates(least)).alias("template"))
        .join(F.broadcast(known), "template")
    )
    starts = F.filter(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.array_contains("template_bigrams", F.concat(F.get("words", i - 1), F.lit(" "), F.get("words", i))),
    )
    needed = F.ceil(F.col("n_template") * (least / (2 - least)) - 1e-9).cast("int")
    last = F.greatest(F.size("words") - F.col("template_words") + 1, F.lit(1))

    def enough(found: Column) -> Column:
        # A window holds as many of the template's bigrams as it needs, or it can't reach the least coefficient.
        begin = F.transform(found, lambda start: F.least(start, last))
        held = F.filter(begin, lambda start, k: F.coalesce(F.get(found, k + needed - 1) <= start + F.col("template_words") - 2, F.lit(False)))
        return F.array_distinct(held)

    def scored(start: Column) -> Column:
        def of(own: Column, unit: Column) -> Column:
            shared = F.size(F.array_intersect(own, F.col("template_bigrams")))
            dice = 2 * shared / (F.size(own) + F.col("n_template"))
            return F.struct(start.alias("start"), F.size(unit).alias("long"), dice.alias("dice"), F.array_join(unit, " ").alias("unit"))

        return _let(F.slice("words", start, F.col("template_words")), lambda unit: _let(bigrams(unit), lambda own: of(own, unit)))

    near = F.filter(F.transform(_let(starts, enough), scored), lambda x: x["dice"] >= least)
    hits = met.select("id", "own_text", "template", "licence", F.explode(near).alias("x")).select("id", "own_text", "template", "licence", "x.*").distinct()
    place = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("long") - 1)).alias("place")
    order = F.struct((-F.col("dice")).alias("d"), "template", "start")
    spread = hits.select("*", order.alias("own"), place)
    best = F.min("own").over(Window.partitionBy("id", "own_text", "place"))
    kept = spread.withColumn("best", F.col("own") == best).groupBy("id", "own_text", "own", "licence", "unit").agg(F.bool_and("best").alias("best"))
    return kept.where("best").select("id", "own.template", "licence", (-F.col("own.d")).alias("dice"), "unit")


def licence_scan(
    df: DataFrame, least: float = LEAST_DICE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, licence, dice, n_units, statement): the licences that a text states, from all its units and windows.

    A unit is a line, a sentence of a line, a paragraph, or a sentence that runs over lines, up to a line without words
    at most; the last one isn't counted again where a line, sentence or paragraph in it is as near to the licence. It states a licence if its distinct word bigrams
    and those of one of the licence's templates have a Dice coefficient of at least `least`. With n bigrams in a
    template, only units of n * least / (2 - least) to n * (2 - least) / least can reach it, and others are
    not compared with it; nor are texts without the words that every match must have. A unit counts for its nearest
    template only. A statement with other words before or behind it is found by its windows (see `windows`), which are no
    further wordings where they lie in a unit that states the licence, or hold one. `dice` is the best coefficient, `n_units`
    the number of distinct wordings that state the licence, `statement` the best wording in normal form, by coefficient, units
    first, and then order. One row per id and licence: a text without a licence, empty or null, gives none; repeated rows count once; a null id is kept as
    one more id. Other columns are not read. The templates are a constant table, the one that is broadcast; only
    bigrams that some template has are shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n")
    sentences = F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE_GAP)))
    wrapped = F.flatten(F.transform(F.split(text, BREAK), lambda x: F.split(x, SENTENCE_GAP)))

    def possible(unit: Column) -> Column:
        return may_state(unit, least)

    plain = F.array_distinct(F.concat(lines, sentences, F.split(text, PARAGRAPH_GAP)))
    units = F.concat(
        F.transform(F.filter(plain, possible), lambda x: F.struct(x.alias("unit"), F.lit(False).alias("runs_over"))),
        F.transform(F.filter(F.array_except(wrapped, plain), possible), lambda x: F.struct(x.alias("unit"), F.lit(True).alias("runs_over"))),
    )
    known = templates(df.sparkSession)
    sizes = [len(set(zip(w, w[1:], strict=False))) for w in (_plain_words(x) for _, x in TEMPLATES)]
    low, high = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    exploded = df.where(possible(text)).select(F.col(id_col).alias("id"), F.explode(units).alias("u"))
    worded = exploded.select("id", "u.runs_over", normalised_words(F.col("u.unit")).alias("words"))
    # With n distinct words there are n - 1 distinct bigrams at least, and words are cheaper to tell apart.
    short = worded.where((F.size("words") > low) & (F.size(F.array_distinct("words")) <= high + 1))
    counted = short.select("id", "runs_over", F.array_join("words", " ").alias("unit"), bigrams(F.col("words")).alias("own"))
    sized = counted.withColumn("n_unit", F.size("own")).where(F.col("n_unit").between(low, high))
    pairs = sized.select("id", "runs_over", "unit", "n_unit", F.explode("own").alias("bigram"))
    template_pairs = known.select("template", "licence", "n_template", F.explode("template_bigrams").alias("template_bigram"))
    within = F.col("n_unit").between(
        F.col("n_template") * (least / (2 - least)), F.col("n_template") * ((2 - least) / least)
    )
    met = pairs.join(F.broadcast(template_pairs), (F.col("bigram") == F.col("template_bigram")) & within)
    shared = met.groupBy("id", "unit", "n_unit", "template", "licence", "n_template").agg(
        F.count_distinct("bigram").alias("shared"), F.min("runs_over").alias("runs_over")
    )
    scored = shared.withColumn("dice", 2 * F.col("shared") / (F.col("n_unit") + F.col("n_template"))).where(
        F.col("dice") >= least
    )
    # A wording counts for the template that is nearest to it, the first of the list if several are.
    told = scored.groupBy("id", "unit").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "template", "licence", "dice")).alias("near"), F.min("runs_over").alias("runs_over")
    )
    stated = told.select("id", "near.licence", (-F.col("near.dice")).alias("d"), F.lit(False).alias("window"), "unit", "runs_over")
    whole = df.select(F.col(id_col).alias("id"), text.alias("text"))
    inside = windows(whole, known, least).groupBy("id", "licence", "unit").agg(F.min(-F.col("dice")).alias("d"))
    stated = stated.unionByName(inside.withColumns({"window": F.lit(True), "runs_over": F.lit(True)}))
    # The wordings of an id and licence; a row for each distinct one, few as statements are.
    wordings = stated.groupBy("id", "licence").agg(F.collect_list(F.struct("d", "window", "unit", "runs_over")).alias("all"))

    def padded(unit: Column) -> Column:
        return F.concat(F.lit(" "), unit, F.lit(" "))

    def repeats(x: Column) -> Column:
        return F.exists("all", lambda y: ~y["runs_over"] & (y["d"] <= x["d"]) & F.contains(padded(x["unit"]), padded(y["unit"])))

    def told_by_unit(x: Column) -> Column:
        return F.exists(
            "all",
            lambda y: ~y["window"] & (F.contains(padded(x["unit"]), padded(y["unit"])) | F.contains(padded(y["unit"]), padded(x["unit"]))),
        )

    counted_once = wordings.withColumn("all", F.filter("all", lambda x: x["window"] | ~(x["runs_over"] & repeats(x))))
    further = F.filter("all", lambda x: ~(x["window"] & told_by_unit(x)))
    nearest = F.array_min("all")
    best = counted_once.select(
        "id", "licence", (-nearest["d"]).alias("dice"), F.size(further).cast("long").alias("n_units"), nearest["unit"].alias("statement")
    )
    return best.withColumnRenamed("id", id_col)


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()
