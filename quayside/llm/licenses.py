"""License scan: set phrases, and an exact containment join of notice templates with blocks of text.

DataFrame operations only. Texts are lower-cased in A-Z; words are runs of digits, letters and
everything beyond ASCII.

1. Base: places where the words of a phrase stand consecutively.
2. Rarity: the tokens of the templates are counted over all texts; rarer ones come first, in
   templates and blocks alike. Tokens of no template cannot add to an overlap and are left out.
3. Blocks: every `STEP` words a block of `BLOCK` words begins, so any run of BLOCK - STEP + 1 words,
   longer than any template, lies within one block. A template of n distinct tokens needs
   ceil(threshold * n) of them in a block, so one of its n - need + 1 rarest must be there: only
   blocks around such a prefix token are formed.
4. Join: tokens of these blocks meet the templates' prefix tokens; the length filter and the
   positional filter bound the overlap, the survivors are verified on their whole sets.

The templates are a parameter of some dozen sentences. What the plan holds of them (their tokens,
ranked, and their prefixes) is bounded by that parameter, whatever the corpus; nothing else is
broadcast. The join never moves a text: blocks meet the templates where they are, and the labels
found come back to the rows by the digest of the text, only for rows that have blocks.
"""

from __future__ import annotations

import string
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 64
STEP = 32
THRESHOLD = 0.9

PHRASES: dict[str, str] = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, a sentence that its notices hold), as the public notices word it.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
)


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none of a null."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _places(found: Column, phrase: list[str]) -> Column:
    """The positions where the words of the phrase begin to stand consecutively."""
    last = F.size(found) - len(phrase)

    def here(i: Column) -> Column:
        hit = F.get(found, i) == phrase[0]
        for j, w in enumerate(phrase[1:], 1):
            hit = hit & (F.get(found, i + j) == w)
        return hit

    # an ascending sequence only: one from 0 to -1 would run backwards
    return F.when((last >= 0) & F.array_contains(found, phrase[-1]), F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(
        F.expr("array()").cast("array<int>")
    )


def token_order(found: DataFrame, templates: tuple[tuple[str, str], ...]) -> list[str]:
    """The templates' tokens, rarest over all texts first; ties by the token. `found` has a column `words`."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    token = found.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("token"))
    count = {r["token"]: r["n"] for r in token.groupBy("token").agg(F.count("*").alias("n")).collect()}  # at most the vocabulary
    return sorted(vocabulary, key=lambda w: (count.get(w, 0), w))


def _prefixes(spark: SparkSession, templates: tuple[tuple[str, str], ...], rank: dict[str, int], threshold: Fraction) -> tuple[DataFrame, set[str], int]:
    """(rank, p, n, need, tokens, label) of every prefix token, the prefix tokens, and the least overlap that any template needs."""
    rows, prefix, least = [], set(), 1 << 30
    for label, text in templates:
        tokens = sorted({rank[w] for w in text.split()})
        need = -(-threshold.numerator * len(tokens) // threshold.denominator)
        least = min(least, need)
        whole = ", ".join(f"{r}L" for r in tokens)
        for p, r in enumerate(tokens[: len(tokens) - need + 1]):
            rows.append(f"({r}L, {p}, {len(tokens)}, {need}, array({whole}), '{label}')")
            prefix.add(r)
    names = {r: w for w, r in rank.items()}
    table = spark.sql(f"select * from values {', '.join(rows)} as t(rank, p, n, need, template, label)")
    return table, {names[r] for r in prefix}, least


def _blocks(order: list[str], prefix: set[str], least: int) -> Column:
    """Block number and ranked tokens of every block around a prefix token that has tokens enough."""
    ranked = F.array(*[F.lit(w) for w in order])
    near = F.filter(F.transform("words", lambda w, i: F.when(w.isin(sorted(prefix)), i)), lambda i: i.isNotNull())
    numbers = F.transform(near, lambda i: F.floor(i / STEP).cast("int"))
    numbers = F.filter(F.array_distinct(F.concat(numbers, F.transform(numbers, lambda k: k - 1))), lambda k: k >= 0)

    def tokens(k: Column) -> Column:
        known = F.filter(F.slice("words", k * STEP + 1, BLOCK), lambda w: w.isin(order))
        return F.array_sort(F.array_distinct(F.transform(known, lambda w: F.array_position(ranked, w))))

    made = F.filter(F.transform(numbers, lambda k: F.struct(k.alias("block"), tokens(k).alias("tokens"))), lambda b: F.size(b["tokens"]) >= least)
    return F.when(F.arrays_overlap("words", F.array(*[F.lit(w) for w in sorted(prefix)])), made)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all phrases, first_word and last_word are the smallest and the largest
    of their starts, null without any. `labels` adds those of templates of whose distinct tokens a block
    holds `threshold` or more; score is 1 where a phrase stands, else the largest such share, else 0.

    A null or an empty text has no words, no labels and score 0. Rows are judged by their text alone,
    so repeated rows and null ids come back as they are, each with its labels. Labels are distinct and
    sorted, so ties cannot matter. Other columns are not read; an empty table gives an empty result.
    Templates must fit into a block wherever they begin: at most BLOCK - STEP + 1 words.
    """
    if max(len(t.split()) for _, t in templates) > BLOCK - STEP + 1:
        raise ValueError(f"a template has more than {BLOCK - STEP + 1} words")
    spark = docs.sparkSession
    text = F.col(text_col)
    plain = docs.select(F.col(id_col).alias("id"), text.cast("string").alias("text"), words(text).alias("words"))
    order = token_order(plain, templates)
    prefixes, prefix, least = _prefixes(spark, templates, {w: i + 1 for i, w in enumerate(order)}, Fraction(str(threshold)))

    places = {phrase: _places(F.col("words"), phrase.split()) for phrase in phrases}
    judged = plain.select(
        "id",
        "text",
        F.size("words").alias("n_words"),
        F.array(*places.values()).alias("places"),
        _blocks(order, prefix, least).alias("blocks"),
    )
    named = [F.when(F.size(F.get("places", F.lit(i))) > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    starts = F.flatten("places")
    facts = stored(
        judged.select(
            "id",
            F.when(F.size("blocks") > 0, F.unhex(F.sha2("text", 256))).alias("digest"),
            F.col("n_words").cast("long"),
            F.size(starts).cast("long").alias("n_base"),
            F.array_min(starts).cast("long").alias("first_word"),
            F.array_max(starts).cast("long").alias("last_word"),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*named)))).alias("base"),
            "blocks",
        ),
        "license-facts",
    )

    block = facts.where("digest is not null").select("digest", F.explode("blocks").alias("b")).select("digest", "b.tokens")
    token = block.select("digest", "tokens", F.size("tokens").alias("m"), F.posexplode("tokens").alias("q", "rank"))
    fits = F.expr("need <= m and 1 + least(n - p - 1, m - q - 1) >= need")
    common = token.join(F.broadcast(prefixes), "rank").where(fits).withColumn("common", F.size(F.array_intersect("tokens", "template")))
    found = (
        common.where("common >= need").groupBy("digest").agg(F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("n")).alias("share"))
    )

    # rows without blocks have no digest to meet anything by and stay out of the join
    bare = facts.where("digest is null").withColumns({"more": F.expr("cast(null as array<string>)"), "share": F.expr("cast(null as double)")})
    both = facts.where("digest is not null").join(found, "digest", "left").unionByName(bare)
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.expr("cast(array() as array<string>)")))))
    return both.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
