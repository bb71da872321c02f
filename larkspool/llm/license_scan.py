"""Licence labels by a positional index of rare words, in DataFrame expressions only.

Templates are short runs of words from public licence notices, each with a key phrase that must stand word for word.  They
are a table, and so are their words, weighted by inverse document frequency over the corpus.  Of each file, the licence
words with the highest weights that the file has are looked up: a template can only stand where all words of its key phrase
are in the file, so its words are ranked among those of such templates, and a template none of whose words is among the
highest is looked up by its own rarest.  Each looked-up word proposes places for the templates that hold it, by the word's
place in the template; the places that all looked-up words of a template agree on are verified by the key phrase and by
the weight of the words that agree.  Nothing is lost by the ranking, and what a file's labels are does not depend on how
common its licence is.  Phrases that name a licence outright are found too.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import table, written

#: Words: bytes and characters outside the ASCII punctuation, white space and (already lowered) capitals.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that name a licence, and their labels; each ends in "license".
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, words of the notice, its key phrase).
TEMPLATES = (
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "you can redistribute it and or modify it"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc", "this work is licensed under a creative commons attribution", "creative commons attribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "unless required by applicable law or agreed to in writing"),
    ("apache-2.0", "spdx license identifier apache 2 0", "identifier apache 2 0"),
    ("mit", "spdx license identifier mit", "license identifier mit"),
    ("bsd", "spdx license identifier bsd", "license identifier bsd"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "names of its contributors may be used to endorse"),
    ("gpl-2.0", "spdx license identifier gpl 2 0", "identifier gpl 2 0"),
    ("gpl-3.0", "spdx license identifier gpl 3 0", "identifier gpl 3 0"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program", "copy of the gnu general public license"),
    ("lgpl", "spdx license identifier lgpl", "license identifier lgpl"),
    ("lgpl-2.1", "licensed under the gnu lesser general public license version 2 1", "lesser general public license version 2 1"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", "lesser general public license version 3"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero general public license version 3"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl was not distributed"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2 0"),
    ("eupl", "licensed under the european union public licence", "european union public licence"),
    ("cddl", "subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "in no event will the authors be held liable"),
    ("artistic-2.0", "distributed under the terms of the artistic license 2 0", "artistic license 2 0"),
    ("ofl-1.1", "licensed under the sil open font license version 1 1", "sil open font license"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("cc0-1.0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", "cc by nc sa 4 0"),
    ("cc-by-sa", "available under the creative commons attribution sharealike license", "creative commons attribution sharealike"),
    ("cc-by-nc", "available under the creative commons attribution noncommercial license", "creative commons attribution noncommercial"),
    ("odbl-1.0", "made available under the open database license", "open database license"),
    ("python", "licensed under the python software foundation license", "python software foundation license"),
    ("wtfpl", "do what the fuck you want to public license", "you want to public license"),
    ("all-rights-reserved", "copyright all rights reserved", "all rights reserved"),
)
#: Part of a template's weight that must agree.
COVERAGE = 0.7


#: Words of a file that are looked up, rarest first, beside those of templates that none of them is a word of.
LOOKED_UP = 4
#: A catalogue is held by every task while it runs: words of all its templates together, at most.
CATALOGUE_WORDS = 500_000
_PLACES = "array<struct<at: int, word: string>>"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def catalogue(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """The templates as a table: id, label, words, key (the words of the key phrase) and key_at (where it begins)."""
    rows = ", ".join(f"({i}, {_quoted(label)}, split({_quoted(text)}, ' '), split({_quoted(key)}, ' '))" for i, (label, text, key) in enumerate(templates))
    known = spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, label, words, key)")
    return known.withColumn("key_at", F.expr("get(filter(sequence(0, size(words) - size(key)), i -> slice(words, i + 1, size(key)) = key), 0)"))


def with_words(docs: DataFrame) -> DataFrame:
    """doc_id and the words of the whole text, A-Z lowered; null counts as empty."""
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("w"))


def weighted(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """The templates with the weights of their words, and the rarest word of each key phrase with its weight.

    Weights are inverse document frequencies over all of docs, as parts of the template's sum.  A word that is in every
    text tells nothing; it keeps a little weight so that a template never weighs nothing.
    """
    words = templates.select(F.explode("words").alias("word"))
    if (n := words.count()) > CATALOGUE_WORDS:
        raise ValueError(f"a catalogue of {n} words; scan with parts of up to {CATALOGUE_WORDS}")
    vocabulary = words.agg(F.array_sort(F.collect_set("word"))).scalar()
    seen = with_words(docs).select(F.explode(F.array_intersect(vocabulary, F.col("w"))).alias("word")).groupBy("word").agg(F.count("*").alias("texts"))
    total = docs.agg(F.count("*")).scalar()
    at = templates.select("id", F.posexplode("words").alias("at", "word")).join(F.broadcast(seen), "word", "left")
    weight = F.greatest(F.log((total + 1) / (F.coalesce(F.col("texts"), F.lit(0)) + 1)), F.lit(1e-3))
    of = at.select("id", "at", weight.alias("weight")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "weight"))).alias("all"))
    out = templates.join(of, "id").select("id", "label", "words", "key", "key_at", F.col("all.weight").alias("weights"))
    ranked = "array_sort(transform(key, (x, j) -> named_struct('less', -weights[key_at + j], 'word', x)))[0]"
    out = out.withColumn("rare", F.expr(ranked)).withColumn("sum", F.expr("aggregate(weights, 0D, (s, x) -> s + x)"))
    return out.select("id", "label", "words", F.expr("transform(weights, x -> x / sum)").alias("weights"), "key", "key_at", F.col("rare.word").alias("rare"),
                      F.expr("transform(key, (x, j) -> named_struct('less', -weights[key_at + j], 'word', x))").alias("ranks"))


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """Licence labels of every row of docs(doc_id, text) by ``templates`` (see ``catalogue``; the built-in ones if None).

    n_words; the places of the base phrases (n_base, first_word, last_word counted in words from 0, base_labels); labels
    of phrases and templates together; score, the largest weight that agrees (1 for a base phrase, 0 without labels).
    Null and empty texts have no words and no labels (empty strings); texts of any length are read whole.  Every row,
    repeated ones too, gives one row; other columns are not looked at.
    """
    templates = catalogue(docs.sparkSession) if templates is None else templates
    known = written(weighted(docs, templates), "licence_templates")
    held = known.agg(F.array_sort(F.collect_list(F.struct("id", "label", "words", "weights", "key", "key_at", "rare")))).scalar()
    by_weight = known.select(F.explode("ranks").alias("r")).groupBy("r.word").agg(F.min("r.less").alias("less"))
    vocabulary = by_weight.agg(F.array_sort(F.collect_list(F.struct("less", "word"))).getField("word")).scalar()

    rows = with_words(docs).withColumn("n", F.size("w"))
    # places of "license" are where any base phrase ends
    ends = "if(array_contains(w, 'license'), filter(sequence(0, greatest(n - 1, 0)), i -> get(w, i) = 'license'), cast(array() as array<int>))"
    rows = rows.withColumn("ends", F.expr(ends))
    base = []
    for phrase, label in BASE:
        before = phrase.split()[:-1]
        test = " and ".join(f"coalesce(get(w, i - {len(before) - j}) = '{x}', false)" for j, x in enumerate(before))
        base.append(f"transform(filter(ends, i -> i >= {len(before)} and {test}), i -> named_struct('at', cast(i - {len(before)} as bigint), 'label', '{label}'))")
    rows = rows.withColumn("base", F.expr(f"if(size(ends) > 0, concat({', '.join(base)}), cast(array() as array<struct<at: bigint, label: string>>))"))

    # the file's words of key phrases, rarest first, and the templates whose key phrase has no other words
    rows = rows.withColumn("present", F.array_intersect(vocabulary, F.col("w"))).withColumn("templates", held)
    rows = rows.withColumn("able", F.expr("filter(templates, t -> array_contains(present, t.rare) and size(array_except(t.key, present)) = 0)"))
    rows = rows.withColumn("highest", F.expr(f"if(size(able) > 0, slice(array_intersect(present, flatten(able.key)), 1, {LOOKED_UP}), cast(array() as array<string>))"))
    rows = rows.withColumn("looked", F.expr("if(size(able) > 0, array_union(highest, transform(filter(able, t -> not arrays_overlap(t.key, highest)), t -> t.rare)), highest)"))
    rows = rows.withColumn("places", F.expr(f"if(size(looked) > 0, filter(transform(w, (x, i) -> named_struct('at', i, 'word', x)), p -> array_contains(looked, p.word)), cast(array() as {_PLACES}))"))
    # where a template's key phrase would begin: the places that all its looked-up words agree on
    start = "transform(filter(places, p -> p.word = {x}), p -> p.at - cast(array_position(t.key, {x}) as int) + 1)"
    begins = f"""transform(able, t -> named_struct('t', t, 'begins', aggregate(
        slice(array_intersect(looked, t.key), 2, size(looked)), {start.format(x="get(array_intersect(looked, t.key), 0)")},
        (found, x) -> array_intersect(found, {start.format(x="x")}))))"""
    rows = rows.withColumn("proposed", F.expr(begins))
    accepted = """flatten(transform(proposed, c -> transform(
        filter(c.begins, b -> b >= 0 and slice(w, greatest(b, 0) + 1, size(c.t.key)) = c.t.key),
        b -> named_struct('label', c.t.label, 'part', aggregate(sequence(0, size(c.t.words) - 1), 0D,
            (s, j) -> s + if(b - c.t.key_at + j >= 0 and coalesce(get(w, b - c.t.key_at + j) = c.t.words[j], false), c.t.weights[j], 0D))))))"""
    rows = rows.withColumn("accepted", F.expr(f"if(size(proposed) > 0, filter({accepted}, a -> a.part >= {COVERAGE}D), cast(array() as array<struct<label: string, part: double>>))"))
    return rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.at").alias("first_word"),
        F.array_max("base.at").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base.label", "accepted.label")), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.round(F.coalesce(F.array_max("accepted.part"), F.lit(0.0)), 9)).alias("score"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
