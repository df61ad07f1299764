"""Licence scans by a positional index of rare words.

Licence texts are templates.  A template is indexed under its rarest words only, by the documents at hand,
each posted with its position.  A document's words that are licence words are kept with their positions; its rare
ones look up the index, and each (document place - template place) votes for where the template would begin.  A template
is taken where enough of its rare words, by weight, agree on the beginning, and where all its mandatory phrases stand at
that beginning too.  Beginnings are compared in overlapping windows, so that a few inserted words (a name, a year) do no
harm.  Everything is counted by grouping; no document meets a template it shares no rare word with.

Phrases that name a licence outright give their label wherever they stand.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.llm.common import whole
from spanweave.shared import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, text of a notice, phrases that must stand in it.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    ("mit", "Released under the MIT License", ["mit license"]),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at",
        ["apache license version 2 0"],
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        ["gnu general public license", "version 3"],
    ),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license version 3"]),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or any later version",
        ["gnu general public license", "version 2"],
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation",
        ["gnu lesser general public license"],
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        ["redistribution and use in source and binary forms", "conditions are met"],
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies",
        ["without fee is hereby granted"],
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at",
        ["mozilla public license v 2 0"],
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0 international"]),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software",
        ["free and unencumbered software", "public domain"],
    ),
]

RARE_WORDS = 12  # of a template that are indexed, at most, out of the rarer half
LEAST_SHARE = 0.7  # of their weight that must agree
WINDOW = 8  # beginnings in a window; windows overlap by half


def split(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAP), "")


def _fixed(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A table of fixed values, made of one literal."""
    names = [field.split()[0] for field in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ':', -1).replace(',:', ',')}>>")))


class Index:
    """Phrases and templates, and the words that occur in them."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str, list[str]]]):
        self.base = [(split(p), label) for p, label in phrases.items()]
        self.templates = [(label, split(text), [split(p) for p in needed]) for label, text, needed in templates]
        self.marks = [p for p, _ in self.base]
        for _, text, needed in self.templates:
            for phrase in needed:
                if not any(text[i : i + len(phrase)] == phrase for i in range(len(text))):
                    raise ValueError(f"{' '.join(phrase)} is mandatory, but not in its template")
                if phrase not in self.marks:
                    self.marks.append(phrase)
        self.vocabulary = sorted({w for text in [*self.marks, *(t for _, t, _ in self.templates)] for w in text})

    def words(self) -> list[tuple[int, str, int]]:
        """(template, word, place)"""
        return [(t, w, i) for t, (_, text, _) in enumerate(self.templates) for i, w in enumerate(text)]

    def mandatory(self) -> list[tuple[int, str, int]]:
        """(template, phrase as #number, first place)"""
        rows = []
        for t, (_, text, needed) in enumerate(self.templates):
            for phrase in needed:
                place = next(i for i in range(len(text)) if text[i : i + len(phrase)] == phrase)
                rows.append((t, f"#{self.marks.index(phrase)}", place))
        return rows


def _hits(docs: DataFrame, index: Index, id_col: str, text_col: str) -> DataFrame:
    """row, id, n_words, hits: licence words with their places, in order."""
    told = docs.select(F.col(id_col).alias("id"), words(whole(text_col)).alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    return told.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.filter(placed, lambda h: h["word"].isin(index.vocabulary)).alias("hits"),
    )


def _stands(phrase: list[str]) -> Callable[[Column], Column]:
    """Whether the phrase begins at the k-th hit."""

    def test(k: Column) -> Column:
        first = F.get("hits", k)
        held = first["word"] == phrase[0]
        for j, word in enumerate(phrase[1:], 1):
            ahead = F.get("hits", k + j)
            held = held & (ahead["word"] == word) & (ahead["at"] == first["at"] + j)
        return F.coalesce(held, F.lit(False))

    return test


def _place(phrase: int) -> Callable[[Column], Column]:
    return lambda k: F.struct(F.lit(phrase).alias("phrase"), F.get("hits", k)["at"].alias("at"))


def _with_phrases(rows: DataFrame, index: Index) -> DataFrame:
    """Adds places: (phrase, at) of every phrase, found on the words that lie side by side in hits."""
    firsts = sorted({p[0] for p in index.marks})
    starts = F.filter(F.sequence(F.lit(0), F.size("hits") - 1), lambda k: F.get("hits", k)["word"].isin(firsts))
    rows = rows.select("*", F.when(F.size("hits") > 0, starts).otherwise(F.expr("cast(array() as array<int>)")).alias("starts"))
    found = [F.transform(F.filter("starts", _stands(phrase)), _place(n)) for n, phrase in enumerate(index.marks)]
    return rows.select("*", F.concat(*found).alias("places")).drop("starts")


def _postings(rows: DataFrame, index: Index, rare_words: int) -> DataFrame:
    """template, mark, place, weight, mandatory: the rarest words of each template, and its mandatory phrases.

    As large as the templates are.
    """
    spark = rows.sparkSession
    held = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("mark"))
    counted = held.groupBy("mark").agg(F.count("*").alias("held"))
    total = rows.agg(F.count("*").alias("total"))
    weight = F.expr("cast(round(1000 * ln((total + 1) / (coalesce(held, 0) + 1))) as bigint) + 1").alias("weight")
    posted = _fixed(spark, "template int, mark string, place int", index.words())
    # The total is one row.
    weighed = posted.join(counted, "mark", "left").join(F.broadcast(total)).select("template", "mark", "place", weight)
    ranks = [F.expr(f"dense_rank() over (partition by template order by {o})").alias(n) for n, o in (("nth", "weight desc, mark"), ("last", "weight, mark desc"))]
    rarest = weighed.select("*", *ranks)
    phrases = _fixed(spark, "template int, mark string, place int", index.mandatory())
    return (
        rarest.filter((F.col("nth") <= rare_words) & (F.col("nth") <= F.col("last")))
        .select("template", "mark", "place", "weight", F.lit(False).alias("mandatory"))
        .unionByName(phrases.select("*", F.lit(0).cast("long").alias("weight"), F.lit(True).alias("mandatory")))
    )


def _aligned(rows: DataFrame, postings: DataFrame, index: Index, least_share: float, window: int) -> DataFrame:
    """row, template, share: the templates that a row holds."""
    # As many as the templates have.
    rare_words = [r.mark for r in postings.filter("not mandatory").select("mark").distinct().collect()]
    rare = F.filter("hits", lambda h: h["word"].isin(rare_words))
    rare = F.transform(rare, lambda h: F.struct(h["word"].alias("mark"), h["at"].alias("at")))
    phrases = F.transform("places", lambda p: F.struct(F.concat(F.lit("#"), p["phrase"].cast("string")).alias("mark"), p["at"].alias("at")))
    marks = rows.filter(F.size("hits") > 0).select("row", F.explode(F.concat(rare, phrases)).alias("m")).select("row", "m.*")
    begins = marks.join(F.broadcast(postings), "mark").withColumn("begin", F.col("at") - F.col("place"))
    grids = F.explode(F.array(F.lit(0), F.lit(window // 2))).alias("shift")
    votes = begins.select("row", "template", "mark", "place", "weight", "mandatory", "begin", grids).select(
        "row", "template", "mark", "place", "weight", "mandatory", "shift", F.expr(f"floor((begin + shift) / {window})").alias("window")
    )
    full = postings.groupBy("template").agg(F.sum("weight").alias("full"), F.count_if("mandatory").alias("needed"))
    agreed = (
        votes.distinct()
        .groupBy("row", "template", "shift", "window")
        .agg(F.sum("weight").alias("weight"), F.count_if("mandatory").alias("given"))
        .join(F.broadcast(full), "template")
        .withColumn("share", F.col("weight") / F.col("full"))
        .filter((F.col("share") >= least_share) & (F.col("given") == F.col("needed")))
    )
    return agreed.groupBy("row", "template").agg(F.max("share").alias("share"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str, list[str]]] = TEMPLATES,
    rare_words: int = RARE_WORDS,
    least_share: float = LEAST_SHARE,
    window: int = WINDOW,
) -> DataFrame:
    """A row per row of docs: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of the phrases, first_word and last_word are the first and last of them (null without one).
    base_labels are the phrases' labels, labels those and the templates', distinct, sorted and joined by commas, empty
    without any.  score is the best share of a template's rare words found, 1 where a phrase stands, 0 without a label.

    Null texts count as empty and give no places; a null or repeated id is handed through, each row by itself.  A text of
    nothing but licence words is grouped by where templates would begin.  Of equal weights the words first by code point
    are the rarest.  No rows in, no rows out; other columns are not looked at.
    """
    index = Index(phrases, templates)
    rows = written(_hits(docs, index, id_col, text_col), "licence-words")
    postings = written(_postings(rows, index, rare_words), "postings")
    rows = _with_phrases(rows, index)
    names = _fixed(rows.sparkSession, "template int, label string", [(t, label) for t, (label, _, _) in enumerate(index.templates)])
    taken = _aligned(rows, postings, index, least_share, window).join(F.broadcast(names), "template")
    taken = taken.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    base = F.filter("places", lambda p: p["phrase"] < len(index.base))
    at = F.transform("base", lambda p: p["at"].cast("long"))
    label = F.array(*(F.lit(name) for _, name in index.base))
    found = rows.select("row", "id", "n_words", base.alias("base")).select(
        "*", F.sort_array(F.array_distinct(F.transform("base", lambda p: F.get(label, p["phrase"])))).alias("names")
    )
    none = F.expr("cast(array() as array<string>)")
    return found.join(taken, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join("names", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("names", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def sql(index: Index, rare_words: int = RARE_WORDS, least_share: float = LEAST_SHARE, window: int = WINDOW) -> str:
    base = [(n, label) for n, (_, label) in enumerate(index.base)]
    spelt = [(n, " ".join(p), len(p)) for n, p in enumerate(index.marks)]
    names = [(t, label) for t, (label, _, _) in enumerate(index.templates)]
    return rf"""
WITH told AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
  FROM documents
),
word AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS pos FROM told),
phrase(n, phrase, size) AS (VALUES {_values(spelt)}),
place AS (
  SELECT r, n, pos FROM told t JOIN word w USING (r) JOIN phrase p ON w.word = split_part(p.phrase, ' ', 1)
  WHERE array_to_string(t.words[pos + 1 : pos + size], ' ') = p.phrase
),
base AS (SELECT r, pos, label FROM place JOIN (VALUES {_values(base)}) b(n, label) USING (n)),
entry(template, mark, spot) AS (VALUES {_values(index.words())}),
rarity AS (
  SELECT e.*, 1 + CAST(round(1000 * ln((SELECT count(*) + 1 FROM told) / (1 + (SELECT count(DISTINCT r) FROM word w WHERE w.word = e.mark)))) AS bigint) AS weight
  FROM entry e
),
posting AS (
  SELECT template, mark, spot, weight, false AS needed FROM rarity
  QUALIFY dense_rank() OVER (PARTITION BY template ORDER BY weight DESC, mark)
       <= least({rare_words}, dense_rank() OVER (PARTITION BY template ORDER BY weight, mark DESC))
  UNION ALL SELECT template, mark, spot, 0, true FROM (VALUES {_values(index.mandatory())}) m(template, mark, spot)
),
vote AS (
  SELECT DISTINCT r, template, mark, spot, weight, needed, shift, CAST(floor((pos - spot + shift) / {window}) AS bigint) AS win
  FROM (SELECT r, word AS mark, pos FROM word UNION ALL SELECT r, '#' || n, pos FROM place) m
  JOIN posting USING (mark), (VALUES (0), ({window // 2})) s(shift)
),
aligned AS (
  SELECT r, template, sum(weight) / any_value(full_weight) AS share
  FROM vote JOIN (SELECT template, sum(weight) AS full_weight, count(*) FILTER (needed) AS n FROM posting GROUP BY template) f USING (template)
  GROUP BY r, template, shift, win
  HAVING sum(weight) / any_value(full_weight) >= {least_share} AND count(*) FILTER (needed) = any_value(n)
),
more AS (
  SELECT r, label, max(share) AS share FROM aligned JOIN (VALUES {_values(names)}) t(template, label) USING (template) GROUP BY ALL
)
SELECT doc_id, CAST(len(words) AS bigint) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END::double AS score
FROM told
LEFT JOIN (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
           FROM base GROUP BY r) b USING (r)
LEFT JOIN (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share
           FROM (SELECT r, label, NULL AS share FROM base UNION ALL SELECT r, label, share FROM more) GROUP BY r) l USING (r)
"""


SQL = sql(Index(PHRASES, TEMPLATES))
