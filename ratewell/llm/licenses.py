"""Licence scan by a positional rare-token index, all in DataFrame functions.

The licence notices are templates of words. A count over all documents gives each template word its document frequency;
the rarest words of every template form the index, with the places where they stand in it. A document looks up its own
highest-IDF words of a template, each occurrence votes for the place where the template would begin, and an alignment
with two votes or more counts only if the template's mandatory phrases stand where it says.

Null or empty text: no words, no labels, score 0. A row without an id is scanned like any other. Repeated rows give
repeated results. No documents: no rows. Only `doc_id` and `text` are read, so extra columns can't clash. Every occurrence of
an indexed word votes: nothing is cut off in long texts, whose time grows with their length, and no row meets another one, so
no key can be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

# Word separators: everything in ASCII that is neither a digit nor a letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases of the base and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Label, notice, mandatory phrases (all lower case, words only).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc", "4 0")),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa", "4 0")),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution", "4 0")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
#: Words of a template that go into the index, and those that one document looks up.
INDEXED, LOOKED_UP = 8, 4


def lowered(text: Column) -> Column:
    """ASCII letters lower-cased. The Kelvin sign, the one other letter whose lower case is plain ASCII, is put aside."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), SEPARATORS), "")


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, notice, _ in templates for w in notice.split()} | {w for phrase, _ in BASE for w in phrase.split()})


def word_places(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words and the template words of the text in order (w) with their places (i). Written once: the text is
    taken apart a single time."""
    wanted = _vocabulary(templates)

    def hits(words: Column) -> Column:
        found = F.filter(F.transform(words, lambda w, i: F.when(w.isin(wanted), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
        return F.struct(F.size(words).cast("long").alias("n_words"), found.alias("hits"))

    found = docs.select("doc_id", let(words_of(F.col("text")), hits).alias("r"))
    return stored(found.select("doc_id", "r.n_words", F.col("r.hits.w").alias("w"), F.col("r.hits.i").alias("i")), "license-words")


def word_frequencies(places: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Documents that hold each template word, over all documents. One row per template word reaches the driver."""
    found = places.select(F.explode(F.array_distinct("w")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return {w: 0 for w in _vocabulary(templates)} | {r["w"]: r["n"] for r in found.collect()}


def _template_score(ws: Column, at_words: Column, notice: str, keys, rarest: list[str]) -> Column:
    """The best share of the notice's words that stand in place, over verified alignments; null if there is none. An alignment
    looks at the words around its vote only, as many as the notice has on either side."""
    own = notice.split()
    index = {w: [o for o, x in enumerate(own) if x == w] for w in rarest}
    postings = F.create_map(*[c for w in rarest for c in (F.lit(w), F.array(*[F.lit(o) for o in index[w]]))])
    key_at = [(notice.split(key)[0].count(" "), len(key.split())) for key in keys]

    def in_place(vote: Column) -> Column:
        """Places in the notice whose words stand where the alignment says."""
        around = F.transform(F.sequence(F.lit(-len(own)), F.lit(len(own))), lambda k: F.struct(F.get(ws, vote["j"] + k).alias("w"), (F.get(at_words, vote["j"] + k) - vote["d"]).alias("o")))
        return F.transform(F.filter(around, lambda x: (x["o"] >= 0) & (x["o"] < len(own)) & (F.get(_strings(own), x["o"]) == x["w"])), lambda x: x["o"])

    def share(placed: Column) -> Column:
        def stands(lo: int, n: int) -> Column:
            return F.size(F.filter(placed, lambda o: (o >= lo) & (o < lo + n))) == n

        return F.when(_all(*[stands(lo, n) for lo, n in key_at]), F.size(placed) / F.lit(float(len(own))))

    def of(mine: Column) -> Column:
        present = F.array_distinct(F.transform(mine, lambda x: x["w"]))
        anchors = F.slice(let(present, lambda p: F.filter(_strings(rarest), lambda w: F.array_contains(p, w))), 1, LOOKED_UP)
        votes = let(anchors, lambda a: F.flatten(F.transform(F.filter(mine, lambda x: F.array_contains(a, x["w"])), lambda x: F.transform(F.element_at(postings, x["w"]), lambda o: F.struct((x["i"] - o).alias("d"), x["j"].alias("j"))))))
        # Of the votes for one place the first of two or more stands for all.
        twice = let(F.sort_array(votes), lambda s: F.filter(s, lambda x, k: (x["d"] == F.get(s, k + 1)["d"]) & ((k == 0) | (x["d"] != F.get(s, k - 1)["d"]))))
        return F.array_max(F.transform(twice, lambda x: let(in_place(x), share)))

    found = F.transform(ws, lambda w, j: F.when(w.isin(rarest), F.struct(w.alias("w"), F.get(at_words, j).alias("i"), j.alias("j"))))
    return let(F.filter(found, lambda x: x.isNotNull()), lambda mine: F.when(F.size(mine) >= 2, of(mine)))


def _all(first: Column, *rest: Column) -> Column:
    for c in rest:
        first = first & c
    return first


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and matches (label, score)."""
    found = word_places(docs, templates)
    seen = word_frequencies(found, templates)
    rank = lambda w: (seen[w], w)  # noqa: E731  the fewer documents, the higher the IDF
    rare = [sorted(set(notice.split()), key=rank)[:INDEXED] for _, notice, _ in templates]

    def places(ws: Column, at_words: Column, phrase: list[str]) -> Column:
        """Where the phrase begins: its words are template words, so they stand side by side among them, too."""
        def begins(w: Column, j: Column) -> Column:
            same = [(F.get(ws, j + k) == word) & (F.get(at_words, j + k) == F.get(at_words, j) + k) for k, word in enumerate(phrase) if k]
            return F.when(_all(w == phrase[0], *same), F.get(at_words, j))

        return F.filter(F.transform(ws, begins), lambda x: x.isNotNull())

    ws, at_words = F.col("w"), F.col("i")
    base = F.array(*[F.struct(F.lit(label).alias("label"), places(ws, at_words, phrase.split()).alias("at")) for phrase, label in BASE])
    matches = F.array(*[F.struct(F.lit(label).alias("label"), _template_score(ws, at_words, notice, keys, words).alias("score")) for (label, notice, keys), words in zip(templates, rare)])
    judged = found.select("doc_id", "n_words", F.filter(base, lambda b: F.size(b["at"]) > 0).alias("base"), F.filter(matches, lambda m: m["score"].isNotNull()).alias("matches"))
    at = F.flatten(F.transform("base", lambda b: b["at"]))
    names = lambda c: F.transform(c, lambda x: x["label"])
    joined = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    return judged.select(
        "doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        joined(names("base")).alias("base_labels"), joined(F.concat(names("base"), names("matches"))).alias("labels"),
        F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))).alias("score"),
        "matches",
    )
