"""Spelling variants: words that differ by one inserted, deleted or replaced code point, grouped under the frequent form.

The nodes of the trie of all words and of the trie of the reversed words are numbered, so that a word's prefixes and
suffixes are integers. A word goes to the pair (prefix node, suffix node) around each of its positions, once with the
position skipped and once with nothing between. Two words that skip a position under one pair differ in that position
only; a word with nothing between is a word that skips a position there without that code point. Both are exact.

A pair holds at most one word per code point of the alphabet (90 here) and one whole word, so its list is bounded; it
returns counts and the best neighbour of each member, never pairs of members. Of the positions in a row of equal code
points only the last counts as deleted, so each neighbour is met once.

Numbering: words are dealt into ranges of their order, a task walks one sorted range and numbers the prefixes that are new.
Only prefixes across a range border could be numbered twice; these come from the borders' two words, of which the driver
sees one pair for every RANGE code points of the vocabulary.

Null text: no words. A null id counts as the empty text. A word that loses a code point and gets too short is no word.
Repeated rows count as often as they stand there. Ties: the smaller word in code-point order. Texts and words of any
length are taken whole. No documents: no words. Only doc_id and text are read, other columns can have any name."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LETTERS, UPPER, LOWER = r"[A-Za-zÀ-ÿ]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, LEAST, RATIO, EVERY, RANGE = 6, 5, 5, 199, 1_000_000


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """word, n. Where `every` divides the crc32 of '<doc_id>:<run>', the run loses a code point."""
    run = F.explode(F.expr(f"regexp_extract_all(text, '{LETTERS}{{{shortest},}}', 0)".replace("\\", "\\\\")))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    runs = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = runs.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = h.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def trie_nodes(words: DataFrame, key: str, kept: list[str], size: int = RANGE) -> DataFrame:
    """The kept long columns, key, rank (place of the key in code-point order), nodes (the trie's node after 0, 1, ... code
    points) and turns (whether a code point differs from the next). Keys are different texts."""
    chars = words.agg(F.sum(F.length(key))).first()[0] or 0
    placed = words.repartitionByRange(max(1, -(-chars // size)), key).withColumn("part", F.spark_partition_id())
    placed = stored(placed, f"trie-{key}")
    edges = placed.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("rows"), F.sum(F.length(key)).alias("chars")).orderBy("part").collect()
    # Per range: its first rank and node number, and the prefixes across its lower and upper border with their (negative) nodes.
    plan, border, ids, used, rank, node = {}, "", [], 0, 0, 1
    for k, edge in enumerate(edges):
        below = (border, ids)
        after = os.path.commonprefix([edge.high, edges[k + 1].low]) if k + 1 < len(edges) else ""
        shared = len(os.path.commonprefix([border, after]))
        ids = ids[:shared] + [-used - j for j in range(1, len(after) - shared + 1)]
        used, border = used + len(after) - shared, after
        plan[edge.part] = (rank, node, *below, border, ids)
        rank, node = rank + edge.rows, node + edge.chars

    def walk(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(key).reset_index(drop=True)
        rank, node, last, path, upper, upper_ids = plan[int(own.part.iloc[0])]
        path, nodes, turns = [0, *path], [], []
        for word in own[key]:
            old, high = len(os.path.commonprefix([last, word])), len(os.path.commonprefix([upper, word]))
            path = path[:old + 1]
            for depth in range(old + 1, len(word) + 1):
                if depth <= high:
                    path.append(upper_ids[depth - 1])
                else:
                    path.append(node)
                    node += 1
            last = word
            nodes.append(np.array(path, np.int64))
            points = np.frombuffer(word.encode("utf-32-le"), "<u4")
            turns.append(np.append(points[1:] != points[:-1], True))
        return own[kept + [key]].assign(rank=rank + np.arange(len(own)), nodes=nodes, turns=turns)

    fields = ", ".join(f"{c} long" for c in kept)
    return placed.groupBy("part").applyInPandas(walk, f"{fields}, {key} string, rank long, nodes array<long>, turns array<boolean>")


def near_words(words: DataFrame) -> DataFrame:
    """rank, n_near and best (n, -rank of the near word with the largest n) of the words that have near words.
    words: rank, n, size, pre (prefix nodes), post (suffix nodes by length), turns."""
    skipped = "transform(sequence(0, size - 1), i -> struct(pre[i] AS p, post[size - 1 - i] AS s, false AS whole, turns[i] AS turn))"
    whole = "transform(sequence(0, size), i -> struct(pre[i] AS p, post[size - i] AS s, true AS whole, false AS turn))"
    places = words.select("rank", "n", F.expr(f"inline(concat({skipped}, {whole}))"))
    pairs = places.groupBy("p", "s").agg(
        F.expr("sort_array(collect_list(struct(n, -rank AS r, turn)) FILTER (WHERE NOT whole), false)").alias("m"),
        F.expr("max(struct(n, -rank AS r)) FILTER (WHERE whole)").alias("w")).where("size(m) > 1 OR (size(m) = 1 AND w IS NOT NULL)")
    other = "IF(i > 0, struct(m[0].n AS n, m[0].r AS r), IF(size(m) > 1, struct(m[1].n AS n, m[1].r AS r), NULL))"
    members = f"transform(m, (x, i) -> struct(-x.r AS rank, size(m) - 1 + IF(x.turn AND w IS NOT NULL, 1, 0) AS near, greatest({other}, IF(x.turn, w, NULL)) AS best))"
    turned = "filter(m, x -> x.turn)"
    middle = f"IF(w IS NULL, array(), array(struct(-w.r AS rank, size({turned}) AS near, get(transform({turned}, x -> struct(x.n AS n, x.r AS r)), 0) AS best)))"
    found = pairs.select(F.expr(f"inline(concat({members}, {middle}))")).where("near > 0")
    return found.groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """rank, form, root: the end of each word's chain of forms, by doubling. Counts grow along a chain, so it has no circle."""
    now = stored(links.select("rank", "form", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(ahead, "root", "left").select("rank", "form", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")


def spelling(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY, ratio: int = RATIO, size: int = RANGE) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word with at least `least` occurrences."""
    forward = stored(trie_nodes(stored(vocabulary(docs, shortest, least, every), "spelling-words"), "word", ["n"], size), "spelling-forward")
    turned = trie_nodes(forward.select(F.col("rank").alias("id"), F.reverse("word").alias("reversed")), "reversed", ["id"], size)
    post = turned.select(F.col("id").alias("rank"), F.col("nodes").alias("post"))
    words = forward.join(post, "rank").select("rank", "n", F.size("turns").alias("size"), F.col("nodes").alias("pre"), "post", "turns")
    known = forward.select("rank", "word", "n")
    near = stored(known.join(near_words(words), "rank").select("rank", "n", "n_near", (-F.col("best.r")).alias("form"), F.col("best.n").alias("form_n")), "spelling-near")
    linked = roots(near.where(F.col("form_n") >= ratio * F.col("n")))
    name = known.select(F.col("rank").alias("at"), F.col("word").alias("name"))
    named = linked.join(name.withColumnsRenamed({"at": "form", "name": "form_word"}), "form").join(name.withColumnsRenamed({"at": "root", "name": "root_word"}), "root")
    counts = near.select("rank", "n_near", F.when(F.col("form_n") >= ratio * F.col("n"), F.col("form_n")).alias("form_n"))
    rows = known.join(counts, "rank", "left").join(named.select("rank", "form_word", "root_word"), "rank", "left")
    return rows.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
