"""N-gram Jaccard join: MinHash banding of one fixed depth over word shingles, then exact verification.

Equal texts form one node, so copies cost one row each and never meet in pairs. Of every node a MinHash signature is cut
into TREES label sequences of DEPTH hashes. All texts are grouped by a prefix of one length: the longest at which a pair of
the wanted similarity meets in some tree with the target recall. This is banding, in place of an LSH forest whose prefixes
adapt; the deeper hashes only choose a group's leader. In groups of up to SMALL
texts under that prefix all meet, and each pair is verified on the exact shingle sets.

Larger groups emit no pairs. The groups that share a text make one crowd. A crowd is cut by a hash into blocks of about BLOCK
texts and BLOCK_CHARS characters, and every two blocks meet in one task, which compares all their texts exactly. It returns
the number of links of each text and the links of a spanning forest, so its output is as long as its input, and neither a
link count nor a class is lost, whatever the size of the crowd. Classes are the connected components of all links.

Shingles are five words (split at white space, lower case); a shorter text is one shingle of all its words, an empty or null
text has none and is only in a class with other empty texts. Null ids take part as texts; a class's id is its smallest id.
Repeated rows are copies. Very long texts are shingled whole. No documents: no rows. Only doc_id and text are read; keep_one
keeps whole rows in a column of their own, so names can't clash. Result: one row per row of documents."""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, wrapped

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.999
TREES, DEPTH, SMALL = 24, 8, 16
BLOCK, BLOCK_CHARS = 128, 2_000_000
_A, _B = (np.random.RandomState(seed).randint(1, 1 << 31, TREES * DEPTH).astype(np.uint64) * np.uint64(2) + np.uint64(1) for seed in (7, 8))


def shortest_prefix(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair of that similarity meets in some tree with that probability."""
    for k in range(depth, 0, -1):
        if 1 - (1 - similarity**k) ** trees >= recall:
            return k
    return 1


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of the text's shingles, sorted."""
    w = (text or "").lower().split()
    h = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in w), np.uint64, len(w))
    n = max(1, len(w) - words + 1) if w else 0
    out = np.full(n, len(w) if len(w) < words else words, np.uint64)
    for k in range(min(words, len(w))):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """TREES x DEPTH minimum hashes of 32 bits."""
    best = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint64)
    for lo in range(0, len(found), 2048):
        part = (found[lo:lo + 2048] >> np.uint64(16))[:, None]
        best = np.minimum(best, ((part * _A + _B) >> np.uint64(32)).min(axis=0))
    return best.astype(np.uint32).reshape(TREES, DEPTH)


def nodes_of(docs: DataFrame) -> DataFrame:
    """node (digest of the text), doc_id: membership of every row."""
    return docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("node"))


def forest(texts: DataFrame) -> DataFrame:
    """node, tree, prefix (at the shortest depth) and path (at full depth) of rows (node, text)."""
    k = shortest_prefix()

    def branches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            nodes, trees, prefixes, paths = [], [], [], []
            for node, text in zip(b.node, b.text):
                found = shingles(text)
                if not len(found):
                    continue
                for tree, row in enumerate(signature(found)):
                    nodes.append(node)
                    trees.append(tree)
                    prefixes.append(xxhash.xxh3_64_intdigest(row[:k].tobytes(), tree) - (1 << 63))
                    paths.append(row[k:].astype(">u4").tobytes())
                if len(nodes) >= 50_000:
                    yield pd.DataFrame({"node": nodes, "tree": trees, "prefix": prefixes, "path": paths})
                    nodes, trees, prefixes, paths = [], [], [], []
            yield pd.DataFrame({"node": nodes, "tree": trees, "prefix": prefixes, "path": paths})

    return texts.mapInPandas(branches, "node binary, tree int, prefix long, path binary")


def groups(branches: DataFrame) -> DataFrame:
    """prefix, n and leader (the first leaf of the trie below the prefix) of the prefixes under which texts meet."""
    return branches.groupBy("prefix").agg(F.count("*").alias("n"), F.min_by("node", F.struct("path", "node")).alias("leader")).where("n > 1")


def crowds(branches: DataFrame) -> DataFrame:
    """node, root: the texts of the large groups; groups that share a text have the same root."""
    large = groups(branches).where(F.col("n") > SMALL).select("prefix", "leader")
    led = stored(branches.join(large, "prefix").groupBy("node").agg(F.collect_set("leader").alias("leaders"), F.min("leader").alias("first")), "near-led")  # TREES leaders at most
    joined = components(led.select(F.explode("leaders").alias("a"), F.col("first").alias("b")).where("a <> b").distinct())
    return led.join(joined.select(F.col("node").alias("first"), "root"), "first", "left").select("node", F.coalesce("root", "first").alias("root"))


def candidates(branches: DataFrame, crowd: DataFrame) -> DataFrame:
    """Pairs (a, b) with a < b that meet in a small group, each once, but for those of one crowd."""
    small = groups(branches).where(F.col("n") <= SMALL).select("prefix")
    met = branches.join(small, "prefix").groupBy("prefix").agg(F.sort_array(F.collect_list("node")).alias("nodes"))  # SMALL at most
    firsts = met.select("nodes", F.posexplode("nodes").alias("k", "a"))
    pairs = firsts.select("a", F.explode(F.slice("nodes", F.col("k") + 2, F.lit(SMALL))).alias("b")).distinct()
    of_a, of_b = crowd.select(F.col("node").alias("a"), F.col("root").alias("crowd_a")), crowd.select(F.col("node").alias("b"), F.col("root").alias("crowd_b"))
    apart = F.coalesce(F.col("crowd_a") != F.col("crowd_b"), F.lit(True))
    return pairs.join(of_a, "a", "left").join(of_b, "b", "left").where(apart).select("a", "b")


def crowd_links(crowd: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (a, b, n): b null and n the number of a's links in one pair of blocks, or a link of the spanning forest and 0."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        inside = group.one.iloc[0] == group.two.iloc[0]
        if not inside and group.block.nunique() < 2:  # an empty block: the other one's own links are counted in its own group
            return pd.DataFrame({"a": [], "b": [], "n": []})
        nodes, block = list(group.node), group.block.to_numpy()
        sets = [shingles(t) for t in group.text]
        size = np.array([len(s) for s in sets])
        values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), size)
        links, label, out = np.zeros(len(sets), int), np.arange(len(sets)), []
        for x in np.flatnonzero(block == block.min()):
            held = np.zeros(len(values), bool)
            held[np.searchsorted(values, sets[x])] = True
            both = np.bincount(owner[held[inverse]], minlength=len(sets))
            near = both >= similarity * (size + size[x] - both)
            near &= np.arange(len(sets)) > x if inside else block != block[x]
            at = np.flatnonzero(near)
            links[x] += len(at)
            links[at] += 1
            for old, first in zip(*np.unique(label[at], return_index=True)):
                if old != label[x]:
                    out.append((nodes[x], nodes[at[first]], 0))
                    label[label == old] = label[x]
        out += [(nodes[k], None, int(links[k])) for k in np.flatnonzero(links)]
        return pd.DataFrame(out, columns=["a", "b", "n"])

    rows = stored(crowd.join(texts, "node").select("root", "node", "text"), "near-crowds")
    blocks = rows.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("text")) / BLOCK_CHARS)).cast("int").alias("blocks"))
    own = rows.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = met.select("root", "node", "text", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    return pairs.groupBy("root", "one", "two").applyInPandas(compare, "a binary, b binary, n long")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b, jaccard) of at least that similarity, on the exact shingle sets."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def of(node: bytes, text: str) -> np.ndarray:
            if node in recent:
                recent.move_to_end(node)
            else:
                recent[node] = shingles(text)
                if len(recent) > 500:
                    recent.popitem(last=False)
            return recent[node]

        for b in batches:
            rows = []
            for x, y, tx, ty in zip(b.a, b.b, b.text_a, b.text_b):
                p, q = of(x, tx), of(y, ty)
                if min(len(p), len(q)) < similarity * max(len(p), len(q)):
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both >= similarity * (len(p) + len(q) - both):
                    rows.append((x, y, both / (len(p) + len(q) - both)))
            yield pd.DataFrame(rows, columns=["a", "b", "jaccard"])

    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInPandas(check, "a binary, b binary, jaccard double")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links lead to. In each round every node moves to its smallest neighbour's smallest
    neighbour and the links are drawn anew between the nodes that are left, once each: they shrink by a share in every round.
    Rounds are written to the shared folder."""
    edges = stored(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("other"))), "edges")
    roots = None
    while True:
        low = edges.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("up"))
        moves = stored(low.join(low.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", "top"), "moves")
        if roots is None:
            roots = moves.select("node", F.col("top").alias("root"))
        else:
            further = moves.select(F.col("node").alias("root"), "top")
            roots = stored(roots.join(further, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
        ends = moves.select(F.col("node").alias("other"), F.col("top").alias("end"))
        moved = edges.join(moves, "node").select(F.col("top").alias("node"), "other").join(ends, "other")
        edges = stored(moved.where("node <> end").select("node", F.col("end").alias("other")).distinct(), "edges")
        if edges.isEmpty():
            return roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """node, n_copies, first_id (of the equal texts), n_links (to different texts), class_id (smallest id of the class, null if
    none of its rows has one) and root (a node of the class, never null: the class's key)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.unhex(F.md5("text")))
    members = stored(rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), F.min(F.length("text")).alias("chars")), "near-nodes")
    texts = _one_text_each(rows, members)
    branches = stored(forest(texts), "near-branches")
    crowd = crowds(branches)
    pairs = stored(candidates(branches, crowd), "near-pairs")
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionAll(crowd.select("node")).distinct()
    texts = stored(texts.join(met, "node", "left_semi"), "near-texts")
    found = stored(verified(pairs, texts).select("a", "b", F.lit(1).cast("long").alias("n")).unionAll(crowd_links(crowd, texts)), "near-links")
    links = found.where("b is not null").select("a", "b")
    ends = found.select(F.explode(F.array("a", "b")).alias("node"), "n").where("node is not null").groupBy("node").agg(F.sum("n").alias("n_links"))
    roots = components(links)
    named = roots.join(members, "node").groupBy("root").agg(F.min("first_id").alias("class_id"))
    linked = roots.join(named, "root").join(ends, "node").select("node", "root", "n_links", "class_id")
    return members.join(linked, "node", "left").select("node", "first_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_id", "first_id").alias("class_id"), F.coalesce("root", "node").alias("root"))


def _one_text_each(rows: DataFrame, members: DataFrame) -> DataFrame:
    """node, text of one row per node: the row of the smallest id; texts whose rows have no id are grouped."""
    known = members.where("first_id is not null").select(F.col("first_id").alias("doc_id"), F.col("node").alias("of"))
    by_id = rows.join(known, "doc_id").where("node = of").select("node", "text")
    nameless = rows.join(members.where("first_id is null").select("node"), "node", "left_semi").select("node", "text")
    # Ids need not be unique: rows repeated with their id are made one again.
    return by_id.unionAll(nameless).groupBy("node").agg(F.first("text").alias("text"))


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, copy_of (the smallest id with the same text), n_copies and n_links, one row per row."""
    found = near_duplicates(docs).select("node", "first_id", "n_copies", "n_links", "class_id")
    return nodes_of(docs).join(found, "node").select("doc_id", "class_id", F.col("first_id").alias("copy_of"), "n_copies", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id, with its own columns. Of a class without ids, or with
    several texts at the smallest id, the smallest text digest stays; of equal rows, the one with the smallest hash."""
    classes = near_duplicates(docs)
    least = F.struct(F.col("first_id").isNull(), "first_id", "node")  # null ids last
    kept = classes.groupBy("root").agg(F.min_by(F.struct("node", "first_id"), least).alias("kept")).select("kept.*")
    rows = wrapped(docs, "doc_id", "text").withColumn("node", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    first = rows.join(kept, "node").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    return first.groupBy("node").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def expected_recall(similarity: float) -> float:
    return 1 - math.pow(1 - similarity ** shortest_prefix(), TREES)
