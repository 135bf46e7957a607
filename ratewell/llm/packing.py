"""Packing of token sequences: the cutting-stock problem by column generation.

Documents are tokenised and cut into full sequences and a rest. The rests are counted by length class: every length up to
EXACT is one, longer ones are rounded up to multiples of STEP. On that histogram
a linear program over patterns (how many rests of which class share a sequence) is solved by column generation: the dual
prices of its current patterns go into a knapsack dynamic program, whose best filling is the next pattern. Patterns are
used as often as the rounded-down solution says; what is left of the histogram is packed best fit decreasing. Long rests go
through the program first, short ones fill the room beside them and go through it among themselves. A rest finds
its sequence from its rank in its class.

The histogram and the patterns have one row per class, some 250, whatever the number of documents: the program runs
on the driver, everything else in Spark. Ranks are counted per class and salt, so no class is sorted in one task.

Null or empty text: no tokens of its own, one piece that holds the end id. Null ids and repeated rows are packed for
themselves. Very long texts are cut into as many full sequences as they need. No documents: no pieces. Only doc_id and text
are read, and placed pieces keep their own columns in one of their own, so names can't clash."""

from __future__ import annotations

import json
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LENGTH, END, EXACT, STEP, GAP = 2048, 1, 128, 16, 5e-4
TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers with their ids, characters taken at once, words in one call of the tokenizer.
REMEMBERED, SLAB, TOGETHER = 800_000, 1 << 20, 2_000


_MARKS = frozenset(".,!?;:")
#: Letters that stay one code point when normalised and have one in lower case: a run of them is one piece for the merges.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f"[{_LETTERS}]+").fullmatch
_LETTER_OR_DIGIT = re.compile(f"[{_LETTERS}0-9]").fullmatch
#: How a tokenizer must normalise and split for that.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT, _BYTES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}


def merges_words(tokenizer) -> bool:
    """Whether a run of letters goes to the tokenizer's merges whole, in lower case and written in its bytes."""
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
        return False
    normal, split = (json.loads(x.__getstate__()) for x in (tokenizer.normalizer, tokenizer.pre_tokenizer))
    steps = split.get("pretokenizers", [])
    return type(tokenizer.model).__name__ == "BPE" and normal.get("normalizers") == _NORMALIZERS and len(steps) == 2 and (
        steps[0] == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True} and _BYTES.items() <= steps[1].items())


# --- tokens ------------------------------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts. The tokenizer never looks across a space, and takes a mark after a letter or digit as a
    token of its own, so every distinct core of a word is encoded once, in lower case. A core of letters alone goes straight
    to the tokenizer's merges, where that gives the same ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.known, self.cores = Tokenizer.from_file(path), {}, {}
        self.merges = self.tokenizer.model if merges_words(self.tokenizer) else None
        written = ByteLevel(add_prefix_space=False, use_regex=False)
        self.in_bytes = {n: written.pre_tokenize_str(chr(n))[0][0] for n in range(0xC0, 0x100)}

    def merged(self, word: str) -> bytes:
        """The ids of a run of letters."""
        low = word.lower()
        return array("I", [t.id for t in self.merges.tokenize(low if low.isascii() else low.translate(self.in_bytes))]).tobytes()

    def learn(self, words: list[str]) -> None:
        parts = {}
        for w in words:
            low = w.lower() if w.isascii() else w  # beyond ASCII the tokenizer's own order of normalising counts
            marked = low[-1:] in _MARKS and len(low) > 1 and _LETTER_OR_DIGIT(low[-2])
            parts[w] = (low[:-1], low[-1]) if marked else (low, "")
        new = {c for pair in parts.values() for c in pair}.difference(self.cores)
        if self.merges is not None:
            words = list(filter(_WORD, new))
            self.cores.update(zip(words, map(self.merged, words)))
            new.difference_update(words)
        new = list(new)
        # Many words in one call, joined by spaces: a call costs far more than a word. Tokens go back by their offsets.
        for lo in range(0, len(new), TOGETHER):
            some = new[lo:lo + TOGETHER]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *[len(c) + 1 for c in some]])
            ends = (4 * np.searchsorted([b for b, _ in e.offsets], begins)).tolist()
            ids = np.array(e.ids, np.uint32).tobytes()
            for c, a, b in zip(some, ends, ends[1:]):
                self.cores[c] = ids[a:b]
        cores = self.cores
        self.known.update({w: cores[core] + cores[mark] if mark else cores[core] for w, (core, mark) in parts.items()})

    def encoded(self, words: list[str]) -> bytes:
        parts = list(map(self.known.get, words))
        missing = [k for k, part in enumerate(parts) if part is None]
        if missing:
            new = {words[k] for k in missing}
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                self.cores.clear()
                missing, new = range(len(words)), set(words)
            self.learn(list(new))
            for k in missing:
                parts[k] = self.known[words[k]]
        return b"".join(parts)

    def ids(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            to = at + SLAB if at + SLAB < len(text) else len(text)
            if to < len(text):
                to = text.find(" ", to) + 1 or len(text)
            parts.append(self.encoded(text[at:to].replace("\n", " ").split(" ")))
            at = to
        return np.append(np.frombuffer(b"".join(parts), np.uint32), np.uint32(END)).astype("<u4")


def worker_encoder(path: str) -> Encoder:
    """One encoder per Python worker, which Spark keeps for many tasks: what it remembers outlives a task."""
    kept = sys.modules.setdefault("_ratewell_worker", types.ModuleType("_ratewell_worker")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian unsigned 32-bit) of every piece of every document."""

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(tokenizer_path(tokenizer))
        for b in batches:
            rows = []
            for doc, text in zip(b.doc_id, b.text):
                ids = encoder.ids(text or "")
                rows += [(doc, at, min(length, len(ids) - at), len(ids), ids[at:at + length].tobytes()) for at in range(0, len(ids), length)]
                if len(rows) >= 2000:
                    yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(encoded, "doc_id string, start long, length long, doc_tokens long, ids binary")
    return rows.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


# --- the linear program ------------------------------------------------------------------------------------

def class_sizes(length: int = LENGTH) -> np.ndarray:
    """The sizes that lengths are rounded up to: every length up to EXACT, then multiples of STEP. Multiples leave room that
    other multiples fill."""
    return np.array(sorted({min(s, length) for s in (*range(1, EXACT + 1), *range(EXACT + STEP, length + STEP, STEP))}))


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """How many of each size fill `room` at the highest price: dynamic program over the room, a size after the other, each in
    1, 2, 4, ... pieces at a time."""
    best, took, many = np.zeros(room + 1), np.full(room + 1, -1), np.zeros(room + 1, np.int64)
    for k in np.argsort(-prices / sizes, kind="stable"):
        if prices[k] <= 0:
            break
        n = 1
        while (w := n * sizes[k]) <= room:
            worth = best[:-w] + n * prices[k]
            at = np.flatnonzero(worth > best[w:] + 1e-12)
            if len(at):
                best[at + w], took[at + w], many[at + w] = worth[at], k, n
            n *= 2
    out, c = np.zeros(len(sizes), np.int64), int(np.flatnonzero(best >= best[-1] - 1e-12)[0])
    while c > 0 and took[c] >= 0:
        out[took[c]] += many[c]
        c -= int(many[c] * sizes[took[c]])
    return out


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often the relaxed program uses each. Revised simplex: the basis starts with one pattern
    per size, each round brings in the pattern with the best price, until no pattern could save more than GAP of all."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    used = inverse @ demand
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        pattern = knapsack(np.maximum(prices, 0), sizes, room).astype(float)
        if prices @ pattern <= 1 + GAP:
            break
        direction = inverse @ pattern
        rising = direction > 1e-9
        ratios = np.where(rising, used / np.where(rising, direction, 1), np.inf)
        out = int(ratios.argmin())
        basis[:, out] = pattern
        used -= ratios[out] * direction
        used[out] = ratios[out]
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
    return basis.T.astype(np.int64), np.maximum(used, 0)


def best_fit(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns for what is left, largest first into what it fills best; equal sequences are counted, not listed."""
    left, out = counts.astype(np.int64).copy(), []
    while left.any():
        pattern, free = np.zeros(len(sizes), np.int64), room
        for k in np.argsort(-sizes, kind="stable"):
            n = min(left[k], free // sizes[k])
            pattern[k], free = n, free - n * sizes[k]
        times = int(min(left[k] // pattern[k] for k in np.flatnonzero(pattern)))
        out.append((pattern, times))
        left -= pattern * times
    return out


def solve(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) that hold all pieces: the program's patterns as often as its rounded-down solution says, the rest best
    fit decreasing."""
    left, out, unit = counts.copy(), [], int(np.gcd.reduce([*sizes, room]))
    patterns, used = column_generation(sizes // unit, counts.astype(float), room // unit)
    for k in np.argsort(-used, kind="stable"):
        held = patterns[k] > 0
        times = int(min(np.floor(used[k] + 1e-6), (left[held] // patterns[k][held]).min()))
        if times > 0:
            out.append((patterns[k], times))
            left -= patterns[k] * times
    return out + best_fit(sizes, left, room)


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[dict[int, int], int]]:
    """(pattern: pieces by size, times) for the number of pieces of each class size. Long pieces are packed first, short ones
    fill the room that their patterns leave, largest first, and those that are left are packed among themselves."""
    sizes = np.array(sorted(size for size, n in counts.items() if n), np.int64)
    left, out = np.array([counts[s] for s in sizes], np.int64), []
    long = sizes > EXACT
    for pattern, times in solve(sizes[long], left[long], length) if long.any() else []:
        held, free = dict(zip(sizes[long][pattern > 0].tolist(), pattern[pattern > 0].tolist())), length - int(pattern @ sizes[long])
        while times:
            filled, room = {}, free
            for k in np.flatnonzero(~long & (left > 0))[::-1]:
                if n := int(min(left[k], room // sizes[k])):
                    filled[k], room = n, room - n * int(sizes[k])
            now = min([times, *[int(left[k]) // n for k, n in filled.items()]])
            out.append(({**held, **{int(sizes[k]): n for k, n in filled.items()}}, now))
            times -= now
            for k, n in filled.items():
                left[k] -= n * now
    short = ~long & (left > 0)
    if short.any():
        out += [({int(s): int(n) for s, n in zip(sizes[short], pattern) if n}, times) for pattern, times in solve(sizes[short], left[short], length)]
    return out


# --- placement ---------------------------------------------------------------------------------------------

def pack(pieces: DataFrame, length: int = LENGTH, salts: int = 64) -> DataFrame:
    """pieces (with a column length of 1 to `length`) and the columns sequence_id and offset. The frame is read several
    times: store it first. The order of equal rows of one class and salt is the order of their hash and then arbitrary,
    so nothing but which of two equal rows comes first is left open; the result is stored before it is used further."""
    spark, names = pieces.sparkSession, pieces.columns
    sizes = class_sizes(length)
    rounded = spark.createDataFrame([(n, int(sizes[np.searchsorted(sizes, n)])) for n in range(1, length + 1)], "of int, class int")
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("length").cast("int").alias("of"), F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("h"))
    rows = rows.join(F.broadcast(rounded), "of").drop("of")  # one row for each length
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("h", F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    # Rows are numbered once and written, so that a lost task can't number them anew against sequences given before.
    numbered = stored(rows.withColumn("n", F.row_number().over(_window("class", "salt", order="h")).cast("long")), "pack-rows")
    found = {(r["class"], r["salt"]): r["n"] for r in numbered.groupBy("class", "salt").agg(F.count("*").alias("n")).collect()}  # classes x salts at most
    counts = {k: sum(n for (c, _), n in found.items() if c == k) for k in {c for c, _ in found}}
    before = [(c, s, sum(found.get((c, t), 0) for t in range(s))) for c, s in found]

    slots, first = [], 0
    seen = dict.fromkeys(counts, 0)
    for pattern, times in plan(counts, length):
        ahead = 0
        for k, many in pattern.items():
            slots.append((k, seen[k], seen[k] + many * times, many, first, ahead))
            seen[k] += many * times
            ahead += many
        first += times
    starts = spark.createDataFrame(before, "class int, salt int, before long")
    by_class = spark.createDataFrame([(k, sorted((lo, many, first, ahead) for c, lo, _, many, first, ahead in slots if c == k)) for k in counts], "class int, slots array<struct<lo:long,many:long,first:long,ahead:long>>")
    # Both tables are bounded by the classes: (classes x salts) and (classes x patterns) rows.
    ranked = numbered.join(F.broadcast(starts), ["class", "salt"]).join(F.broadcast(by_class), "class")
    rank = F.col("before") + F.col("n") - 1
    slot = F.element_at(F.filter("slots", lambda s: s["lo"] <= rank), -1)
    placed = ranked.select("row", slot.alias("slot"), rank.alias("rank")).select(
        "row", (F.col("slot.first") + F.floor((F.col("rank") - F.col("slot.lo")) / F.col("slot.many"))).cast("long").alias("sequence_id"), (F.col("slot.ahead") + (F.col("rank") - F.col("slot.lo")) % F.col("slot.many")).alias("place"))
    inside = _window("sequence_id", order="place")
    offset = F.coalesce(F.sum("row.length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).select("row.*", "sequence_id", "offset")


def _window(*keys: str, order: str):
    return Window.partitionBy(*keys).orderBy(order)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from placed pieces that carry them: a sequence holds a bounded number of tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("x"))))
    return placed.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["x"]), "")).alias("ids"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with the digest of their ids and their places."""
    pieces = token_pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(stored(pieces, "pack-pieces"))
