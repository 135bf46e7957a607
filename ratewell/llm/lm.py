"""Language-model scoring: a gated recurrent network with a class-factored softmax, beside an add-one unigram base.

Tasks cut their documents into blocks of about BLOCK_CHARS characters. A block keeps its texts as numbers of its own words;
these words, with their training tokens, are summed over all blocks and the sums go back to the blocks that hold the word,
so no table of all words is ever sent whole and no text is read twice. Words become symbols: each of the most frequent words
is one, and their number grows with the corpus (wide * wide, where wide is the sixth root of the training tokens); the others
share a symbol per power of two of their count. The network predicts a class of symbols, then the word in its class: by a
softmax among the frequent words, by the corpus counts in the classes of rarer words. Unseen words share the class of the
rarest: half of it is theirs, as V + 1 equally likely forms.

The network is trained by truncated backpropagation in numpy on all training documents, each once: the blocks are dealt into
ROUNDS lots, the blocks of a lot are learned side by side from the same weights, and Spark averages what they learned before
the next lot begins. For scoring, documents of a batch advance together in windows, and the state is carried from window to
window to the document's end.

Null or empty text: the end token alone. Texts are cut into words PIECE characters at a time, longer ones alone, and very long ones
make a block of their own. A null id is never held out nor learned from. Repeated rows are scored for themselves and each counts, and as blocks are
cut by size, copies of one row share no task beyond it. Without training rows, also on an empty table, N and V are 0 and the
base score of every token is log10(1). Only doc_id and text are read, so other columns can have any name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_hash, one_blas_thread, stored

BLOCK_CHARS, PIECE = 16_000_000, 1 << 22
WIDE, BINS, HIDDEN = 16, 24, 24
ROUNDS, STREAMS, UPDATES, STEPS, RATE = 4, 512, 250, 24, 0.01
WINDOW, TOGETHER = 48, 1024


# --- counts ------------------------------------------------------------------------------------------------

def words_of(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts with A-Z lower-cased, one after the other, and how many each text has. Arrow's ASCII white space
    is what splits words."""
    data = pa.array([text.encode("utf-8", "replace") for text in texts], pa.large_binary()).cast(pa.large_string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(data))
    offsets, flat = parts.offsets.to_numpy(), parts.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0)  # white space at an end of a text leaves an empty part
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), np.diff(before[offsets])


class Block:
    """Documents as numbers of the block's words, in the order in which they come; word 0 is the end, the empty word. Arrow
    splits PIECE characters at a time, and numbers the words of all when the block is full."""

    def __init__(self, name: str):
        self.name, self.chars, self.waiting = name, 0, 0
        self.ids: list[str | None] = []
        self.folds: list[str | None] = []
        self.texts: list[str] = []
        self.words: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []

    def add(self, doc_id: str | None, fold: str | None, text: str) -> None:
        self.ids.append(doc_id)
        self.folds.append(fold)
        self.texts.append(text)
        self.chars += len(text) + 8
        self.waiting += len(text) + 8
        if self.waiting >= PIECE:
            self.split()

    def split(self) -> None:
        words, sizes = words_of(self.texts)
        self.words.append(words)
        self.sizes.append(sizes)
        self.texts, self.waiting = [], 0

    def row(self) -> pa.RecordBatch:
        self.split()
        own = pa.chunked_array(self.words).dictionary_encode().chunks
        words = pa.concat_arrays([pa.array([""], pa.large_string()), *[c.dictionary for c in own[-1:]]]).cast(pa.string())  # the last chunk knows all
        numbers = np.concatenate([np.zeros(0, np.uint32), *[c.indices.to_numpy().astype(np.uint32) + np.uint32(1) for c in own]])
        ends = np.cumsum(np.concatenate(self.sizes))
        ids = np.insert(numbers, ends, np.uint32(0))  # each document's end follows its words
        ends += np.arange(1, len(ends) + 1)
        learned = np.repeat([f is not None and f != "2" for f in self.folds], np.diff(ends, prepend=0))
        counts = np.bincount(ids[learned], minlength=len(words))
        parts = [x.tobytes() for x in np.split(ids, ends[:-1])]
        docs = pa.StructArray.from_arrays([pa.array(self.ids, pa.string()), pa.array(self.folds, pa.string()), pa.array(parts, pa.binary())], ["doc_id", "fold", "ids"])
        whole = lambda x: pa.ListArray.from_arrays([0, len(x)], x)
        return pa.RecordBatch.from_arrays([pa.array([self.name]), whole(words), whole(pa.array(counts, pa.int64())), whole(docs)], ["block", "words", "n", "docs"])


def blocks(docs: DataFrame) -> DataFrame:
    """block, words, n (training tokens of each word), docs (doc_id, fold: remainder of the id's hash, ids): written, so that
    the blocks stay the same whatever order the rows come in when they are asked for again."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        block = Block(f"{part}-{n}")
        for batch in batches:
            for doc_id, fold, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "fold", "text"))):
                block.add(doc_id, fold, text)
                if block.chars >= BLOCK_CHARS:
                    yield block.row()
                    n += 1
                    block = Block(f"{part}-{n}")
        if block.ids:
            yield block.row()

    rows = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"), F.pmod(doc_hash(), F.lit(7)).cast("string").alias("fold"))
    kind = "block string, words array<string>, n array<long>, docs array<struct<doc_id: string, fold: string, ids: binary>>"
    return stored(rows.mapInArrow(made, kind), "lm-blocks")


class Shape:
    """The sizes of the network: wide classes of wide frequent words each, and the bins of rarer words that occur."""

    def __init__(self, wide: int, bins: int = BINS):
        self.wide, self.head, self.bins = wide, wide * wide, bins
        self.classes, self.symbols = 1 + wide + bins, 1 + self.head + bins  # the end, the frequent words, the bins
        self.shapes = {
            "x": (self.symbols, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, self.classes), "bc": (self.classes,),
            "ww": (wide, HIDDEN, wide), "bw": (wide, wide),
        }
        self.size = sum(int(np.prod(s)) for s in self.shapes.values())
        self.class_of = np.array([0, *[1 + k // wide for k in range(self.head)], *range(1 + wide, self.classes)])

    def unpacked(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name] = flat[at:at + size].reshape(shape)
            at += size
        return out


def wide_for(training_tokens: int) -> int:
    return max(WIDE, round(training_tokens ** (1 / 6)))


class Totals:
    """What the driver knows of the counts: N, V, the frequent words, and the tokens per bin."""

    def __init__(self, counts: DataFrame):
        row = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
        self.n, self.v = row["n"] or 0, row["v"] or 0
        wide = wide_for(self.n)
        top = counts.where("word <> '' and c > 0").orderBy(F.desc("c"), "word").limit(wide * wide).collect()
        self.top = {r["word"]: k + 1 for k, r in enumerate(top)}
        rare = counts.where("word <> ''").groupBy(F.least(F.floor(F.log2(F.col("c") + 1)), F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.sum("c").alias("c")).collect()
        self.bins = np.zeros(BINS)
        for r in rare:
            self.bins[r["bin"]] = r["c"]
        for r in top:
            self.bins[bin_of(r["c"])] -= r["c"]
        # Frequent words leave the upper bins empty: those are no classes.
        used = np.flatnonzero(self.bins > 0)
        self.shape = Shape(wide, int(used.max(initial=1)) + 1)
        ends = counts.where("word = ''").agg(F.sum("c")).first()[0] or 0
        self.head_counts = np.array([r["c"] for r in top] + [0] * (wide * wide - len(top)), float)
        self.start = np.log(np.concatenate([[ends], self.head_counts.reshape(-1, wide).sum(axis=1), self.bins[:self.shape.bins]]) + 1.0)


def bin_of(c) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.asarray(c, float) + 1)), BINS - 1).astype(int)


def encode(made: DataFrame, counts: DataFrame, totals: Totals) -> DataFrame:
    """block, doc_id, fold, n_tokens, n_known, base_score, rare_score (of rarer words in their classes) and symbols, per row."""
    n, v, bins, head = totals.n, totals.v, totals.bins, totals.shape.head

    def encoded(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("place")
        c = known.c.to_numpy(np.int64)
        base = np.log10((c + 1) / (n + v + 1))
        kind = np.maximum(bin_of(c), 1)
        symbol = 1 + head + kind
        rare = np.where(c > 0, np.log10(np.maximum(c, 1) / np.maximum(bins[kind], 1)), -np.log10(v + 1))
        rare += np.where(kind == 1, np.log10(0.5), 0.0)
        named = known.named.to_numpy(np.int64)
        symbol, rare = np.where(named > 0, named, symbol), np.where(named > 0, 0.0, rare)
        symbol[0], rare[0] = 0, 0.0
        symbol, out = symbol.astype(np.uint16), []
        for doc in own.docs.iloc[0]:
            ids = np.frombuffer(doc["ids"], np.uint32)
            out.append((own.block.iloc[0], doc["doc_id"], doc["fold"], len(ids), int((c[ids] > 0).sum()), float(base[ids].sum()), float(rare[ids].sum()), symbol[ids].tobytes()))
        return pd.DataFrame(out, columns=["block", "doc_id", "fold", "n_tokens", "n_known", "base_score", "rare_score", "symbols"])

    # The frequent words, wide * wide at most, are marked in the counts; words themselves move once.
    top = made.sparkSession.createDataFrame(list(totals.top.items()), "word string, named long")
    marked = counts.join(F.broadcast(top), "word", "left").select("word", "c", F.coalesce("named", F.lit(0)).alias("named"))
    words = made.select(F.col("block").alias("of"), F.posexplode("words").alias("place", "word")).join(marked, "word").select("of", "place", "c", "named")
    kind = "block string, doc_id string, fold string, n_tokens long, n_known long, base_score double, rare_score double, symbols binary"
    return made.select("block", "docs").groupBy("block").cogroup(words.groupBy("of")).applyInPandas(encoded, kind)


# --- the network -------------------------------------------------------------------------------------------

def first_weights(totals: Totals) -> np.ndarray:
    flat = np.random.RandomState(3).normal(0, 0.1, totals.shape.size)
    p = totals.shape.unpacked(flat)
    p["bc"][:] = totals.start - totals.start.max()
    p["bw"][:] = np.log(totals.head_counts + 1.0).reshape(p["bw"].shape)
    return flat.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def _exp(x: np.ndarray, spans: list[tuple[int, int, int]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """exp of logits in place, kept within what single precision can sum, and the sums of the rows, a span of rows at a time
    if spans are given: the last bit of a sum depends on the rows beside it. A row's largest logit is not looked for, which
    would take longer than all the rest."""
    np.maximum(x, np.float32(-80), out=x)
    np.minimum(x, np.float32(60), out=x)
    np.exp(x, out=x)
    ones, sums = np.ones(x.shape[1], np.float32), np.empty(len(x), np.float32)
    for _, a, b in [(0, 0, len(x))] if spans is None else spans:
        sums[a:b] = x[a:b] @ ones
    return x, sums


def _softmax(x: np.ndarray, spans: list[tuple[int, int, int]] | None = None) -> np.ndarray:
    x, sums = _exp(x, spans)
    x *= np.reciprocal(sums)[:, None]
    return x


def _log_picked(x: np.ndarray, at: np.ndarray, spans: list[tuple[int, int, int]] | None = None) -> np.ndarray:
    """Log softmax of one entry of each row."""
    picked = np.clip(x[np.arange(len(at)), at], -80, 60)
    return picked - np.log(_exp(x, spans)[1])


def run_states(p: dict, inputs: np.ndarray, h: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """The state after each step of (steps, rows) input symbols; the gates, which the way back needs, go to keep."""
    out, given = np.empty((len(inputs), *h.shape), np.float32), p["x"][inputs]
    for t, g in enumerate(given):
        hu = h @ p["u"]
        zr = _sigmoid(g[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        hun = hu[:, 2 * HIDDEN:]
        c = r * hun
        c += g[:, 2 * HIDDEN:]
        np.tanh(c, out=c)
        if keep is not None:
            for k, gate in enumerate((z, r, c, hun)):
                keep[k, t] = gate
        new = out[t]
        np.subtract(h, c, out=new)
        new *= z
        new += c
        h = new
    return out


def by_class(kinds: np.ndarray, wide: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The places of words of the frequent classes in the order of their classes, and (class, from, to) in that order of each
    class that occurs."""
    order = np.argsort(kinds.astype(np.uint16), kind="stable")
    ends = np.searchsorted(kinds[order], np.arange(1, wide + 2))
    spans = [(k, int(a - ends[0]), int(b - ends[0])) for k, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
    return order[ends[0]:ends[-1]], spans


def word_logits(p: dict, rows: np.ndarray, spans: list[tuple[int, int, int]], wide: int) -> np.ndarray:
    """The logits of the words of a row's class; rows stand in the order of their classes, so that a class is one slice."""
    logits = np.empty((len(rows), wide), np.float32)
    for k, a, b in spans:
        np.matmul(rows[a:b], p["ww"][k], out=logits[a:b])
        logits[a:b] += p["bw"][k]
    return logits


def log_prob(shape: Shape, p: dict, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of target symbols (class, then word in the frequent classes) for rows of states."""
    kinds = shape.class_of[targets]
    logits = states @ p["wc"]
    logits += p["bc"]
    out = _log_picked(logits, kinds)
    at, spans = by_class(kinds, shape.wide)
    logits = word_logits(p, states[at], spans, shape.wide)
    out[at] += _log_picked(logits, (targets[at].astype(int) - 1) % shape.wide, spans)
    return out


def train_shard(shape: Shape, documents: list[np.ndarray], flat: np.ndarray) -> np.ndarray:
    """Truncated backpropagation through windows of STEPS over parallel streams, as many as leave UPDATES windows; Adam; the
    state is carried on."""
    flat = flat.copy()
    p, joined = shape.unpacked(flat), np.concatenate(documents)
    grad, m1, m2 = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    d = shape.unpacked(grad)
    streams = max(1, min(STREAMS, max(16, len(joined) // (STEPS * UPDATES)), len(joined) // (2 * STEPS)))
    width = len(joined) // streams
    s = joined[:streams * width].reshape(streams, width).T
    before = np.concatenate([np.zeros((1, streams), s.dtype), s[:-1]])  # every document follows an end
    h, turn = np.zeros((streams, HIDDEN), np.float32), 0
    for lo in range(0, width, STEPS):
        x, y = before[lo:lo + STEPS], s[lo:lo + STEPS].ravel().astype(np.int64)
        keep = np.empty((4, *x.shape, HIDDEN), np.float32)
        states = run_states(p, x, h, keep)
        first, h = h, states[-1]
        grad[:] = 0
        rows, kinds = states.reshape(-1, HIDDEN), shape.class_of[y]
        e = _softmax(rows @ p["wc"] + p["bc"])
        e[np.arange(len(y)), kinds] -= 1
        d["wc"] += rows.T @ e
        d["bc"] += e.sum(axis=0)
        back = e @ p["wc"].T
        at, spans = by_class(kinds, shape.wide)
        own = rows[at]
        e = _softmax(word_logits(p, own, spans, shape.wide), spans)
        e[np.arange(len(at)), (y[at] - 1) % shape.wide] -= 1
        own_back = np.empty_like(own)
        for k, a, b in spans:
            d["ww"][k] += own[a:b].T @ e[a:b]
            d["bw"][k] += e[a:b].sum(axis=0)
            np.matmul(e[a:b], p["ww"][k].T, out=own_back[a:b])
        back[at] += own_back
        back, dh, (z, r, c, hun) = back.reshape(states.shape), np.zeros_like(h), keep
        h0 = np.concatenate([first[None], states[:-1]])
        # What a step multiplies, for all steps at once: by the new state, its gate and the reset.
        to_new, to_gate, to_reset = (1 - z) * (1 - c * c), (h0 - c) * z * (1 - z), hun * r * (1 - r)
        dg, dhu, turned = np.empty((*x.shape, 3 * HIDDEN), np.float32), np.empty((*x.shape, 3 * HIDDEN), np.float32), p["u"].T.copy()
        for t in range(len(x) - 1, -1, -1):
            dh += back[t]
            d_gate, d_reset, d_new = (dg[t, :, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
            np.multiply(dh, to_gate[t], out=d_gate)
            np.multiply(dh, to_new[t], out=d_new)
            np.multiply(d_new, to_reset[t], out=d_reset)
            dhu[t, :, :2 * HIDDEN] = dg[t, :, :2 * HIDDEN]
            np.multiply(d_new, r[t], out=dhu[t, :, 2 * HIDDEN:])
            dh *= z[t]
            dh += dhu[t] @ turned
        d["u"] += h0.reshape(-1, HIDDEN).T @ dhu.reshape(-1, 3 * HIDDEN)
        # Sums per input symbol: rows in the order of their symbols, one sum per run.
        order = np.argsort(x.ravel(), kind="stable")
        ordered = x.ravel()[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        d["x"][ordered[starts]] += np.add.reduceat(dg.reshape(-1, 3 * HIDDEN)[order], starts, axis=0)
        grad /= len(y)
        grad *= min(1.0, 1.0 / (float(np.sqrt(grad @ grad)) + 1e-9))
        turn += 1
        m1 += 0.1 * (grad - m1)
        m2 += 0.01 * (grad * grad - m2)
        flat -= RATE * (m1 / (1 - 0.9**turn)) / (np.sqrt(m2 / (1 - 0.99**turn)) + 1e-6)
    return flat


def fit(encoded: DataFrame, totals: Totals) -> np.ndarray:
    """The weights after all lots of training documents were learned once."""
    spark, shape = encoded.sparkSession, totals.shape
    rows = encoded.where("fold is not null and fold <> '2'").select("block", "doc_id", "symbols")
    flat = first_weights(totals)
    for lot in range(ROUNDS):
        shared = spark.sparkContext.broadcast(flat)

        def learn(group: pd.DataFrame) -> pd.DataFrame:
            one_blas_thread()
            group = group.sort_values(["doc_id", "symbols"])
            docs = [np.frombuffer(b, np.uint16) for b in group.symbols]
            made = train_shard(shape, docs, shared.value)
            return pd.DataFrame({"weights": [made], "tokens": [sum(map(len, docs))]})

        mine = rows.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == lot)
        made = mine.groupBy("block").applyInPandas(learn, "weights array<float>, tokens long")
        # Decimals, so that the sum does not depend on the order of the blocks.
        weighed = F.sum((F.col("col").cast("double") * F.col("tokens")).cast("decimal(28,9)"))
        each = made.select("tokens", F.posexplode("weights")).groupBy("pos").agg((weighed.cast("double") / F.sum("tokens")).alias("w"))
        learned = each.orderBy("pos").collect()  # as many rows as the network has weights
        if learned:
            flat = np.array([r["w"] for r in learned], np.float32)
        shared.unpersist()
    return flat


def score_documents(shape: Shape, p: dict, documents: list[np.ndarray]) -> np.ndarray:
    """log10 probability of whole documents of symbols, TOGETHER at a time, the state carried over windows."""
    out = np.zeros(len(documents))
    order = np.argsort([-len(d) for d in documents], kind="stable")
    for lo in range(0, len(order), TOGETHER):
        rows = order[lo:lo + TOGETHER]
        sizes = np.array([len(documents[k]) for k in rows])
        h, last = np.zeros((len(rows), HIDDEN), np.float32), np.zeros(len(rows), np.uint16)
        for at in range(0, sizes[0], WINDOW):
            live = int((sizes > at).sum())  # longest first: those still running are in front
            steps = min(WINDOW, sizes[0] - at)
            y = np.zeros((live, steps), np.uint16)
            for k in range(live):
                part = documents[rows[k]][at:at + steps]
                y[k, :len(part)] = part
            x = np.concatenate([last[:live, None], y[:, :-1]], axis=1)
            states = run_states(p, x.T, h[:live])
            h, last = states[-1], y[:, -1]
            real = (np.arange(steps)[:, None] < (sizes[:live] - at)[None, :])
            got = log_prob(shape, p, states[real], y.T[real])
            out[rows[:live]] += np.bincount(np.nonzero(real)[1], got, live)
    return out / np.log(10)


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, made = docs.sparkSession, blocks(docs)
    counts = stored(made.select(F.explode(F.arrays_zip("words", "n")).alias("w")).groupBy(F.col("w.words").alias("word")).agg(F.sum("w.n").alias("c")), "lm-counts")
    totals = Totals(counts)
    encoded = stored(encode(made, counts, totals), "lm-symbols")
    shared, shape = spark.sparkContext.broadcast(fit(encoded, totals)), totals.shape

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one_blas_thread()
        p = shape.unpacked(shared.value)
        for b in batches:
            yield pd.Series(score_documents(shape, p, [np.frombuffer(x, np.uint16) for x in b]), dtype="float64")

    id_type = docs.schema["doc_id"].dataType
    return encoded.select(
        F.col("doc_id").cast(id_type).alias("doc_id"), F.coalesce(F.col("fold") == "2", F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(totals.n).cast("long").alias("train_tokens"), "base_score", (F.col("rare_score") + score("symbols")).alias("score"))
