"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, neighbouring word pairs and pairs with one word between. Each
shard of the labelled rows runs FTRL-proximal by rows in hash order, with a learning rate per coordinate; after each
round of passes the shards' states are brought together, a range of features in a task. The L1 term leaves few weights other
than zero; those alone come to the driver and are sent to the tasks that score.

The model is fitted on about SAMPLE different labelled rows (all, if there are fewer), chosen by a hash of id and text. A null
or empty text has the score of the bias alone; very long texts are hashed whole. A null id is never labelled and not held out.
Repeated rows are learned once and scored for themselves; of contradicting labels of one id the highest counts. Without labels
every score is next to 0, without documents there are no rows. Only ids, texts and labels are read; drop_toxic keeps whole rows
in a column of their own, so that names can't clash."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_hash, stored, wrapped

BITS, SHARD_ROWS, ROUNDS, PASSES, SAMPLE = 19, 5_000, 2, 3, 20_000
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.1
#: Ranges of features in which the shards' states are brought together, and a row of a state.
PARTS, STATE = 16, "shard long, part int, at binary, z binary, n binary"
THRESHOLD = 0.3
# Letters lower-cased, all other ASCII but digits a space: bytes over 127 stay as they are.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
_BIAS = 0


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").translate(_TABLE).split()
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Hashed words, pairs and pairs with a gap, with repeats; 0 is left to the bias."""
    h = word_hashes(text)
    pair = h[:-1] * np.uint64(3) + h[1:] * np.uint64(0x10001) + np.uint64(7)
    skip = h[:-2] * np.uint64(5) + h[2:] * np.uint64(0x30007) + np.uint64(11)
    return np.maximum(_mixed(np.concatenate([h, pair, skip])), 1)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def ftrl_pass(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over rows of (distinct features, label); z and n change in place."""
    for at, y in rows:
        w = _weights(z[at], n[at])
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """shard, h, toxic and features of the labelled rows to learn from. h is the hash of id and text: equal rows are one, and
    rows are chosen and dealt by it, so that an id with many rows is bounded like any others."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(F.pmod(doc_hash(), F.lit(4)) != 2)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    n = rows.select("doc_id", "h").join(known, "doc_id").select("h").distinct().count()
    share, shards = min(1.0, sample / max(1, n)), max(1, -(-min(n, sample) // SHARD_ROWS))
    chosen = rows.where(F.pmod(F.col("h"), F.lit(1 << 20)) < int(share * (1 << 20))).join(known, "doc_id")
    texts = chosen.dropDuplicates(["h"]).withColumn("shard", F.pmod(F.shiftright("h", 20), F.lit(shards)))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"shard": b.shard, "h": b.h, "toxic": b.toxic, "at": [np.unique(features(t)).astype(np.int32) for t in b.text]})

    return stored(texts.select("shard", "h", "toxic", "text").mapInPandas(hashed, "shard long, h long, toxic int, at array<int>"), "toxic-training")


def _state_rows(shard: int, at: np.ndarray, z: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """The state as rows (shard, part, at, z, n), one for each range of features, also where it is empty; at is in order."""
    cuts = np.searchsorted(at, np.arange(PARTS + 1) * (1 << BITS) // PARTS)
    pieces = [(shard, part, at[lo:hi].astype(np.int32).tobytes(), z[lo:hi].astype(np.float32).tobytes(), n[lo:hi].astype(np.float32).tobytes()) for part, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
    return pd.DataFrame(pieces, columns=["shard", "part", "at", "z", "n"])


def _shard_pass(turn: int):
    """PASSES passes of one shard from the shared state on, as a function of the shard's rows and of the state's."""

    def learn(group: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        for s in state.itertuples():
            at = np.frombuffer(s.at, np.int32)
            z[at], n[at] = np.frombuffer(s.z, np.float32), np.frombuffer(s.n, np.float32)
        rows = [(np.append(at, _BIAS), y) for at, y in zip(group["at"], group.toxic)]
        for k in range(PASSES):
            order = np.lexsort((group.h, [zlib.crc32(f"{turn}:{k}:{i}".encode()) for i in group.h]))
            ftrl_pass([rows[j] for j in order], z, n)
        at = np.flatnonzero(n)
        return _state_rows(int(group.shard.iloc[0]), at, z[at], n[at])

    return learn


def _together(states: pd.DataFrame, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, z and n of one range of features from the states of all shards. A coordinate's evidence adds up over the
    shards of the first round and is averaged over the following ones."""
    states = states.sort_values("shard")
    found = [np.frombuffer(x, np.int32) for x in states["at"]]
    at = np.unique(np.concatenate(found))
    z, n, heard = np.zeros(len(at)), np.zeros(len(at)), np.zeros(len(at))
    for own, own_z, own_n in zip(found, states.z, states.n):
        k = np.searchsorted(at, own)
        z[k] += np.frombuffer(own_z, np.float32)
        n[k] += np.frombuffer(own_n, np.float32)
        heard[k] += 1
    return (at, z / heard, n / heard) if turn else (at, z, n)


def _for_all(turn: int):
    """The state of one range after a round, a row for each shard, as a function of the shards' states."""

    def join(states: pd.DataFrame) -> pd.DataFrame:
        at, z, n = _together(states, turn)
        rows = pd.DataFrame({"shard": sorted(states.shard), "part": states.part.iloc[0]})
        return rows.assign(at=at.tobytes(), z=z.astype(np.float32).tobytes(), n=n.astype(np.float32).tobytes())

    return join


def _nonzero(states: pd.DataFrame) -> pd.DataFrame:
    """The weights of one range after the last round."""
    at, z, n = _together(states, ROUNDS - 1)
    w = _weights(z, n)
    return pd.DataFrame({"at": [at[w != 0].tobytes()], "w": [w[w != 0].tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The weights that aren't zero: their features, in order, and values. States stay with the tasks and in the shared
    folder; the weights alone come to the driver."""
    rows, state = training_rows(docs, labels, sample), docs.sparkSession.createDataFrame([], STATE)
    for turn in range(ROUNDS):
        states = rows.groupBy("shard").cogroup(state.groupBy("shard")).applyInPandas(_shard_pass(turn), STATE).groupBy("part")
        if turn < ROUNDS - 1:
            state = stored(states.applyInPandas(_for_all(turn), STATE), "toxic-state")
    parts = states.applyInPandas(_nonzero, "at binary, w binary").collect()  # PARTS rows
    if not parts:
        return np.array([_BIAS]), np.array([-35.0])
    at, w = (np.concatenate([np.frombuffer(r[name], kind) for r in parts]) for name, kind in (("at", np.int32), ("w", np.float64)))
    order = np.argsort(at)
    return at[order], w[order]


def score_text(text: str | None, dense: np.ndarray) -> float:
    at = features(text)
    at = np.unique(at[dense[at] != 0])
    return float(1 / (1 + np.exp(-np.clip(dense[at].sum() + dense[_BIAS], -35, 35))))


def scored(rows: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """rows (with a column text) and the score. The model is as large as L1 leaves it: BITS bound it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w = shared.value
        dense = np.zeros(1 << BITS)
        dense[at] = w
        for texts in batches:
            yield pd.Series([score_text(t, dense) for t in texts], dtype="float64")

    return rows.withColumn("score", score("text"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", F.coalesce(F.pmod(doc_hash(), F.lit(4)) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = THRESHOLD) -> DataFrame:
    """The documents that score below `reject`, with their own columns."""
    out = scored(wrapped(docs, "text"), fit(docs, labels))
    return out.where(F.col("score") < reject).select("row.*")
