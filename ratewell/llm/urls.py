"""URL filters: rules on hosts and paths, and beyond them logistic regression on hashed character n-grams.

Host and path are cut out of the url by DataFrame functions; the longest rule that fits decides. Urls without a rule get
the verdict of a model that is trained from a table of labelled urls: about SAMPLE different ones, chosen by hash, each with the number of its rows as weight.

A null url or one without `://` has an empty host and path, no rule, and the model's verdict on its bias. Repeated rows
are judged alike; equal urls with different labels all count. With labels of one kind only the model gives that label,
with none it allows. Very long urls are hashed whole. Only `page_id` and `url` are read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules, host and path together, with their verdicts.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
BITS, GRAMS, SAMPLE, STEPS, BATCH = 16, (3, 4, 5), 20_000, 6, 64


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        out = F.when(((host == name) | host.endswith("." + name)) & path.startswith("/" + rest), rule).otherwise(out)
    return out


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashes of the character n-grams of host and path, each kind apart."""
    found = []
    for kind, text in ((b"h", "^" + host + "$"), (b"p", "^" + path + "$")):
        raw = text.encode("utf-8", "replace")
        found += [zlib.crc32(kind + raw[i:i + n]) for n in GRAMS for i in range(len(raw) - n + 1)]
    return np.unique(np.array(found, np.int64) & ((1 << BITS) - 1))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def sampled(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """host, path, block and n (labelled rows) of about `sample` different urls: two rows a url at most, however often it occurs."""
    counts = labelled.where("block is not null").groupBy("host", "path", "block").agg(F.count("*").alias("n"))
    share = min(1.0, sample / max(1, counts.select("host", "path").distinct().count()))
    return counts.where(F.pmod(F.xxhash64("host", "path"), F.lit(1 << 20)) < int(share * (1 << 20)))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The weights, the bias last, from rows of (host, path, block 0 or 1). One task trains on the bounded sample."""
    chosen = sampled(labelled, sample)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"at": [grams(h, p).astype(np.int32) for h, p in zip(b.host, b.path)], "block": b.block.astype("int32"), "n": b.n, "turn": [zlib.crc32(f"{h}{p}".encode("utf-8", "replace")) for h, p in zip(b.host, b.path)]})

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"at": [], "block": [], "n": [], "turn": []}), *batches])
        got["key"] = [a.tobytes() for a in got["at"]]
        got = got.sort_values(["turn", "key", "block"])
        xs, ys, ns = list(got["at"]), got.block.to_numpy("float64"), got.n.to_numpy("float64")
        w, scale = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-6)
        w[-1] = -1.0 if not len(ys) else 0.0
        for _ in range(STEPS):
            for lo in range(0, len(ys), BATCH):
                part = [np.append(x, 1 << BITS) for x in xs[lo:lo + BATCH]]
                who = np.repeat(np.arange(len(part)), [len(x) for x in part])
                at = np.concatenate(part)
                many = ns[lo:lo + BATCH]
                wrong = (_sigmoid(np.bincount(who, w[at], len(part))) - ys[lo:lo + BATCH]) * many / many.sum()
                touched, back = np.unique(at, return_inverse=True)
                g = np.bincount(back, wrong[who]) + 1e-6 * w[touched]
                scale[touched] += g * g  # AdaGrad: a rate per coordinate
                w[touched] -= 0.2 * g / np.sqrt(scale[touched])
        yield pd.DataFrame({"w": [w.tobytes()]})

    made = chosen.mapInPandas(hashed, "at array<int>, block int, n long, turn long").coalesce(1).mapInPandas(train, "w binary").collect()
    return np.frombuffer(made[0]["w"]) if made else np.append(np.zeros(1 << BITS), -1.0)


def predicted(parts: DataFrame, weights: np.ndarray) -> DataFrame:
    """parts (with host and path) and block_score."""
    shared = parts.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = shared.value
        for hosts, paths in batches:
            yield pd.Series([float(_sigmoid(w[grams(h, p)].sum() + w[-1])) for h, p in zip(hosts, paths)], dtype="float64")

    return parts.withColumn("block_score", score("host", "path"))


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score. Without a table of labelled urls the rules label the urls they fit."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    says = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    if labelled is None:
        labelled = parts.where("rule is not null").select("host", "path", (F.element_at(says, F.col("rule")) == "block").cast("int").alias("block"))
    out = predicted(parts, fit(labelled))
    return out.select("page_id", "host", "path", "rule", F.coalesce(F.element_at(says, F.col("rule")), F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "block_score")
