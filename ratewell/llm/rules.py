"""Quality rules: a decision list learned by sequential covering, all in DataFrame functions.

`doc_stats` computes per document the counted signals of the base and the ratios the rules may use. `learn` grows one
conjunction of thresholds after another on two thirds of the labelled rows, prunes it on the rest, and stops when no
rule is precise enough; the list becomes one ordered conditional expression. Every step of the search is one grouping of
the labelled rows by feature and bin, so a few hundred rows reach the driver, whatever the number of documents.

Null or empty text: no words, all counts 0, base_failed. Null ids are kept and never matched to a label. Repeated rows
give repeated results. Ties between thresholds go to the feature that comes first and the smaller threshold. No label
rows, or labels of one kind only: an empty list, which keeps what the base keeps. Very long texts are counted whole. No
documents: no rows. Only doc_id, text and labels are read; keep_good keeps whole rows in a column of their own, so names can't
clash."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored, wrapped

SPACE = r"[ \t-\r]+"
WINDOW = 5
FEATURES = ("mean_word", "symbol_share", "upper_share", "digit_share", "bang_share", "bar_share", "dup_line_share", "repeat_share")


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    value: float

    def column(self) -> Column:
        return F.col(self.feature) >= self.value if self.at_least else F.col(self.feature) < self.value


Rule = tuple[Literal, ...]


def _repeated(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more, each counted once."""
    n = F.size(words)
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def twice(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        at = let(ordered, lambda s: F.transform(F.filter(F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), ((x["g"] == F.get(s, j + 1)["g"]) | ((j > 0) & (x["g"] == F.get(s, F.greatest(j - 1, F.lit(0)))["g"]))).alias("hit"))), lambda x: x["hit"]), lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(F.sort_array(at), start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])

    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), twice(g)).otherwise(F.lit(0)))


def _stats(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    words = F.array_remove(F.split(text, SPACE), "")
    marks = F.regexp_replace(text, r"[a-z \x{80}-\x{10FFFF}]+", "")  # few ranges: a long negated class is slow
    without = lambda m, kinds: F.length(m) - F.length(F.regexp_replace(m, kinds, ""))
    return F.struct(
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).cast("long").alias("repeated"))).alias("w"),
        let(lines, lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))).alias("l"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("chars"),
        let(marks, lambda m: F.struct(without(m, r"[#*$%&|<>]+").cast("long").alias("symbols"), without(m, "[A-Z]+").alias("upper"), without(m, "[0-9]+").alias("digits"), without(m, "!+").alias("bangs"), without(m, r"\|+").alias("bars"))).alias("m"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def doc_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, the counts of the base and the learned rules' features, one row per row."""
    chars, n = F.col("s.chars"), F.col("s.w.n")
    return docs.select(*keep, _stats(F.coalesce(F.col("text"), F.lit(""))).alias("s")).select(
        *keep, n.alias("n_words"), chars.alias("word_chars"), F.col("s.m.symbols").alias("n_symbols"), F.col("s.l.dup").alias("n_dup_lines"), F.col("s.w.repeated").alias("n_repeat_words"),
        _share(chars, n).alias("mean_word"), _share(F.col("s.m.symbols"), chars).alias("symbol_share"), _share(F.col("s.m.upper"), chars).alias("upper_share"),
        _share(F.col("s.m.digits"), chars).alias("digit_share"), _share(F.col("s.m.bangs"), n).alias("bang_share"), _share(F.col("s.m.bars"), n).alias("bar_share"),
        _share(F.col("s.l.dup"), F.col("s.l.n")).alias("dup_line_share"), _share(F.col("s.w.repeated"), n).alias("repeat_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _conjunction(rule: Rule) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column()
    return out


def _counts(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Per feature and bin, the good and the bad rows: bin k holds values from threshold k-1 up to threshold k."""
    bins = F.array(*[F.struct(F.lit(f).alias("f"), sum(((F.col(f) >= v).cast("int") for v in vs), F.lit(0)).alias("b")) for f, vs in thresholds.items()])
    out = {f: [[0, 0] for _ in range(len(vs) + 1)] for f, vs in thresholds.items()}
    for r in rows.select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.b").agg(F.sum(1 - F.col("bad")).alias("good"), F.sum("bad").alias("bad")).collect():
        out[r["f"]][r["b"]] = [r["good"], r["bad"]]
    return out


def _best_literal(counts, thresholds, good: int, bad: int) -> Literal | None:
    """The threshold with the highest information gain of covering sequentially (FOIL's measure)."""
    before = math.log2(bad / (good + bad))
    best, gain = None, 0.0
    for f, values in thresholds.items():
        for k, v in enumerate(values):
            above = [sum(c[i] for c in counts[f][k + 1:]) for i in (0, 1)]
            for at_least, (g, b) in ((True, above), (False, (good - above[0], bad - above[1]))):
                if b and b * (math.log2(b / (g + b)) - before) > gain * (1 + 1e-12):
                    best, gain = Literal(f, at_least, v), b * (math.log2(b / (g + b)) - before)
    return best


def _tally(rows: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """Good and bad rows under each of the rules, in one pass."""
    sums = [F.sum(F.when(_conjunction(r), kind).otherwise(0)).alias(f"{name}{k}") for k, r in enumerate(rules) for name, kind in (("good", 1 - F.col("bad")), ("bad", F.col("bad")))]
    got = rows.agg(*sums).first()
    return [(got[f"good{k}"] or 0, got[f"bad{k}"] or 0) for k in range(len(rules))]


def learn(labelled: DataFrame, bins: int = 32, max_rules: int = 8, max_literals: int = 3, precision: float = 0.97, support: int = 8) -> list[Rule]:
    """The decision list from rows of (fold, bad 0 or 1, features); fold 0 prunes, the other folds grow."""
    grow, prune = labelled.where("fold > 0"), labelled.where("fold = 0")
    edges = grow.agg(*[F.percentile_approx(f, [k / bins for k in range(1, bins)] + [0.985, 0.99, 0.995], 10_000).alias(f) for f in FEATURES]).first()
    thresholds = {f: sorted(set(edges[f])) for f in FEATURES if edges[f]}
    rules: list[Rule] = []
    while thresholds and len(rules) < max_rules:
        rest, rule = grow, ()
        for r in rules:
            rest = rest.where(~_conjunction(r))
        while len(rule) < max_literals:
            counts = _counts(rest.where(_conjunction(rule)), thresholds)
            good, bad = (sum(c[i] for c in next(iter(counts.values()))) for i in (0, 1))
            if bad < support or good == 0 or not (literal := _best_literal(counts, thresholds, good, bad)):
                break
            rule += (literal,)
        if not rule:
            break
        held = prune
        for r in rules:
            held = held.where(~_conjunction(r))
        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        seen, fit = _tally(held, shorter), _tally(rest, shorter)
        # A prefix is kept if it is precise on both parts; of these the one that covers most, then the shortest.
        fine = [k for k in range(len(shorter)) if fit[k][1] >= support and fit[k][1] >= precision * sum(fit[k]) and seen[k][1] >= precision * sum(seen[k])]
        if not fine:
            break
        rules.append(shorter[max(fine, key=lambda k: (seen[k][1] + fit[k][1], -k))])
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that fires, as one ordered conditional expression; 0 where none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(_conjunction(rule), k) if out is None else out.when(_conjunction(rule), k)
    return F.lit(0) if out is None else out.otherwise(0)


def with_labels(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that the base keeps and that have a label. Of contradicting labels the lower counts."""
    per_doc = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    return stats.where(~base_failed()).join(per_doc, "doc_id").select("bad", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("fold"), *FEATURES)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the number of the rule that rejects (0: none)."""
    stats = stored(doc_stats(docs, "doc_id"), "quality-stats")
    rules = learn(stored(with_labels(stats, labels), "quality-labelled"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & (verdict(rules) == 0)).alias("kept"), verdict(rules).alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base and the learned list keep, with their own columns."""
    stats = doc_stats(wrapped(docs, "doc_id", "text"), "doc_id", "row")
    rules = learn(stored(with_labels(doc_stats(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi"), "doc_id"), labels), "quality-labelled"))
    return stats.where(~base_failed() & (verdict(rules) == 0)).select("row.*")
