"""Quality gates. A gate is a frame of check results or of offenders; enforce() raises on any FAIL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.cleaning import is_series_code
from ratewell.functions.numeric import drift
from ratewell.operators.reconcile import missing_by_day, required_jumps, with_baseline
from ratewell.params import Params


class GateFailed(RuntimeError):
    """A check reported FAIL."""


def _status(failed: Column) -> Column:
    return F.when(failed, "FAIL").otherwise("PASS").alias("status")


def enforce(results: DataFrame, shown: int = 20) -> None:
    """Raise if a result has status FAIL, naming the first `shown` of them. A top-k over one column takes one
    job, where a bare limit would look at ever more partitions in turn."""
    failed = results.where(F.col("status") == "FAIL").orderBy(results.columns[0]).limit(shown).collect()
    if failed:
        raise GateFailed("; ".join(str(row.asDict()) for row in failed))


# --- stage candidate -------------------------------------------------------------------------------------

def stage_gates(
    candidate: DataFrame, hash_id: str | None = None, keys: Sequence[str] = ("rate_date", "currency")
) -> DataFrame:
    """Five checks as rows (check, status, observed): observed counts the rows for the first two checks, the
    offenders for the others. One scan and one shuffle: rows are counted per key, then the keys are summed."""
    owned = F.lit(True) if hash_id is None else F.col("hash_id") == hash_id
    per_key = candidate.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(owned).alias("_owned"),
        F.count_if(owned & ~is_series_code(F.col("currency"))).alias("_bad_code"),
        F.count_if(owned & (F.col("rate") <= 0)).alias("_bad_rate"),
    )
    totals = per_key.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_rows", "_owned", "_bad_code", "_bad_rate")
        ],
        F.count_if(F.col("_owned") > 1).alias("_copies"),
    )

    def check(name: str, column: str, failed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), _status(failed), F.col(column).alias("observed"))

    checks = F.array(
        check("not_empty", "_rows", F.col("_rows") == 0),
        check("holds_snapshot", "_owned", F.col("_owned") == 0),
        check("series_format", "_bad_code", F.col("_bad_code") > 0),
        check("positive_rate", "_bad_rate", F.col("_bad_rate") > 0),
        check("unique_key", "_copies", F.col("_copies") > 0),
    )
    return totals.select(F.inline(checks))


def required_gate(
    stage: DataFrame, required: Sequence[str], days: Sequence[str] = ("rate_date",)
) -> DataFrame:
    """(day columns, check, status, missing): FAIL for a day that lacks a required code."""
    return missing_by_day(stage, required, days).select(
        *days, F.lit("required").alias("check"), _status(F.size("missing") > 0), "missing"
    )


# --- loaded days -----------------------------------------------------------------------------------------

def quality_gate(
    meta: DataFrame, days: DataFrame, params: Params, expected_hash: str | Column | None = None
) -> DataFrame:
    """One row per day of `days` (rate_date, expected): the first rule that decides it, in this order: day not
    expected, meta row missing, other snapshot, no baseline, baseline gone, baseline empty, row drift, baseline
    without series, series drift, no rates, required code missing, jump of a required code. Limits are
    exceeded strictly and compared in double. All jumps above the limit are listed, ordered by code."""
    loaded = with_baseline(meta).withColumn("_found", F.lit(True))
    day = days.join(loaded, "rate_date", "left")
    rows = drift(F.col("base_row_count"), F.col("row_count"))
    series = drift(F.col("base_currency_count"), F.col("currency_count"))
    required = F.coalesce(F.col("required_curr"), F.array().cast("array<string>"))
    absent = F.array_sort(
        F.array_except(required, F.transform("rates", lambda pair: pair["currency"]))
    )
    if expected_hash is None:
        other = F.lit(False)
    else:
        wanted = F.lit(expected_hash) if isinstance(expected_hash, str) else expected_hash
        other = ~F.col("hash_id").eqNullSafe(wanted)
    measured = day.withColumns({
        "_rows": rows,
        "_series": series,
        "_absent": absent,
        "_jumps": F.filter(
            required_jumps(F.col("rates"), F.col("base_rates"), required),
            lambda j: j["jump"] > F.lit(params.rate_jump),
        ),
        "_other": other,
    })
    empty = (F.coalesce(F.size("rates"), F.lit(0)) <= 0) | (F.coalesce(F.size("base_rates"), F.lit(0)) <= 0)
    rules = [
        ("not_expected", ~F.col("expected")),
        ("meta_missing", F.col("_found").isNull()),
        ("other_snapshot", F.col("_other")),
        ("no_baseline", F.col("baseline_date").isNull()),
        ("baseline_missing", F.col("base_found").isNull()),
        ("baseline_empty", F.col("base_row_count") <= 0),
        ("row_drift", F.col("_rows") > F.lit(params.row_drift)),
        ("baseline_no_series", F.col("base_currency_count") <= 0),
        ("series_drift", F.col("_series") > F.lit(params.series_drift)),
        ("no_rates", empty),
        ("required_missing", F.size("_absent") > 0),
        ("rate_jump", F.size("_jumps") > 0),
    ]
    check = F.lit("ok")
    for name, hit in reversed(rules):
        check = F.when(hit, name).otherwise(check)
    outcome = F.col("check")
    return measured.withColumn("check", check).select(
        "rate_date",
        F.when(outcome == "not_expected", "SKIP")
        .when(outcome.isin("no_baseline", "ok"), "PASS")
        .otherwise("FAIL")
        .alias("status"),
        "check",
        "baseline_date",
        F.when(outcome == "row_drift", F.col("_rows"))
        .when(outcome == "series_drift", F.col("_series"))
        .when(outcome == "rate_jump", F.array_max(F.transform("_jumps", lambda j: j["jump"])))
        .alias("observed"),
        F.when(outcome == "row_drift", F.lit(params.row_drift))
        .when(outcome == "series_drift", F.lit(params.series_drift))
        .when(outcome == "rate_jump", F.lit(params.rate_jump))
        .cast("double")
        .alias("threshold"),
        F.when(outcome == "required_missing", F.col("_absent")).alias("missing"),
        F.when(outcome == "rate_jump", F.col("_jumps")).alias("jumps"),
    )


# --- log and stored files --------------------------------------------------------------------------------

def log_gate(
    wanted: DataFrame, log: DataFrame, required: Sequence[str], expected: Sequence[str] = ()
) -> DataFrame:
    """One row per wanted hash_id: FAIL if the log has no row for it, a required field is NULL or empty, or a
    field of `expected` differs from the column of that name in `wanted`."""
    logged = log.select(
        F.col("hash_id"), F.lit(True).alias("_logged"), *[
            F.col(c).alias(f"_log_{c}") for c in dict.fromkeys([*required, *expected])
        ],
    )
    joined = wanted.join(logged, "hash_id", "left")
    check = F.when(F.col("_logged").isNull(), "row_missing")
    for name in required:
        value = F.col(f"_log_{name}")
        check = check.when(value.isNull() | (value.cast("string") == ""), f"{name}_missing")
    for name in expected:
        check = check.when(~F.col(f"_log_{name}").eqNullSafe(F.col(name)), f"{name}_differs")
    return joined.select("hash_id", check.otherwise("ok").alias("check")).select(
        "hash_id", "check", _status(F.col("check") != "ok")
    )


def snapshot_audit(
    log: DataFrame, files: DataFrame, path: str = "gcs_zip_uri", size: str = "zip_size"
) -> DataFrame:
    """One row per logged snapshot with a path: the file must exist, have the logged size and, where `files`
    has a hash_id recomputed from its bytes, hash to the logged id."""
    recomputed = F.col("hash_id") if "hash_id" in files.columns else F.lit(None).cast("string")
    stored = files.select(
        F.col("path").alias("_path"), F.col("size").alias("_size"), recomputed.alias("_hash")
    )
    # An empty path names no file: such rows are spread by their hash, under names that no path has.
    named = F.when(F.col(path) == "", F.concat(F.lit("\u0000"), F.col("hash_id"))).otherwise(F.col(path))
    checked = log.where(F.col(path).isNotNull()).withColumn("_named", named).join(stored, F.col("_named") == F.col("_path"), "left")
    check = F.when(F.col("_path").isNull(), "file_missing").when(
        ~F.col("_size").eqNullSafe(F.col(size)), "size_differs"
    )
    if "hash_id" in files.columns:
        check = check.when(~F.col("_hash").eqNullSafe(F.col("hash_id")), "hash_differs")
    return checked.select("hash_id", check.otherwise("ok").alias("check")).select(
        "hash_id", "check", _status(F.col("check") != "ok")
    )


# --- declared table tests --------------------------------------------------------------------------------

@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def label(self) -> str:
        return f"not_null({self.column})"

    def offends(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedRange:
    """Bounds of a column; NULL passes, as it has its own test."""

    column: str
    low: float | int | None = None
    high: float | int | None = None
    inclusive: bool = True

    @property
    def label(self) -> str:
        return f"accepted_range({self.column})"

    def offends(self) -> Column:
        value, outside = F.col(self.column), F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low if self.inclusive else value <= self.low)
        if self.high is not None:
            outside = outside | (value > self.high if self.inclusive else value >= self.high)
        return outside


@dataclass(frozen=True)
class ExpressionIsTrue:
    expression: str

    @property
    def label(self) -> str:
        return f"expression_is_true({self.expression})"

    def offends(self) -> Column:
        return ~F.expr(self.expression)


@dataclass(frozen=True)
class Unique:
    """No two rows agree on the columns."""

    columns: tuple[str, ...]
    combination: bool = True

    @property
    def label(self) -> str:
        return f"{'unique_combination' if self.combination else 'unique'}({', '.join(self.columns)})"

    def rows(self, df: DataFrame) -> DataFrame:
        return df if self.combination else df.where(F.col(self.columns[0]).isNotNull())

    def copies(self) -> Column:
        """Over a frame of one counted row per key: the keys held by more than one row."""
        held = F.col("_n") > 1
        return F.count_if(held if self.combination else held & F.col(self.columns[0]).isNotNull())


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a NULL in one of the columns."""
    offends = F.lit(False)
    for c in columns:
        offends = offends | F.col(c).isNull()
    return df.where(offends)


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    return df.where(AcceptedRange(column, low, high, inclusive).offends())


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.where(ExpressionIsTrue(expression).offends())


def table_tests(df: DataFrame, tests: Sequence, model: str) -> DataFrame:
    """(model, test, status, failures) for all tests of one table. Row tests are counted per key of the first
    uniqueness test and summed, so a table with one key is scanned and shuffled once."""
    uniques = [t for t in tests if isinstance(t, Unique)]
    row_tests = [t for t in tests if not isinstance(t, Unique)]
    counts = [F.count_if(t.offends()).alias(f"_t{i}") for i, t in enumerate(row_tests)]
    sums = [F.coalesce(F.sum(f"_t{i}"), F.lit(0)).alias(f"_t{i}") for i in range(len(row_tests))]

    def rows(totals: DataFrame, named: Sequence[tuple[str, str]]) -> DataFrame:
        return totals.select(
            F.inline(
                F.array(*[
                    F.struct(
                        F.lit(model).alias("model"),
                        F.lit(label).alias("test"),
                        _status(F.col(column) > 0),
                        F.col(column).cast("long").alias("failures"),
                    )
                    for label, column in named
                ])
            )
        )

    labels = [(t.label, f"_t{i}") for i, t in enumerate(row_tests)]
    if not uniques:
        return rows(df.agg(*counts), labels)
    first, others = uniques[0], uniques[1:]
    per_key = df.groupBy(*first.columns).agg(F.count(F.lit(1)).alias("_n"), *counts)
    result = rows(
        per_key.agg(first.copies().alias("_copies"), *sums), [(first.label, "_copies"), *labels]
    )
    for other in others:
        copies = unique_combination(other.rows(df), other.columns).agg(F.count(F.lit(1)).alias("_copies"))
        result = result.unionByName(rows(copies, [(other.label, "_copies")]))
    return result


def data_tests(tables: Mapping[str, DataFrame], tests: Mapping[str, Sequence]) -> DataFrame:
    """All declared tests of all given tables, one row per test."""
    result = None
    for model, df in tables.items():
        part = table_tests(df, tests[model], model)
        result = part if result is None else result.unionByName(part)
    if result is None:
        raise ValueError("no tables given")
    return result
