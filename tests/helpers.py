from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from ratewell.schemas import CORE_META, STAGE_LONG

D = date.fromisoformat


def stage(spark, rows, hash_id="h"):
    """(rate_date, currency, rate[, hash_id]) rows as a stage frame."""
    return spark.createDataFrame(
        [(D(r[0]), r[1], None if r[2] is None else Decimal(str(r[2])), r[3] if len(r) > 3 else hash_id) for r in rows],
        STAGE_LONG,
    )


def meta(spark, rows, required=("USD", "GBP"), hash_id="h"):
    """(rate_date, {code: rate}, overrides) rows as a meta frame."""
    made = []
    for row in rows:
        day, rates, changes = row[0], row[1], row[2] if len(row) > 2 else {}
        pairs = None if rates is None else [(c, Decimal(str(r))) for c, r in sorted(rates.items())]
        made.append((
            D(day), "scheduled", changes.get("hash_id", hash_id),
            changes.get("row_count", len(rates or {})), changes.get("currency_count", len(rates or {})),
            pairs, list(changes.get("required", required)), datetime(2026, 1, 1),
        ))
    return spark.createDataFrame(made, CORE_META)


def tuples(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=lambda t: [str(x) for x in t])
