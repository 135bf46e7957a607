"""Independent SQL for the registered queries. Rates are whole hundredths, so quotients and means at nine
places are computed exactly in integers, rounded half up as NUMERIC does."""

from __future__ import annotations

from ratewell.plans.marts import model_tests
from ratewell.plans.registry import GATE_PARAMS, GATED_YEAR
from ratewell.plans.views import AS_OF, LINE_CODES, PAIR_CODES, PARAMS, SNAPSHOT, START

NANO = "1000000000"


def quotient(a: str, b: str) -> str:
    """a / b in units of 1e-9 for integers a >= 0 and b > 0, rounded half up."""
    return f"((2 * ({a})::hugeint * {NANO} + ({b})::hugeint) // (2 * ({b})::hugeint))"


def mean(total: str, n: str, scale: int) -> str:
    """total / n times scale for integers total >= 0 and n > 0, rounded half up."""
    return f"((2 * ({total})::hugeint * {scale} + ({n})::hugeint) // (2 * ({n})::hugeint))"


def nano(units: str) -> str:
    return f"(({units})::double / 1e9)"


def money(cents: str) -> str:
    return f"(({cents})::double / 100)"


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_PAIRS = " ".join(f"WHEN '{pair}' THEN '{code}'" for pair, code in PAIR_CODES.items())

RATES = f"""rates AS (
  SELECT CAST(l_shipdate AS DATE) AS rate_date,
         CASE l_returnflag || l_linestatus {_PAIRS} END AS currency,
         CAST(round(max(l_extendedprice) * 100) AS BIGINT) AS cents
  FROM lineitem GROUP BY ALL)"""


def series(key: str, table: str = "lineitem", day: str = "l_shipdate", value: str = "l_extendedprice") -> str:
    return f"""rates AS (
  SELECT CAST({day} AS DATE) AS rate_date, {key} AS series, CAST(round(max({value}) * 100) AS BIGINT) AS cents
  FROM {table} GROUP BY ALL)"""


STG = RATES + f""", stg AS (
  SELECT * FROM rates WHERE rate_date >= DATE '{START}' AND currency IN ({listed(PARAMS.listed)}))"""

LARGE_STG = STG.replace("rates AS (", "small AS (", 1).replace("stg AS (", """rates AS (
  SELECT rate_date, currency, cents * CAST(10 ** (6 + day(rate_date) % 3) AS BIGINT) AS cents FROM small), stg AS (""")

CHANGES = f"""changes AS (
  SELECT *, {quotient('cents', 'prev')} - {NANO} AS change FROM (
    SELECT *, lag(cents) OVER (PARTITION BY {{key}} ORDER BY rate_date) AS prev FROM {{source}})
  WHERE prev IS NOT NULL)"""


def pct_change_sql(head: str, source: str, key: str) -> str:
    return f"""WITH {head}, {CHANGES.format(source=source, key=key)}
SELECT rate_date, {key}, {money('cents')} AS rate, {money('prev')} AS prev_rate, {nano('change')} AS pct_change
FROM changes"""


def rolling_sql(head: str, source: str, key: str) -> str:
    parts, names = [], []
    for n in (7, 30):
        parts.append(
            f"min(rate_date) OVER w{n} AS d{n}, min(cents) OVER w{n} AS lo{n}, max(cents) OVER w{n} AS hi{n}, "
            f"sum(cents) OVER w{n} AS s{n}, count(*) OVER w{n} AS n{n}"
        )
        names.append(
            f"d{n} AS window_start_date_{n}d, {money(f'lo{n}')} AS rate_min_{n}d, {money(f'hi{n}')} AS rate_max_{n}d, "
            f"{nano(mean(f's{n}', f'n{n}', 10_000_000))} AS rate_avg_{n}d, "
            f"{nano(quotient(f'hi{n} - lo{n}', f'lo{n}'))} AS range_pct_{n}d"
        )
    windows = ", ".join(
        f"w{n} AS (PARTITION BY {key} ORDER BY rate_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (7, 30)
    )
    return f"""WITH {head}, framed AS (SELECT *, {', '.join(parts)} FROM {source} WINDOW {windows})
SELECT rate_date, {key}, {money('cents')} AS rate, {', '.join(names)} FROM framed"""


_OTHERS = [c for c in PARAMS.listed if c != PARAMS.base]
_WIDE = ", wide AS (SELECT rate_date, 100 AS eur, " + ", ".join(
    f"max(CASE WHEN currency = '{c}' THEN cents END) AS {c.lower()}" for c in _OTHERS
) + " FROM stg GROUP BY rate_date)"
WIDE, LARGE_WIDE = STG + _WIDE, LARGE_STG + _WIDE

_WIDE_NAMES = [c.lower() for c in PARAMS.listed]


def _base_block(base: str) -> str:
    if base == PARAMS.base:
        cells = ", ".join(f"{money(c)} AS rate_{c}" for c in _WIDE_NAMES)
    else:
        cells = ", ".join(f"{nano(quotient(c, base.lower()))} AS rate_{c}" for c in _WIDE_NAMES)
    return f"SELECT rate_date, '{base}' AS base_currency, {cells} FROM wide"


DAILY = " UNION ALL ".join(_base_block(b) for b in PARAMS.bases)

QUALITY = f"""calendar AS (
  SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE) AS rate_date),
day_stats AS (
  SELECT rate_date, count(*) AS row_count, count(DISTINCT currency) AS currency_count FROM stg GROUP BY 1),
change_stats AS (
  SELECT rate_date, {mean('sum(abs(change))', 'count(*)', 1)} AS mean_change, max(abs(change)) AS max_change
  FROM changes GROUP BY 1),
quality AS (
  SELECT c.rate_date, dayofweek(c.rate_date) BETWEEN 1 AND 5 AS data_expected,
         coalesce(row_count, 0) AS row_count, coalesce(currency_count, 0) AS currency_count,
         CASE WHEN dayofweek(c.rate_date) BETWEEN 1 AND 5 THEN {PARAMS.expected_series}::bigint ELSE 0 END
           AS expected_currency_count, mean_change, max_change
  FROM calendar c LEFT JOIN day_stats USING (rate_date) LEFT JOIN change_stats USING (rate_date))"""

QUALITY_HEAD = f"{STG}, {CHANGES.format(source='stg', key='currency')}, {QUALITY}"


def _copies(table: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1))"


def data_tests_sql() -> str:
    """One row per declared test; the failures of row tests are written out by hand per table."""
    framed = "framed AS (SELECT * FROM stg)"
    head = (
        f"{WIDE}, {CHANGES.format(source='stg', key='currency')}, {QUALITY}, "
        f"daily AS ({DAILY}), {framed}"
    )
    source = {
        "stg_rates": "stg", "stg_rates_wide": "wide", "mart_daily": "daily", "mart_pct_change": "changes",
        "mart_quality_daily": "quality", "mart_rolling_stats": "framed",
    }
    column = {"rate": "cents", "pct_change": "change"}
    wide_tables = ("wide",)
    rows = []
    for model, tests in model_tests(PARAMS).items():
        table = source[model]
        for test in tests:
            label = test.label.replace("'", "''")
            kind = type(test).__name__
            if kind == "Unique":
                failures = _copies(table, ", ".join(test.columns))
            elif kind == "NotNull":
                name = test.column
                if table in wide_tables:
                    name = name.removeprefix("rate_") if name != "rate_date" else name
                failures = f"(SELECT count(*) FROM {table} WHERE {column.get(name, name)} IS NULL)"
            elif kind == "ExpressionIsTrue":
                failures = f"(SELECT count(*) FROM {table} WHERE NOT (eur > 0 AND usd > 0 AND gbp > 0))"
            elif test.column == "rate":
                failures = f"(SELECT count(*) FROM {table} WHERE cents <= 0)"
            else:
                failures = f"(SELECT count(*) FROM {table} WHERE change <= -2 * {NANO} OR change >= 2 * {NANO})"
            rows.append(f"SELECT '{model}' AS model, '{label}' AS test, {failures} AS failures")
    return f"""WITH {head}, counted AS ({' UNION ALL '.join(rows)})
SELECT model, test, CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS status, failures FROM counted"""


# --- provider text ---------------------------------------------------------------------------------------

_TEXT = "CAST(CAST(cents AS DECIMAL(18, 2)) / 100 AS DECIMAL(18, 2))::varchar"
BLANKS = "' ' || chr(9) || chr(160)"

DIRTY = RATES + f""", copied AS (
  SELECT *, day(rate_date) AS d, unnest(CASE WHEN day(rate_date) IN (18, 19) THEN [0, 1] ELSE [0] END) AS copy
  FROM rates),
money AS (
  SELECT *, (cents // 100)::varchar || '.' || lpad((cents % 100)::varchar, 2, '0') AS txt,
         (cents // 100 + copy)::varchar || '.' || lpad((cents % 100)::varchar, 2, '0') AS second
  FROM copied),
dirty AS (
  SELECT CASE d WHEN 10 THEN strftime(rate_date, '%Y-%m')
                WHEN 11 THEN year(rate_date)::varchar || '-' || month(rate_date)::varchar || '-' || d::varchar
                WHEN 12 THEN strftime(rate_date, '%Y-%m-%d') || ' 10:00'
                ELSE strftime(rate_date, '%Y-%m-%d') END AS date_str,
         CASE d WHEN 13 THEN ' ' || lower(currency) || ' '
                WHEN 14 THEN chr(9) || currency || chr(160) ELSE currency END AS currency,
         CASE d WHEN 3 THEN '' WHEN 4 THEN 'N/A' WHEN 5 THEN ' N/A ' WHEN 6 THEN 'abc' WHEN 7 THEN 'n/a'
                WHEN 8 THEN '  ' || txt || chr(9) WHEN 9 THEN txt || '12345675' WHEN 15 THEN NULL
                WHEN 16 THEN '0' WHEN 17 THEN '-' || txt WHEN 19 THEN second ELSE txt END AS rate_str
  FROM money),
typed AS (
  SELECT CASE WHEN regexp_full_match(date_str, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast(date_str AS DATE) END
           AS rate_date,
         upper(trim(currency, {BLANKS})) AS currency,
         try_cast(nullif(nullif(trim(rate_str, {BLANKS}), ''), 'N/A') AS DECIMAL(38, 9)) AS rate
  FROM dirty),
clean AS (
  SELECT DISTINCT rate_date, currency, rate FROM typed
  WHERE rate_date IS NOT NULL AND currency <> '' AND rate IS NOT NULL)"""

# --- days ------------------------------------------------------------------------------------------------

_TXT = "(cents // 100)::varchar || '.' || lpad((cents % 100)::varchar, 2, '0')"

META = RATES + f""", meta AS (
  SELECT rate_date, count(*) AS row_count, count(DISTINCT currency) AS currency_count,
         string_agg(currency || '=' || {_TXT}, ',' ORDER BY currency) AS rates
  FROM rates GROUP BY 1),
based AS (
  SELECT *, lag(rate_date) OVER (ORDER BY rate_date) AS baseline_date,
         lag(row_count) OVER (ORDER BY rate_date) AS base_row_count,
         lag(currency_count) OVER (ORDER BY rate_date) AS base_currency_count
  FROM meta),
jumps AS (
  SELECT b.rate_date, b.baseline_date, n.currency, o.cents AS old, n.cents AS new,
         abs(({money('n.cents')} / {money('o.cents')}) - 1.0) AS jump
  FROM based b JOIN rates n ON n.rate_date = b.rate_date
  JOIN rates o ON o.rate_date = b.baseline_date AND o.currency = n.currency
  WHERE n.currency IN ({listed(PARAMS.required)}))"""

# The meta rows with some days spoilt: no rows on the 5th, no series on the 9th, no rates on the 13th, another snapshot on the 3rd.
SPOILT_META = META.replace("meta AS (", "whole AS (", 1).replace("based AS (", """meta AS (
  SELECT rate_date, CASE WHEN day(rate_date) = 5 THEN 0 ELSE row_count END AS row_count,
         CASE WHEN day(rate_date) = 9 THEN 0 ELSE currency_count END AS currency_count, rates FROM whole),
based AS (""", 1)

_CODES = ", ".join(f"('{c}')" for c in PARAMS.required)

SPAN = f"""span AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)),
         INTERVAL 1 DAY)) AS DATE) AS rate_date FROM lineitem),
days AS (
  SELECT rate_date, dayofweek(rate_date) BETWEEN 1 AND 5 AND strftime(rate_date, '%Y-%m-%d')
         NOT IN ({listed(GATE_PARAMS.holidays)}) AS expected FROM span)"""

GATE = f"""WITH {META}, {SPAN},
absent AS (
  SELECT m.rate_date, string_agg(code, ',' ORDER BY code) AS missing
  FROM meta m, (VALUES {_CODES}) AS r(code)
  WHERE NOT EXISTS (SELECT 1 FROM rates t WHERE t.rate_date = m.rate_date AND t.currency = code)
  GROUP BY 1),
high AS (
  SELECT rate_date, string_agg(currency, ',' ORDER BY currency) AS jumps, max(jump) AS jump
  FROM jumps WHERE jump > {GATE_PARAMS.rate_jump} GROUP BY 1),
measured AS (
  SELECT d.rate_date, d.expected, b.rate_date AS found, b.baseline_date,
         abs(base_row_count - row_count)::double / base_row_count AS rows_drift,
         abs(base_currency_count - currency_count)::double / base_currency_count AS series_drift,
         missing, jumps, jump
  FROM days d LEFT JOIN based b USING (rate_date) LEFT JOIN absent USING (rate_date)
  LEFT JOIN high USING (rate_date)),
decided AS (
  SELECT *, CASE WHEN NOT expected THEN 'not_expected' WHEN found IS NULL THEN 'meta_missing'
                 WHEN baseline_date IS NULL THEN 'no_baseline'
                 WHEN rows_drift > {GATE_PARAMS.row_drift} THEN 'row_drift'
                 WHEN series_drift > {GATE_PARAMS.series_drift} THEN 'series_drift'
                 WHEN missing IS NOT NULL THEN 'required_missing'
                 WHEN jumps IS NOT NULL THEN 'rate_jump' ELSE 'ok' END AS decision
  FROM measured)
SELECT rate_date,
       CASE WHEN decision = 'not_expected' THEN 'SKIP' WHEN decision IN ('ok', 'no_baseline') THEN 'PASS'
            ELSE 'FAIL' END AS status,
       decision AS "check", baseline_date,
       CASE decision WHEN 'row_drift' THEN rows_drift WHEN 'series_drift' THEN series_drift
                     WHEN 'rate_jump' THEN jump END AS observed,
       CASE decision WHEN 'row_drift' THEN {GATE_PARAMS.row_drift}::double
                     WHEN 'series_drift' THEN {GATE_PARAMS.series_drift}::double
                     WHEN 'rate_jump' THEN {GATE_PARAMS.rate_jump}::double END AS threshold,
       CASE WHEN decision = 'required_missing' THEN missing END AS missing,
       CASE WHEN decision = 'rate_jump' THEN jumps END AS jumps
FROM decided"""

SPOILT_GATE = GATE.replace(META, SPOILT_META)
for _rule, _after in (
    ("WHEN found IS NOT NULL AND day(rate_date) = 3 THEN 'other_snapshot'", "THEN 'meta_missing'"),
    ("WHEN base_row_count <= 0 THEN 'baseline_empty'", "THEN 'no_baseline'"),
    ("WHEN base_currency_count <= 0 THEN 'baseline_no_series'", "THEN 'row_drift'"),
    ("WHEN 13 IN (day(rate_date), day(baseline_date)) THEN 'no_rates'", "THEN 'series_drift'"),
):
    SPOILT_GATE = SPOILT_GATE.replace(_after, f"{_after}\n                 {_rule}", 1)
SPOILT_GATE = SPOILT_GATE.replace("AS found, b.baseline_date,", "AS found, b.baseline_date, base_row_count, base_currency_count,", 1)

# --- publications ----------------------------------------------------------------------------------------


def publications(key: str, value: str) -> str:
    def one(name: str, status: str) -> str:
        return f"""{name} AS (
  SELECT CAST(l_shipdate AS DATE) AS rate_date, {key} AS currency,
         CAST(round(max({value}) * 100) AS BIGINT) AS cents
  FROM lineitem WHERE l_linestatus = '{status}' GROUP BY ALL)"""

    return f"{one('loaded', 'F')}, {one('published', 'O')}"


LINES = publications("'LN' || chr(64 + l_linenumber)", "l_quantity")
_LINE_CODES = ", ".join(f"('{c}')" for c in LINE_CODES)


def diff(eps_cents: str) -> str:
    return f"""diff AS (
  SELECT * FROM (
    SELECT rate_date, currency, p.cents AS stage_cents, l.cents AS core_cents,
           CASE WHEN l.cents IS NULL THEN 'late_insert' WHEN p.cents IS NULL THEN 'core_extra'
                WHEN abs(p.cents - l.cents) > {eps_cents} THEN 'late_update' END AS diff_type
    FROM published p FULL JOIN loaded l USING (rate_date, currency))
  WHERE diff_type IS NOT NULL)"""


_SUMMARY = "SELECT diff_type, count(*) AS cnt FROM diff GROUP BY 1"

ABSENT_LINES = f"""both_sides AS (
  SELECT rate_date, currency, 'published' AS hash_id FROM published
  UNION ALL SELECT rate_date, currency, 'loaded' FROM loaded),
absent AS (
  SELECT d.rate_date, d.hash_id, code
  FROM (SELECT DISTINCT rate_date, hash_id FROM both_sides) d, (VALUES {_LINE_CODES}) AS r(code)
  WHERE NOT EXISTS (
    SELECT 1 FROM both_sides t WHERE t.rate_date = d.rate_date AND t.hash_id = d.hash_id AND t.currency = code))"""


def replaced(day_rule: str) -> str:
    """The loaded table with the published rows of the days that meet the rule in the place of its own."""
    return f"""days AS (SELECT DISTINCT rate_date FROM published WHERE {day_rule}),
core AS (
  SELECT rate_date, currency, cents, 'published' AS hash_id FROM published
  WHERE rate_date IN (SELECT rate_date FROM days)
  UNION ALL
  SELECT rate_date, currency, cents, 'loaded' FROM loaded
  WHERE rate_date NOT IN (SELECT rate_date FROM days))"""


# --- logs ------------------------------------------------------------------------------------------------

_HASH = "sha256({}::varchar)"

ORDER_LOG = f"""order_log AS (
  SELECT {_HASH.format('o_orderkey')} AS hash_id, 'zip/' || o_orderkey::varchar AS gcs_zip_uri,
         length(o_orderpriority) AS zip_size, CAST(o_orderdate AS DATE) AS ingested_at,
         CASE WHEN o_orderstatus <> 'O' THEN 'csv/' || o_orderkey::varchar END AS gcs_csv_uri,
         CASE WHEN o_orderstatus <> 'O' THEN 0 END AS csv_size,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS unpacked_at
  FROM orders)"""

LINE_LOG = f"""line_log AS (
  SELECT {_HASH.format('l_orderkey')} AS hash_id, count(*) AS zip_size,
         CASE WHEN max(l_returnflag) <> 'A' THEN 'zip/' || l_orderkey::varchar ELSE '' END AS gcs_zip_uri
  FROM lineitem GROUP BY l_orderkey)"""

_DECIDED = "SELECT hash_id, \"check\", CASE WHEN \"check\" = 'ok' THEN 'PASS' ELSE 'FAIL' END AS status FROM decided"


ORACLES: dict[str, str] = {
    "stg_rates": f"""WITH {STG} SELECT rate_date, CAST(date_trunc('month', rate_date) AS DATE) AS rate_month,
'{PARAMS.base}' AS base_currency, currency, {money('cents')} AS rate FROM stg""",
    "stg_rates_wide": f"WITH {WIDE} SELECT rate_date, "
    + ", ".join(f"{money(c)} AS rate_{c}" for c in _WIDE_NAMES) + " FROM wide",
    "mart_daily": f"WITH {WIDE} {DAILY}",
    "mart_daily_large": f"WITH {LARGE_WIDE} {DAILY}",
    "pct_change": pct_change_sql(STG, "stg", "currency"),
    "pct_change_large": pct_change_sql(LARGE_STG, "stg", "currency"),
    "rolling_stats": rolling_sql(STG, "stg", "currency"),
    "rolling_stats_blocked": rolling_sql(STG, "stg", "currency"),
    "rolling_by_supplier": rolling_sql(series("l_suppkey"), "rates", "series"),
    "pct_change_by_part": pct_change_sql(series("l_partkey"), "rates", "series"),
    "pct_change_by_part_blocked": pct_change_sql(series("l_partkey"), "rates", "series"),
    "event_rolling": rolling_sql(series("event_type", "events", "ts", "value"), "rates", "series"),
    "quality_daily": f"""WITH {QUALITY_HEAD}
SELECT rate_date, CASE WHEN data_expected THEN 'true' ELSE 'false' END AS data_expected, row_count, currency_count,
       expected_currency_count, {nano('mean_change')} AS avg_abs_pct_change, {nano('max_change')} AS max_abs_pct_change,
       CASE WHEN data_expected AND row_count = 0 THEN 'MISSING_DATA'
            WHEN data_expected AND currency_count < expected_currency_count THEN 'INCOMPLETE_DATA'
            WHEN max_change > {int(PARAMS.large_change * 10**9)} THEN 'LARGE_CHANGE' END AS alert
FROM quality""",
    "data_tests": data_tests_sql(),
    "unpivot_long": f"""WITH {RATES} SELECT strftime(rate_date, '%Y-%m-%d') AS date_str, currency, {_TXT} AS rate_str,
'{SNAPSHOT}' AS hash_id FROM rates""",
    "clean_long": f"WITH {DIRTY} SELECT rate_date, currency, rate::double AS rate, '{SNAPSHOT}' AS hash_id FROM clean",
    "duplicate_keys": f"""WITH {DIRTY} SELECT rate_date, currency, count(*) AS copies FROM clean
GROUP BY 1, 2 HAVING count(*) > 1""",
    "stage_gates": f"""WITH {DIRTY}, counts AS (
  SELECT count(*) AS n, count(*) FILTER (NOT regexp_full_match(currency, '[A-Z]{{3}}')) AS bad_code,
         count(*) FILTER (rate <= 0) AS bad_rate,
         (SELECT count(*) FROM (SELECT 1 FROM clean GROUP BY rate_date, currency HAVING count(*) > 1)) AS copies
  FROM clean),
listed AS (
  SELECT 'not_empty' AS "check", n = 0 AS failed, n AS observed FROM counts
  UNION ALL SELECT 'holds_snapshot', n = 0, n FROM counts
  UNION ALL SELECT 'series_format', bad_code > 0, bad_code FROM counts
  UNION ALL SELECT 'positive_rate', bad_rate > 0, bad_rate FROM counts
  UNION ALL SELECT 'unique_key', copies > 0, copies FROM counts)
SELECT "check", CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END AS status, observed FROM listed""",
    "replace_table": f"""WITH {RATES} SELECT rate_date, currency, {money('cents')} AS rate FROM rates WHERE currency <> 'AUD'""",
    "table_lookups": f"""WITH {RATES}, codes(code) AS (VALUES {_CODES}, ('none'))
SELECT code, (SELECT count(*) FROM rates) AS table_rows, (SELECT count(*) FROM rates WHERE currency = code) AS scanned,
       CASE WHEN code IN (SELECT currency FROM rates) THEN 'true' ELSE 'false' END AS there,
       CASE WHEN code IN (SELECT currency FROM rates WHERE rate_date = (SELECT min(rate_date) FROM rates))
            THEN 'true' ELSE 'false' END AS there_on_first_day
FROM codes""",
    "materialized_marts": f"WITH {WIDE} {DAILY}",
    "days_to_yesterday": f"""WITH {RATES}, days AS (
  SELECT CAST(unnest(generate_series(DATE '{START}', current_date - 1, INTERVAL 1 DAY)) AS DATE) AS rate_date)
SELECT rate_date, count(currency) AS row_count FROM days LEFT JOIN rates USING (rate_date) GROUP BY 1""",
    "run": f"""WITH {RATES}, last_year AS (SELECT max(year(rate_date)) AS y FROM rates),
full_days AS (
  SELECT rate_date FROM rates, last_year WHERE year(rate_date) = y GROUP BY 1 HAVING count(*) = {len(PARAMS.required)}),
ends AS (SELECT min(rate_date) AS first_day, max(rate_date) AS last_day FROM full_days)
SELECT rate_date, currency, {money('cents + 10000000')} AS rate,
       CASE WHEN rate_date = first_day THEN 'manual' WHEN rate_date = last_day THEN 'scheduled' ELSE 'backfill' END AS run_type
FROM rates JOIN full_days USING (rate_date), ends""",
    "stage_promote": f"""WITH {RATES} SELECT rate_date, currency, {money('cents')} AS rate, '{SNAPSHOT}' AS hash_id,
CAST(date_trunc('month', rate_date) AS DATE) AS rate_month FROM rates""",
    "day_meta": f"""WITH {META} SELECT rate_date, 'scheduled' AS run_type, '{SNAPSHOT}' AS hash_id, row_count,
currency_count, rates, '{",".join(PARAMS.required)}' AS required_curr FROM meta""",
    "missing_required": f"WITH {LINES}, {ABSENT_LINES} SELECT rate_date, hash_id, code AS missing_currency FROM absent",
    "required_gate": f"""WITH {LINES}, {ABSENT_LINES}, named AS (
  SELECT rate_date, hash_id, string_agg(code, ',' ORDER BY code) AS missing FROM absent GROUP BY 1, 2)
SELECT rate_date, hash_id, 'required' AS "check", CASE WHEN missing IS NULL THEN 'PASS' ELSE 'FAIL' END AS status,
       coalesce(missing, '') AS missing
FROM (SELECT DISTINCT rate_date, hash_id FROM both_sides) LEFT JOIN named USING (rate_date, hash_id)""",
    "baseline_asof": f"WITH {META} SELECT rate_date, baseline_date, row_count, base_row_count FROM based",
    "baseline_date": f"""WITH {RATES} SELECT max(rate_date) AS baseline_date FROM rates
WHERE rate_date < (SELECT max(rate_date) FROM rates)""",
    "rate_lookup": f"""WITH {RATES} SELECT rate_date, count(DISTINCT currency) AS codes,
max(CASE WHEN currency = 'USD' THEN {money('cents')} END) AS usd,
max(CASE WHEN currency = 'AUD' THEN {money('cents')} END) AS aud FROM rates GROUP BY 1""",
    "rate_jumps": f"""WITH {META} SELECT rate_date, baseline_date, currency, {money('old')} AS base_rate,
{money('new')} AS new_rate, jump FROM jumps""",
    "quality_gate": GATE,
    "quality_gate_spoilt": SPOILT_GATE,
    "backfill_gate": GATE + " WHERE rate_date BETWEEN DATE '{}' AND DATE '{}'".format(*GATED_YEAR),
    "expected_days": f"""WITH {SPAN} SELECT rate_date, CASE WHEN expected THEN 'true' ELSE 'false' END AS expected
FROM days""",
    "late_diff": f"""WITH {LINES}, {diff('0')}
SELECT DATE '{AS_OF}' AS check_date, CAST(DATE '{AS_OF}' - 3000 AS DATE) AS lookback_date, rate_date, currency,
       CASE WHEN stage_cents IS NOT NULL THEN 'published' END AS stage_hash_id,
       CASE WHEN core_cents IS NOT NULL THEN 'loaded' END AS core_hash_id,
       {money('stage_cents')} AS stage_rate, {money('core_cents')} AS core_rate, diff_type FROM diff""",
    "late_diff_summary": f"WITH {LINES}, {diff('0')} {_SUMMARY}",
    "late_diff_logged": f"WITH {LINES}, {diff('0')} {_SUMMARY}",
    "late_diff_by_part": f"""WITH {publications('l_partkey', 'l_extendedprice')}, {diff('2500050')}
SELECT rate_date, currency, {money('stage_cents')} AS stage_rate, {money('core_cents')} AS core_rate, diff_type
FROM diff""",
    "replace_days": f"""WITH {LINES}, {replaced('dayofweek(rate_date) BETWEEN 1 AND 5')}
SELECT rate_date, currency, {money('cents')} AS rate, hash_id FROM core""",
    "backfill_days": f"""WITH {LINES}, {ABSENT_LINES}, {replaced("rate_date NOT IN (SELECT rate_date FROM absent WHERE hash_id = 'published')")},
marked AS (
  SELECT rate_date, count(*) AS meta_rows FROM published WHERE rate_date IN (SELECT rate_date FROM days) GROUP BY 1)
SELECT rate_date, currency, {money('cents')} AS rate, hash_id, meta_rows FROM core LEFT JOIN marked USING (rate_date)""",
    "insert_missing": f"""WITH logged AS (
  SELECT {_HASH.format("(o_orderkey::varchar || '-' || o_orderstatus)")} AS hash_id FROM orders),
offered AS (
  SELECT DISTINCT {_HASH.format("(l_orderkey::varchar || '-' || l_linestatus)")} AS hash_id FROM lineitem)
SELECT hash_id, 'log' AS origin FROM logged
UNION ALL SELECT hash_id, 'new' FROM offered WHERE hash_id NOT IN (SELECT hash_id FROM logged)""",
    "fill_table": f"""WITH {ORDER_LOG}, updates AS (
  SELECT {_HASH.format('l_orderkey')} AS hash_id, 'new/' || l_orderkey::varchar AS uri, count(*) AS n,
         CAST(max(l_shipdate) AS DATE) AS day FROM lineitem GROUP BY l_orderkey)
SELECT hash_id, gcs_zip_uri, CASE WHEN gcs_csv_uri IS NULL THEN uri ELSE gcs_csv_uri END AS gcs_csv_uri,
       CASE WHEN gcs_csv_uri IS NULL THEN n ELSE csv_size END AS csv_size,
       CASE WHEN gcs_csv_uri IS NULL THEN day ELSE unpacked_at END AS unpacked_at
FROM order_log LEFT JOIN updates USING (hash_id)""",
    "fill_missing": f"""WITH {ORDER_LOG}, updates AS (
  SELECT {_HASH.format('l_orderkey')} AS hash_id, 'new/' || l_orderkey::varchar AS uri, count(*) AS n,
         CAST(max(l_shipdate) AS DATE) AS day FROM lineitem GROUP BY l_orderkey)
SELECT hash_id, gcs_zip_uri, CASE WHEN gcs_csv_uri IS NULL THEN uri ELSE gcs_csv_uri END AS gcs_csv_uri,
       CASE WHEN gcs_csv_uri IS NULL THEN n ELSE csv_size END AS csv_size,
       CASE WHEN gcs_csv_uri IS NULL THEN day ELSE unpacked_at END AS unpacked_at
FROM order_log LEFT JOIN updates USING (hash_id)""",
    "latest_snapshot": f"""WITH {ORDER_LOG} SELECT hash_id, gcs_zip_uri, zip_size, ingested_at FROM order_log
ORDER BY ingested_at DESC, hash_id LIMIT 1""",
    "present_keys": f"""WITH {ORDER_LOG} SELECT DISTINCT {_HASH.format('l_orderkey')} AS hash_id FROM lineitem
WHERE {_HASH.format('l_orderkey')} IN (SELECT hash_id FROM order_log WHERE gcs_csv_uri IS NOT NULL)""",
    "log_gate": f"""WITH {LINE_LOG}, wanted AS (SELECT {_HASH.format('o_orderkey')} AS hash_id FROM orders),
decided AS (
  SELECT w.hash_id, CASE WHEN l.hash_id IS NULL THEN 'row_missing' WHEN gcs_zip_uri = '' THEN 'gcs_zip_uri_missing'
                         WHEN zip_size <> 4 THEN 'zip_size_differs' ELSE 'ok' END AS "check"
  FROM wanted w LEFT JOIN line_log l ON l.hash_id = w.hash_id)
{_DECIDED}""",
    "snapshot_audit": f"""WITH {LINE_LOG}, files AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'gone/' ELSE 'zip/' END || o_orderkey::varchar AS path,
         CASE WHEN o_orderpriority LIKE '1%' THEN sha256('changed') ELSE {_HASH.format('o_orderkey')} END AS hash_id
  FROM orders),
decided AS (
  SELECT l.hash_id, CASE WHEN f.path IS NULL THEN 'file_missing' WHEN zip_size <> 4 THEN 'size_differs'
                         WHEN f.hash_id <> l.hash_id THEN 'hash_differs' ELSE 'ok' END AS "check"
  FROM line_log l LEFT JOIN files f ON f.path = l.gcs_zip_uri)
{_DECIDED}""",
    "archive_roundtrip": f"""WITH {RATES}, years AS (SELECT DISTINCT year(rate_date) AS y FROM rates)
SELECT rate_date, currency, {money('cents')} AS rate, NULL AS problem FROM rates
UNION ALL SELECT make_date(y, 12, 31), NULL, NULL, 'archive is too large' FROM years
UNION ALL SELECT make_date(y, 12, 31), NULL, NULL, 'BadZipFile' FROM years""",
    "land_stream": """WITH years AS (SELECT DISTINCT year(l_shipdate)::VARCHAR AS year FROM lineitem)
SELECT 'rates-' || year || '.zip' AS origin, 64::bigint AS hash_length, NULL AS problem FROM years
UNION ALL SELECT 'vast-' || year || '.zip', NULL, 'archive is too large' FROM years
UNION ALL SELECT 'vast-' || year || '.zip', NULL, 'archive is too large' FROM years""",
}
