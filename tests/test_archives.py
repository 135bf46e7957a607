import hashlib
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.operators.reshape import clean_long, to_long
from ratewell.plans.views import zip_bytes
from ratewell.sources import archives as zips
from tests.helpers import D, tuples

LIMIT = 10 * 1024 * 1024
MEMBER_COLUMNS = T.StructType([*zips.MEMBERS.fields, T.StructField("layout", T.StringType())])
CSV = "Date,USD,GBP,\n2026-01-05,1.1,0.9,\n2026-01-06,N/A,0.8,\n"


def two_members():
    import io
    import zipfile

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("a.csv", CSV)
        archive.writestr("b.csv", CSV)
    return buffer.getvalue()


def damaged():
    import io
    import zipfile

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("a.csv", CSV)
    return buffer.getvalue().replace(b"0.9", b"7.7", 1)


def opened(spark, contents: dict):
    """Rows of extract_members by archive name."""
    files = spark.createDataFrame(
        [(name, len(data), bytearray(data)) for name, data in contents.items()], "path string, length long, content binary"
    ).withColumn("modificationTime", F.current_timestamp())
    found = zips.identify(files, LIMIT)
    names = {r["hash_id"]: r["path"] for r in found.select("hash_id", "path").collect()}
    return {names[r["hash_id"]]: r for r in zips.extract_members(found).collect()}


def test_hash_is_sha256_of_the_bytes(spark):
    data = zip_bytes("a.csv", CSV)
    assert opened(spark, {"a": data})["a"]["hash_id"] == hashlib.sha256(data).hexdigest()


def test_member_rules(spark):
    rows = opened(spark, {
        "good": zip_bytes("rates.csv", CSV),
        "upper": zip_bytes("RATES.CSV", CSV + " "),
        "nested": zip_bytes("x/rates.csv", CSV),
        "suffix": zip_bytes("rates.txt", CSV),
        "blank": zip_bytes("rates.csv", ""),
        "two": two_members(),
        "truncated": zip_bytes("rates.csv", CSV)[:60],
        "garbage": b"no archive",
        "damaged": damaged(),
    })
    errors = {name: r["error"] for name, r in rows.items()}
    assert errors["good"] is None and errors["upper"] is None
    assert rows["good"]["csv_text"] == CSV and rows["upper"]["name"] == "RATES.CSV"
    assert "root" in errors["nested"]
    assert "not a .csv" in errors["suffix"]
    assert "is empty" in errors["blank"]
    assert "2 members" in errors["two"]
    assert all(errors[n] for n in ("truncated", "garbage", "damaged"))


def test_size_limits(spark, tmp_path):
    for name, size in [("none.zip", 0), ("one.zip", 1), ("ten.zip", 10), ("eleven.zip", 11)]:
        (tmp_path / name).write_bytes(b"x" * size)
    files = zips.landed_files(spark, str(tmp_path))
    assert sorted(os.path.basename(r["path"]) for r in zips.identify(files, 10).collect()) == ["one.zip", "ten.zip"]
    refused = {os.path.basename(r["path"]): r["error"] for r in zips.refused(files, 10).collect()}
    # Spark's file sources give no row for a file of no bytes, so an empty archive never enters.
    assert refused == {"eleven.zip": "archive is too large"}
    made = spark.createDataFrame([("none", 0), ("one", 1)], "path string, length long")
    assert tuples(zips.refused(made, 10), "path", "error") == [("none", "archive is empty")]


@pytest.mark.parametrize("text, columns, delimiter", [
    (CSV, ["Date", "USD", "GBP", "_trailing_empty"], ","),
    ("Date;USD\n2026-01-05;1,5\n", ["Date", "USD"], ";"),
    ("Date\tUSD\tGBP\n2026-01-05\t1\t2\n", ["Date", "USD", "GBP"], "\t"),
    ("\n Date , USD \r\n\r\n2026-01-05,1\r\n", ["Date", "USD"], ","),
    ('"Date","USD"\n"2026-01-05","1"\n', ["Date", "USD"], ","),
])
def test_header_layouts(text, columns, delimiter):
    assert zips.header_layout(text) == (columns, delimiter)


@pytest.mark.parametrize("text, problem", [
    ("Date,USD\n", "one row"),
    ("Date,USD,\n2026-01-05,1,x\n", "trailing"),
    ("Date,usd\n2026-01-05,1\n", "three capitals"),
    ("Date,USDT\n2026-01-05,1\n", "three capitals"),
    ("Date,US1\n2026-01-05,1\n", "three capitals"),
    ("Date,USD,USD\n2026-01-05,1,2\n", "twice"),
    ("Date,,USD\n2026-01-05,1,2\n", "no name"),
    ("Day,USD\n2026-01-05,1\n", "first column"),
    ("Date\n2026-01-05\n", "no delimiter"),
    ("Date,USD\n2026-01-05,1,2\n", "no delimiter"),
])
def test_header_errors(text, problem):
    with pytest.raises(ValueError, match=problem):
        zips.header_layout(text)


def test_bom_and_bad_utf8(spark):
    rows = opened(spark, {
        "bom": zip_bytes("a.csv", "﻿" + CSV),
        "latin": zip_bytes("a.csv", CSV.encode() + "ä".encode("latin-1")),
    })
    assert rows["bom"]["columns"][0] == "Date" and rows["bom"]["csv_text"] == CSV
    assert "UnicodeDecodeError" in rows["latin"]["error"]


def members(spark, *texts):
    contents = {str(i): zip_bytes("a.csv", t) for i, t in enumerate(texts)}
    return spark.createDataFrame([tuple(r) for r in opened(spark, contents).values()], MEMBER_COLUMNS)


OTHER = 'Date;JPY\r\n"2026-01-07";"150;5"\r\n\r\n2026-01-08;151\r\n'


def rates_of(wide):
    return tuples(to_long(wide), "date_str", "currency", "rate_str")


WANTED = [("2026-01-05", "GBP", "0.9"), ("2026-01-05", "USD", "1.1"), ("2026-01-06", "GBP", "0.8"), ("2026-01-06", "USD", "N/A")]


def test_load_raw_by_layout(spark):
    opened_members = members(spark, CSV, OTHER)
    found = {tuple(c): (name, d) for name, c, d in zips.layouts(opened_members)}
    assert {c: d for c, (_, d) in found.items()} == {("Date", "USD", "GBP", "_trailing_empty"): ",", ("Date", "JPY"): ";"}
    by_layout = {c: rates_of(zips.load_raw(opened_members, name, list(c), d)) for c, (name, d) in found.items()}
    assert by_layout[("Date", "USD", "GBP", "_trailing_empty")] == WANTED
    assert by_layout[("Date", "JPY")] == [("2026-01-07", "JPY", "150;5"), ("2026-01-08", "JPY", "151")]
    assert tuples(zips.snapshots_long(opened_members), "date_str", "currency", "rate_str") == sorted(sum(by_layout.values(), []))


def test_csv_objects(spark, tmp_path):
    root = str(tmp_path / "csv")
    opened_members = members(spark, CSV, OTHER, "Date\n")
    zips.write_members(opened_members, root)
    ids = {tuple(r["columns"]): r["hash_id"] for r in opened_members.where("error is null").collect()}
    sizes = {r["hash_id"]: r["size"] for r in zips.stored_members(spark, root).collect()}
    comma = ids[("Date", "USD", "GBP", "_trailing_empty")]
    assert set(sizes) == set(ids.values()) and sizes[comma] == len(CSV)
    wide = zips.load_csv(spark, root, [comma], ["Date", "USD", "GBP", "_trailing_empty"], ",")
    assert rates_of(wide) == WANTED
    assert wide.select("hash_id").distinct().first()[0] == comma
    typed = clean_long(to_long(wide))
    assert tuples(typed, "rate_date", "currency", "rate")[1] == (D("2026-01-05"), "USD", Decimal("1.1"))


@pytest.mark.parametrize("row", ["2026-01-06,1", "2026-01-06,1,2,3"])
def test_ragged_rows_fail_the_load(spark, tmp_path, row):
    text = f"Date,USD,GBP\n2026-01-05,1,2\n{row}\n"
    opened_members = members(spark, text)
    columns = ["Date", "USD", "GBP"]
    with pytest.raises(Exception, match="(?i)malformed"):
        zips.snapshots_long(opened_members).collect()
    root = str(tmp_path / "csv")
    zips.write_members(opened_members, root)
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        zips.load_csv(spark, root, [opened_members.first()["hash_id"]], columns, ",").collect()
