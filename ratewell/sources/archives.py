"""Snapshot archives: ZIP files that hold one wide CSV each, identified by the hash of their bytes."""

from __future__ import annotations

import codecs
import csv
import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.operators.reshape import DATE_COLUMN, TRAILING_COLUMN
from ratewell.schemas import INGESTION_LOG
from ratewell.sources.sinks import insert_missing
from ratewell.sources.tables import rows_of_key

# Delimiters in the order they are tried, and the quote character.
DELIMITERS = (",", ";", "\t")
QUOTE = '"'

#: Bytes of a member that are inflated at a time, and the longest line in characters.
CHUNK_BYTES, LONGEST_LINE = 8 << 20, 8 << 20

MEMBERS = T.StructType([
    T.StructField("hash_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("chunk", T.LongType()),
    T.StructField("csv_text", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("delimiter", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _fits(max_size: int):
    return F.col("length").between(1, max_size)


def identify(files: DataFrame, max_size: int) -> DataFrame:
    """(hash_id, path, size, modified, content) of a frame with the columns of the binaryFile source. The size
    test is pushed to that source, so a file that is too large is never read."""
    return files.where(_fits(max_size)).select(
        F.sha2("content", 256).alias("hash_id"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        "content",
    )


def refused(files: DataFrame, max_size: int) -> DataFrame:
    """Files of an unacceptable size, without reading them. Spark's file sources skip files of no bytes, so an
    empty archive is seen here only if the frame comes from elsewhere; it is never identified in either case."""
    modified = [F.col("modificationTime").alias("modified")] if "modificationTime" in files.columns else []
    return files.where(~_fits(max_size)).select(
        "path",
        F.col("length").alias("size"),
        *modified,
        F.when(F.col("length") < 1, "archive is empty").otherwise("archive is too large").alias("error"),
    )


def landed_files(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.format("binaryFile").load(directory)


def newest_file(spark: SparkSession, landing: str | DataFrame) -> DataFrame | None:
    """The file that landed last, of a folder or of a frame with the columns of the binaryFile source; of files of one time the
    one with the smallest path. Its content is read only when it is used."""
    files = landed_files(spark, landing) if isinstance(landing, str) else landing
    newest = files.select("path", "modificationTime").orderBy(F.col("modificationTime").desc(), "path").first()
    if newest is None:
        return None
    return landed_files(spark, newest["path"]) if isinstance(landing, str) else files.where(F.col("path") == newest["path"])


def scan_archives(spark: SparkSession, directory: str, max_size: int, strict: bool = True) -> DataFrame:
    """The identified archives of a folder. Strict: a file of an unacceptable size raises; otherwise `refused` lists it."""
    files = landed_files(spark, directory)
    if strict and (bad := refused(files, max_size).first()):
        raise ValueError(f"{bad['path']}: {bad['error']} ({bad['size']} bytes)")
    return identify(files, max_size)


def log_rows(archives: DataFrame) -> DataFrame:
    """The ingestion-log rows of identified archives; extraction fields are still NULL."""
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in INGESTION_LOG.fields}
    known = {
        "hash_id": F.col("hash_id"),
        "gcs_zip_uri": F.col("path").alias("gcs_zip_uri"),
        "zip_size": F.col("size").alias("zip_size"),
        "ingested_at": F.current_timestamp().alias("ingested_at"),
    }
    return archives.select(*[known.get(name, empty[name]) for name in INGESTION_LOG.fieldNames()])


# --- archives by content ---------------------------------------------------------------------------------

def address(path: str, hash_id: Column) -> Column:
    """Where the archive table at `path` holds a content."""
    return F.concat(F.lit(f"{path.rstrip('/')}/hash_id="), hash_id)


def store_archives(archives: DataFrame, path: str) -> None:
    """Keep each content once, with the path it was found under (the smallest, if several land together)."""
    rows = archives.select("hash_id", F.col("path").alias("origin"), "size", "content", F.current_timestamp().alias("stored_at"))
    insert_missing(rows, path, order=("origin",), most_files=None)


def stored_archive(spark: SparkSession, path: str, hash_id: str) -> DataFrame:
    """The stored content of a hash as an identified archive: hash and size are those of the bytes that are there now."""
    kept = rows_of_key(spark, path, hash_id)
    if kept is None:
        raise FileNotFoundError(f"no archive table {path}")
    return kept.select(
        F.sha2("content", 256).alias("hash_id"), address(path, F.lit(hash_id)).alias("path"),
        F.length("content").cast("long").alias("size"), "content",
    )


# --- members ---------------------------------------------------------------------------------------------

def sole_member(archive: zipfile.ZipFile) -> zipfile.ZipInfo:
    """The one root-level CSV of an archive."""
    entries = archive.infolist()
    if len(entries) != 1:
        raise ValueError(f"archive holds {len(entries)} members, not one")
    name = entries[0].filename
    if "/" in name:
        raise ValueError(f"member {name!r} is not in the root folder")
    if not name.lower().endswith(".csv"):
        raise ValueError(f"member {name!r} is not a .csv file")
    return entries[0]


def whole_lines(archive: zipfile.ZipFile, entry: zipfile.ZipInfo) -> Iterator[str]:
    """The member's text in chunks that end with a line, inflated bit by bit; what follows the last line's end is carried
    on. The checksum is verified where the member ends."""
    decoder, carried = codecs.getincrementaldecoder("utf-8-sig")("strict"), ""
    with archive.open(entry) as stream:
        while block := stream.read(CHUNK_BYTES):
            carried += decoder.decode(block)
            # A lone carriage return ends a line, but at the end of a block its line feed may follow.
            cut = max(carried.rfind("\n"), carried.rfind("\r", 0, max(len(carried) - 1, 0))) + 1
            if cut:
                yield carried[:cut]
                carried = carried[cut:]
            if len(carried) > LONGEST_LINE:
                raise ValueError(f"a line is longer than {LONGEST_LINE} characters")
    carried += decoder.decode(b"", True)
    if carried:
        yield carried


# What must hold of a header, by name. Each rule sees the trimmed names, the last being TRAILING_COLUMN if it had none.
_HEADER_RULES = (
    ("the first column is Date", lambda names: names[0] == DATE_COLUMN),
    ("there is no name left out", lambda names: all(names)),
    ("no name occurs twice", lambda names: len(names) == len(set(names))),
    ("series are codes of three capitals", lambda names: all(re.fullmatch("[A-Z]{3}", n) for n in names[1:] if n and n != TRAILING_COLUMN)),
)


def header_layout(text: str) -> tuple[list[str], str]:
    """Column names and delimiter of a wide CSV. Every delimiter is tried on the first two filled lines; the first that
    gives two equally wide rows of two fields or more counts. All rules that the header breaks are named."""
    filled = list(islice(filter(str.strip, io.StringIO(text, newline=None)), 2))
    grids = {d: list(csv.reader((line.rstrip("\n") for line in filled), delimiter=d, quotechar=QUOTE)) for d in DELIMITERS}
    fitting = [d for d, grid in grids.items() if len({len(row) for row in grid}) == 1 and len(grid) == 2 and len(grid[0]) > 1]
    if not fitting:
        raise ValueError("no delimiter gives a header and one row of equally many fields, two at least")
    header, values = ([cell.strip() for cell in row] for row in grids[fitting[0]])
    broken = []
    if header[-1] == "":
        header[-1] = TRAILING_COLUMN
        if values[-1]:
            broken.append("a trailing column without a name is empty")
    broken += [rule for rule, holds in _HEADER_RULES if not holds(header)]
    if broken:
        raise ValueError("the header breaks: " + "; ".join(broken))
    return header, fitting[0]


def _checked(archive: zipfile.ZipFile, entry: zipfile.ZipInfo) -> tuple[list[str], str]:
    """Columns and delimiter of a member that was read to its end once."""
    filled: list[str] = []
    for text in whole_lines(archive, entry):
        if len(filled) < 2:
            filled += islice(filter(str.strip, io.StringIO(text, newline=None)), 2 - len(filled))
    if not entry.file_size:
        raise ValueError(f"member {entry.filename!r} is empty")
    return header_layout("".join(line if line.endswith("\n") else line + "\n" for line in filled))


def _open(hash_id: str, content: bytes) -> Iterator[dict]:
    """A row for each chunk of the member, or one that says what is wrong. The member is read twice, so that no chunk of a
    damaged one is given out, and is never held as a whole."""
    row = dict.fromkeys(MEMBERS.fieldNames())
    row["hash_id"] = hash_id
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            entry = sole_member(archive)
            row["name"] = entry.filename
            row["columns"], row["delimiter"] = _checked(archive, entry)
            for chunk, text in enumerate(whole_lines(archive, entry)):
                yield {**row, "chunk": chunk, "csv_text": text}
        return
    except (ValueError, csv.Error, zipfile.BadZipFile, OSError, EOFError, RuntimeError, NotImplementedError) as e:
        row["error"] = f"{type(e).__name__}: {e}"
    except Exception as e:  # zlib.error and other codec failures of a damaged member
        row["error"] = f"damaged archive: {e}"
    yield row


def extract_members(archives: DataFrame) -> DataFrame:
    """(hash_id, name, chunk, csv_text, columns, delimiter, error, layout): the member of each archive in chunks of whole
    lines of about CHUNK_BYTES, each with the checked header, or one row with what is wrong. A task holds an archive and one
    chunk. layout names the header."""

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for hash_id, content in zip(batch["hash_id"], batch["content"]):
                for row in _open(hash_id, bytes(content)):
                    yield pd.DataFrame([row], columns=MEMBERS.fieldNames()).astype({"chunk": "Int64"})

    header = F.sha2(F.concat_ws("\u0001", "delimiter", "columns"), 256)
    return archives.select("hash_id", "content").mapInPandas(opened, MEMBERS).withColumn(
        "layout", F.when(F.col("error").isNull(), header)
    )


def rejected(members: DataFrame) -> DataFrame:
    return members.where(F.col("error").isNotNull()).select("hash_id", "name", "error")


# --- CSV objects -----------------------------------------------------------------------------------------

def write_members(members: DataFrame, root: str) -> None:
    """The CSV of each valid archive under root/hash_id=<hash>/; those of other archives stay."""
    text = F.regexp_replace("csv_text", r"\n\z", "")
    members.where(F.col("error").isNull()).select("hash_id", text.alias("value")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("hash_id").text(root)


def stored_members(spark: SparkSession, root: str) -> DataFrame:
    """(hash_id, path, size) of the CSV objects, from the listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
        "recursiveFileLookup", "true"
    ).load(root)
    return listed.select(
        F.regexp_extract("path", "hash_id=([0-9a-f]+)", 1).alias("hash_id"),
        "path",
        F.col("length").alias("size"),
    )


def load_csv(
    spark: SparkSession, root: str, hashes: list[str], columns: list[str], delimiter: str
) -> DataFrame:
    """The wide all-text rows of the named CSV objects, which share one header, with their hash_id. A row that
    is too short or too long fails the load; a field must end on its line. The schema names hash_id too, so
    that Spark takes the folder name as text. The header is told by its first field, as it may stand in any part."""
    rows = (
        spark.read.schema(_wide_schema([*columns, "hash_id"]))
        .options(header=False, multiLine=False, encoding="UTF-8", basePath=root, **_dialect(delimiter))
        .csv([f"{root.rstrip('/')}/hash_id={h}" for h in hashes])
    )
    return rows.where(~F.trim(F.col(f"`{columns[0]}`")).eqNullSafe(columns[0]))


# --- many archives at once -------------------------------------------------------------------------------

def layouts(members: DataFrame) -> list[tuple[str, list[str], str]]:
    """The distinct (layout, columns, delimiter) of the valid members, for load_raw, which gives one wide frame per header.
    snapshots_long needs no such list."""
    headers = members.where(F.col("layout").isNotNull()).select("layout", "columns", "delimiter").distinct()
    return [(row["layout"], list(row["columns"]), row["delimiter"]) for row in headers.collect()]


def snapshots_long(members: DataFrame, strict: bool = True) -> DataFrame:
    """(date_str, currency, rate_str, hash_id) of all valid members, as to_long gives them, in one plan however many headers
    there are: each chunk carries its header, whose names meet the fields of a line by place. Strict: a rejected archive
    raises; otherwise `rejected` lists it. A row that is too short or too long fails."""
    if strict and (bad := rejected(members).first()):
        raise ValueError(f"archive {bad['hash_id']}: {bad['error']}")
    rows = _lines(members, "columns", "delimiter").select("hash_id", "columns", _fields().alias("_fields"))
    wrong = F.raise_error(F.concat(F.lit("malformed row of "), "hash_id", F.lit(": "), F.size("_fields").cast("string"), F.lit(" fields")))
    fitting = F.when(F.size("_fields") == F.size("columns"), F.col("_fields")).otherwise(wrong.cast("array<string>"))
    rows = rows.select("hash_id", "columns", fitting.alias("_fields"))
    names, values = (F.slice(c, F.lit(2), F.size("columns")) for c in ("columns", "_fields"))
    cells = rows.select("hash_id", _unquoted(F.col("_fields")[0]).alias("date_str"), F.inline(F.arrays_zip(names.alias("currency"), values.alias("_field"))))
    return cells.where(F.col("currency") != TRAILING_COLUMN).select(
        "date_str", "currency", _unquoted(F.col("_field")).alias("rate_str"), "hash_id"
    ).where(F.col("rate_str").isNotNull())


def _lines(members: DataFrame, *columns: str) -> DataFrame:
    """The filled lines of valid members but the header, which is the first one of the first chunk, as _line."""
    filled = F.filter(F.split("csv_text", r"\r\n|\r|\n"), lambda line: F.trim(line) != "")
    first = F.when(F.col("chunk") == 0, 2).otherwise(1)
    good = members.where(F.col("error").isNull())
    return good.select("hash_id", *columns, F.explode(F.slice(filled, first, F.size(filled))).alias("_line"))


def _fields() -> Column:
    """The raw fields of _line by its delimiter. With quotes, a field is all up to a delimiter outside of them; where that
    leaves characters over, the row is no good and gives no fields."""
    found = F.lit(None).cast("array<string>")
    for d in DELIMITERS:
        plain = F.split("_line", d, -1)
        pattern = f'("[^"]*(?:""[^"]*)*"|[^"{d}]*){d}'
        quoted = F.regexp_extract_all(F.concat("_line", F.lit(d)), F.lit(pattern), F.lit(1))
        used = F.aggregate(quoted, F.lit(0), lambda n, field: n + F.length(field) + 1)
        whole = F.when(used == F.length("_line") + 1, quoted).otherwise(F.array().cast("array<string>"))
        found = F.when(F.col("delimiter") == d, F.when(F.contains("_line", F.lit(QUOTE)), whole).otherwise(plain)).otherwise(found)
    return found


def _unquoted(field: Column) -> Column:
    """A quoted field's content; an empty field is NULL, with quotes or without, as in load_csv."""
    inside = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit(QUOTE * 2), F.lit(QUOTE))
    return F.nullif(F.when(F.startswith(field, F.lit(QUOTE)), inside).otherwise(field), F.lit(""))


def load_raw(members: DataFrame, layout: str, columns: list[str], delimiter: str) -> DataFrame:
    """The wide all-text rows of every member with this header, with their hash_id, parsed on the JVM side from
    the member texts. Bad rows fail the load, as in load_csv."""
    rows = _lines(members.where(F.col("layout") == layout))
    parsed = F.from_csv("_line", ", ".join(f"`{c}` string" for c in columns), _dialect(delimiter))
    return rows.select(parsed.alias("_row"), "hash_id").select("_row.*", "hash_id")


def _wide_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _dialect(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST"}
