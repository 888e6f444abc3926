"""Readers for delimited text and for the benchmark tables.

Every reader takes text columns first and types them with guarded
expressions, so one bad cell never fails a job and rejected rows stay visible.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import exprs
from ..operators.clean import ROW_ID, drop_empty_columns
from . import delimited

CORRUPT = "_corrupt"

# ---- fixed values: column names of the known inputs --------------------------
SUBMISSION_COLUMNS = ("name", "domain", "task", "score", "submitted")
STUDENT_COLUMNS = (
    "student_id", "name", "domain", "attendance_percent", "score", "study_hours", "height", "weight", "submitted",
)
CLEANED_COLUMNS = (
    "student_id", "name", "domain", "attendance_percent", "score", "study_hours", "height_cm", "weight_kg", "submitted",
)
CLEANED_NUMBERS = ("attendance_percent", "score", "study_hours", "height_cm", "weight_kg")
MEASUREMENT_COLUMNS = (
    "record_id", "domain", "condition", "input_type", "input_value", "input_unit", "replicate", "time_step",
    "signal", "signal_unit", "expected_signal", "baseline_signal", "voltage_v", "current_a", "stress_mpa",
    "reference_stress_mpa", "temperature_c",
)
MEASUREMENT_NUMBERS = (
    "input_value", "replicate", "time_step", "signal", "expected_signal", "baseline_signal", "voltage_v",
    "current_a", "stress_mpa", "reference_stress_mpa", "temperature_c",
)
AIR_SENTINEL = -200.0
# ------------------------------------------------------------------------------


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no valid rows in {what}")
    return df


def text_schema(columns: Sequence[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType(fields + ([T.StructField(CORRUPT, T.StringType())] if corrupt else []))


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None,
    sep: str = ",",
    null_tokens: Sequence[str] = exprs.NULL_TOKENS,
    strict_width: bool = False,
    header: bool = True,
    multiline: bool = False,
    keep_broken: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): all columns as trimmed text with missing tokens as NULL, plus ``_rid``.

    Every file begins with its header, and only that one record is taken away. Columns are found by its names, in whatever order the
    file has them; a missing one is an error, as are files with other names than the rest, and further ones are left out. Without a
    header, ``columns`` are those of all files. Quotes inside a quoted field are doubled. Rows with too few or too many fields are rejected when
    ``strict_width`` is set; ``rejected`` holds their raw text.
    ``multiline`` lets quoted fields hold line breaks (a large file is still read by many tasks); without it a line with an
    unbalanced quote is rejected, or with ``keep_broken`` read as far as it goes.
    """
    if multiline:
        groups, lost = delimited.multiline(spark, path, sep, header)
    else:
        groups, lost = delimited.plain(spark, path, sep, header), None
    if not groups:
        raise ValueError(f"missing columns: {list(columns or ())} (no header in {path})")
    tables = []
    for group, (kind, lines) in enumerate(groups):
        if len(groups) > 1:  # every group numbers its lines from the start
            lines = lines.withColumn("id", F.col("id") * len(groups) + group)
        names = list(columns) if kind is None else list(kind.names)
        wanted = names if columns is None else list(columns)
        missing = [c for c in wanted if c not in names]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        tables.append(_parsed(lines, names, wanted, sep, null_tokens, strict_width, keep_broken))
    rows, rejected = (reduce(DataFrame.unionByName, part) for part in zip(*tables))
    if lost is not None:
        rejected = rejected.union(lost.select(F.col("id").alias("_rid"), F.col(delimited.LINE).alias("line")))
    return rows, rejected


def _parsed(
    lines: DataFrame, names: list[str], columns: list[str], sep: str, null_tokens: Sequence[str] | None, strict_width: bool, keep_broken: bool
) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of records that share one order of columns; ``null_tokens`` None keeps cells as they stand."""
    ddl = ", ".join(f"`{f.name}` string" for f in text_schema([f"c{i}" for i in range(len(names))], corrupt=True))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1"}
    line = F.col(delimited.LINE)
    raw = lines.select(F.col("id").alias(ROW_ID), line, F.from_csv(line, ddl, options).alias("r")).select(ROW_ID, delimited.LINE, "r.*")
    broken = F.col(CORRUPT).isNotNull()
    cut = F.lit(False) if keep_broken else F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1
    clean = lambda c: c if null_tokens is None else exprs.null_tokens(c, null_tokens) if null_tokens else F.trim(c)
    cells = [clean(F.col(f"c{names.index(c)}")).alias(c) for c in columns]
    rows = raw.where(~(broken | cut) if strict_width else ~cut)
    return rows.select(ROW_ID, *cells), raw.where(broken | cut).select(ROW_ID, F.coalesce(line, CORRUPT).alias("line"))


def file_header(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> list[str]:
    """The names that the files begin with."""
    found = delimited.headers(spark, delimited.first_lines(delimited.numbered(spark, path)), sep)
    return list(found[0].names) if found else []


def read_plain(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """A comma-separated table with a header, all columns as text as it stands, short rows with NULL at the end."""
    return read_text_table(spark, path, None, null_tokens=None, multiline=multiline, keep_broken=True)[0].drop(ROW_ID)


def read_submissions(
    spark: SparkSession, path: str, on_invalid: str = "skip", strict_width: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) submissions with a typed score and a boolean ``submitted``.

    ``on_invalid``: 'skip' rejects rows without a whole-number score, 'zero'
    takes the truncated number or 0, 'null' keeps the row with a NULL score.
    """
    rows, malformed = read_text_table(
        spark, path, SUBMISSION_COLUMNS, null_tokens=(), strict_width=strict_width
    )
    flag = F.coalesce(exprs.equals_text("submitted", "yes"), F.lit(False))
    if on_invalid == "zero":
        score = exprs.whole_or_zero("score")
    else:
        score = exprs.integer("score")
    typed = rows.withColumns({"__raw": F.col("score"), "score": score, "submitted": flag})
    if on_invalid != "skip":
        return typed.drop("__raw"), malformed
    bad = typed.where(F.col("score").isNull()).select(
        "_rid", F.concat(F.lit("invalid score: "), F.coalesce("__raw", F.lit("missing"))).alias("line")
    )
    return typed.where(F.col("score").isNotNull()).drop("__raw"), malformed.unionByName(bad)


def read_students(spark: SparkSession, path: str) -> DataFrame:
    """Messy student table, all text, missing tokens as NULL."""
    return read_text_table(spark, path, STUDENT_COLUMNS)[0]


def with_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Guarded cast of the listed columns that exist."""
    return df.withColumns({c: exprs.number(F.col(c).cast("string")) for c in columns if c in df.columns})


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return with_numbers(read_text_table(spark, path, CLEANED_COLUMNS)[0], CLEANED_NUMBERS)


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    return with_numbers(read_text_table(spark, path, MEASUREMENT_COLUMNS)[0], MEASUREMENT_NUMBERS)


def safe_name(column: str) -> str:
    """Column name without dots, brackets and blanks: 'PT08.S1(CO)' to 'PT08_S1_CO'."""
    return "_".join(part for part in "".join(ch if ch.isalnum() else " " for ch in column).split())


def read_european(
    spark: SparkSession, path: str, columns: Sequence[str], text: Sequence[str] = ("Date", "Time")
) -> DataFrame:
    """Semicolon-separated table with decimal commas.

    Columns without any value and rows whose measured columns are all empty
    are dropped; such files end their lines with unnamed columns, so that many names may be missing from the header.
    Names are made safe for column expressions.
    """
    found = {name.strip() for name in file_header(spark, path, ";")}
    unnamed = sum(name.startswith("_c") and name[2:].isdigit() for name in found)
    missing = [c for c in columns if c not in found]
    if len(missing) > unnamed:
        raise ValueError(f"missing columns: {missing}")
    columns = [c for c in columns if c in found]
    rows, _ = read_text_table(spark, path, columns, sep=";")
    rows = rows.select("_rid", *[F.col(f"`{c}`").alias(safe_name(c)) for c in columns])
    numbers = [safe_name(c) for c in columns if c not in text]
    rows = rows.withColumns({c: exprs.number(F.replace(F.col(c), F.lit(","), F.lit("."))) for c in numbers})
    rows = drop_empty_columns(rows)
    return rows.dropna(how="all", subset=[c for c in numbers if c in rows.columns])


def read_scoring_input(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """Feature columns as doubles; fails with the list of missing columns."""
    raw = read_plain(spark, path)
    require_columns(raw, features)
    return raw.select(*[exprs.number(c).alias(c) for c in features])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
