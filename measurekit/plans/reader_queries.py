"""The readers on delimited text that Spark writes from the tables: two files' worth of column orders in one folder, quoted cells, broken rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import exprs
from ..session import shared_folder
from ..sources import records
from ..sources.records import MEASUREMENT_COLUMNS, MEASUREMENT_NUMBERS, STUDENT_COLUMNS, SUBMISSION_COLUMNS, table
from .cleaning_queries import TOKENS, WITH_MESSY, messy
from .registry import derive, derive_sql, query


def written(rows: DataFrame, columns: Sequence[str], by: str, sep: str = ",") -> str:
    """A folder with a header in every file; every other row (by ``by``) goes to files with the reverse order of columns."""
    folder = shared_folder(rows.sparkSession, "delimited")
    for rest, order in enumerate((list(columns), list(columns)[::-1])):
        part = rows.where(F.pmod(F.col(by), F.lit(2)) == rest).select(*[F.col(f"`{c}`") for c in order])
        part.write.mode("append").csv(folder, header=True, sep=sep, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return folder


SUBMITTED = {
    "_key": "o_orderkey",
    "name": "CASE WHEN o_orderkey % 13 = 0 THEN 'name' ELSE concat('C \"', CAST(o_custkey AS {text}), '\", ', o_orderpriority) END",
    "domain": "CASE WHEN o_orderkey % 13 = 0 THEN 'domain' ELSE o_orderpriority END",
    "task": "CASE WHEN o_orderkey % 13 = 0 THEN 'task' ELSE concat('T', CAST(o_orderkey AS {text})) END",
    "score": "CASE WHEN o_orderkey % 13 = 0 THEN 'score' WHEN o_orderkey % 5 = 1 THEN 'abc' WHEN o_orderkey % 5 = 2 THEN '7.5' WHEN o_orderkey % 5 = 3 THEN '' "
    "ELSE concat(' ', CAST(o_custkey AS {text})) END",
    "submitted": "CASE WHEN o_orderkey % 13 = 0 THEN 'submitted' WHEN o_orderstatus = 'F' THEN ' Yes' ELSE 'no' END",
}
SUBMISSIONS = "WITH s AS (" + derive_sql(SUBMITTED, "orders") + ") "
#: Every thirteenth row reads like a header.
WHOLE = r"regexp_matches(trim(score), '^[+-]?\d+$')"


def submissions(spark, sf) -> str:
    return written(derive(table(spark, sf, "orders"), SUBMITTED), SUBMISSION_COLUMNS, "_key")


@query(
    "SRC1_read_submissions",
    SUBMISSIONS + f"SELECT name, domain, task, CAST(trim(score) AS INTEGER) AS score, lower(trim(submitted)) = 'yes' AS submitted FROM s WHERE {WHOLE}",
)
def read_submissions(spark, sf):
    return records.read_submissions(spark, submissions(spark, sf), "skip", strict_width=True)[0].drop("_rid")


@query(
    "SRC1_read_rejected",
    SUBMISSIONS + f"SELECT 'invalid score: ' || CASE WHEN score = '' THEN 'missing' ELSE score END AS line FROM s WHERE NOT {WHOLE}",
)
def read_rejected(spark, sf):
    line = F.when(F.col("line") == "invalid score: ", "invalid score: missing").otherwise(F.col("line"))
    return records.read_submissions(spark, submissions(spark, sf), "skip", strict_width=True)[1].select(line.alias("line"))


@query(
    "SRC3_read_coerced",
    SUBMISSIONS + "SELECT name, domain, task, CAST(trunc(CASE WHEN regexp_matches(trim(score), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') "
    "THEN CAST(trim(score) AS DOUBLE) ELSE 0 END) AS INTEGER) AS score, lower(trim(submitted)) = 'yes' AS submitted FROM s",
)
def read_coerced(spark, sf):
    return records.read_submissions(spark, submissions(spark, sf), "zero")[0].drop("_rid")


@query(
    "SRC4_read_students",
    WITH_MESSY + " SELECT " + ", ".join(f"CASE WHEN {c} IN ({TOKENS}) OR trim({c}) = '' THEN NULL ELSE trim({c}) END AS {c}" for c in STUDENT_COLUMNS) + " FROM messy",
)
def read_students(spark, sf):
    return records.read_students(spark, written(messy(spark, sf), STUDENT_COLUMNS, "_rid")).drop("_rid")


MEASURED = {
    "_key": "l_orderkey",
    "record_id": "concat('R', CAST(l_orderkey AS {text}), '-', CAST(l_linenumber AS {text}))",
    "domain": "l_returnflag",
    "condition": "concat(l_returnflag, ', ', l_linestatus)",
    "input_type": "CASE WHEN l_linenumber = 3 THEN NULL ELSE 'load' END",
    "input_value": "CASE WHEN l_linenumber = 5 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS {text}) END",
    "input_unit": "'kg'",
    "replicate": "CAST(l_linenumber AS {text})",
    "time_step": "concat(' ', CAST(l_linenumber * 2 AS {text}))",
    "signal": "CASE WHEN l_linenumber = 4 THEN '1_000' ELSE CAST(CAST(l_quantity * 2 AS INTEGER) AS {text}) END",
    "signal_unit": "'mm'",
    **{c: "CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_suppkey AS {text}) END" for c in MEASUREMENT_COLUMNS[10:]},
}


def number_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN CAST(trim({c}) AS DOUBLE) END AS {c}"


@query(
    "SRC6_read_measurements",
    "WITH m AS (" + derive_sql(MEASURED, "lineitem") + ") SELECT "
    + ", ".join(number_sql(c) if c in MEASUREMENT_NUMBERS else f"CASE WHEN {c} IN ({TOKENS}) OR trim({c}) = '' THEN NULL ELSE trim({c}) END AS {c}" for c in MEASUREMENT_COLUMNS) + " FROM m",
)
def read_measurements(spark, sf):
    return records.read_measurements(spark, written(derive(table(spark, sf, "lineitem"), MEASURED), MEASUREMENT_COLUMNS, "_key")).drop("_rid")


EUROPEAN = {
    "_key": "l_orderkey",
    "Date": "CAST(l_shipdate AS {text})",
    "Time": "CASE WHEN l_linenumber = 6 THEN NULL ELSE '18.00.00' END",
    "CO(GT)": "CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE concat(CAST(CAST(l_quantity AS INTEGER) AS {text}), ',', CAST(l_linenumber AS {text})) END",
    "PT08.S1": "CASE WHEN l_linenumber IN (5, 6) THEN NULL ELSE CAST(l_partkey AS {text}) END",
    "Empty": "CAST(NULL AS {text})",
}


@query(
    "SRC7_read_european",
    "SELECT CAST(l_shipdate AS VARCHAR) AS \"Date\", '18.00.00' AS \"Time\", "
    "CASE WHEN l_linenumber <> 7 THEN CAST(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.' || l_linenumber AS DOUBLE) END AS \"CO_GT\", "
    "CASE WHEN l_linenumber <> 5 THEN CAST(l_partkey AS DOUBLE) END AS \"PT08_S1\" FROM lineitem WHERE l_linenumber <> 6",
)
def read_european(spark, sf):
    columns = [c for c in EUROPEAN if c != "_key"]
    rows = table(spark, sf, "lineitem").selectExpr(*[f"{text.format(text='string')} AS `{name}`" for name, text in EUROPEAN.items()])
    return records.read_european(spark, written(rows, columns, "_key", ";"), columns).drop("_rid")


@query(
    "SRC9_read_scoring",
    "SELECT CAST(p_size AS DOUBLE) AS p_size, CASE WHEN p_partkey % 7 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS DOUBLE) END AS p_retailprice FROM part",
)
def read_scoring(spark, sf):
    price = F.when(F.col("p_partkey") % 7 != 0, F.expr("cast(cast(p_retailprice AS decimal(12, 2)) AS string)")).otherwise("oops")
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"), price.alias("p_retailprice"), "p_name")
    return records.read_scoring_input(spark, written(rows, ["p_name", "p_size", "p_retailprice"], "p_partkey"), ["p_size", "p_retailprice"])


NOTES = {
    "_key": "p_partkey",
    "key": "CAST(p_partkey AS {text})",
    "note": "CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, '\n', 'key,note', '\n\n', p_brand) WHEN p_partkey % 3 = 1 THEN concat('\"', p_name, '\"') ELSE p_name END",
}


@query("SRC1_read_line_breaks", "WITH n AS (" + derive_sql(NOTES, "part") + ") SELECT key, note FROM n")
def read_line_breaks(spark, sf):
    folder = written(derive(table(spark, sf, "part"), NOTES), ["key", "note"], "_key")
    return records.read_text_table(spark, folder, ["key", "note"], null_tokens=(), multiline=True)[0].drop("_rid")
