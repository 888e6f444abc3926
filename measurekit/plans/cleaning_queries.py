"""Cleaning, profiling and validation over messy text derived from ``part``.

Every part becomes one row of a messy student table; every seventh row has a
second, identical copy. The same text is built in SQL for the comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import clean, profile
from ..session import shared_folder
from ..sources import records, sinks
from ..sources.records import CLEANED_COLUMNS, CLEANED_NUMBERS, STUDENT_COLUMNS, table
from .registry import derive, derive_sql, query
from .students import DOMAINS, student_plan, student_rules

# The same column texts build the table in Spark and in SQL; {text} is the string type.
MESSY = {
    "student_id": "CASE WHEN p_partkey % 211 = 5 THEN NULL ELSE concat('S', CAST(p_partkey AS {text})) END",
    "name": "CASE WHEN p_partkey % 97 = 3 THEN NULL ELSE p_name END",
    "domain": "CASE p_partkey % 9 WHEN 0 THEN 'ml' WHEN 1 THEN ' Machine  Learning ' WHEN 2 THEN 'WEB' WHEN 3 "
        "THEN 'web dev' WHEN 4 THEN 'Electronics' WHEN 5 THEN 'mechanical' WHEN 6 THEN NULL WHEN 7 THEN "
        "'Biology' ELSE 'web development' END",
    "attendance_percent": "CASE p_partkey % 8 WHEN 0 THEN concat(CAST(p_size * 2 AS {text}), '%') WHEN 1 THEN CAST(p_size + "
        "40 AS {text}) WHEN 2 THEN '105%' WHEN 3 THEN '-10' WHEN 4 THEN 'n/a' WHEN 5 THEN NULL WHEN 6 "
        "THEN '5d' ELSE concat(' ', CAST(p_size AS {text}), ' %') END",
    "score": "CASE p_partkey % 7 WHEN 0 THEN 'nine' WHEN 1 THEN ' Two ' WHEN 2 THEN CAST(p_size % 11 AS "
        "{text}) WHEN 3 THEN '7.5' WHEN 4 THEN 'eleven' WHEN 5 THEN NULL ELSE CAST(p_size % 5 AS {text}) "
        "END",
    "study_hours": "CASE p_partkey % 5 WHEN 0 THEN 'zero' WHEN 1 THEN 'TEN' WHEN 2 THEN CAST(p_size % 13 AS {text}) "
        "WHEN 3 THEN '1e1' ELSE 'nan' END",
    "height": "CASE p_partkey % 6 WHEN 0 THEN concat(CAST(150 + p_size AS {text}), ' cm') WHEN 1 THEN '1.62 m' "
        "WHEN 2 THEN CAST(140 + p_size AS {text}) WHEN 3 THEN 'abc cm' WHEN 4 THEN '5 ft' ELSE "
        "concat(CAST(160 + p_size AS {text}), 'CM') END",
    "weight": "CASE p_partkey % 4 WHEN 0 THEN concat(CAST(40 + p_size AS {text}), ' kg') WHEN 1 THEN "
        "concat(CAST(41 + p_size AS {text}), 'KG') WHEN 2 THEN NULL ELSE CAST(50 + p_size AS {text}) END",
    "submitted": "CASE p_partkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN ' y ' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'no' WHEN "
        "4 THEN 'maybe' ELSE NULL END",
    "_key": "p_partkey",
    "copies": "CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 1 END",
}


def messy(spark, sf):
    """Messy students; ``_rid`` numbers the rows, copies after their originals."""
    base = derive(table(spark, sf, "part"), MESSY)
    copies = base.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return copies.select(*STUDENT_COLUMNS, (F.col("_key") * 2 + F.col("_copy")).alias("_rid"))


BASE = "m0 AS (" + derive_sql(MESSY, "part") + "), messy AS (SELECT m0.*, _key * 2 + c AS _rid FROM m0, (SELECT unnest([0, 1]) AS c) WHERE c < copies)"

NUM = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def num(text: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({text}), {NUM}) THEN CAST(trim({text}) AS DOUBLE) END)"


def words(text: str) -> str:
    cases = " ".join(f"WHEN '{w}' THEN {v}::DOUBLE" for w, v in exprs.WORD_NUMBERS.items())
    return f"(CASE lower(trim({text})) {cases} ELSE {num('lower(trim(' + text + '))')} END)"


DOMAIN = "coalesce(CASE replace(lower(trim(domain)), '  ', ' ') " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in exprs.DOMAIN_NAMES.items()
) + " END, domain)"
ATT = num("replace(attendance_percent, '%', '')")
HEIGHT = (
    "(CASE WHEN lower(trim(height)) LIKE '%cm' THEN " + num("replace(lower(trim(height)), 'cm', '')")
    + " WHEN lower(trim(height)) LIKE '%m' THEN " + num("replace(lower(trim(height)), 'm', '')") + " * 100 ELSE " + num("lower(trim(height))") + " END)"
)
WEIGHT = num("replace(lower(trim(weight)), 'kg', '')")
YES = "CASE WHEN lower(trim(submitted)) IN ('yes', 'y', 'true', '1') THEN 'yes' ELSE 'no' END"

FIRST = (
    ", firsts AS (SELECT student_id, name, domain, attendance_percent, score, study_hours, height, weight, submitted, min(_rid) AS _rid "
    "FROM messy GROUP BY ALL)"
)
TYPED = (
    f", typed AS (SELECT _rid, student_id, name, {DOMAIN} AS domain, CASE WHEN {ATT} BETWEEN 0 AND 100 THEN {ATT} END AS attendance_percent, "
    f"{words('score')} AS score, {words('study_hours')} AS study_hours, {HEIGHT} AS height_cm, {WEIGHT} AS weight_kg, {YES} AS submitted FROM firsts)"
)
STATS = (
    ", stats AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in CLEANED_NUMBERS)
    + ", (SELECT domain FROM typed WHERE domain IS NOT NULL GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 1) AS m_domain FROM typed)"
)
CLEANED = (
    STATS + ", cleaned AS (SELECT _rid, student_id, name, coalesce(domain, m_domain) AS domain, "
    + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in CLEANED_NUMBERS)
    + ", submitted FROM typed, stats WHERE name IS NOT NULL AND student_id IS NOT NULL)"
)
WITH_MESSY, WITH_FIRST = "WITH " + BASE, "WITH " + BASE + FIRST
WITH_TYPED, WITH_CLEAN = WITH_FIRST + TYPED, WITH_FIRST + TYPED + CLEANED
OUT = ", ".join(CLEANED_COLUMNS)


def typed(spark, sf):
    return student_plan().apply_rules(clean.dedupe(messy(spark, sf)))


def cleaned(spark, sf):
    return clean.run(messy(spark, sf), student_plan())


@query("SCL_clean_students", WITH_CLEAN + f" SELECT {OUT} FROM cleaned")
def clean_students(spark, sf):
    return cleaned(spark, sf).drop("_rid")


TOKENS = ", ".join(f"'{t}'" for t in exprs.NULL_TOKENS)


@query(
    "SRC4_text_null_tokens",
    WITH_MESSY + " SELECT _rid, " + ", ".join(
        f"CASE WHEN {c} IN ({TOKENS}) OR trim({c}) = '' THEN NULL ELSE trim({c}) END AS {c}" for c in STUDENT_COLUMNS
    ) + " FROM messy",
)
def null_tokens(spark, sf):
    return messy(spark, sf).select("_rid", *[exprs.null_tokens(c).alias(c) for c in STUDENT_COLUMNS])


@query(
    "SRC3_coerced_score",
    WITH_MESSY + f" SELECT _rid, CAST(trunc(coalesce({num('score')}, 0)) AS INTEGER) AS score FROM messy",
)
def coerced(spark, sf):
    return messy(spark, sf).select("_rid", exprs.whole_or_zero("score").alias("score"))


@query(
    "SRC1_rejected_rows",
    WITH_MESSY + r" SELECT _rid, score FROM messy WHERE score IS NULL OR NOT regexp_matches(trim(score), '^[+-]?\d+$')",
)
def rejected(spark, sf):
    return messy(spark, sf).where(exprs.integer("score").isNull()).select("_rid", "score")


@query(
    "SRC7_decimal_comma",
    "WITH t AS (SELECT p_partkey, replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS price FROM part) "
    "SELECT p_partkey, price, CAST(replace(price, ',', '.') AS DOUBLE) AS value FROM t",
)
def decimal_comma(spark, sf):
    price = F.replace(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    rows = table(spark, sf, "part").select("p_partkey", price.alias("price"))
    return rows.withColumn("value", exprs.number(F.replace("price", F.lit(","), F.lit("."))))


@query("SRC8_shape_and_classes", "SELECT count(*) AS n_rows, 6 AS n_columns, count(DISTINCT p_brand) AS brands, count(DISTINCT p_type) AS types FROM part")
def shape(spark, sf):
    part = table(spark, sf, "part")
    return part.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(part.columns)).alias("n_columns"),
        F.count_distinct("p_brand").alias("brands"), F.count_distinct("p_type").alias("types"),
    )


@query("SRC9_scoring_input", "SELECT CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def scoring_input(spark, sf):
    rows = records.require_columns(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return rows.select(*[F.col(c).cast("double").alias(c) for c in ("p_size", "p_retailprice")])


WIDTHS = {
    "line": "CASE p_partkey % 11 WHEN 3 THEN concat(CAST(p_partkey AS {text}), ',short') "
    "WHEN 5 THEN concat(CAST(p_partkey AS {text}), ',too,many,fields') "
    "ELSE concat(CAST(p_partkey AS {text}), ' , ', p_name, ',', CAST(p_size AS {text})) END",
}


def _strict(spark, sf):
    """Lines of three fields with short and long rows among them, written to the shared folder and read strictly."""
    folder = shared_folder(spark, "lines")
    derive(table(spark, sf, "part"), WIDTHS).write.text(folder)
    return records.read_text_table(spark, folder, ("key", "name", "size"), null_tokens=(), strict_width=True, header=False)


@query("SRC2_strict_width", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part WHERE p_partkey % 11 NOT IN (3, 5)")
def strict_width(spark, sf):
    return _strict(spark, sf)[0].drop("_rid")


@query("SRC2_rejected_lines", "WITH l AS (" + derive_sql({"p_partkey": "p_partkey", **WIDTHS}, "part") + ") SELECT line FROM l WHERE p_partkey % 11 IN (3, 5)")
def rejected_lines(spark, sf):
    return _strict(spark, sf)[1].select("line")


@query("SRC5_reload_cleaned", WITH_CLEAN + f" SELECT {OUT} FROM cleaned")
def reload_cleaned(spark, sf):
    folder = shared_folder(spark, "cleaned")
    sinks.write_table(cleaned(spark, sf).drop("_rid"), folder, "csv")
    return records.read_cleaned(spark, folder).drop("_rid")


@query("SCL1_trimmed_flag", WITH_MESSY + " SELECT _rid, lower(trim(submitted)) = 'yes' AS flag FROM messy")
def trimmed_flag(spark, sf):
    return messy(spark, sf).select("_rid", exprs.equals_text("submitted", "yes").alias("flag"))


@query("SET1_dedupe", WITH_FIRST + " SELECT * FROM firsts")
def dedupe(spark, sf):
    return clean.dedupe(messy(spark, sf))


@query("SCL2_domains", WITH_MESSY + f" SELECT _rid, {DOMAIN} AS domain FROM messy")
def domains(spark, sf):
    return messy(spark, sf).select("_rid", exprs.canonical("domain").alias("domain"))


@query("SCL3_percent", WITH_MESSY + f" SELECT _rid, {ATT} AS raw_value, CASE WHEN {ATT} BETWEEN 0 AND 100 THEN {ATT} END AS value FROM messy")
def percent(spark, sf):
    raw = exprs.number(F.replace("attendance_percent", F.lit("%"), F.lit("")))
    return messy(spark, sf).select("_rid", raw.alias("raw_value"), exprs.percent("attendance_percent").alias("value"))


@query("SCL4_number_words", WITH_MESSY + f" SELECT _rid, {words('score')} AS score, {words('study_hours')} AS study_hours FROM messy")
def number_words(spark, sf):
    return messy(spark, sf).select("_rid", *[exprs.word_number(c).alias(c) for c in ("score", "study_hours")])


@query("SCL5_height", WITH_MESSY + f" SELECT _rid, {HEIGHT} AS height_cm FROM messy")
def height(spark, sf):
    return messy(spark, sf).select("_rid", exprs.length_cm("height").alias("height_cm"))


@query("SCL6_weight", WITH_MESSY + f" SELECT _rid, {WEIGHT} AS weight_kg FROM messy")
def weight(spark, sf):
    return messy(spark, sf).select("_rid", exprs.mass_kg("weight").alias("weight_kg"))


@query("SCL7_yes_no", WITH_MESSY + f" SELECT _rid, {YES} AS submitted FROM messy")
def yes_no(spark, sf):
    return messy(spark, sf).select("_rid", exprs.yes_no("submitted").alias("submitted"))


@query("SCL8_missing_sweep", WITH_CLEAN + f" SELECT _rid, {OUT} FROM cleaned")
def sweep(spark, sf):
    plan = student_plan()
    return clean.drop_missing(clean.fill(typed(spark, sf), plan.fills), plan.identity).select("_rid", *CLEANED_COLUMNS)


@query("FLT4_range_to_null", "SELECT p_partkey, CASE WHEN p_size BETWEEN 10 AND 40 THEN p_size END AS size FROM part")
def range_to_null(spark, sf):
    return table(spark, sf, "part").select("p_partkey", exprs.keep_between(F.col("p_size"), 10, 40).alias("size"))


@query("FLT9_complete_rows", WITH_MESSY + " SELECT _rid FROM messy WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in STUDENT_COLUMNS))
def complete(spark, sf):
    return clean.drop_incomplete(messy(spark, sf)).select("_rid")


@query("FLT10_identity", WITH_MESSY + " SELECT _rid FROM messy WHERE name IS NOT NULL AND student_id IS NOT NULL")
def identity(spark, sf):
    return clean.drop_missing(messy(spark, sf), ["name", "student_id"]).select("_rid")


@query("PRJ1_column_order", WITH_CLEAN + " SELECT student_id, domain, score FROM cleaned")
def column_order(spark, sf):
    return clean.keep_columns(cleaned(spark, sf), ["student_id", "unknown_column", "domain", "score"])


@query("PRJ2_dropped_columns", WITH_MESSY + " SELECT _rid, student_id, name, domain, score, study_hours, submitted FROM messy")
def dropped(spark, sf):
    return clean.drop_columns(messy(spark, sf), ["height", "weight", "attendance_percent", "unknown_column"])


@query("PRJ3_numeric_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_only(spark, sf):
    part = table(spark, sf, "part")
    return part.select(*clean.numeric_columns(part))


@query("PRJ4_renamed_units", WITH_TYPED + " SELECT _rid, height_cm, weight_kg FROM typed")
def renamed(spark, sf):
    return typed(spark, sf).select("_rid", "height_cm", "weight_kg")


@query("AGG7_medians", WITH_TYPED + " SELECT " + ", ".join(f"median({c}) AS {c}" for c in CLEANED_NUMBERS) + " FROM typed")
def medians(spark, sf):
    from ..operators.quantiles import medians_row

    return medians_row(typed(spark, sf), CLEANED_NUMBERS)


@query("AGG8_mode", WITH_TYPED + " SELECT domain FROM typed WHERE domain IS NOT NULL GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 1")
def mode(spark, sf):
    return clean.mode_row(typed(spark, sf), "domain")


@query(
    "JON3_global_fill",
    "SELECT p_partkey, coalesce(CASE WHEN p_size > 10 THEN p_size END, (SELECT median(p_size) FROM part WHERE p_size > 10)) AS size FROM part",
)
def global_fill(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).alias("size"))
    return clean.fill(rows, {"size": "median"})


@query(
    "SCL9_sentinel",
    "SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_size END AS p_size, p_retailprice FROM part",
)
def sentinel(spark, sf):
    return clean.sentinel_to_null(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"), 1, ["p_size", "p_retailprice"])


PROFILE = (
    " SELECT 'total_rows' AS fact, '' AS \"column\", count(*) AS value FROM messy UNION ALL SELECT 'total_columns', '', 9 "
    + " ".join(f"UNION ALL SELECT 'missing_values', '{c}', count(*) - count({c}) FROM messy HAVING count(*) > count({c})" for c in STUDENT_COLUMNS)
    + " UNION ALL SELECT 'duplicate_rows', '', (SELECT count(*) FROM messy) - (SELECT count(*) FROM firsts)"
)


@query("PRF1_profile", WITH_FIRST + PROFILE)
def data_profile(spark, sf):
    return profile.profile(messy(spark, sf))


@query(
    "SET2_distinct_first_seen",
    WITH_MESSY + " SELECT 'domain' AS \"column\", domain AS value, min(_rid) AS first_row FROM messy WHERE domain IS NOT NULL GROUP BY domain "
    "UNION ALL SELECT 'submitted', submitted, min(_rid) FROM messy WHERE submitted IS NOT NULL GROUP BY submitted",
)
def distinct_first(spark, sf):
    return profile.distinct_values(messy(spark, sf), ["domain", "submitted"])


@query(
    "SET3_duplicate_counts",
    WITH_FIRST + " SELECT 'rows' AS what, (SELECT count(*) FROM messy) - (SELECT count(*) FROM firsts) AS duplicates UNION ALL "
    "SELECT 'student_id', (SELECT count(*) FROM messy) - (SELECT count(*) FROM (SELECT DISTINCT student_id FROM messy))",
)
def duplicate_counts(spark, sf):
    rows = messy(spark, sf).drop("_rid")
    a = profile.duplicate_rows(rows).select(F.lit("rows").alias("what"), "duplicates")
    return a.unionByName(profile.duplicate_rows(rows, ["student_id"]).select(F.lit("student_id").alias("what"), "duplicates"))


DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "PRF2_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, "
        f"round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max FROM lineitem"
        for c in DESCRIBED
    ),
)
def describe(spark, sf):
    rounded = ("mean", "std", "q25", "q50", "q75")
    out = profile.describe(table(spark, sf, "lineitem"), DESCRIBED)
    return out.select(*[F.round(c, 4).alias(c) if c in rounded else F.col(c) for c in out.columns])


@query(
    "PRF3_null_and_distinct_counts",
    WITH_MESSY + " ".join(
        f"{'' if i == 0 else 'UNION ALL '} SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(DISTINCT {c}) AS \"distinct\" FROM messy"
        for i, c in enumerate(STUDENT_COLUMNS)
    ),
)
def null_and_distinct(spark, sf):
    rows = messy(spark, sf)
    return profile.null_counts(rows, STUDENT_COLUMNS).join(
        F.broadcast(profile.distinct_counts(rows, STUDENT_COLUMNS)), "column"  # one row per column
    )


def _rule_sql() -> str:
    low = [("attendance_percent in 0..100", "attendance_percent BETWEEN 0 AND 100"), ("score >= 0", "score >= 0"),
           ("study_hours >= 0", "study_hours >= 0"), ("height_cm > 0", "height_cm > 0"), ("weight_kg > 0", "weight_kg > 0"),
           ("submitted is known", "submitted IN ('yes', 'no')"),
           ("domain is known", "domain IN (" + ", ".join(f"'{d}'" for d in DOMAINS) + ")")]
    low += [(f"{c} is present", f"{c} IS NOT NULL") for c in CLEANED_COLUMNS]
    parts = [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT coalesce({e}, false)) AS invalid FROM cleaned" for n, e in low]
    parts.append("SELECT 'student_id is unique', count(*) - count(DISTINCT student_id) FROM cleaned")
    return " SELECT rule, invalid, invalid = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


@query("AGG21_validation", WITH_CLEAN + _rule_sql())
def validation(spark, sf):
    return profile.validate(cleaned(spark, sf), student_rules(), unique=["student_id"])


@query(
    "AGG21_offending_values",
    WITH_CLEAN + " SELECT domain AS value, count(*) AS n FROM cleaned WHERE NOT coalesce(domain IN ('ML', 'Web', 'Electronics', 'Mechanical'), false) GROUP BY domain",
)
def offending(spark, sf):
    return profile.offending_values(cleaned(spark, sf), "domain", DOMAINS)


@query(
    "SNK4_clean_facts",
    WITH_CLEAN + " SELECT (SELECT count(*) FROM messy) AS rows_before, (SELECT count(*) FROM firsts) AS rows_distinct, (SELECT count(*) FROM cleaned) AS rows_after, "
    "(SELECT median(attendance_percent) FROM typed) AS median_attendance, (SELECT median(weight_kg) FROM typed) AS median_weight",
)
def clean_facts(spark, sf):
    before = messy(spark, sf)
    rows = typed(spark, sf)
    from ..operators.quantiles import medians_row

    total = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return medians_row(rows, ["attendance_percent", "weight_kg"]).select(
        total(before).alias("rows_before"), total(rows).alias("rows_distinct"), total(cleaned(spark, sf)).alias("rows_after"),
        F.col("attendance_percent").alias("median_attendance"), F.col("weight_kg").alias("median_weight"),
    )
