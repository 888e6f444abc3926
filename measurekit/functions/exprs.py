"""Scalar building blocks of the cleaners and feature plans.

Every function returns a native Column expression, so the rules stay inside
whole-stage code generation and also run unchanged on streaming frames.
Spark 4 runs in ANSI mode: casts and divisions use their ``try_`` forms.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

# ---- fixed values -----------------------------------------------------------
# Plain decimal numbers only: Spark itself would also take '5d' or 'nan'.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER_PATTERN = r"^[+-]?\d+$"
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
WORD_NUMBERS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5,
    "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
}
YES_TOKENS = ("yes", "y", "true", "1")
DOMAIN_NAMES = {
    "ml": "ML",
    "machine learning": "ML",
    "web": "Web",
    "web dev": "Web",
    "web development": "Web",
    "electronics": "Electronics",
    "mechanical": "Mechanical",
}
STABILITY_LIMITS = (0.05, 0.15)
STABILITY_LABELS = ("stable", "moderate", "unstable")
# -----------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes NULL."""
    text = F.trim(col(c))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def integer(c: str | Column) -> Column:
    """Strict whole number: '8.7' is rejected, not rounded."""
    text = F.trim(col(c))
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("int"))


def whole_or_zero(c: str | Column) -> Column:
    """The number without its decimals; 0 for anything that is not a number or is too large for a whole one."""
    value = number(c)
    whole = F.when(value < 0, F.ceil(value).cast("double")).otherwise(F.floor(value).cast("double"))
    return F.coalesce(F.when(F.abs(value) < 2.0**31, whole).try_cast("int"), F.lit(0))


def null_tokens(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text with missing-value tokens turned into NULL."""
    raw = col(c)
    return F.when(~raw.isin(*tokens) & (F.trim(raw) != ""), F.trim(raw))


def null_if(c: str | Column, *sentinels: float) -> Column:
    value = col(c)
    return F.when(~value.isin(*sentinels), value)


def keep_between(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def equals_text(c: str | Column, word: str) -> Column:
    return F.lower(F.trim(col(c))) == F.lit(word)


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def canonical(c: str | Column, mapping: Mapping[str, str] = DOMAIN_NAMES) -> Column:
    """Canonical spelling of a category; unknown spellings and NULL stay as they are.

    The mapping holds lower-case spellings. A value is looked up after trimming,
    lower-casing and halving double blanks.
    """
    raw = col(c)
    key = F.replace(F.lower(F.trim(raw)), F.lit("  "), F.lit(" "))
    return F.coalesce(F.try_element_at(literal_map(mapping), key), raw)


def percent(c: str | Column, low: float = 0.0, high: float = 100.0) -> Column:
    """'92%' or '92' to 92.0; out-of-range values become NULL."""
    return keep_between(number(F.replace(col(c), F.lit("%"), F.lit(""))), low, high)


def word_number(c: str | Column, words: Mapping[str, int] = WORD_NUMBERS) -> Column:
    text = F.lower(F.trim(col(c)))
    as_double = {word: float(value) for word, value in words.items()}
    return F.coalesce(F.try_element_at(literal_map(as_double), text), number(text))


def length_cm(c: str | Column) -> Column:
    """'170 cm', '1.62 m' or a bare number of centimetres."""
    text = F.lower(F.trim(col(c)))
    return (
        F.when(text.endswith("cm"), number(F.replace(text, F.lit("cm"), F.lit(""))))
        .when(text.endswith("m"), number(F.replace(text, F.lit("m"), F.lit(""))) * F.lit(100.0))
        .otherwise(number(text))
    )


def mass_kg(c: str | Column) -> Column:
    return number(F.replace(F.lower(F.trim(col(c))), F.lit("kg"), F.lit("")))


def yes_no(c: str | Column, yes: Iterable[str] = YES_TOKENS) -> Column:
    """Two-valued text; NULL and everything unrecognised count as 'no'."""
    return F.when(F.lower(F.trim(col(c))).isin(*yes), F.lit("yes")).otherwise(F.lit("no"))


def bucket(c: str | Column, limits: Sequence[float], labels: Sequence[str], unknown: str) -> Column:
    """Label by inclusive upper limits; one more label than limits; NULL gives ``unknown``."""
    value = col(c)
    chain = F.when(value.isNull(), F.lit(unknown))
    for limit, label in zip(limits, labels):
        chain = chain.when(value <= F.lit(limit), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def stability(cv: str | Column) -> Column:
    return bucket(cv, STABILITY_LIMITS, STABILITY_LABELS, "unknown")


def safe_ratio(a: str | Column, b: str | Column, digits: int | None = 6) -> Column:
    """a / b, NULL when b is NULL or zero."""
    ratio = F.try_divide(col(a), col(b))
    return ratio if digits is None else F.round(ratio, digits)


def percent_error(actual: str | Column, expected: str | Column, digits: int = 4) -> Column:
    a, e = col(actual), col(expected)
    return F.round(F.try_divide(a - e, e) * F.lit(100.0), digits)


def gated(condition: Column, value: Column) -> Column:
    """The value where the condition holds, NULL elsewhere."""
    return F.when(condition, value)


def bracket_midpoint(c: str | Column, open_label: str = "101+", open_value: float = 110.0) -> Column:
    """'$10-$20' to 15.0; the open-ended top bracket has a fixed midpoint."""
    text = F.replace(F.trim(col(c)), F.lit("$"), F.lit(""))
    low = number(F.split_part(text, F.lit("-"), F.lit(1)))
    high = number(F.split_part(text, F.lit("-"), F.lit(2)))
    return F.when(text == F.lit(open_label), F.lit(open_value)).otherwise((low + high) / F.lit(2.0))


#: Limits of a logit, and distance of a probability from 0 and 1 in a loss.
CLIP, EPSILON = 500.0, 1e-12


def sigmoid(z: Column) -> Column:
    bounded = F.greatest(F.least(z, F.lit(CLIP)), F.lit(-CLIP))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded))


def log_loss_term(y: Column, p: Column, eps: float = EPSILON) -> Column:
    """Cross-entropy of one row with the probability kept inside (eps, 1 - eps)."""
    q = F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))
    return -(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))


def confidence(probability_array: Column, digits: int = 4) -> Column:
    return F.round(F.array_max(probability_array), digits)


def overfit(train: Column, validation: Column, gap: float = 0.05) -> Column:
    return F.when(train - validation > F.lit(gap), F.lit("overfit")).otherwise(F.lit("ok"))


def weighted_sum(columns: Sequence[str | Column], weights: Sequence[float], bias: float = 0.0) -> Column:
    """bias + sum(w * x) as one plain arithmetic expression."""
    total = F.lit(float(bias))
    for c, w in zip(columns, weights):
        total = total + col(c) * F.lit(float(w))
    return total
