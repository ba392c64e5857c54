"""Scalar column expressions, all built from native functions.

None of them leaves the JVM, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank at either end of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: a text that reads as a number.  Spark's own cast also takes Java
# suffixes ("1.0f") and hexadecimal floats, which are not numbers here.
NUMBER_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"
# How feeds write dates other than year first, and how to read them.
DATE_FORMS = {
    r"^\d{8}$": "yyyyMMdd",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^[A-Za-z]{3} \d{1,2}, \d{4}$": "MMM d, yyyy",
    r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$": "MMMM d, yyyy",
    r"^\d{1,2} [A-Za-z]{3} \d{4}$": "d MMM yyyy",
    r"^\d{1,2} [A-Za-z]{4,9} \d{4}$": "d MMMM yyyy",
}
# Fixed value: the en dash between the two halves of a score.
SCORE_DASH = "\u2013"


def strip_text(text: Column) -> Column:
    """Remove blanks, Unicode ones included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def coerce_number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    stripped = strip_text(text.cast("string"))
    return F.when(stripped.rlike(NUMBER_TEXT), stripped.try_cast("double"))


def without_thousands(text: Column) -> Column:
    """Drop the thousands separators of a figure such as ``60,704``."""
    return F.replace(text, F.lit(","), F.lit(""))


def coerce_date(text: Column) -> Column:
    """Text or timestamp to date; what does not parse, or holds a time only, becomes NULL."""
    stripped = strip_text(text.cast("string"))
    year_first = F.when(stripped.rlike(r"^[+-]?\d{4}"), stripped.try_cast("timestamp"))
    others = [
        F.when(stripped.rlike(pattern), F.try_to_timestamp(stripped, F.lit(form)))
        for pattern, form in DATE_FORMS.items()
    ]
    return F.coalesce(year_first, *others).cast("date")


def number_or_zero(number: Column) -> Column:
    """NULL and NaN both count as 0.0."""
    value = number.cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def count_or_zero(number: Column) -> Column:
    """NULL, NaN and what no counter can hold count as 0; fractions are cut off towards zero."""
    return F.coalesce(number_or_zero(number).try_cast("bigint"), F.lit(0).cast("bigint"))


def count_where(condition: Column) -> Column:
    """Aggregate: rows for which the condition holds.

    ``count_if`` of a compound condition plans as a shared sub-expression, and the
    optimizer then stops moving filters down; a plain CASE does not.
    """
    return F.count(F.when(condition, True))


def safe_ratio(made: Column, attempted: Column) -> Column:
    """made / attempted, or NULL where nothing was attempted."""
    return F.when(attempted > 0, made / attempted)


def round_to(number: Column, digits: int) -> Column:
    """Round half away from zero on the binary value.

    ``F.round(x, n)`` rounds the shortest decimal text of x instead and so
    differs from most other engines on values such as 2.675.
    """
    scale = float(10**digits)
    return F.round(number * scale) / scale


def derive_result(home: Column, away: Column) -> Column:
    """H, D or A; NULL while either score is missing."""
    return F.when(home > away, "H").when(home < away, "A").when(home == away, "D")


def presence_flag(value: Column) -> Column:
    """True for anything but NULL and the empty text."""
    return value.isNotNull() & (F.coalesce(value.cast("string"), F.lit("")) != "")


def truth_flag(value: Column) -> Column:
    """A present value that does not itself say no (0, false, n, no)."""
    text = F.lower(strip_text(value.cast("string")))
    says_no = text.isin("0", "0.0", "false", "f", "no", "n")
    return presence_flag(value) & ~F.coalesce(says_no, F.lit(False))


def hash_id(*parts: Column) -> Column:
    """First twelve hex digits of the MD5 of the parts joined by ``_``."""
    kept = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.substring(F.md5(F.concat_ws("_", *kept)), 1, 12)


def slug(text: Column) -> Column:
    """Lower case with underscores for spaces, as used in dataset names."""
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def score_part(score: Column, part: int, dash: str = SCORE_DASH) -> Column:
    """One half of a score text as a number; shoot-out notation gives NULL."""
    return coerce_number(F.split_part(score, F.lit(dash), F.lit(part)))


def absolute_url(href: Column, base: str) -> Column:
    """Put the site address before a relative link."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))
