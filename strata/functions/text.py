"""String cleaning and text-to-number parsing as Column expressions (O8h, O13, O15, O16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col

# Unicode white space at either end ((?U) makes \s the Unicode White_Space property,
# so tab, newline, no-break space and em space are all removed, as a Unicode strip does).
_EDGE_SPACE = r"(?U)^\s+|\s+$"

# The words that read as true / false.
TRUE_WORDS = ("yes", "included")
FALSE_WORDS = ("no", "not included")

# A number the way Python's float() reads it after the caller removed ',' and '$':
# optional sign, digits with optional '_' groups, fraction, exponent, or inf/nan words.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_FLOAT_TEXT = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def strip(c) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(as_col(c).cast("string"), _EDGE_SPACE, "")


def strip_lower(c) -> Column:
    """Strip, then lower-case."""
    return F.lower(strip(c))


def to_boolean(c) -> Column:
    """yes/included -> true, no/not included -> false, anything else -> null."""
    words = [x for w, v in [*((w, True) for w in TRUE_WORDS), *((w, False) for w in FALSE_WORDS)] for x in (F.lit(w), F.lit(v))]
    return F.try_element_at(F.create_map(*words), F.lower(strip(c)))  # the word is made once


def parse_float(c) -> Column:
    """O8h: a double from text after dropping ',' and '$' and trimming; null if unparsable."""
    text = strip(F.translate(as_col(c).cast("string"), ",$", ""))
    return F.when(text.rlike(_FLOAT_TEXT), F.regexp_replace(text, "_", "").try_cast("double"))


def parse_int(c) -> Column:
    """O8h: an integer from *all* digits of the text, concatenated ("1.5" -> 15)."""
    digits = F.regexp_replace(as_col(c).cast("string"), "[^0-9]", "")
    return F.when(F.length(digits) > 0, digits.try_cast("int"))


def non_blank(c) -> Column:
    """True when the value is present and not only white space."""
    col = as_col(c)
    return col.isNotNull() & (F.length(strip(col)) > 0)
