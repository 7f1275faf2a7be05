"""Field parsers for messy catalogue text, as Spark Column expressions.

Each function maps a string Column to a typed Column.  Everything runs inside
whole-stage codegen or JVM higher-order functions; nothing calls Python per row.
Spark runs with ANSI mode on, so casts are ``try_cast`` and element access is
``try_element_at``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as missing (compared after strip + lower).
MISSING_TOKENS = ["", "nan", "none", "null", "<na>", "n/a"]

# Weight unit -> grams.
WEIGHT_UNITS = {
    "g": 1.0, "gram": 1.0, "grams": 1.0, "gm": 1.0, "gms": 1.0,
    "kg": 1000.0, "kilogram": 1000.0, "kilograms": 1000.0,
    "mg": 0.001, "milligram": 0.001,
    "oz": 28.3495, "ounce": 28.3495, "ounces": 28.3495,
    "lb": 453.592, "lbs": 453.592, "pound": 453.592, "pounds": 453.592,
}
# The profiler's variant lacks the two shorthand gram spellings.
WEIGHT_UNITS_LENIENT = {u: f for u, f in WEIGHT_UNITS.items() if u not in ("gm", "gms")}

# Patterns.
NUMBER_PATTERN = r"[\d,]+\.?\d*"
WEIGHT_PATTERN = r"([\d.,]+)\s*([a-zA-Z]+)"
RATING_PATTERN = r"([\d.]+)\s*out of\s*5"
SENTINEL_PATTERN = r"^9{6,}(\.0+)?$"
# A plain decimal number as Python's float() reads it (Spark's cast also takes
# suffixes such as "4.5d", which Python rejects).
FLOAT_TEXT_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Remove leading and trailing whitespace, Unicode included (Spark's trim only removes spaces)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def is_missing(x) -> Column:
    """Null, or one of the missing tokens after strip + lower."""
    x = _c(x)
    return x.isNull() | F.lower(strip(x)).isin(*MISSING_TOKENS)


def _float_text(s: Column) -> Column:
    """try_cast of text that Python's float() would also accept, else null."""
    return F.when(s.rlike(FLOAT_TEXT_PATTERN), s.try_cast("double"))


def parse_price(x, lenient: bool = False) -> Column:
    """Mean of every number in the text (ranges give their midpoint), commas dropped.

    Strict form: missing tokens give null and a mean <= 0 gives null.  Lenient
    form (profiler): only a null input is missing and any mean is kept.  A bare
    comma matches the number pattern but is not a number; it is ignored.
    """
    x = _c(x)
    nums = F.transform(F.regexp_extract_all(x, F.lit(NUMBER_PATTERN), 0),
                       lambda m: F.replace(m, F.lit(","), F.lit("")).try_cast("double"))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))

    def merge(acc, v):
        return F.when(v.isNull(), acc).otherwise(
            F.struct((acc["s"] + v).alias("s"), (acc["n"] + 1).alias("n")))

    def finish(acc):
        mean = acc["s"] / acc["n"]
        return F.when(acc["n"] > 0, mean) if lenient else F.when((acc["n"] > 0) & (mean > 0), mean)

    value = F.aggregate(nums, zero, merge, finish)
    return F.when(x.isNotNull(), value) if lenient else F.when(~is_missing(x), value)


def _unit_map(units: dict) -> Column:
    return F.create_map(*[t for u, f in units.items() for t in (F.lit(u), F.lit(f))])


def parse_weight(x, sentinel: float = 1_000_000.0, lenient: bool = False) -> Column:
    """Grams from the FIRST number+unit pair; unknown or no unit gives null.

    Strict form also nulls weights <= 0 g or >= the sentinel.
    """
    x = _c(x)
    low = F.lower(x)
    found = low.rlike(WEIGHT_PATTERN)
    qty = F.replace(F.regexp_extract(low, WEIGHT_PATTERN, 1), F.lit(","), F.lit(""))
    qty = _float_text(qty)
    factor = F.try_element_at(_unit_map(WEIGHT_UNITS_LENIENT if lenient else WEIGHT_UNITS),
                              F.regexp_extract(low, WEIGHT_PATTERN, 2))
    grams = qty * factor
    if lenient:
        return F.when(x.isNotNull() & found, grams)
    return F.when(~is_missing(x) & found & (grams > 0) & (grams < F.lit(sentinel)), grams)


def parse_rating(x, lenient: bool = False) -> Column:
    """A plain number or prose such as '3.5 out of 5' as a number; outside [0, 5] -> null.

    Lenient form (profiler): the 'out of 5' branch has no range check.
    """
    x = _c(x)
    matched = x.rlike(RATING_PATTERN)
    from_prose = _float_text(F.regexp_extract(x, RATING_PATTERN, 1))
    plain = _float_text(strip(x))
    in_range = lambda v: F.when((v >= 0) & (v <= 5), v)
    if lenient:
        return F.when(x.isNotNull(), F.when(matched, from_prose).otherwise(in_range(plain)))
    return F.when(~is_missing(x), in_range(F.when(matched, from_prose).otherwise(plain)))


def parse_percentage(x) -> Column:
    """Keep digits and dots, read as a number; outside [0, 100] -> null."""
    x = _c(x)
    digits = F.regexp_replace(x, r"[^\d.]", "")
    v = _float_text(digits)
    return F.when(~is_missing(x) & (v >= 0) & (v <= 100), v)


def parse_dict(x) -> Column:
    """Text of a dict literal ``{'Cat': '#1,793'}`` (or a JSON object) as map<string,string>.

    Anything else gives null.  Single quotes are accepted by Spark's JSON reader.
    """
    x = _c(x)
    return F.when(~is_missing(x), F.from_json(x, "map<string,string>",
                                               {"allowSingleQuotes": "true"}))


def category_key(x, parsed: bool = False) -> Column:
    """Last non-blank key of the dict text, stripped (``parsed``: x is already the map)."""
    m = _c(x) if parsed else parse_dict(x)
    keys = F.filter(F.map_keys(m), lambda k: strip(k) != "")
    return strip(F.try_element_at(keys, F.lit(-1)))


def category_rank(x, parsed: bool = False) -> Column:
    """Digits of the dict's last value as a number; none -> null."""
    m = _c(x) if parsed else parse_dict(x)
    last = F.try_element_at(F.map_values(m), F.lit(-1))
    digits = F.regexp_replace(F.coalesce(last, F.lit("")), r"[^\d]", "")
    return F.when(digits != "", digits.try_cast("double"))


def split_multi(x, sep: str = "|") -> Column:
    """Lower-cased, stripped, non-empty parts of a delimited list; missing -> empty array."""
    x = _c(x)
    parts = F.filter(F.transform(F.split(x, "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep),
                                 lambda p: F.lower(strip(p))),
                     lambda p: p != "")
    return F.when(is_missing(x), F.array().cast("array<string>")).otherwise(parts)


def first_of_multi(x, sep: str = "|") -> Column:
    return F.try_element_at(split_multi(x, sep), F.lit(1))


def clean_text(x) -> Column:
    """Lower-case, URLs and non [a-z0-9] characters to spaces, collapse, trim; missing -> ''."""
    x = _c(x)
    s = F.lower(x)
    s = F.regexp_replace(s, r"https?://\S+", " ")
    s = F.regexp_replace(s, r"[^a-z0-9\s]", " ")
    s = strip(F.regexp_replace(s, r"\s+", " "))
    return F.when(is_missing(x), F.lit("")).otherwise(s)


def clean_categorical(x) -> Column:
    """Strip + lower; missing -> null."""
    x = _c(x)
    s = F.lower(strip(x))
    return F.when(~is_missing(x) & (s != ""), s)


def list_price(price, discount) -> Column:
    """Price before discount, when both are known and the discount is under 100 %."""
    price, discount = _c(price), _c(discount)
    return F.when(price.isNotNull() & discount.isNotNull() & (discount < 100),
                  price / (F.lit(1.0) - discount / F.lit(100.0)))


def text_concat(name, keywords) -> Column:
    return strip(F.concat(clean_text(name), F.lit(" "), clean_text(keywords)))


def yn_flag(x) -> Column:
    """1.0 when the text is 'Y' after strip + upper, else 0.0 (null too)."""
    return F.coalesce((F.upper(strip(_c(x))) == "Y").cast("double"), F.lit(0.0))


def to_number(x) -> Column:
    """Lenient number: plain numeric text -> double, anything else -> null."""
    return _float_text(strip(_c(x)))


def review_count(x) -> Column:
    """Digits of the text as a number; none -> null."""
    digits = F.regexp_replace(_c(x).cast("string"), r"[^\d]", "")
    return F.when(digits != "", digits.try_cast("double"))


def is_sentinel(x) -> Column:
    """Whole text (stripped, lower) is a run of 6+ nines, optionally '.0…'."""
    return F.coalesce(F.lower(strip(_c(x))).rlike(SENTINEL_PATTERN), F.lit(False))
