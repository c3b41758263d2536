"""Text functions as Spark column expressions (no Python UDFs).

All of them stay inside whole-stage code generation; they are applied to
distinct names where possible (for example once per package row, before a
join fans the rows out).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()`` for ASCII text without spaces (cleaned names):
    the first letter of every run of letters upper case, the rest lower
    case (``12hr`` -> ``12Hr``).  Spark's ``initcap`` starts words only
    after spaces, so a space is put before every letter run that follows
    another character, ``initcap`` cases the words, and the spaces are
    taken out again.  Plain expressions (no lambdas), so identical plans
    stay identical and Spark can reuse their shuffles."""
    spaced = F.regexp_replace(_col(c), r"(\P{Alpha})(\p{Alpha})", "$1 $2")
    return F.regexp_replace(F.initcap(spaced), " ", "")


def normalize_name(c: ColumnOrName, case: str = "camel", spaces: bool = False) -> Column:
    """Clean a name for use as a state or file name.

    Every character outside ``[A-Za-z0-9]`` becomes ``_``, runs of ``_``
    collapse to one, one trailing ``_`` is removed (a leading one stays),
    then the case is set: ``lower``, ``upper`` or ``camel`` (title case);
    any other value keeps the case.  ``spaces`` turns ``_`` into spaces.
    """
    # One pass for "non-alphanumeric -> _" and "collapse runs of _": a run
    # of non-alphanumeric characters (underscores included) becomes one _.
    # \P{Alnum} is the POSIX (ASCII) class, the same set as [^a-zA-Z0-9],
    # and much faster in Java's regex engine.
    out = F.regexp_replace(_col(c), r"\P{Alnum}+", "_")
    out = F.regexp_replace(out, "_$", "")
    if case == "lower":
        out = F.lower(out)
    elif case == "upper":
        out = F.upper(out)
    elif case == "camel":
        out = title_case(out)
    if spaces:
        out = F.regexp_replace(out, "_", " ")
    return out


def code_key(c: ColumnOrName) -> Column:
    """A product code as join key: text without surrounding spaces, and a code of
    digits only without leading zeros, so that '007' and 7 are one code and a
    code with letters is a code like any other."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise(text)


def text_to_int_prefix(c: ColumnOrName) -> Column:
    """Text-to-integer cast with the rules of an SQL engine that reads the
    leading integer: ``'30.00'`` -> 30, ``'abc'`` -> 0, ``'1e2'`` -> 1,
    ``' 7 '`` -> 7, null -> null."""
    c = _col(c)
    digits = F.nullif(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1), F.lit(""))
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(
        F.coalesce(digits.try_cast("int"), F.lit(0)))


def text_greater(c: ColumnOrName, value: str) -> Column:
    """Comparison of text with text (``'00' > '0'`` is true, ``'-15'`` is not)."""
    return _col(c) > F.lit(value)


def decode_gender(c: ColumnOrName) -> Column:
    """Sex code to gender, comparing text: '1' -> M, '2' -> F, else null."""
    c = _col(c)
    return F.when(c == F.lit("1"), F.lit("M")).when(c == F.lit("2"), F.lit("F"))


def none_text(c: ColumnOrName) -> Column:
    """Stringify with null shown as ``'None'`` (the survey join's key form)."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def remark_line(index: ColumnOrName, share: ColumnOrName, name: ColumnOrName) -> Column:
    """``'{i}. [ {share*100 rounded to 2}% ] {name}'``."""
    pct = F.bround(_col(share) * F.lit(100.0), 2).cast("string")
    return F.concat(_col(index).cast("string"), F.lit(". [ "), pct, F.lit("% ] "), _col(name))


def json_key_values(c: ColumnOrName, key: str) -> Column:
    """All scalar values stored under ``key`` at any depth of a JSON text.

    Values that are objects or arrays are not returned (their contents are
    searched instead, as every key is matched wherever it occurs).  Strings
    come back decoded, a JSON null as null, numbers in Java's notation of their
    value.  ``operators.json_search`` parses the document and keeps all digits.
    """
    import re

    pattern = (r'(?<!\\)"' + re.escape(key) + r'"\s*:\s*'
               r'("(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|true|false|null)')
    found = F.regexp_extract_all(_col(c), F.lit(pattern), 1)
    return F.transform(found, lambda v: F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v"))
