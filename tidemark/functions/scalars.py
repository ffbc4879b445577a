"""Column expressions over identifiers, versions, booleans, URLs and literals.

Everything here is a native expression, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quote character and the text that replaces a quote inside a
# name. None means that the dialect does not escape.
IDENTIFIER_QUOTES = {
    "backtick": ("`", "\\`"),
    "double": ('"', None),
    "spark": ("`", "``"),
}

DOTTED_NUMBER = r"^[0-9]+([._][0-9]+)*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_ident(parts: list[Column | str], dialect: str = "backtick") -> Column:
    """Quote each part of a name and join the parts with a dot."""
    quote, escaped = IDENTIFIER_QUOTES[dialect]

    def quoted(part: Column) -> Column:
        body = part if escaped is None else F.replace(part, F.lit(quote), F.lit(escaped))
        return F.concat(F.lit(quote), body, F.lit(quote))

    return F.concat_ws(".", *[quoted(_col(p)) for p in parts])


def unquote_ident(s: Column | str) -> Column:
    """Remove one pair of surrounding quotes; null stays null."""
    return F.regexp_replace(_col(s), r'^(?s)["`](.*)["`]$', "$1")


def version_text(v: Column | str) -> Column:
    """Canonical spelling of a dotted version: ``001`` and ``1.0`` become ``1``.

    Null where the text is not a dotted number.
    """
    v = F.trim(_col(v))
    shortened = F.regexp_replace(v, r"([._]0+)+$", "")
    dotted = F.regexp_replace(shortened, "_", ".")
    no_zeros = F.regexp_replace(dotted, r"(^|\.)0+(?=[0-9])", "$1")
    return F.when(v.rlike(DOTTED_NUMBER), no_zeros)


def version_key(v: Column | str) -> Column:
    """Version as an array of numbers; arrays compare element by element."""
    return F.transform(F.split(version_text(v), r"\."), lambda x: x.try_cast("bigint"))


def version_at_least(v: Column | str, minimum: Column | str) -> Column:
    """Is ``v`` the minimum version or a later one?"""
    low = F.lit(minimum) if isinstance(minimum, str) else minimum
    return version_key(v) >= version_key(low)


def version_from_text(s: Column | str) -> Column:
    """Second word of a version comment, or null when there is none."""
    s = _col(s)
    return F.when(F.trim(s) != "", F.get(F.split(s, " "), F.lit(1)))


def version_with_build(v: Column | str, build: Column | str) -> Column:
    """Append a build number; null when either part is missing."""
    return F.concat(_col(v), F.lit("."), _col(build).cast("string"))


def to_bool(value: Column | str, strict: bool = False) -> Column:
    """Read 1/0 and true/false in any case as a boolean, anything else as null.

    With ``strict`` a non-null value that cannot be read fails the query.
    """
    text = F.lower(F.trim(_col(value).cast("string")))
    unreadable = F.lit(None).cast("boolean")
    if strict:
        message = F.concat(F.lit("not a boolean: "), text)
        unreadable = F.when(text.isNotNull(), F.raise_error(message).cast("boolean"))
    return (
        F.when(text.isin("1", "true"), F.lit(True))
        .when(text.isin("0", "false"), F.lit(False))
        .otherwise(unreadable)
    )


def needs_user(url: Column | str) -> Column:
    """The URL carries no user name."""
    return ~F.contains(_col(url), F.lit("user="))


def needs_password(url: Column | str) -> Column:
    """The URL carries no password."""
    return ~F.contains(_col(url), F.lit("password="))


def unescape_sql_string(s: Column | str) -> Column:
    """Value of a quoted SQL string; text without quotes is returned as it is."""
    s = _col(s)
    inner = F.substring(s, F.lit(2), F.length(s) - 2)
    return F.when(s.rlike(r"^(?s)'.*'$"), F.replace(inner, F.lit("''"), F.lit("'"))).otherwise(s)


def split_args(s: Column | str) -> Column:
    """Split on the commas outside single quotes and trim the parts.

    One forward pass over the text: each match is a comma, the first one put
    before the text, followed by quoted runs and plain runs. A lone quote is an
    ordinary character.
    """
    pattern = r",((?:'[^']*+'|[^',]++|')*+)"
    parts = F.regexp_extract_all(F.concat(F.lit(","), _col(s)), F.lit(pattern), F.lit(1))
    return F.transform(parts, lambda p: F.trim(p))


def or_default(value: Column | str, default: Column | str) -> Column:
    """Null or blank text becomes the default."""
    value = _col(value)
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.when(F.trim(value) != "", value).otherwise(fallback)


def iso_timestamp(s: Column | str) -> Column:
    """ISO-8601 text with a zone, such as ``2025-05-09T00:01:00.000000Z``."""
    return F.to_timestamp(_col(s))


def cast_or_null(value: Column, source: T.DataType, target: str) -> Column:
    """Cast that gives null for a value that does not fit.

    A failed cast of text costs an exception per row. No text with a letter,
    a point or nothing but spaces is a whole number, so these never get there.
    """
    cast = value.try_cast(target)
    whole = target.lower() in ("tinyint", "smallint", "int", "integer", "bigint", "long")
    if not (whole and isinstance(source, T.StringType)):
        return cast
    return F.when(value.rlike(r"[0-9]") & ~value.rlike(r"[A-Za-z.]"), cast)
