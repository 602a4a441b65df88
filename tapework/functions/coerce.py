"""How single values are read: from text, from variants, and from the marked texts of an event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A decimal as events write it; the largest unsigned 64-bit integer; the largest time in milliseconds.
DECIMAL = r"(?s)^(?<sign>-?)(?<whole>[0-9]*)(?:[.](?:(?<long>[0-9]{18}).*|(?<short>[0-9]{0,17})))?\z"
MOST_UNSIGNED, MOST_MILLIS = "18446744073709551615", 8_200_000_000_000_000


def decimal_trunc18(text: Column) -> Column:
    """decimal(38,18) of a plain decimal number, cut off after 18 places; null for anything else and for more than 20 whole digits."""
    built = F.regexp_replace(text, DECIMAL, "${sign}0${whole}.${long}${short}")
    long = F.when(text.rlike(DECIMAL) & text.rlike(r"^-?[.]?[0-9]"), built.try_cast("decimal(38,18)"))
    # Up to 19 characters there is nothing to cut off, and a cast accepts the same texts; most values take this way, which builds no text.
    short = (F.length(text) <= 19) & text.rlike(r"^-?[0-9]*[.]?[0-9]*\z")
    return F.when(short, text.try_cast("decimal(38,18)")).otherwise(long)


def _bare_integer(text: Column) -> Column:
    """bigint of digits with or without a sign; null for anything else. A cast would also accept space around them."""
    return F.when(F.substring(text, 1, 1).between("+", "9") & F.substring(text, -1, 1).between("0", "9"), text.try_cast("bigint"))


def u64_or_zero(text: Column) -> Column:
    """decimal(20,0) of an unsigned 64-bit integer; 0 for anything else."""
    small = _bare_integer(text)
    number = F.when(text.rlike(r"^[+]?[0-9]+\z"), F.regexp_replace(text, "^[+]", "").try_cast("decimal(38,0)"))
    large = F.when(number <= F.lit(MOST_UNSIGNED).cast("decimal(38,0)"), number.cast("decimal(20,0)"))
    return F.coalesce(F.when(small >= 0, small.cast("decimal(20,0)")), large, F.lit(0).cast("decimal(20,0)"))


def i64_or_zero(text: Column) -> Column:
    return F.coalesce(_bare_integer(text), F.lit(0).cast("bigint"))


def millis_or(milliseconds: Column, received_at: Column, zero: Column) -> Column:
    """The time; zero's value for 0; the receive time out of range."""
    inside = F.abs(milliseconds) <= MOST_MILLIS
    return F.when(milliseconds == 0, zero).when(inside, F.timestamp_millis(F.when(inside, milliseconds))).otherwise(received_at)


def epoch() -> Column:
    return F.timestamp_millis(F.lit(0).cast("bigint"))


def present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def quoted(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def text_of(v: Column) -> Column:
    """A quoted or bare value as text; null if missing."""
    return F.when(present(v), F.try_variant_get(v, "$", "string"))


#: Stands before every quoted value of a marked JSON text, so that a value read as text still tells whether it was quoted.
MARK = "~"
_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'


def marked(json: Column) -> Column:
    """A JSON object's text with MARK inside each quoted value, keys as they are.

    A colon and a quote begin a value, unless the quote ends a text whose last character is a colon. Where that may be, or where there is space around colons, strings are told apart one by one.
    """
    every = F.regexp_replace(json, f'"({_STRING})"', f'"{MARK}$1"')
    exact = F.regexp_replace(every, rf'(?<!\\)"{MARK}({_STRING})"(\s*+:)', '"$1"$2')
    return F.when(json.rlike(r':(?:\s|"[,:\]}\s])'), exact).otherwise(F.replace(json, F.lit(':"'), F.lit(f':"{MARK}')))


def unquoted(value: Column) -> Column:
    """The text of a marked value that was quoted; null for others."""
    return F.when(F.startswith(value, F.lit(MARK)), F.substring(value, 2, 1 << 30))


def unmarked(value: Column) -> Column:
    """The text of a marked value, quoted or bare."""
    return F.coalesce(unquoted(value), value)


def read(value: Column, rule: str, spot: bool, received_at: Column, text: Column, number: Column | None = None) -> Column:
    """A marked value by a rule of the table registry; spot and futures rules differ for decimals and times. text: what it holds, of decimals and strings only if quoted; number: its integer, where at hand.

    For j the value is a variant.
    """
    if rule == "s":
        return F.coalesce(text, F.lit(""))
    if rule == "d":
        decimal = decimal_trunc18(text)
        return F.coalesce(decimal, F.lit(0).cast("decimal(38,18)")) if spot else decimal
    if rule == "u":
        return u64_or_zero(text)
    if rule == "i":
        return i64_or_zero(text)
    if rule in ("oi", "st"):
        return F.when(value.isNotNull(), i64_or_zero(text).try_cast("int"))
    if rule in ("b0", "b1"):
        return F.when(value.isin("true", "false"), value == "true").otherwise(rule == "b1")
    if rule == "t":
        return millis_or(i64_or_zero(text) if number is None else number, received_at, received_at if spot else epoch())
    if rule == "j":
        return F.when(present(value), F.to_json(value)).otherwise("[]")
    raise ValueError(f"unknown rule {rule}")


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def human_bytes(n: Column) -> Column:
    """A size in steps of 1024, with one place: 1536 is 1.5 KiB."""
    size = n.cast("double")
    out = F.format_string("%.1f TiB", size / 1024**4)
    for k, unit in ((3, "GiB"), (2, "MiB"), (1, "KiB"), (0, "B")):
        out = F.when(size < 1024.0 ** (k + 1), F.format_string(f"%.1f {unit}", size / 1024**k)).otherwise(out)
    return out
