"""Scalar expressions. All are built-in Spark functions, so they stay inside code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.constants import (
    LANGUAGE_EXTENSION,
    LANGUAGE_FORMAT,
    NAME_CUT,
    SECRET_KEYS,
    SEVERITIES,
)


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_blank(value: Column | str) -> Column:
    """Null or empty string."""
    return F.coalesce(_c(value).cast("string"), F.lit("")) == ""


def array_length(value: Column | str) -> Column:
    """Element count, 0 for a missing array."""
    return F.greatest(F.coalesce(F.size(_c(value)), F.lit(0)), F.lit(0))


def first_upper(value: Column | str) -> Column:
    """First letter upper-cased, the rest unchanged (unlike ``initcap``)."""
    c = _c(value)
    return F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))


def replace_ci(value: Column | str, search: str, replacement: str) -> Column:
    """Replace every occurrence, ignoring case; ``search`` is plain text."""
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(value), "(?i)" + re.escape(search), literal)


def cut_name(value: Column | str) -> Column:
    """Text after the first ``/``, cut to 50 characters *before* the closing ``')]`` is removed.

    The order matters: a name of 48 or 49 characters keeps part of the closing text.
    """
    c = _c(value)
    return F.replace(c.substr(F.instr(c, "/") + 1, F.lit(NAME_CUT)), F.lit("')]"), F.lit(""))


def clean_name(value: Column | str) -> Column:
    """Text between the first ``/`` (or the start, when there is none) and the last ``'``; null without such text."""
    c = _c(value)
    slash = F.instr(c, "/")
    quote = F.length(c) - F.length(F.substring_index(c, "'", -1))
    return F.when((quote > 0) & (quote > slash), c.substr(slash + 1, quote - slash - 1))


def clean_type(value: Column | str) -> Column:
    """Text after the last ``/``."""
    return F.substring_index(_c(value), "/", -1)


def key_name(value: Column | str) -> Column:
    """Second part of a ``type|name`` key."""
    return F.split_part(_c(value), F.lit("|"), F.lit(2))


def words(value: Column | str) -> Column:
    """Split on one blank; empty tokens are kept."""
    return F.split(_c(value), " ", -1)


def first_dot_extension(name: Column | str) -> Column:
    """Text after the *first* dot: ``a.b.csv`` gives ``b.csv``; the whole name when there is no dot."""
    c = _c(name)
    return c.substr(F.instr(c, ".") + 1, F.length(c))


def dataset_name(path: Column | str) -> Column:
    """File name without directory and last extension, blanks removed."""
    base = F.regexp_replace(F.regexp_replace(_c(path), "^.*/", ""), "\\.[^.]*$", "")
    return F.replace(base, F.lit(" "), F.lit(""))


def landing_parts(ts: Column | str, hour24: bool = False) -> dict[str, Column]:
    """Year, Month, Day, Hour text of one timestamp.

    The hour is on a 12-hour clock by default, so 03:00 and 15:00 share a folder; ``hour24`` separates them.
    """
    c = _c(ts)
    return {
        "Year": F.date_format(c, "yyyy"),
        "Month": F.date_format(c, "MM"),
        "Day": F.date_format(c, "dd"),
        "Hour": F.date_format(c, "HH" if hour24 else "hh"),
    }


def landing_folder(ts: Column | str, hour24: bool = False) -> Column:
    """``Year=…/Month=…/Day=…/Hour=…``."""
    parts = landing_parts(ts, hour24)
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), v) for k, v in parts.items()])


def add_days(ts: Column | str, days: int) -> Column:
    return _c(ts) + F.make_dt_interval(F.lit(days))


def run_date(value: Column | str | None, type_name: str = "timestamp") -> Column:
    """``yyyy-MM-dd`` text to a timestamp; an empty string gives null."""
    c = F.lit(value) if value is None or isinstance(value, str) else value
    return F.to_timestamp(F.nullif(c, F.lit("")), "yyyy-MM-dd").cast(type_name)


def log_line(ts: Column | str, message: Column | str) -> Column:
    return F.concat_ws("|", F.date_format(_c(ts), "dd/MM/yyyy HH:mm:ss"), _c(message))


def log_line_time(line: Column | str) -> Column:
    return F.to_timestamp(F.substring_index(_c(line), "|", 1), "dd/MM/yyyy HH:mm:ss")


def log_line_message(line: Column | str) -> Column:
    """Everything after the first bar; the message itself may hold bars."""
    c = _c(line)
    return F.when(F.instr(c, "|") > 0, c.substr(F.instr(c, "|") + 1, F.length(c)))


def two_digits(key: Column | str, seed: int) -> Column:
    """First two digits of a repeatable pseudo-random number (seeded, so that retries agree)."""
    positive = F.xxhash64(_c(key), F.lit(seed)).bitwiseAND(F.lit(2**63 - 1))
    return F.substring(positive.cast("string"), 1, 2)


def fk_table(name: Column | str) -> Column:
    """Table part of a foreign key name: ``FK_`` removed, text before the first ``_``, else empty."""
    c = replace_ci(name, "FK_", "")
    return F.when(F.instr(c, "_") > 0, F.substring_index(c, "_", 1)).when(c.isNotNull(), F.lit(""))


def redact(key: Column, value: Column) -> Column:
    """Hide the value of a parameter whose key names a secret."""
    return F.when(key.rlike(SECRET_KEYS), F.lit("<redacted>")).otherwise(value)


_PLACEHOLDER = r"@\{linkedService\(\)\.([^{}]*)\}|@dataset\(\)\.(\w+)"


def fill_parameters(template: Column | str, params: Column | str) -> Column:
    """Fill ``@{linkedService().Key}`` and ``@dataset().Key`` from a map; unknown keys stay, secrets are redacted.

    The text is cut at its placeholders once and each is looked up by its whole key, so a key never fills the head of
    a longer one and a value is never searched for placeholders.
    """
    text, pattern = _c(template), F.lit(_PLACEHOLDER)

    def filled(piece: Column, placeholder: Column) -> Column:
        key = F.coalesce(
            F.nullif(F.regexp_extract(placeholder, _PLACEHOLDER, 1), F.lit("")), F.regexp_extract(placeholder, _PLACEHOLDER, 2)
        )
        value = F.coalesce(redact(key, F.try_element_at(_c(params), key)), F.lit(""))
        known = F.coalesce(F.array_contains(F.map_keys(_c(params)), key), F.lit(False))
        return F.concat(piece, F.when(placeholder.isNull(), F.lit("")).when(known, value).otherwise(placeholder))

    pieces = F.split(text, _PLACEHOLDER, -1)
    return F.array_join(F.zip_with(pieces, F.regexp_extract_all(text, pattern, F.lit(0)), filled), "")


def _lookup(value: Column | str, table: dict[str, str]) -> Column:
    c = F.upper(_c(value))
    out = F.lit(None).cast("string")
    for key, result in table.items():
        out = F.when(c == key, F.lit(result)).otherwise(out)
    return out


def language_extension(language: Column | str) -> Column:
    return _lookup(language, LANGUAGE_EXTENSION)


def language_format(language: Column | str) -> Column:
    return _lookup(language, LANGUAGE_FORMAT)


def parse_error(error: Column | str) -> Column:
    """Struct ``errorCode, failureType, message``; null fields for malformed text."""
    return F.from_json(_c(error), "errorCode STRING, failureType STRING, message STRING")


def severity_rank(severity: Column | str) -> Column:
    """Low 1, Medium 2, High 3, anything else 0."""
    c = F.lower(_c(severity))
    out = F.lit(0)
    for rank, name in enumerate(SEVERITIES, start=1):
        out = F.when(c == name.lower(), F.lit(rank)).otherwise(out)
    return out
