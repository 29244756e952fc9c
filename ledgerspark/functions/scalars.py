"""Column expressions of the payments model."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerspark.sources.schemas import CURRENCY_PATTERN, KEY_MAX_LENGTH, SAFE_ID_PATTERN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def request_hash(*payload: str | Column) -> Column:
    """Fingerprint of a request payload."""
    return F.md5(F.concat_ws(":", *[_col(p).cast("string") for p in payload]))


def stable_id(*parts: str | Column) -> Column:
    """Id derived from the row, in the shape of a uuid, so that a repeated job gives the same one."""
    digest = F.md5(F.concat_ws("|", *[_col(p).cast("string") for p in parts]))
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def is_currency(c: str | Column) -> Column:
    return F.coalesce(_col(c).rlike(CURRENCY_PATTERN), F.lit(False))


def is_safe_id(c: str | Column) -> Column:
    return F.coalesce(_col(c).rlike(SAFE_ID_PATTERN) & (F.length(_col(c)) <= KEY_MAX_LENGTH), F.lit(False))


def is_request_name(c: str | Column) -> Column:
    """Not blank and at most 128 characters: the rule for keys and actors."""
    return F.coalesce((F.length(F.trim(_col(c))) > 0) & (F.length(_col(c)) <= KEY_MAX_LENGTH), F.lit(False))


def normalized_email(c: str | Column) -> Column:
    return F.lower(F.trim(_col(c)))


def one_line(text: str | Column, width: int) -> Column:
    """Text with runs of white space folded, cut for display."""
    return F.left(F.regexp_replace(_col(text), r"\s+", " "), F.lit(width))


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, NULL when the whole is zero."""
    ratio = part.cast("double") * 100 / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(ratio, digits)


def json_contains(document: str | Column, pattern: dict) -> Column:
    """Whether the JSON text contains ``pattern``: an object holds every member of a pattern object, recursively,
    an array holds every element of a pattern array, in any place, and scalars are equal.

    The pattern is compiled to one conjunct per leaf, evaluated in the JVM.
    """
    variant = F.try_parse_json(_col(document))
    return F.coalesce(_contains(variant, pattern, "$"), F.lit(False))


def _contains(variant: Column, pattern, path: str) -> Column:
    if isinstance(pattern, dict):
        # a member that is found proves that this is an object
        result = F.lit(True) if pattern else F.try_variant_get(variant, path, "map<string,variant>").isNotNull()
        for name, value in pattern.items():
            result = result & F.coalesce(_contains(variant, value, f"{path}['{name}']"), F.lit(False))
        return result
    if isinstance(pattern, list):
        elements = F.try_variant_get(variant, path, "array<variant>")
        result = elements.isNotNull()
        for value in pattern:
            result = result & F.exists(elements, _holds(value))
        return result
    if pattern is None:
        return F.coalesce(F.is_variant_null(F.try_variant_get(variant, path, "variant")), F.lit(False))
    if isinstance(pattern, bool):
        return _kind(variant, path, "BOOLEAN") & (F.try_variant_get(variant, path, "boolean") == F.lit(pattern))
    if isinstance(pattern, str):
        return _kind(variant, path, "STRING") & (F.try_variant_get(variant, path, "string") == F.lit(pattern))
    return ~_kind(variant, path, "STRING") & ~_kind(variant, path, "BOOLEAN") & (
        F.try_variant_get(variant, path, "decimal(38,10)") == F.lit(json.dumps(pattern)).cast("decimal(38,10)")
    )


def _holds(value):
    return lambda element: F.coalesce(_contains(element, value, "$"), F.lit(False))


def _kind(variant: Column, path: str, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant")) == name


def check_word(word: str) -> str:
    """The word in lower case; it must consist of letters, marks and digits."""
    wanted = word.lower()
    if not wanted or not all(unicodedata.category(c)[0] in "LMN" for c in wanted):
        raise ValueError(f"not a word: {word}")
    return wanted


def has_word(text: str | Column, word: str) -> Column:
    """Whether a text has the word, as a run of letters, marks and digits of its own, in any language and case.

    Letters are compared as they are stored: a text and a word in different normal forms do not match.
    """
    wanted = check_word(word)
    low = F.lower(_col(text))
    # the plain search settles most texts before the pattern is tried
    border = r"[^\p{L}\p{M}\p{N}]"
    return low.contains(wanted) & low.rlike(f"(^|{border}){wanted}($|{border})")
