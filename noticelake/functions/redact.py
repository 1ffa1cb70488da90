"""Redaction: plate masks, identifier replacement, personal data in texts and URLs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from . import urls
from .text import blank_to_null, clean, extract_all, holds, let, matches


def _mask_token(token: Column) -> Column:
    """Hide the last two or three characters of one plate token."""
    long_tail = F.regexp_replace(token, r"^(.*[-－][A-Za-z0-9]?)[A-Za-z0-9]{3}$", "$1***")
    short_tail = F.regexp_replace(long_tail, r"^(.*[-－])[A-Za-z0-9]{2}$", "$1**")
    return F.regexp_replace(short_tail, r"^([A-Za-z0-9]*)[A-Za-z0-9]([-－])[A-Za-z0-9]$", "$1*$2*")


def mask_plate(c: Column) -> Column:
    """Masked plate text; NULL when fewer than two characters could be hidden.

    Every plate token is masked where it stands. Without a token the last two or three
    letters and digits of the whole text are hidden.
    """
    return let(F.trim(c), _mask_plate)


def _mask_plate(plate: Column) -> Column:
    tokens = extract_all(plate, P.MASKABLE_TOKEN)
    gaps = F.split(plate, P.MASKABLE_TOKEN, -1)
    by_token = F.array_join(
        F.zip_with(gaps, tokens, lambda gap, token: F.concat(gap, F.coalesce(_mask_token(token), F.lit("")))), ""
    )
    size = F.length(F.regexp_replace(plate, "[^A-Za-z0-9]", ""))
    last_three = F.regexp_replace(
        plate, r"[A-Za-z0-9]([^A-Za-z0-9]*)[A-Za-z0-9]([^A-Za-z0-9]*)[A-Za-z0-9]([^A-Za-z0-9]*)$", "*$1*$2*$3"
    )
    last_two = F.regexp_replace(plate, r"[A-Za-z0-9]([^A-Za-z0-9]*)[A-Za-z0-9]([^A-Za-z0-9]*)$", "*$1*$2")
    return F.when(F.size(tokens) > 0, by_token).when(size >= 3, last_three).when(size == 2, last_two)


def mask_plate_list(c: Column, separator: str = "、") -> Column:
    """Mask each entry of a joined plate list, keeping order; suppressed ones drop out."""
    masked = F.filter(F.transform(F.split(c, separator), mask_plate), lambda p: p.isNotNull())
    return blank_to_null(F.array_join(masked, separator))


def known_identifiers(identifiers: Column, units: Column) -> Column:
    """Distinct (type, value) pairs of a record, original and normalized forms."""
    everything = F.concat(
        F.coalesce(identifiers, F.array()), F.flatten(F.transform(F.coalesce(units, F.array()), lambda u: u["identifiers"]))
    )

    def both(i: Column) -> Column:
        kind = F.upper(F.trim(i["identifier_type"])).alias("type")
        return F.array(
            F.struct(kind, F.trim(i["original_value"]).alias("value")),
            F.struct(kind, F.trim(i["normalized_value"]).alias("value")),
        )

    return F.array_distinct(F.filter(F.flatten(F.transform(everything, both)), lambda x: x["value"] != ""))


def replacements(identifiers: Column) -> Column:
    """(value, replacement) pairs, longest value first so that parts never win."""

    def replacement(x: Column) -> Column:
        plate = F.coalesce(mask_plate(x["value"]), F.lit(P.HIDDEN_PLATE))
        return F.struct(
            x["value"].alias("value"),
            F.when(x["type"] == "PLATE", plate).otherwise(P.HIDDEN_IDENTIFIER).alias("replacement"),
        )

    pairs = F.array_distinct(F.transform(identifiers, replacement))
    return F.array_sort(pairs, lambda a, b: F.length(b["value"]) - F.length(a["value"]))


def replace_known(c: Column, pairs: Column) -> Column:
    """Replace each known identifier as a whole word, ignoring case.

    Every row has its own identifiers, so their patterns are compiled anew for each. A plain search comes first: most texts hold none of
    them, and need no pattern.
    """

    def step(acc: Column, pair: Column) -> Column:
        value = pair["value"]
        quoted = F.concat(F.lit("\\Q"), F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        left = F.when(value.rlike("^[A-Za-z0-9]"), "(?<![A-Za-z0-9])").otherwise("")
        right = F.when(value.rlike("[A-Za-z0-9]$"), "(?![A-Za-z0-9])").otherwise("")
        literal = F.regexp_replace(pair["replacement"], r"([\\$])", r"\\$1")
        replaced = F.regexp_replace(acc, F.concat(F.lit("(?i)"), left, quoted, right), literal)
        return F.when(F.contains(F.lower(acc), F.lower(value)), replaced).otherwise(acc)

    return F.aggregate(pairs, c, step)


def _replaced(c: Column, pattern: str, instead: str, needed: Callable[[Column], Column] | None = None) -> Column:
    """All matches replaced; a text without what they need is left alone."""
    return let(c, lambda t: F.when(needed(t) if needed else holds(t, P.NEEDED[pattern]), F.regexp_replace(t, pattern, instead)).otherwise(t))


def hide_personal_data(c: Column) -> Column:
    """Vehicle numbers, phones, e-mails, national ids and role-named people, in that order."""
    out = F.regexp_replace(c, P.VIN, P.HIDDEN_VIN)
    out = _replaced(out, P.LABELLED_IDENTIFIER, "$1已隱藏", lambda t: holds(t, ["引擎", "車身", "車架"]) | F.upper(t).contains("VIN"))
    out = _replaced(out, P.PHONE, P.HIDDEN_PHONE)
    # The address pattern starts at every word; texts without an @ need no search at all.
    out = _replaced(out, P.EMAIL, P.HIDDEN_EMAIL, lambda t: t.contains("@"))
    out = F.regexp_replace(out, P.NATIONAL_ID, P.HIDDEN_ID)
    return _replaced(out, P.PERSON_ROLE, "$1：已隱去")


def sanitize(c: Column, identifier_replacements: Column | None = None) -> Column:
    """Public form of a text. NULL stays NULL."""
    return hide_personal_data(c if identifier_replacements is None else replace_known(c, identifier_replacements))


def redact_private(c: Column) -> Column:
    """Private-side minimum: national ids and named owners leave the parsed text."""
    out = F.regexp_replace(c, P.NATIONAL_ID, P.PRIVATE_ID_REMOVED)
    return clean(_replaced(out, P.PRIVATE_PERSON, "$1：" + P.PRIVATE_NAME_REMOVED))


def contains_personal_data(c: Column) -> Column:
    return let(
        urls.decode(c),
        lambda t: t.rlike(P.NATIONAL_ID) | matches(t, P.PERSON_ROLE) | matches(t, P.PHONE) | (t.contains("@") & t.rlike(P.EMAIL)),
    )


def contains_known(c: Column, identifiers: Column) -> Column:
    return let(
        F.lower(urls.decode(c)), lambda t: F.exists(identifiers, lambda x: t.contains(F.lower(x["value"])))
    )


def leaks(c: Column, identifiers: Column | None = None) -> Column:
    """True when a link or id would publish an identifier or personal data."""
    found = urls.decode(c).rlike(P.VIN) | contains_personal_data(c)
    return found if identifiers is None else found | contains_known(c, identifiers)


def sanitize_url(c: Column, identifiers: Column | None = None) -> Column:
    """The link itself, or only its origin when the rest leaks something."""
    return F.when(leaks(c, identifiers), urls.origin(c)).otherwise(c)


def redacted_record_id(source: Column, record_id: Column, identifiers: Column | None = None) -> Column:
    """The record id, or a stable digest when the id itself would leak."""
    digest = F.substring(F.sha2(F.concat_ws("\u0000", source, record_id), 256), 1, 20)
    return F.when(leaks(record_id, identifiers), F.concat(F.lit("redacted-"), digest)).otherwise(record_id)


def public_since(now: Column, days: int = 30) -> Column:
    """The earliest end of an auction whose plates are still shown."""
    return now - F.make_dt_interval(F.lit(days))


def plate_still_public(ends_at: Column, now: Column, days: int = 30) -> Column:
    """Plates stay visible until thirty days after a known end."""
    return F.coalesce(ends_at >= public_since(now, days), F.lit(False))
