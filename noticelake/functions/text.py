"""Text cleaning, amounts, labelled values and sentences."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P

FULL_WIDTH_DIGITS = "０１２３４５６７８９"


def text(value: str) -> Column:
    return F.lit(value)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use``, however often that refers to it.

    Without the binding a long text would be searched again for every reference.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean(c: Column) -> Column:
    """Collapse any Unicode whitespace to one space and trim; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), P.SPACE, " "))


def ascii_digits(c: Column) -> Column:
    """Full-width digits folded. Translating costs a lookup per character, so a text without any is left alone."""
    return let(c, lambda t: F.when(t.rlike("[０-９]"), F.translate(t, FULL_WIDTH_DIGITS, "0123456789")).otherwise(t))


def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def nfkc_clean(c: Column) -> Column:
    """Compatibility-normalized text with the one radical NFKC leaves apart.

    Spark has no normalization function, so this one step is an Arrow UDF.
    """
    return clean(F.translate(F.pandas_udf(_nfkc, T.StringType()).asNondeterministic()(F.coalesce(c, F.lit(""))), "⾞", "車"))


def holds(c: Column, parts: list[str]) -> Column:
    """Whether a text holds one of the parts as it stands."""
    return reduce(lambda a, b: a | b, [c.contains(x) for x in parts])


def matches(c: Column, pattern: str) -> Column:
    """``rlike``; a pattern whose necessary parts are known is tried only on texts that hold one of them."""
    found = c.rlike(pattern)
    return holds(c, P.NEEDED[pattern]) & found if pattern in P.NEEDED else found


def first_match(c: Column, pattern: str) -> Column:
    """The first match of a pattern, '' without one, in the same way."""
    found = F.regexp_extract(c, pattern, 0)
    return F.when(~holds(c, P.NEEDED[pattern]), F.lit("")).otherwise(found) if pattern in P.NEEDED else found


def extract(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of a pattern or NULL."""
    return blank_to_null(first_match(c, pattern) if group == 0 and pattern in P.NEEDED else F.regexp_extract(c, pattern, group))


def extract_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def to_int(c: Column) -> Column:
    return ascii_digits(c).try_cast("int")


def to_long(c: Column) -> Column:
    return F.regexp_replace(ascii_digits(c), ",", "").try_cast("bigint")


def amount(c: Column) -> Column:
    """Money or count in official wording: 1萬6千 -> 16000, 新臺幣2,500元 -> 2500.

    With unit characters every ``number unit`` term is weighted and a trailing plain
    number is added; without any, the first digit run counts. Nothing readable -> NULL.
    """
    return let(ascii_digits(c), _amount)


def _amount(digits: Column) -> Column:
    terms = extract_all(digits, rf"[\d,]*\d[\d,]*\s*[{P.UNIT_CHARS}]")
    weight = F.create_map(*[x for unit, value in P.AMOUNT_UNITS.items() for x in (F.lit(unit), F.lit(value))])
    weighted = F.aggregate(
        terms,
        F.lit(0).cast("bigint"),
        lambda total, term: total
        + F.coalesce(to_long(F.regexp_extract(term, r"^[\d,]+", 0)), F.lit(0).cast("bigint"))
        * F.try_element_at(weight, F.substring(term, -1, 1)),
    )
    tail = F.regexp_extract(digits, rf"[{P.UNIT_CHARS}]\s*([\d,]++)(?!\s*[{P.UNIT_CHARS}])", 1)
    plain = to_long(F.regexp_extract(digits, r"[\d,]+", 0))
    return F.when(F.size(terms) > 0, weighted + F.coalesce(to_long(tail), F.lit(0).cast("bigint"))).otherwise(plain)


def normalize_identifier(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def label_value(c: Column, labels: list[str]) -> Column:
    """Text after the first of the labels that occurs, up to the next separator."""
    found = [
        blank_to_null(clean(F.regexp_extract(c, rf"{'(?i)' if re.search('[A-Za-z]', label) else ''}{re.escape(label)}\s*[：:]\s*({P.LABEL_STOP})", 1)))
        for label in labels
    ]
    return F.coalesce(*found)


def sentences(c: Column) -> Column:
    return F.split(c, P.SENTENCE_END)


def fact_sentence(c: Column, pattern: str) -> Column:
    """First sentence that matches, cleaned; NULL when none does."""
    return first_sentence(sentences(c), pattern)


def first_sentence(parts: Column, pattern: str) -> Column:
    """The same of sentences that were split before."""
    return blank_to_null(clean(F.get(F.filter(parts, lambda s: s.rlike(pattern)), F.lit(0))))


def distinct_sentences(c: Column, pattern: str, separators: str = "[。；]") -> Column:
    parts = F.transform(F.filter(F.split(c, separators), lambda s: s.rlike(pattern)), clean)
    return F.array_distinct(parts)


def tokens(c: Column) -> Column:
    """Lower-case word tokens of a text, without stemming or stop words."""
    return F.array_distinct(F.filter(F.split(F.lower(c), r"(?U)[^\w]+"), lambda t: t != ""))


def safe_search_term(c: Column) -> Column:
    """User keyword without pattern punctuation."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"[,%()]", " "), P.SPACE, " ")


def stable_id(*columns: Column) -> Column:
    """Deterministic surrogate key of a natural key; NULL parts differ from blanks."""
    parts = [F.coalesce(F.concat(F.lit("="), x.cast("string")), F.lit("~")) for x in columns]
    return F.sha2(F.concat_ws("\u0000", *parts), 256)


def feed_record_id(organization: Column, case_number: Column, count: Column) -> Column:
    """Stable id of a feed row from its three cleaned identity fields."""
    joined = F.concat_ws("\u0000", organization, case_number, count)
    return F.concat(F.lit("open-data-"), F.substring(F.sha2(joined, 256), 1, 24))


def content_path(checksum: Column, mime_type: Column) -> Column:
    """Content-addressed relative path: two-character folder, checksum, extension."""
    extension = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    suffix = F.coalesce(F.try_element_at(extension, mime_type), F.lit(".bin"))
    return F.concat(F.substring(checksum, 1, 2), F.lit("/"), checksum, suffix)


# The file extension of each stored media type.
EXTENSIONS = {
    "text/html": ".html", "application/json": ".json", "application/pdf": ".pdf", "application/xml": ".xml",
    "text/xml": ".xml", "image/jpeg": ".jpg", "image/png": ".png", "image/gif": ".gif", "image/webp": ".webp",
    "application/zip": ".zip", "text/plain": ".txt",
}


def payload_checksum(fields: list[str], struct_of) -> Column:
    """SHA-256 of the compact JSON of named fields in sorted order, NULLs written out."""
    body = F.to_json(F.struct(*[struct_of(name).alias(name) for name in sorted(fields)]), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)
