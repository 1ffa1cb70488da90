"""Patterns that look behind their first character, or are tried only where a needed part stands, find what the plain ones find."""

import random

import pytest
from pyspark.sql import functions as F

from noticelake.functions import classify, dates, facts, redact
from noticelake.functions import patterns as P
from noticelake.functions import text as X

c = F.col
#: Pattern as it is, as it was, and what texts are made of.
ALNUM = r"(?<![A-Za-z0-9])"
PAIRS = [
    (P.SPACE, r"(?U)\s+", list("a車 \t\n　   、")),
    (P.SLASH_DATE, r"(?<!\d)\d{2,4}/\d{1,2}/\d{1,2}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?", ["11", "2/3", "/", "5:06", ":07", " ", "a", "1"]),
    (P.LIST_DATE, r"(?<!\d)\d{2,3}[-/.]\d{1,2}[-/.]\d{1,2}", ["11", "2/3", "/4", "-5-", ".6", "a", "1"]),
    (P.PLATE_TOKEN, ALNUM + r"[A-Za-z0-9]{2,4}[-－][A-Za-z0-9]{2,4}(?![A-Za-z0-9])", list("AbZ19-－車")),
    (P.MASKABLE_TOKEN, ALNUM + r"[A-Za-z0-9]{1,4}[-－][A-Za-z0-9]{1,4}(?![A-Za-z0-9])", list("AbZ19-－車")),
    (P.VIN, r"(?i)(?<![A-Za-z0-9])[A-HJ-NPR-Z0-9]{17}(?![A-Za-z0-9])", ["A1b2C3d4", "E5f", "o", "X", "車", "12345678"]),
    (P.PHONE, r"(?<!\d)(?:09\d{2}(?:[-－ ]?\d{3}){2}|0\d{1,2}[-－ ]?\d{6,8})(?:\s*(?:#|分機)\s*\d+)?(?!\d)", ["09", "12", "345", "0", "-", "02", " ", "#", "1", "x"]),
    (P.NATIONAL_ID, r"(?i)(?<![A-Za-z0-9])[A-Z][12]\d{8}(?![A-Za-z0-9])", ["A", "b", "1", "2", "12345678", "車"]),
    (P.CATEGORY_WORDING[0][1], r"(?i)休旅車|運動型多用途車|SUV", ["休旅", "車", "運動型多用途", "s", "U", "v", "SUV"]),
    (facts.START[1], "(?<![不無未])(?:可發動|能發動)", list("不無未可能發動")),
    (facts.START_COURT[1], "(?<![不無未])(?:可|能)(?:發動|啟動)", list("不未可能發啟動")),
    (facts.TEST[1], "(?<![不無未])可測試|提供.{0,8}測試", list("不未可測試") + ["測試", "提供"]),
    (facts.TEST_COURT[1], "(?<![不無未])(?:可|能)測試", list("不無可能測試")),
    (facts.RELICENSE, "(?<!不)可再領牌", ["不", "可", "再領牌"]),
]
WORDS = ["普通輕型機車", "普通重型機車", "重型機車", "大型重型機車", "曳引車", "大型重機", "重機", "電動", "機車", "汽", "、", "車", "汽車燃料使用費", "小客", "大貨", "貨車", "客貨兩用車", "休旅車", "轎車", "廂型車", "自用", "機器腳踏車", "2", "10", "輛", "台", " ", "。",
         "車主", "：", "王小明", "，", "被告", "0912345678", "引擎號碼", "vin", "AB12345", "A123456789", "112/3/4", "年", "報廢", "公務車", "a@b.tw", "suv", "遊覽車", "整批"]

PLAIN = ["普通重型機車2輛", "普通輕型機車", "大型重型機車", "電動機車", "重型機車", "廂型車", "曳引車", "遊覽車", "轎車", "汽車燃料費", "標售公務車", "公務車標售", "公務車 3 輛", "車主：王小明，住址",
         "0912345678", "自用小客車3輛", "機車 2 台小貨車10輛"]


def texts(parts, seed, n=400):
    draw = random.Random(seed)
    return [None, "", *PLAIN, *["".join(draw.choices(parts, k=draw.randrange(1, 14))) for _ in range(n)]]


@pytest.mark.parametrize("number", range(len(PAIRS)))
def test_same_matches_as_the_plain_pattern(evaluate, number):
    now, before, parts = PAIRS[number]
    values = texts(parts, number)
    got, want = (evaluate(lambda v, p=p: F.regexp_replace(v, p, "<$0>"), values) for p in (now, before))
    assert got == want and any(x and "<" in x for x in got)


def test_nouns_are_found_by_their_ends(evaluate):
    for noun, end in P.NOUN_ENDS.items():
        got, want = (evaluate(lambda v, n=n: F.to_json(X.extract_all(v, rf"{n}\s*(\d+)\s*[輛台]", 1)), texts(["2", "10", "輛", "台", " ", *WORDS[:18]], 5, 1500)) for n in (end, noun))
        assert got == want and sum(x not in (None, "[]") for x in got) > 2


def test_needed_parts_are_needed(evaluate):
    """A guarded pattern gives what it gives unguarded, and most texts without its parts need no search."""
    values = texts(["標售", *WORDS], 7, 1500)
    for pattern in P.NEEDED:
        found = evaluate(lambda v, p=pattern: v.rlike(p).cast("string"), values)
        assert evaluate(lambda v, p=pattern: X.matches(v, p).cast("string"), values) == found and "true" in found, pattern
        assert evaluate(lambda v, p=pattern: X.first_match(v, p), values) == evaluate(lambda v, p=pattern: F.regexp_extract(v, p, 0), values), pattern


def test_guarded_steps_leave_other_texts_alone(evaluate):
    values = texts(WORDS, 9, 1200)

    def plain(v):
        for pattern, instead in ((P.VIN, P.HIDDEN_VIN), (P.LABELLED_IDENTIFIER, "$1已隱藏"), (P.PHONE, P.HIDDEN_PHONE), (P.EMAIL, P.HIDDEN_EMAIL), (P.NATIONAL_ID, P.HIDDEN_ID), (P.PERSON_ROLE, "$1：已隱去")):
            v = F.regexp_replace(v, pattern, instead)
        return v

    assert evaluate(redact.hide_personal_data, values) == evaluate(plain, values)
    assert evaluate(lambda v: classify.vehicle_type(v)["value"], ["汽車燃料使用費", "汽車", None, "大型重機與小貨車"]) == ["UNKNOWN", "CAR", "UNKNOWN", "MIXED"]
    assert evaluate(lambda v: dates.roc_datetime(v).cast("string"), ["112/3/4 5:06", "112年", None]) == ["2023-03-03 21:06:00", None, None]
