"""Normalizers on invented notices, built here from the values that the assertions name."""

import json
from datetime import datetime
from decimal import Decimal

import pytest

from noticelake.plans.notices import normalize

AS_OF = "2026-03-01 00:00:00"
PLATES = ["KLM-7351", "KLM-7352", "QRS-8810"]


@pytest.fixture(scope="module")
def run(spark):
    schema = ("source_record_id string, official_url string, title string, content string, organization string, "
              "recycler_only boolean, result_record boolean")

    def go(source, *pages):
        rows = [(p.get("id", "n1"), p.get("url", "https://notice.gov.tw/a/b"), p.get("title"), p["content"], p.get("organization"), False, False) for p in pages]
        records, errors = normalize(source, spark.createDataFrame(rows, schema), AS_OF)
        by_id = {r["source_record_id"]: r.asDict(recursive=True) for r in records.collect()}
        return by_id, {r["source_record_id"] for r in errors.collect()}

    return go


def has(record, **expected):
    assert {k: record[k] for k in expected} == expected


def cells(*pairs):
    return "<table>" + "".join(f"<tr><td>{k}</td><td>{v}</td></tr>" for k, v in pairs) + "</table>"


def headed(*pairs):
    return "<table>" + "".join(f"<tr><th>{k}</th><td>{v}</td></tr>" for k, v in pairs) + "</table>"


def sale(heading, pairs=(), lines=(), note=""):
    body = "".join(f"<p>{x}</p>" for x in lines)
    return f"<body><strong>{heading}</strong>{cells(*pairs)}{body}<div>物品說明：{note}</div><h2>其他條款</h2></body>"


def test_sale_page(run):
    page = sale(
        "【114Z77】自用小客車1輛", [("物品名稱", "自用小客車1輛"), ("拍賣次數", "3"), ("底價", "新台幣 58,000 元"), ("拍賣開始與截止日", "115/03/02~115/03/09 15:30:00"),
                              ("拍賣單位", "示範清潔隊"), ("放置地點", "花蓮縣吉安鄉")],
        ["廠牌：裕隆", "型號：QX90", "牌照異動登記：已繳銷(可再領牌)"],
        "出廠年份：2016.11；排氣量：1598cc。車牌號碼：KLM-7351；引擎號碼：ENG0099123；銀色。左側車門凹陷。可發動。有鑰匙。",
    )
    got, errors = run("shwoo", {"content": page, "url": "https://shwoo.gov.taipei/shwoo/newproduct/newproduct00/product?AUID=77"})
    has(got["n1"], official_case_number="114Z77", reserve_price=Decimal("58000.00"), auction_round=3, brand="裕隆", model="QX90", manufacture_year=2016,
        manufacture_month=11, displacement_cc=1598, has_key="YES", can_start="YES", vehicle_type="CAR", lot_size=1, bulk_lot=False,
        ends_at=datetime(2026, 3, 9, 7, 30), location="花蓮縣吉安鄉", registration_status="RE_REGISTRATION_REQUIRED")
    assert got["n1"]["identifiers"][0] == {"identifier_type": "PLATE", "normalized_value": "KLM7351", "original_value": "KLM-7351"}
    assert {"reserve_price", "brand", "can_start"} <= {e["field_name"] for e in got["n1"]["evidence"]} and not errors


def test_sale_lots_keep_every_plate(run):
    heading = f"【9】公務機車2輛(可領牌){'、'.join(PLATES)}"
    got, _ = run("shwoo", {"content": sale(heading, [("底價", "9,000")])}, {"id": "n2", "content": "<p>無內容</p>"})
    units = [u["source_vehicle_key"] for u in got["n1"]["vehicle_units"]]
    assert got["n1"]["bulk_lot"] and units == [f"plate:{p.replace('-', '')}" for p in PLATES]


def test_contradictions_are_no_answer(run):
    page = sale("【10】機車1輛", note="清單記載有鑰匙；點交紀錄記載無鑰匙。可發動；複查時無法發動。", lines=["牌照異動登記：已繳銷(可再領牌)"])
    got, _ = run("shwoo", {"content": page})
    has(got["n1"], has_key="CONFLICTING", can_start="CONFLICTING")


def test_procurement_page(run):
    page = headed(("機關名稱", "示範環境保護局"), ("機關地址", "屏東縣"), ("標案案號", "Z-88"), ("公告次數", "2"), ("公告日期", "115/02/20"), ("財物名稱", "報廢汽車5輛標售"),
                  ("截止投標", "115/03/12 09:30"), ("保證金額度", "新臺幣4,200元整"), ("變賣標的所在地", "示範停車場"), ("底價金額", "76,500"))
    got, errors = run("pcc", {"content": page, "title": "t"})
    has(got["n1"], vehicle_type="CAR", lot_size=5, bulk_lot=True, reserve_price=Decimal("76500.00"), deposit=Decimal("4200.00"), location="示範停車場",
        auction_round=2, ends_at=datetime(2026, 3, 12, 1, 30), organization="示範環境保護局")
    assert not errors


def test_court_row(run):
    row = {"rowid": "Z5", "filenm": "/z.pdf", "crmyy": "114", "crmid": "司執助", "crmno": "004321", "saledate": "1150320", "saleno": "2", "ttitle": "普通重型機車",
           "registeno": "普通重型機車", "qty": "2", "crtnm": "臺灣屏東地方法院", "crm": "", "sumprice": 45000, "pic_cnt": 0, "fee_notes": [" ", "另計規費"],
           "notes": "1.車牌：KLM-7351、QRS-8810。2.廠牌：光陽、出廠年月：2014年7月、型式：ZT12、排氣量(馬力)：149cc(HP)、顏色：黑色、引擎：E9K7711Z。3.現況"}
    got, errors = run("judicial", {"content": json.dumps(row, ensure_ascii=False)}, {"id": "list", "content": "[]"})
    has(got["n1"], official_case_number="114司執助字第004321號", auction_round=2, reserve_price=Decimal("45000.00"), brand="KYMCO", model="ZT12",
        manufacture_year=2014, manufacture_month=7, displacement_cc=149, lot_size=2, fee_notes=["另計規費"], status="SCHEDULED")
    assert [u["source_vehicle_key"] for u in got["n1"]["vehicle_units"]] == ["plate:KLM7351", "plate:QRS8810"]
    assert errors == {"list"}


def test_seized_pages(run):
    page = ('<meta name="DC.Creator" content="臺灣屏東地方檢察署"><h2 class="title">114年度變價字第205號大型重型機車拍賣公告</h2><section class="cp">'
            "拍賣時間：中華民國115年3月18日下午2時。大型重型機車1輛，車牌QRS-8810，廠牌：三陽，型號：LB8，排氣量：399cc。</section>")
    row = '<tr><td data-title="標題"><a href="/1724/1726/5/post">自用小貨車拍賣公告</a></td><td data-title="單位">臺灣基隆地方檢察署</td></tr>'
    got, errors = run("moj_auction", {"id": "p", "content": page}, {"id": "r", "content": row}, {"id": "x", "content": "<p>會議桌</p>"})
    has(got["p"], displacement_cc=399, organization="臺灣屏東地方檢察署", ends_at=datetime(2026, 3, 18, 6), official_case_number="114年度變價字第205號", lot_size=1)
    has(got["r"], organization="臺灣基隆地方檢察署", vehicle_type="CAR", status="ANNOUNCED")
    assert errors == {"x"}


def test_enforcement_page(run):
    text = "本分署拍賣自用小客車一輛，車號QRS-8810，廠牌：裕隆，排氣量：1794cc，出廠年月：2018年9月，有鑰匙，" + "詳見現場說明，" * 30
    page = f'<div class="title_h3">公告事項</div><ul><li>案號：1140200000088</li><li>開標日：2026/03/25 14:00:00</li><li>{text}</li></ul>'
    got, _ = run("moj_enforcement", {"content": page, "title": "n1"})
    has(got["n1"], official_case_number="1140200000088", ends_at=datetime(2026, 3, 25, 6), has_key="YES", manufacture_year=2018, manufacture_month=9, vehicle_type="CAR")
    # a title taken from the description is the whole of it
    assert len(got["n1"]["title"]) > 150


def test_branch_post_keeps_every_attachment(run):
    links = "".join(f'<a href="/media/{i}/f.pdf">公告{i}.pdf</a>' for i in range(14))
    page = ('<meta name="ContentTitle" content="115年度自用小客車拍賣（115年3月30日）"><meta name="DC.Creator" content="行政執行署花蓮分署"><section class="cp">自用小客車一輛，'
            f'廠牌：裕隆，車牌：KLM-7352。拍賣地點：花蓮分署；無鑰匙，核定底價新臺幣61,000元。</section><div class="file_download">{links}<a href="/m/p.jpg">照片</a></div>')
    got, errors = run("moj_enforcement_cms", {"content": page, "url": "https://www.hly.moj.gov.tw/5/6/post"})
    has(got["n1"], reserve_price=Decimal("61000.00"), has_key="NO", location="花蓮分署", bulk_lot=False)
    urls = [e["normalized_value"] for e in got["n1"]["evidence"] if e["field_name"] == "official_attachment_url"]
    assert sorted(urls) == sorted(f"https://www.hly.moj.gov.tw/media/{i}/f.pdf" for i in range(14)) and not errors


def test_customs_notice(run):
    page = ("<main><article><h1>標售逾期未領車輛公告</h1><p>發文字號：示普字第114000777號。</p><p>標的物：自用小客車 3 輛，廠牌：裕隆，排氣量：1998 c.c.，車牌：QRS-8810。</p>"
            "<p>開標日期及地點：115年3月27日下午3時，二樓。</p><p>本車須經檢測合格後始得辦理登檢領照。</p></article></main>")
    got, errors = run("customs", {"content": page, "title": "標售逾期未領車輛公告", "url": "https://web.customs.gov.tw/z/9"},
                      {"id": "other", "content": "<p>標售電腦一批</p>", "title": "標售電腦一批"})
    has(got["n1"], vehicle_type="CAR", displacement_cc=1998, lot_size=3, registration_status="INSPECTION_REQUIRED", official_case_number="示普字第114000777號",
        ends_at=datetime(2026, 3, 27, 7))
    assert got["n1"]["identifiers"][0]["normalized_value"] == "QRS8810" and errors == {"other"}
