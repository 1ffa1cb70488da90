"""Wording, labels and formats of the official notices.

Patterns are Java regular expressions. Full-width digits are folded to ASCII before
any of them is applied, so ``\\d`` stays ASCII. A choice of many words names their first characters ahead, so that
most places of a text are passed over without trying every word. What must not stand before a match is looked at behind its first
character, not at every place of a text.
"""

# --- whitespace and separators -------------------------------------------------
# no white space lies beyond the ideographic one, so most characters need one comparison
SPACE = r"(?U)[\x00-\u3000&&\s]+"
SENTENCE_END = r"[。；;\n]"
LABEL_STOP = r"[^，,、；;。\n]+"

# --- dates ---------------------------------------------------------------------
SLASH_DATE = r"\d(?<!\d\d)\d{1,3}/\d{1,2}/\d{1,2}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?"
LIST_DATE = r"\d(?<!\d\d)\d{1,2}[-/.]\d{1,2}[-/.]\d{1,2}"
WORDED_DATE = (
    r"(\d{2,4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日"
    r"(?:[^上下\d]{0,8}(上午|下午)?\s*(\d{1,2})?\s*時?\s*(\d{1,2})?\s*分?)?"
)

# --- amounts -------------------------------------------------------------------
AMOUNT_UNITS = {"億": 100_000_000, "萬": 10_000, "千": 1_000, "百": 100, "十": 10}
UNIT_CHARS = "億萬千百十"

# --- vehicle wording -----------------------------------------------------------
CLASS_WORDING = [
    ("ELECTRIC_MOTORCYCLE", r"(?=[普大電])(?:普通輕型|普通重型|大型重型)?電動機車"),
    ("LARGE_HEAVY", r"大型重型機車|大型重機"),
    ("ORDINARY_HEAVY", r"普通重型機車"),
    ("ORDINARY_LIGHT", r"普通輕型機車"),
    ("HEAVY_UNSPECIFIED", r"重型機車"),
]
MOTORCYCLE_WORDING = r"(?=[普大電重機])(?:普通輕型機車|普通重型機車|大型重型機車|大型重機|電動機車|重型機車|機器腳踏車|機車|重機)"
CAR_WORDING = (
    r"(?=[自營小大客休轎廂貨汽])"
    r"(?:自用小客車|營業小客車|小客車|大客車|自用小貨車|營業小貨車|小貨車|大貨車|客貨兩用車|休旅車|轎車|廂型車|貨車|汽車)"
)
FUEL_FEE_WORDING = r"汽車燃料(?:使用)?費"
COMBINED_VEHICLE_WORDING = r"汽(?:、|及|與|和)?機車"
CATEGORY_WORDING = [
    ("SUV", r"休旅車|運動型多用途車|[Ss][Uu][Vv]"),
    ("VAN", r"(?=[廂客])(?:廂型車|客貨兩用車)"),
    ("TRUCK", r"(?=[自營小大貨曳])(?:(?:自用|營業)?(?:小貨|大貨)車|貨車|曳引車)"),
    ("BUS", r"(?=[大遊公])(?:大客車|遊覽車|公車)"),
    ("PASSENGER", r"(?=[轎自營小])(?:轎車|自用小客車|營業小客車|小客車)"),
]
VEHICLE_NOUN = (
    r"(?=[機重汽小大客休轎廂貨])(?:機車|重機|機器腳踏車|汽車|小客車|大客車|小貨車|大貨車|客貨兩用車|休旅車|轎車|廂型車|貨車)"
)
PROCUREMENT_NOUN = r"(?=[汽機小大客休轎廂貨])(?:汽車|機車|小客車|大客車|小貨車|大貨車|客貨兩用車|休旅車|轎車|廂型車|貨車)"

# The same nouns where only what follows them matters: found by their last character.
NOUN_ENDS = {
    VEHICLE_NOUN: r"(?:車(?<=(?:機器腳踏|客貨兩用|小客|大客|休旅|廂型|機|汽|貨|轎)車)|重機)",
    PROCUREMENT_NOUN: r"車(?<=(?:客貨兩用|小客|大客|休旅|廂型|機|汽|貨|轎)車)",
}

# --- brands --------------------------------------------------------------------
BRAND_ALIASES = {"光陽": "KYMCO", "三陽": "SYM", "山葉": "YAMAHA", "台灣山葉": "YAMAHA"}
BRAND_SCAN = [
    "台灣山葉", "光陽", "三陽", "山葉", "KYMCO", "SYM", "YAMAHA", "HONDA", "SUZUKI", "PGO", "GOGORO", "PIAGGIO",
]

# --- plates and identifiers ----------------------------------------------------
PLATE_TOKEN = r"[A-Za-z0-9](?<![A-Za-z0-9]{2})[A-Za-z0-9]{1,3}[-－][A-Za-z0-9]{2,4}(?![A-Za-z0-9])"
PLATE_LABEL_BEFORE = r"(?:車牌|牌照)(?:號碼)?\s*[：:]?\s*"
MASKABLE_TOKEN = r"[A-Za-z0-9](?<![A-Za-z0-9]{2})[A-Za-z0-9]{0,3}[-－][A-Za-z0-9]{1,4}(?![A-Za-z0-9])"
VIN = r"(?i)[A-HJ-NPR-Z0-9](?<![A-Za-z0-9]{2})[A-HJ-NPR-Z0-9]{16}(?![A-Za-z0-9])"
LABELLED_IDENTIFIER = r"(?i)((?:引擎|車身|車架|VIN)(?:號碼|號|碼)?\s*[:：]?\s*)[A-Za-z0-9-]{5,}"
PHONE = (
    r"0(?<!\d0)(?:9\d{2}(?:[-－ ]?\d{3}){2}|\d{1,2}[-－ ]?\d{6,8})(?:\s*(?:#|分機)\s*\d+)?(?!\d)"
)
EMAIL = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
NATIONAL_ID = r"(?i)[A-Z](?<![A-Za-z0-9]{2})[12]\d{8}(?![A-Za-z0-9])"
PERSON_ROLE = (
    r"(義務人|債務人|所有人|車主|被告|受刑人|保管人|姓名)"
    r"\s*[:：]?\s*([\u4e00-\u9fff○ＯO·．・]{2,6}?)"
    r"(?=$|[\s　，,。；;、/()（）.\-_?&#]|應|係|之|於|住址|電話|身分|證號)"
)
PRIVATE_PERSON = r"(義務人|所有人|車主)\s*[：:]?\s*[\u4e00-\u9fff○ＯO]{2,4}"
ROLES, PRIVATE_ROLES = ["義務人", "債務人", "所有人", "車主", "被告", "受刑人", "保管人", "姓名"], ["義務人", "所有人", "車主"]

# --- replacement texts ---------------------------------------------------------
HIDDEN_IDENTIFIER = "車輛識別碼已隱藏"
HIDDEN_PLATE = "車牌已隱藏"
HIDDEN_VIN = "車身識別碼已隱藏"
HIDDEN_PHONE = "聯絡電話已隱藏"
HIDDEN_EMAIL = "聯絡信箱已隱藏"
HIDDEN_ID = "身分證字號已隱去"
PRIVATE_ID_REMOVED = "[已移除身分證字號]"
PRIVATE_NAME_REMOVED = "[已移除姓名]"

# --- counties ------------------------------------------------------------------
COUNTIES = [
    "臺北市", "新北市", "桃園市", "臺中市", "臺南市", "高雄市", "基隆市", "新竹市", "嘉義市", "新竹縣", "苗栗縣",
    "彰化縣", "南投縣", "雲林縣", "嘉義縣", "屏東縣", "宜蘭縣", "花蓮縣", "臺東縣", "澎湖縣", "金門縣", "連江縣",
]
COUNTY_HINTS = [
    ("士林", "臺北市"), ("橋頭", "高雄市"), ("臺北", "臺北市"), ("新北", "新北市"), ("桃園", "桃園市"),
    ("新竹", "新竹市"), ("苗栗", "苗栗縣"), ("臺中", "臺中市"), ("南投", "南投縣"), ("彰化", "彰化縣"),
    ("雲林", "雲林縣"), ("嘉義", "嘉義市"), ("臺南", "臺南市"), ("高雄", "高雄市"), ("屏東", "屏東縣"),
    ("臺東", "臺東縣"), ("花蓮", "花蓮縣"), ("宜蘭", "宜蘭縣"), ("基隆", "基隆市"), ("澎湖", "澎湖縣"),
    ("金門", "金門縣"), ("連江", "連江縣"),
]

# --- relevance terms -----------------------------------------------------------
PROCUREMENT_TERMS = r"汽車|機車|車輛"
RAIL_TERMS = r"鐵路機車|電力機車|柴油機車|蒸汽機車"
CENTRAL_LIST_TERMS = (
    r"(?=[機重汽小大客休轎廂貨])(?:機車|機器腳踏車|重機|汽車|小客車|大客車|小貨車|大貨車|客貨兩用車|休旅車|轎車|廂型車|貨車)"
)
BRANCH_VEHICLE_TERMS = (
    r"(?=[汽機大重車小客休轎廂貨曳半拖遊])"
    r"(?:汽機車|汽車|機車|機器腳踏車|大型重機|重型機車|重機|車輛|小客車|大客車|客貨兩用車|休旅車|轎車|廂型車|"
    r"小貨車|大貨車|貨車|曳引車|半拖車|拖車|遊覽車)"
)
BRANCH_AUCTION_TERMS = r"拍賣|變賣|標售|應買"
GENERIC_VEHICLE_WORDING = [
    r"(?=[標拍變沒報])(?:標售|拍賣|變賣|標的物|沒入|報廢).{0,20}(?:車輛|公務車)",
    r"(?:車輛|公務車).{0,20}(?:標售|拍賣|變賣|報廢)",
    r"(?:車輛|公務車)\s*\d+\s*輛",
]
# Pattern -> parts of which a text holds one wherever the pattern matches. A plain search for them is far cheaper than the pattern.
NEEDED = {
    MOTORCYCLE_WORDING: ["機車", "重機", "機器腳踏車"],
    CAR_WORDING: ["客車", "貨車", "兩用車", "休旅車", "轎車", "廂型車", "汽車"],
    FUEL_FEE_WORDING: ["汽車燃料"],
    **dict(zip([p for _, p in CLASS_WORDING], [["電動機車"], ["大型重"], ["普通重型機車"], ["普通輕型機車"], ["重型機車"]])),
    **dict(zip([p for _, p in CATEGORY_WORDING[1:]], [["廂型車", "兩用車"], ["貨車", "曳引車"], ["大客車", "遊覽車", "公車"], ["轎車", "小客車"]])),
    **dict.fromkeys(GENERIC_VEHICLE_WORDING, ["車輛", "公務車"]),
    PERSON_ROLE: ROLES,
    PRIVATE_PERSON: PRIVATE_ROLES,
    PHONE: ["0"],
}
PASS_CARD = "車輛通行證"
LIST_LABELS = ["動產拍賣公告", "拍賣品消息", "電子公布欄", "最新消息"]
IMMOVABLE_LABEL = "不動產拍賣"
