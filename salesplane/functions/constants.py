"""Fixed values that results depend on.

FIXED VALUES: these must equal the source behaviour for right results
(platform aliases, calendar anchors, keyword weights, monthly scores).
They are stated plainly, in natural order, and nowhere else.
"""

# --- FIXED VALUES: platform aliases -> canonical platform -------------------
PLATFORM_ALIASES = {
    "京东": "JD", "jd": "JD", "JD.com": "JD",
    "天猫": "Tmall", "tmall": "Tmall", "Tmall.com": "Tmall",
    "抖音": "Douyin", "douyin": "Douyin", "TikTok": "Douyin", "tiktok": "Douyin",
}

# --- FIXED VALUES: raw header names -> canonical column names ---------------
HEADER_MAP = {
    "销售月份": "sales_month", "Sales Month": "sales_month",
    "一级平台": "primary_platform", "主要平台": "primary_platform",
    "Primary Platform": "primary_platform",
    "主要平台（原始）": "primary_platform_original",
    "Primary Platform (Original)": "primary_platform_original",
    "二级平台": "secondary_platform", "Secondary Platform": "secondary_platform",
    "店铺名称": "store_name", "Store Name": "store_name",
    "品牌名称": "brand_name", "Brand Name": "brand_name",
    "商品编码": "product_code", "Product Code": "product_code",
    "销售金额": "sales_amount", "Sales Amount": "sales_amount",
    "销售数量": "sales_quantity", "Sales Quantity": "sales_quantity",
}

# --- FIXED VALUES: promotional events (name, [(month, day)], duration days, intensity)
PROMO_EVENTS = [
    ("Singles Day", [(11, 11)], 3, 1.0),
    ("Chinese New Year", [(1, 20), (1, 25), (2, 1), (2, 5), (2, 10), (2, 15)], 15, 0.9),
    ("618 Shopping Festival", [(6, 18)], 7, 0.8),
    ("Double 12", [(12, 12)], 2, 0.7),
    ("May Day Golden Week", [(5, 1)], 7, 0.6),
    ("National Day Golden Week", [(10, 1)], 7, 0.6),
    ("Qixi Festival", [(8, 14), (8, 20), (8, 25)], 3, 0.5),
    ("Mother's Day", [(5, 8), (5, 15)], 3, 0.4),
    ("Father's Day", [(6, 15), (6, 22)], 3, 0.4),
    ("Back to School", [(8, 15), (9, 1)], 14, 0.5),
]

# --- FIXED VALUES: seasons (name, months, intensity) -------------------------
SEASONS = [
    ("Winter Holiday Season", [12, 1, 2], 0.8),
    ("Spring Season", [3, 4, 5], 0.6),
    ("Summer Season", [6, 7, 8], 0.7),
    ("Autumn Season", [9, 10, 11], 0.9),
]
SEASON_BASELINE_FACTOR = 0.3

# --- FIXED VALUES: monthly promotional score, months 1..12; default 0.4 -----
MONTHLY_PROMO_SCORE = [0.8, 0.7, 0.4, 0.4, 0.6, 0.8, 0.5, 0.6, 0.5, 0.7, 1.0, 0.8]
MONTHLY_PROMO_DEFAULT = 0.4

# --- FIXED VALUES: store type keywords (type, weight, keywords), declared order
STORE_TYPE_KEYWORDS = [
    ("flagship", 1.0, ["旗舰店", "官方旗舰店", "品牌旗舰店", "flagship"]),
    ("official", 0.9, ["官方", "官网", "official", "正品", "直营"]),
    ("supermarket", 0.8, ["超市", "大卖场", "商城", "mall", "supermarket", "天猫超市"]),
    ("specialty", 0.7, ["专营店", "专卖店", "特产店", "specialty", "专业"]),
    ("franchise", 0.6, ["加盟店", "连锁", "franchise", "分店"]),
    ("distributor", 0.5, ["经销商", "代理商", "distributor", "批发"]),
    ("third_party", 0.3, ["店铺", "商店", "小店", "店", "shop"]),
    ("cross_border", 0.4, ["海外", "进口", "跨境", "global", "international", "海淘"]),
]
STORE_TYPE_DEFAULT = "third_party"

# --- FIXED VALUES: platform-specific indicators (platform, flagship, official)
PLATFORM_INDICATORS = [
    ("Tmall", ["天猫旗舰店", "tmall", "天猫超市"], ["官方", "正品保证"]),
    ("JD", ["京东旗舰店", "jd", "京东自营", "京东超市"], ["自营", "官方", "直营"]),
    ("Douyin", ["官方", "旗舰", "品牌"], ["认证", "官方认证"]),
]

# --- FIXED VALUES: v1 ordered store-type rules (substrings, label) ----------
STORE_TYPE_RULES_V1 = [
    (["官方旗舰店"], "Official Flagship"),
    (["卖场旗舰店"], "Mall Flagship"),
    (["旗舰店"], "Flagship"),
    (["专卖店", "专营店"], "Specialty Store"),
    (["卖场店"], "Mall Store"),
    (["自营"], "Platform Direct"),
    (["超市"], "Supermarket"),
]
STORE_TYPE_V1_OTHER = "Other"
STORE_TYPE_V1_NULL = "Unknown"

# --- FIXED VALUES: v1 promotional months and season groups ------------------
PROMO_MONTHS_V1 = [1, 6, 9, 11, 12]
SEASON_GROUPS_V1 = [("spring_summer", [4, 5, 6]), ("summer", [7, 8]),
                    ("fall", [9, 10]), ("winter_holiday", [11, 12])]
SEASON_GROUP_V1_OTHER = "other"

# --- FIXED VALUES: v2 calendar flags by month ------------------------------
HOLIDAY_SEASON_MONTHS = [12, 1, 2]
MID_YEAR_MONTHS = [6, 7]
BACK_TO_SCHOOL_MONTHS = [8, 9]

# --- FIXED VALUES: epoch for days_since_epoch, months per day ---------------
EPOCH_DATE = "2021-01-01"
DAYS_PER_MONTH = 30.44
