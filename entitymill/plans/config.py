"""What is known of the sources: columns with their cleaners, field priorities, services.

Fixed values, as text: names of columns and services are those of the data.
"""

from __future__ import annotations


def _all(cleaner: str, columns: str) -> dict[str, str]:
    return dict.fromkeys(columns.split(), cleaner)


#: source: column to cleaner, in output order. Leaving a line out leaves the column out.
SILVER: dict[str, dict[str, str]] = {
    "company_info": {"企業名": "short_text", "本社都道府県": "address", "代表者名": "short_text", "従業員数": "people_count", "企業規模": "short_text", "業種": "short_text", "業種詳細": "short_text", "代表電話番号": "phone"},
    "ra_company": {"本社所在地": "address", "設立": "date", "資本金": "money", **_all("long_text", "事業所 関連会社 株主"), "株主公開": "short_text", **_all("long_text", "決算情報 備考"), "公開求人数": "people_count"},
    "ra_kyujin": {"想定年収": "short_text", "仕事の特徴": "long_text"},
    "mynavi": {"本社郵便番号": "zipcode", **_all("long_text", "採用実績校 採用実績学部学科")},
    "rikunabi_company": {
        "業種": "short_text", "設立": "date", "代表者": "short_text", "資本金": "money", "従業員数": "people_count", "売上高": "money", "純利益": "money", "地域別売上高": "long_text", "連結子会社数": "people_count",
        "連結研究開発費": "money", **_all("long_text", "事業内容 事業所 企業理念 関連会社 リクナビ限定情報"), "プレエントリー候補リスト登録人数": "people_count",
    },
    "rikunabi_employ": {
        **_all("long_text", "主な募集職種 主な勤務地 応募資格 積極採用対象 採用予定学科"), "採用人数": "people_count", **_all("long_text", "新卒採用人数 初年度月収例 選考フロー 給与 手当 昇給 賞与"), "勤務時間": "short_text",
        **_all("long_text", "休日休暇 福利厚生 試用期間 研修制度 自己啓発支援 メンター制度 キャリアコンサルティング制度 社内検定制度"), **_all("numeric_value", "月平均残業時間 有給休暇取得日数"), "海外赴任者数": "people_count",
        "受動喫煙対策": "long_text", **_all("numeric_value", "平均勤続年数 平均年齢"), "提出書類": "long_text", "採用活動開始時期": "short_text",
    },
    "caritasu": {**_all("short_text", "企業名 上場区分"), "沿革": "long_text"},
    "prtimes": {"本社所在地": "address", "電話番号": "phone", "企業URL": "url", "プレスリリース": "json", **_all("url", "SNS_X SNS_Facebook SNS_YouTube")},
    "en_hyouban": {
        "company_name": "short_text", "total_score": "ratio", **_all("short_text", "review_count founded_year"), "employees": "people_count", "capital": "money", "listed_year": "short_text", "avg_salary": "salary", "avg_age": "numeric_value",
        **_all("ratio", "score_growth score_advantage score_meritocracy score_culture score_youth score_contribution score_innovation score_leadership"), "reviews_text": "long_text",
    },
    "phones": {"source_url": "url", **_all("short_text", "拠点 事業部 ラベル"), "電話番号": "phone", "担当者名リレーションキー": "short_text"},
    "persons": {"source_url": "url", **_all("short_text", "拠点 事業部 ラベル 担当者名 電話番号リレーションキー")},
    "emails": {"事業部": "short_text", "メールアドレス": "email"},
    "competitors": _all("short_text", "類似企業1 類似企業2 類似企業3 競合企業1 競合企業2 競合企業3"),
    "hr": {"企業名_掲載名": "short_text", "掲載日": "date"},
    "call_logs": {
        **_all("short_text", "company_name sales_rep_name"), "phone_number": "phone", **_all("short_text", "phone_status product_name"), "phone_status_memo": "long_text", "discovered_number": "phone", "discovered_number_memo": "long_text",
        **_all("short_text", "call_result spoke_with discovered_person_chuto discovered_person_shinsotsu"), "notes": "long_text",
    },
}

#: Sources with several rows for an entity; the others keep its latest.
MANY = ("phones", "persons", "emails", "call_logs", "hr")

#: Gold field: the sources' columns that it may come from, first choice first.
PRIORITY: dict[str, tuple[str, ...]] = {
    "本社所在地": ("ra_company.本社所在地", "prtimes.本社所在地"), "本社都道府県": ("company_info.本社都道府県",), "本社郵便番号": ("mynavi.本社郵便番号",),
    **{c: (f"ra_company.{c}", f"rikunabi_company.{c}") for c in "設立 資本金 事業所 関連会社".split()},
    "代表者": ("rikunabi_company.代表者", "company_info.代表者名"), "従業員数": ("rikunabi_company.従業員数", "company_info.従業員数"),
    "企業規模": ("company_info.企業規模",), "業種": ("rikunabi_company.業種",), "業種_csv": ("company_info.業種",), "業種詳細": ("company_info.業種詳細",), "代表電話番号": ("company_info.代表電話番号",),
    **{c: (f"caritasu.{c}",) for c in "上場区分 沿革".split()},
    **{c: (f"prtimes.{c}",) for c in "企業URL 電話番号 プレスリリース SNS_X SNS_Facebook SNS_YouTube".split()},
    **{c: (f"rikunabi_company.{c}",) for c in "売上高 純利益 地域別売上高 連結子会社数 連結研究開発費 事業内容 企業理念 リクナビ限定情報 プレエントリー候補リスト登録人数".split()},
    **{c: (f"ra_company.{c}",) for c in "株主 株主公開 決算情報 公開求人数 備考".split()},
    **{c: (f"ra_kyujin.{c}",) for c in "想定年収 仕事の特徴".split()},
    **{c: (f"mynavi.{c}",) for c in "採用実績校 採用実績学部学科".split()},
    **{c: (f"rikunabi_employ.{c}",) for c in SILVER["rikunabi_employ"]},
    **{c: (f"rikunabi_employ.{c}",) for c in "女性役員比率 女性管理職比率 育休取得者数_男性 育休取得者数_女性 育休対象者数_男性 育休対象者数_女性 育休取得率_男性 育休取得率_女性 直近採用者数 直近離職者数 直近定着率".split()},
    **{c: (f"en_hyouban.{c}",) for c in SILVER["en_hyouban"] if c != "company_name"},
}

SERVICES = "labbase talentbook type_shinsotsu onecareer levtech_rookie bizreach_campus offerbox en_tenshoku caritasu career_ticket bizreach en_ambi type_chuto hitotore acaric supporters".split()
COMPETITOR_SLOTS = list(SILVER["competitors"])
