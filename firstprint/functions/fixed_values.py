"""These must equal the published formats for right results."""

# English month abbreviations in calendar order.
MONTH_ABBREVIATIONS = ["jan", "feb", "mar", "apr", "may", "jun",
                       "jul", "aug", "sep", "oct", "nov", "dec"]

# First and last day of month that a published window covers.
WINDOW_DAYS = {"D10": (1, 10), "D20": (1, 20), "MONTH": (1, 31)}

# Release-stage words, strongest first, and the stage each one names.
STAGE_WORDS = [("確定", "FIXED"), ("確々報", "REVISED"), ("確報", "DETAILED"),
               ("9桁速報", "PROV9"), ("速報", "PROV9")]

# Stage ranks: a higher rank replaces a lower one.
STAGE_RANKS = {"PROV9": 1, "DETAILED": 2, "REVISED": 3, "FIXED": 4}
PRESS_STAGE_RANKS = {"MONTH_PROV": 1, "MONTH_DP": 2}

# Report titles that recur, most specific first, and their English names.
TITLE_GLOSSES = [
    ("四半期決算短信", "quarterly earnings release"),
    ("決算短信", "earnings release"),
    ("決算説明", "results presentation"),
    ("配当予想の修正", "dividend forecast changed"),
    ("業績予想の修正", "profit guidance changed"),
    ("予想値と実績値", "results versus guidance gap"),
    ("自己株式の消却", "share cancellation"),
    ("自己株式の取得", "share buyback"),
    ("自己株券買付状況", "buyback progress report"),
    ("大量保有報告書", "5% big-holder report"),
    ("変更報告書", "big-holder stake change report"),
    ("中期経営計画", "medium-term business plan"),
    ("譲渡制限付株式報酬", "restricted stock pay for staff (routine)"),
    ("半期報告書", "half-year report"),
    ("有価証券報告書", "annual report"),
    ("臨時報告書", "extraordinary report"),
    ("영업(잠정)실적", "early, unaudited operating results"),
    ("잠정실적", "early, unaudited results"),
    ("현금ㆍ현물배당결정", "dividend declared"),
    ("배당", "dividend"),
    ("주식소각결정", "share cancellation decided"),
    ("자기주식취득결정", "share buyback decided"),
    ("자기주식처분결정", "treasury shares to be sold or used"),
    ("기업가치제고계획", "corporate value-up plan (shareholder-return plan)"),
    ("기업가치 제고", "corporate value-up plan (shareholder-return plan)"),
    ("임원ㆍ주요주주특정증권등소유상황보고서", "director or major-holder share dealing"),
    ("최대주주등소유주식변동신고서", "largest shareholder group's holdings changed"),
    ("조회공시요구(풍문또는보도)에대한답변(미확정)",
     "reply to the exchange's question about a rumor or press report: not yet decided"),
    ("조회공시요구(풍문또는보도)에대한답변",
     "reply to the exchange's question about a rumor or press report"),
    ("조회공시요구", "reply to the exchange's question"),
    ("소송등의판결ㆍ결정", "court ruling in a lawsuit"),
    ("소송등의제기", "lawsuit filed"),
    ("주식등의대량보유상황보고서", "5% big-holder report"),
    ("신규시설투자", "new capacity investment"),
    ("기업설명회", "investor presentation scheduled"),
    ("분기보고서", "quarterly report"),
    ("반기보고서", "half-year report"),
    ("사업보고서", "annual report"),
]

# Filing type codes that imply a topic whatever the description says.
DOC_TYPE_TOPICS = {
    "350": "ownership", "360": "ownership",
    "220": "buyback", "230": "buyback",
    "120": "results", "140": "results", "160": "results",
}

# Field triples (long, short, spread) per trader group and report family.
# Spellings are the publisher's own.
GROUP_FIELDS = {
    "legacy": {
        "noncommercial": ("noncomm_positions_long_all", "noncomm_positions_short_all",
                          "noncomm_postions_spread_all"),
        "commercial": ("comm_positions_long_all", "comm_positions_short_all", None),
        "nonreportable": ("nonrept_positions_long_all", "nonrept_positions_short_all", None),
    },
    "disagg": {
        "producer_merchant": ("prod_merc_positions_long", "prod_merc_positions_short", None),
        "swap_dealer": ("swap_positions_long_all", "swap__positions_short_all",
                        "swap__positions_spread_all"),
        "managed_money": ("m_money_positions_long_all", "m_money_positions_short_all",
                          "m_money_positions_spread"),
        "other_reportable": ("other_rept_positions_long", "other_rept_positions_short",
                             "other_rept_positions_spread"),
        "nonreportable": ("nonrept_positions_long_all", "nonrept_positions_short_all", None),
    },
    "tff": {
        "dealer": ("dealer_positions_long_all", "dealer_positions_short_all",
                   "dealer_positions_spread_all"),
        "asset_manager": ("asset_mgr_positions_long", "asset_mgr_positions_short",
                          "asset_mgr_positions_spread"),
        "leveraged_money": ("lev_money_positions_long", "lev_money_positions_short",
                            "lev_money_positions_spread"),
        "other_reportable": ("other_rept_positions_long", "other_rept_positions_short",
                             "other_rept_positions_spread"),
        "nonreportable": ("nonrept_positions_long_all", "nonrept_positions_short_all", None),
    },
}

# Western Easter Sundays as published.
EASTER_SUNDAYS = """
    1990-04-15 1991-03-31 1992-04-19 1993-04-11 1994-04-03 1995-04-16 1996-04-07 1997-03-30 1998-04-12 1999-04-04
    2000-04-23 2001-04-15 2002-03-31 2003-04-20 2004-04-11 2005-03-27 2006-04-16 2007-04-08 2008-03-23 2009-04-12
    2010-04-04 2011-04-24 2012-04-08 2013-03-31 2014-04-20 2015-04-05 2016-03-27 2017-04-16 2018-04-01 2019-04-21
    2020-04-12 2021-04-04 2022-04-17 2023-04-09 2024-03-31 2025-04-20 2026-04-05 2027-03-28 2028-04-16 2029-04-01
    2030-04-21""".split()
