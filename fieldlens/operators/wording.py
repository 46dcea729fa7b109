"""Texts of the evidence documents."""

# Sentences, headings and labels of the documents.
WHY = "Retrieved as most relevant to a new factory structure on agricultural land."
ZONING = "Agricultural farmland (農牧用地); factory use is not a permitted use."
ACTION = (
    "Dispatch a field inspection to verify the structure and its use; if confirmed as an "
    "unregistered factory built after 2016-05-20, proceed under 工廠管理輔導法 第28-1條 "
    "(stop water/electricity and demolish) and 區域計畫法 第21條 (penalty + restoration)."
)
NO_STATUTES = "(no statute excerpts retrieved)"
REPORT_SOURCE = "Disfactory"
QUERY_HEAD = "農地（"
QUERY_PLOT = " 地號 "
QUERY_TAIL = (
    "）疑似新建未登記工廠，土地編定為農牧用地，違反非都市土地使用管制與工廠管理輔導法，"
    "主管機關得依區域計畫法、農業發展條例停止供電供水並拆除。罰則 拆除 恢復原狀。"
)
MAX_STATUTES = 3

# Own wording.
CAVEATS = (
    "This text was filled in from a template. Ten-metre pixels blur small buildings: compare with detailed aerial photos and "
    "visit the place before acting. The list of known sites has gaps."
)
TEMPLATE_MODEL = "template"

# Name printed as the producer of a document.
GENERATOR = "fieldlens"

# Wording that states an offence as a fact.
OVER_CERTAIN = ("is illegal", "is an illegal", "has violated", "violates the law", "is guilty", "committed an offence")
