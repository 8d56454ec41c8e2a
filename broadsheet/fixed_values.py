"""Fixed values.

Every word list, pattern, limit and lookup table below is part of the curation
policy: results are only comparable when these values are the same, so they
are kept together, as plain text, in their natural order.
"""

# --- Fixed values: content hosts and terms ---------------------------------
BLOCKED_HOSTS = ("github.com", "openai.com")
BLOCKED_WORDS = "openai|chatgpt|codex|github"

TOPIC_WORDS = (
    "ai|deepseek|anthropic|claude|gemini|agent|mcp|model|llm|api|machine learning|generative|chip|"
    "semiconductor|software|robot|robotics|vehicle|ev|mobility|space|satellite|science|research|"
    "internet|cloud|security|processor|device|smartphone|quantum"
)
TOPIC_STEMS = (
    "energy|battery|materials|biotech|medical|genome|fusion|privacy|科技|芯片|能源|电池|材料|生物|医疗|"
    "量子|航天|网络|安全|软件|研究|机器人"
)
WIDE_TOPIC_STEMS = (
    "policy|economy|economic|industry|industrial|education|university|college|employment|job|talent|"
    "skills?|startup|entrepreneur|manufacturing|infrastructure|population|society|social|"
    "digital economy|regulation|legislation|investment|trade|labor|workforce|climate|health|"
    "政策|经济|产业|工业|制造|教育|高校|就业|人才|职业|技能|创业|投资|数字经济|社会|人口|基础设施|统计|发展|"
    "规划|意见|通知|办法|报告"
)

# --- Fixed values: categories, channels, roles ------------------------------
CATEGORIES = (
    "ai", "chips", "consumer_tech", "software", "robotics", "mobility", "space", "science", "internet",
    "other_tech", "policy", "economy", "industry", "education", "employment", "society",
    "infrastructure", "opportunities",
)
CHANNELS = ("technology", "policy_economy", "society_trends", "future_opportunities", "deep_read")
SOURCE_ROLES = ("primary", "media", "discovery")
ADAPTERS = ("rss", "atom", "html_index", "json_index", "discovery_json")
HEALTH_STATES = ("active", "degraded", "paused")
NETWORK_ROUTES = ("system", "direct", "explicit")
REGISTRY_FIELDS = (
    "id", "name", "source_type", "adapter", "url", "allow_hosts", "priority", "article_path_pattern",
    "enabled", "cleaning", "conditional_requests", "region", "category", "tier", "language",
    "fetch_method", "health_status", "source_role", "channel", "proxy_mode", "network_route",
    "request_timeout_seconds", "request_attempts",
)

# Category rules in order of precedence.
CATEGORY_RULES = (
    ("employment", "employment|jobs?|labor|workforce|career|internship|graduate|就业|招聘|实习|劳动|职业"),
    ("education", "education|university|college|student|degree|training|教育|高校|大学|学生|升学|培训"),
    ("policy", "policy|regulation|law|plan|guideline|政策|法规|意见|通知|办法|规划|条例"),
    ("economy", "economy|economic|gdp|trade|investment|inflation|statistics|经济|投资|贸易|统计|增长|国内生产总值"),
    ("industry", "industry|industrial|manufacturing|supply chain|产业|工业|制造|供应链|企业"),
    ("opportunities", "opportunit|talent|skills?|startup|entrepreneur|fellowship|grant|机会|人才|技能|创业|项目|资助"),
    ("society", "society|social|population|public service|digital life|社会|人口|公共服务|数字生活|民生"),
    ("infrastructure", "infrastructure|network|grid|transport|基础设施|网络|电网|交通|物流"),
)
CHANNEL_GROUPS = (
    ("future_opportunities", ("employment", "education", "opportunities")),
    ("policy_economy", ("policy", "economy", "industry")),
    ("society_trends", ("society", "infrastructure")),
)

# --- Fixed values: headline patterns ---------------------------------------
DEEP_TITLE = (
    "tutorial|how to|deep dive|analysis|lessons|review|report|study|research|paper|"
    "教程|实操|研究|论文|报告|复盘|深度"
)
IMPACT_TITLE = (
    "breakthrough|first|critical|vulnerability|launch|release|discovery|clinical|"
    "突破|首次|重大|漏洞|发布|临床"
)
LOW_VALUE_TITLE = (
    "APOD:|image of the day|high school.*challenge|middle school.*challenge|named.*auditor|"
    "named.*top university|innovation fellow|hall of fame|showroom|new exhibition|podcast:|"
    "early careers|humanist lens|finding purpose|luxury yacht"
)
SHORT_LIVED = (
    "flash sale|discount|promotion|stock price|shares (?:rose|fell)|outage|security incident|"
    "launch event|product launch|announces? (?:a |the )?new|发布会|促销|股价|临时故障|安全事件|限时|抽奖"
)
# What each alternative of a pattern holds at least, in lower case.
SHORT_LIVED_PARTS = (
    "flash sale", "discount", "promotion", "stock price", "shares ", "outage", "security incident", "launch event",
    "product launch", "announce", "发布会", "促销", "股价", "临时故障", "安全事件", "限时", "抽奖",
)
INDEX_PATHS = ("", "/research", "/news", "/about", "/newsroom", "/en/news")

# Body evidence of a long read, by kind.
DEEP_EVIDENCE = (
    ("mechanism", "works by|underlying mechanism|principles? of|工作原理|作用机制|推导过程"),
    ("method", "methodology|implementation details|step.by.step|工程实践|实现步骤|具体方法"),
    ("code", r"```|\bdef \w+\(|\bfunction \w+\(|pip install|代码示例"),
    ("comparative_evidence",
     "comparative analysis|experimental results|systematic review|实验结果|系统综述|对比分析"),
)
NUMBERED_STEP = r"(?:step|步骤)\s*(\d+|[一二三四])"
DEEP_EVIDENCE_PARTS = {
    "mechanism": ("works by", "underlying mechanism", "principle", "工作原理", "作用机制", "推导过程"),
    "method": ("methodology", "implementation details", "step", "工程实践", "实现步骤", "具体方法"),
    "code": ("```", "def ", "function ", "pip install", "代码示例"),
    "comparative_evidence": ("comparative analysis", "experimental results", "systematic review", "实验结果", "系统综述", "对比分析"),
}
NUMBERED_STEP_PARTS = ("step", "步骤")

# --- Fixed values: edition rules -------------------------------------------
RULES = {
    "minimum": 10, "target": 14, "maximum": 18, "explore_minimum": 2,
    "personal_categories": ("ai", "robotics"), "major_score": 85,
    "category_share": 0.65, "media_limit": 2, "source_share": 0.25,
}
TIER_POINTS = ((1, 100), (2, 85), (3, 65))
SUPPLY_LAYERS = ("today", "catch_up", "deep_read", "evergreen")
SAME_EVENT_RATIO = 0.78
CHUNK_WORDS = 18
CLEAN_LIMIT = 18_000
RAW_LIMIT = 60_000
TITLE_LIMIT = 500
FINGERPRINT_CHARS = 1_500
DEEP_CHARS = 1_500  # least length of the clean text of a deep read
SCAN_CHARS = 3_000
FEED_CAP = 100
SOURCE_CAP = 20
RUN_CAP = 200
WINDOW_HOURS = 168
FUTURE_MINUTES = 10
DAILY_TOKENS = 40_000
LOCAL_ZONE = "Asia/Shanghai"
ENRICH_TASK = "phase5_5_bilingual_tech_daily"

# --- Fixed values: page extraction -----------------------------------------
DROPPED_TAGS = ("script", "style", "svg", "nav", "footer", "header", "aside", "form", "noscript")
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
)
SELECTOR = r"^(?P<tag>[a-z][a-z0-9-]*)?(?:(?P<kind>[.#])(?P<value>[a-zA-Z_][\w-]*))?$"
TITLE_DATE = r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},\s+\d{4}\b"

META_FORWARD = r'(?i)<meta[^>]+(?:property|name)=["\'](?:{name})["\'][^>]+content=["\']([^"\']+)'
META_BACKWARD = r'(?i)<meta[^>]+content=["\']([^"\']+)["\'][^>]+(?:property|name)=["\'](?:{name})["\']'
TIME_TAG = r'(?i)<time[^>]+datetime=["\']([^"\']+)'
DATE_METAS = ("article:published_time", "date", "PubDate")

# --- Fixed values: stored names ------------------------------------------------
OFF_TOPIC = "radar_terms_absent"
EDITION_CATEGORY = {1: "ai", 2: "tech", 3: "radar"}
MODEL_ERROR_TYPE = "DeepSeekError"
MODEL_HTTP_MESSAGE = r"^DeepSeek HTTP \d{3}$"
TOO_LARGE_MESSAGE = "Source response exceeds 2 MB"
REDIRECT_MESSAGE = "Fetch redirected outside allowed HTTPS hosts:"
UNSURE_SEND = "feishu_send_failed_or_uncertain"

# --- Fixed values: bilingual fact grammar ------------------------------------
FIELD_NAMES = ("title", "what_happened", "why_it_matters")
REPAIR_FIELDS = {
    "title": {"en": "title_en", "zh": "title_cn"},
    "what_happened": {"en": "what_happened_en", "zh": "what_happened"},
    "why_it_matters": {"en": "why_it_matters_en", "zh": "why_it_matters"},
}
HARD_FACT_TYPES = (
    "organization", "organisation", "company", "institution", "product", "model", "technology",
    "technical_name", "version",
)
FORM_LIMIT = 48
SCHEMA_LISTS = (
    "key_entities", "dates", "numbers", "versions", "products", "companies", "technologies",
    "limitations", "importance_reasons",
)
MONTH_NAMES = (
    r"(?P<month>jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|"
    r"jul(?:y)?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
DATE_ISO = (
    r"(?<!\d)(?P<year>20\d{2})[-/](?P<month>1[0-2]|0?[1-9])[-/](?P<day>3[01]|[12]\d|0?[1-9])(?!\d)"
)
DATE_ZH = (
    r"(?:(?P<year>20\d{2})\s*年\s*)?(?P<month>1[0-2]|0?[1-9])\s*月\s*(?P<day>3[01]|[12]\d|0?[1-9])\s*[日号]?"
)
DATE_ZH_PAIR = (
    r"(?:(?P<year>20\d{2})\s*年\s*)?(?P<month>1[0-2]|0?[1-9])\s*月\s*(?P<day>3[01]|[12]\d|0?[1-9])\s*[日号]?\s*"
    r"(?:和|与|及|至|、)\s*(?P<end>3[01]|[12]\d|0?[1-9])\s*[日号]?"
)
DATE_ZH_MONTH = r"(?P<year>20\d{2})\s*年\s*(?P<month>1[0-2]|0?[1-9])\s*月(?!\s*\d{1,2}\s*[日号])"
DATE_EN = r"\b" + MONTH_NAMES + r"\.?\s+(?P<day>[12]?\d|3[01])(?:,?\s*(?P<year>20\d{2}))?\b"
DATE_EN_RANGE = (
    r"\b" + MONTH_NAMES + r"\.?\s+(?P<day>[12]?\d|3[01])\s*[-–]\s*(?P<end>[12]?\d|3[01])(?:,?\s*(?P<year>20\d{2}))?\b"
)
DATE_EN_PAIR = (
    r"\b" + MONTH_NAMES + r"\.?\s+(?P<day>[12]?\d|3[01])\s+and\s+(?P<end>[12]?\d|3[01])(?:,?\s*(?P<year>20\d{2}))?\b"
)
DATE_EN_MONTH = r"\b" + MONTH_NAMES + r"\.?\s+(?P<year>20\d{2})\b"
CLOCK_TIME = r"(?<!\d)(?:[01]?\d|2[0-3]):[0-5]\d(?!\d)"
VERSION_LITERAL = r"(?<![A-Za-z0-9_.])v?\d+(?:\.\d+){1,3}(?![A-Za-z0-9_]|\.\d)"
# What follows a dotted number that is no version.
NOT_A_VERSION = (
    r"\s*(?:thousand|million|billion|trillion)\b",
    r"\s*(?:km\s*/\s*s(?![A-Za-z])|公里\s*/\s*秒|千米\s*/\s*秒)",
    r"[%％]|\s*(?:[xX]|倍|千|万|亿|万亿|百万|千万)",
)
NUMBER_EN = (
    r"(?<![\w.])(?P<value>\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?)\s*"
    r"(?P<unit>%|percent|thousand|million|billion|trillion|[kKmMbB]|[xX])?(?!\w)"
)
NUMBER_ZH = (
    r"(?<![A-Za-z0-9_.])(?P<value>\d{1,3}(?:[,，]\d{3})+|\d+(?:\.\d+)?)\s*"
    r"(?P<unit>万亿|千万|百万|%|％|千|万|亿|倍|[kKmMbB]|[xX])?(?![A-Za-z0-9_])"
)
TRAILING_SCALE = r"\s*(thousand|million|billion|trillion)\b"
ORDINAL_EN = r"(?<![\w.])(?P<value>\d{1,3}(?:,\d{3})+|\d+)(?:st|nd|rd|th)\b"
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11,
    "twelve": 12,
}
COUNTED_EN = r"\b(?P<word>" + "|".join(NUMBER_WORDS) + r")\s*-?\s*(?:loops?|steps?|particles?)\b"
SCALED_EN = r"\b(?P<word>" + "|".join(NUMBER_WORDS) + r")\s+(?P<scale>thousand|million|billion|trillion)\b"
COUNTED_ZH = r"(?P<word>[二两三四五六七八九十])(?=(?:圈|粒子|维|倍|毫秒|参数|步))"
ZH_DIGITS = {"一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "十": 10}
UNIT_MULTIPLIERS = {
    "thousand": 1_000, "million": 1_000_000, "billion": 1_000_000_000, "trillion": 1_000_000_000_000,
    "k": 1_000, "m": 1_000_000, "b": 1_000_000_000,
    "千": 1_000, "万": 10_000, "百万": 1_000_000, "千万": 10_000_000, "亿": 100_000_000, "万亿": 1_000_000_000_000,
}
PERCENT_UNITS = ("%", "％", "percent")
MULTIPLE_UNITS = ("x", "倍")
AVAILABILITY_EN = (
    r"\b(?:does not support|not supported|unavailable|available|supports?|released|release|ships?|"
    r"will release|planned)\b"
)
AVAILABILITY_ZH = (
    r"(?:不支持|未支持|不可使用|无法使用|不可用|将发布|计划发布|即将上线|计划上线|已发布|发布|已上线|上线|可用|"
    r"可(?:以|在[^。；;不无]{0,60})?使用|支持|开放|释放|获得|获取)"
)
AVAILABILITY_STATE = {
    "does not support": "unsupported", "not supported": "unsupported", "unavailable": "unsupported",
    "不支持": "unsupported", "未支持": "unsupported", "不可用": "unsupported", "不可使用": "unsupported",
    "无法使用": "unsupported",
    "will release": "planned", "planned": "planned", "将发布": "planned", "计划发布": "planned",
    "即将上线": "planned", "计划上线": "planned",
    "release": "released", "released": "released", "ships": "released", "ship": "released",
    "已发布": "released", "发布": "released", "已上线": "released", "上线": "released", "释放": "released",
}
FORM_PUNCTUATION = "[\"'‘’“”《》,，。:：;；!?！？（）()\\[\\]{}]"

# --- Fixed values: secrets ---------------------------------------------------
SECRET_RULES = (
    (r"(?i)(https?://)[^\s/@]+(?::[^\s/@]*)?@", "$1[REDACTED]@"),
    (r"(?i)(authorization\s*[:=]\s*)(?:bearer|basic)?\s*[^\r\n]+", "$1[REDACTED]"),
    (r"(?i)((?:access[_-]?token|token|username|password|passwd|secret|api[_-]?key)\s*[=:]\s*)[^\s&\"']+",
     "$1[REDACTED]"),
    (r"\b(?:gh[pousr]_[A-Za-z0-9_]+|github_pat_[A-Za-z0-9_]+)\b", "[REDACTED]"),
)
MODEL_ERROR_RULES = (
    (r"https?://[^\s)]+", "[URL]"),
    (r"(?i)(bearer|api[_ -]?key|secret|access[_ -]?token|password)(?:\s*[:=]\s*|\s+)\S+", "$1=[REDACTED]"),
)
MODEL_ERROR_LIMIT = 300

# --- Fixed values: audit stages ------------------------------------------------
VIEW_STAGES = ("collected", "normalized", "candidate", "enrichment", "validation", "publishable")
CANDIDATE_STAGES = (
    "initial_candidate_pool", "initial_selection", "candidate_pool", "initial_freshness",
    "initial_quality_filter", "initial_historical_dedup",
)
# Stages whose drop rules out each view stage.
TERMINAL_BEFORE = {
    "normalized": (
        "source_url_dedup", "feed_freshness", "source_cap",
    ),
    "candidate": (
        "source_url_dedup", "feed_freshness", "source_cap", "normalization", "extracted_freshness",
        "release_burst_dedup", "collection_cap", "content_gate",
    ),
    "enrichment": (
        "source_url_dedup", "feed_freshness", "source_cap", "normalization", "extracted_freshness",
        "release_burst_dedup", "collection_cap", "content_gate", "initial_freshness",
        "initial_quality_filter", "initial_historical_dedup", "initial_selection",
    ),
    "validation": (
        "source_url_dedup", "feed_freshness", "source_cap", "normalization", "extracted_freshness",
        "release_burst_dedup", "collection_cap", "content_gate", "initial_freshness",
        "initial_quality_filter", "initial_historical_dedup", "initial_selection", "enrichment",
        "token_budget",
    ),
    "publishable": (
        "source_url_dedup", "feed_freshness", "source_cap", "normalization", "extracted_freshness",
        "release_burst_dedup", "collection_cap", "content_gate", "initial_freshness",
        "initial_quality_filter", "initial_historical_dedup", "initial_selection", "enrichment",
        "token_budget", "validation", "repair",
    ),
}
SUPPLY_FIELDS = (
    "supply_layer", "is_today", "locked_today", "historical_age_days", "selected_as_fallback",
    "fallback_priority", "reserve_type", "reserve_status", "reserve_reason", "policy_validity",
    "deep_read", "cache_reused",
)
SCORE_STAGES = (
    "final_selection", "final_candidate_pool", "final_quality_filter", "validation", "enrichment_cache",
)

# --- Fixed values: outcomes -------------------------------------------------------
FAILURE_CODES = {
    "collection_failed": 2, "normalization_failed": 2, "enrichment_failed": 3, "model_request_failed": 3,
    "token_budget_exhausted": 4, "publication_or_deployment_failed": 5, "publish_failed": 5,
    "publish_verification_failed": 6, "feishu_send_failed_or_uncertain": 7, "validation_failed": 8,
    "persistence_failed": 9, "no_qualified_tech_news": 1,
}
NORMAL_SKIPS = ("already_sent_or_pending", "dry_run", "feishu_send_dry_run", "verified_without_send")
