"""The small lookup relations that decide results.

Larger relations (the full field-group registry, title dictionaries) are inputs: pass them as
DataFrames read from JSON, see ``pagemill.sources.specs``.
"""

from __future__ import annotations

# --- Fixed values: fetch routing, first matching rule wins -------------------------------
# (platform, resource type or None, needs sign-in or None, first backend, fallbacks)
ROUTING_RULES = (
    ("linkedin", "search", None, "api", ("playwright", "camoufox")),
    ("linkedin", "post", None, "camoufox", ("playwright",)),
    ("linkedin", None, True, "api", ("playwright", "camoufox")),
    ("linkedin", None, None, "playwright", ("camoufox",)),
    ("amazon", None, None, "http", ("playwright", "camoufox")),
    ("wikipedia", None, None, "api", ("http", "playwright")),
    ("arxiv", None, None, "api", ("http", "playwright")),
    ("generic", None, None, "http", ("playwright", "camoufox")),
    ("base", None, None, "api", ("http", "playwright")),
)
ROUTING_DEFAULT = ("http", ("playwright", "camoufox"))

# --- Fixed values: request rates and retries ----------------------------------------------
# platform -> (requests per minute, retries)
RATE_LIMITS = {
    "wikipedia": (60, 2),
    "arxiv": (30, 2),
    "amazon": (12, 4),
    "base": (24, 3),
    "linkedin": (6, 4),
}
RATE_DEFAULT = (30, 3)
BACKOFF_SECONDS = (2, 5, 10)

# --- Fixed values: circuit breaker --------------------------------------------------------
TRIP_CODES = (
    "RATE_LIMITED",
    "AUTH_EXPIRED",
    "CAPTCHA",
    "IP_BLOCKED",
    "SERVER_ERROR",
    "NETWORK_ERROR",
)
BREAKER_FAILURES = 2
BREAKER_COOLDOWN_SECONDS = 30.0

# --- Fixed values: what a person should do about an error ---------------------------------
NEXT_ACTIONS = {
    "refresh_session": "refresh login session and retry",
    "wait_and_retry": "wait and retry",
    "retry_later": "retry later",
    "notify_user": "notify user",
    "retry": "retry",
    "inspect": "inspect error and retry",
    "inspect_agent_browser": "inspect auto-browser setup",
    "inspect_auto_browser_setup": "inspect auto-browser setup",
    "inspect_auto_browser_state": "inspect auto-browser state",
    "retry_export_session": "retry session export",
    "open_public_url_and_complete_login": "open public URL and complete login",
    "provide_state": "provide cookies or storage state",
    "complete_auto_login": "complete login in auto-browser and retry",
}

# --- Fixed values: address templates, required field per (platform, type) -------------------
# (platform, type) -> (template, required fields)
URL_TEMPLATES = {
    ("wikipedia", "article"): ("https://en.wikipedia.org/wiki/{title}", ("title",)),
    ("arxiv", "paper"): ("https://arxiv.org/abs/{arxiv_id}", ("arxiv_id",)),
    ("amazon", "product"): ("https://www.amazon.com/dp/{asin}", ("asin",)),
    ("amazon", "seller"): ("https://www.amazon.com/sp?seller={seller_id}", ("seller_id",)),
    ("amazon", "search"): ("https://www.amazon.com/s?k={query}", ("query",)),
    ("base", "address"): ("https://basescan.org/address/{address}", ("address",)),
    ("base", "transaction"): ("https://basescan.org/tx/{tx_hash}", ("tx_hash",)),
    ("base", "token"): ("https://basescan.org/token/{contract_address}", ("contract_address",)),
    ("base", "contract"): ("https://basescan.org/address/{contract_address}#code", ("contract_address",)),
    ("linkedin", "search"): (
        "https://www.linkedin.com/search/results/{search_type}/?keywords={query}",
        ("search_type", "query"),
    ),
    ("linkedin", "profile"): ("https://www.linkedin.com/in/{public_identifier}/", ("public_identifier",)),
    ("linkedin", "company"): ("https://www.linkedin.com/company/{company_slug}/", ("company_slug",)),
    ("linkedin", "post"): ("https://www.linkedin.com/feed/update/{activity_urn}/", ("activity_urn",)),
    ("linkedin", "job"): ("https://www.linkedin.com/jobs/view/{job_id}/", ("job_id",)),
    ("generic", "page"): ("{url}", ("url",)),
}
ARTIFACT_TEMPLATES = {("arxiv", "paper"): {"pdf_url": "https://arxiv.org/pdf/{arxiv_id}.pdf"}}

# --- Fixed values: accepted input names of each required field ------------------------------
FIELD_ALIASES = {
    ("wikipedia", "article"): {"title": ("title", "page_title", "article_title", "post_id")},
    ("arxiv", "paper"): {"arxiv_id": ("arxiv_id", "paper_id", "id", "post_id")},
    ("amazon", "product"): {"asin": ("asin", "product_id", "id", "post_id")},
    ("amazon", "seller"): {"seller_id": ("seller_id", "merchant_id", "user_id")},
    ("amazon", "search"): {"query": ("query", "keyword", "search_term", "screen_name")},
    ("base", "address"): {"address": ("address", "wallet", "wallet_address", "account", "post_id")},
    ("base", "transaction"): {"tx_hash": ("tx_hash", "txhash", "transaction_hash", "hash", "post_id")},
    ("base", "token"): {"contract_address": ("contract_address", "token_address", "contract", "post_id")},
    ("base", "contract"): {"contract_address": ("contract_address", "address", "contract", "post_id")},
    ("linkedin", "search"): {
        "query": ("query", "keyword", "keywords", "search_term", "screen_name"),
        "search_type": ("search_type", "entity_type", "result_type"),
    },
    ("linkedin", "profile"): {
        "public_identifier": ("public_identifier", "vanity_name", "username", "screen_name"),
    },
    ("linkedin", "company"): {
        "company_slug": ("company_slug", "universal_name", "company_name_slug", "screen_name"),
    },
    ("linkedin", "post"): {"activity_urn": ("activity_urn", "urn", "activity_id", "post_id")},
    ("linkedin", "job"): {"job_id": ("job_id", "job_posting_id", "post_id")},
    ("generic", "page"): {"url": ("url", "canonical_url", "source_url")},
}
SEARCH_PATHS = {
    "company": "companies",
    "companies": "companies",
    "profile": "people",
    "people": "people",
    "job": "jobs",
    "jobs": "jobs",
    "post": "content",
    "content": "content",
}

# --- Fixed values: ordered alias rules for enrichment input ---------------------------------
COMMON_ALIASES = (
    ("summary", ("extract", "abstract", "description")),
    ("extract", ("summary", "plain_text")),
    ("abstract", ("summary", "description", "plain_text")),
    ("full_text", ("plain_text",)),
    ("references", ("citations", "refs")),
    ("bullet_points", ("highlights", "bullets")),
    ("category", ("categories", "category_path")),
    ("reviews_count", ("review_count", "ratings_count")),
    ("review_text", ("review_body", "body", "content")),
    ("seller_name", ("seller", "merchant_name", "shop_name")),
    ("price", ("current_price",)),
    ("images", ("image_urls",)),
    ("balance", ("eth_balance",)),
    ("token_balances", ("tokens", "assets")),
    ("transactions", ("txs", "transaction_list")),
    ("code", ("bytecode", "runtime_code")),
    ("source_code", ("verified_source", "contract_source")),
    ("abi", ("contract_abi",)),
    ("tx_hash", ("hash", "transaction_hash", "identifier")),
    ("from_address", ("from",)),
    ("to_address", ("to",)),
    ("input", ("input_data", "calldata")),
    ("gas_used", ("gasUsed",)),
    ("gas_price", ("gasPrice",)),
    ("block_number", ("blockNumber",)),
    ("logs", ("events", "log_entries")),
)
PLATFORM_ALIASES = {
    ("linkedin", "profile"): (("name", ("title",)), ("profile_url", ("canonical_url",))),
    ("linkedin", "company"): (
        ("company_name", ("title",)),
        ("about", ("description", "summary", "plain_text")),
        ("employee_count", ("staff_count",)),
        ("company_url", ("canonical_url",)),
    ),
    ("linkedin", "job"): (
        ("job_title", ("title", "headline")),
        ("job_description", ("description", "plain_text")),
        ("posted_date", ("published_at", "listed_at")),
    ),
    ("wikipedia", "article"): (("extract", ("summary", "plain_text")),),
    ("arxiv", "paper"): (
        ("abstract", ("summary", "description", "plain_text")),
        ("full_text", ("plain_text",)),
    ),
    ("amazon", "product"): (
        ("brand", ("manufacturer",)),
        ("availability", ("stock_status",)),
        ("fulfillment", ("shipping_type",)),
        ("variants", ("variant_options", "product_variants")),
    ),
    ("amazon", "review"): (
        ("review_text", ("plain_text",)),
        ("reviewer_name", ("author", "reviewer", "user_name")),
        ("rating", ("review_rating", "stars")),
        ("verified_purchase", ("is_verified_purchase", "verified")),
        ("review_images", ("photo_urls", "image_urls", "images")),
    ),
    ("amazon", "seller"): (
        ("seller_name", ("title", "name")),
        ("product_listings", ("products", "listings", "items")),
        ("seller_since", ("since", "shop_since", "joined_date")),
    ),
    ("base", "address"): (("address", ("identifier", "canonical_url")),),
    ("base", "contract"): (
        ("address", ("identifier", "contract_address", "canonical_url")),
        ("contract_address", ("address", "identifier")),
    ),
    ("base", "defi"): (("protocol_id", ("identifier", "title")),),
}

# --- Fixed values: HTML noise and main-content selectors -------------------------------------
NOISE_TAGS = ("nav", "footer", "aside", "script", "style", "noscript", "iframe", "svg")
# The class and id patterns of page noise, as they must match.
NOISE_CLASS = r"(^|\b)(nav|menu|sidebar|footer|header|ad|ads|tracking|cookie|banner|popup|modal|overlay|social-share|share-bar|breadcrumb|pagination|related-posts|comments|comment-form)(\b|$)"
NOISE_ID = r"(^|\b)(nav|menu|sidebar|footer|header|ad|ads|tracking|cookie|banner|popup|modal|overlay)(\b|$)"
NOISE_SELECTORS = {
    "linkedin": (
        ".global-nav", ".feed-identity-module", ".ad-banner-container", ".msg-overlay-list-bubble",
        ".scaffold-layout__aside", ".artdeco-toasts", ".authentication-outlet",
        ".share-box-feed-entry", ".feed-shared-update-v2__control-menu",
    ),
    "amazon": (
        "#nav-main", "#rhf", ".a-carousel", "#navFooter", "#nav-subnav", "#nav-tools",
        ".sponsored-products-truncator-truncate", "#ad-endcap-1", "#percolate-ui-ilm_div",
    ),
    "wikipedia": (
        "#mw-navigation", "#mw-panel", "#footer", ".mw-editsection", ".navbox", ".sistersitebox",
        ".noprint", ".mw-indicators", "#catlinks", ".mw-jump-link",
    ),
    "arxiv": ("#header", "#footer", ".extra-services", ".endorsers"),
    "base": (".header-container", ".footer-container", "#sidebar", ".ad-container"),
}
MAIN_SELECTORS = {
    "linkedin": {
        "search": "main",
        "profile": "main.scaffold-layout__main",
        "company": "section.org-page-details-module__card-spacing",
        "job": ".jobs-description",
        "default": "main",
    },
    "amazon": {"product": "#dp-container", "search": ".s-main-slot", "default": "#a-page"},
    "wikipedia": {"article": "#mw-content-text", "default": "#mw-content-text"},
    "arxiv": {"paper": "#abs", "default": "#content"},
    "base": {
        "address": "#ContentPlaceHolder1_maincontentinner",
        "transaction": "#ContentPlaceHolder1_maintable",
        "default": "#content",
    },
}

# --- Fixed values: skill patterns (pattern, category, label) ----------------------------------
SKILL_PATTERNS = (
    (r"\b(Python|Java|JavaScript|TypeScript|Go|Rust|C\+\+|C#|Ruby|Swift|Kotlin|Scala|R|MATLAB|PHP|Perl|Shell|Bash)\b",
     "programming_language", "Programming Languages"),
    (r"\b(React|Angular|Vue|Next\.js|Svelte|Django|Flask|FastAPI|Spring|Express|Rails|Laravel)\b",
     "framework", "Web Frameworks"),
    (r"\b(AWS|Azure|GCP|Google Cloud|Amazon Web Services|Kubernetes|Docker|Terraform|Ansible|Jenkins|CircleCI|GitHub Actions)\b",
     "cloud_devops", "Cloud & DevOps"),
    (r"\b(PostgreSQL|MySQL|MongoDB|Redis|Elasticsearch|DynamoDB|Cassandra|Neo4j|SQLite|Oracle|SQL Server)\b",
     "database", "Databases"),
    (r"\b(Machine Learning|Deep Learning|NLP|Computer Vision|TensorFlow|PyTorch|scikit-learn|Keras|Hugging Face|LLM|GPT|BERT|Transformers)\b",
     "ml_ai", "ML/AI"),
    (r"\b(Agile|Scrum|Kanban|CI/CD|DevOps|Microservices|REST|GraphQL|gRPC|API Design)\b",
     "methodology", "Methodologies"),
    (r"\b(Project Management|Product Management|Team Lead|Technical Writing|Public Speaking|Mentoring|Strategic Planning)\b",
     "soft_skill", "Soft Skills"),
    (r"\b(Figma|Sketch|Adobe XD|Photoshop|Illustrator|InDesign|Premiere|After Effects)\b",
     "design_tool", "Design Tools"),
    (r"\b(Tableau|Power BI|Looker|Apache Spark|Hadoop|Kafka|Airflow|dbt|Snowflake|BigQuery|Databricks)\b",
     "data_engineering", "Data Engineering"),
    (r"\b(Solidity|Web3|Blockchain|Smart Contracts|Ethereum|DeFi|NFT|Layer 2)\b",
     "blockchain", "Blockchain"),
    (r"\b(Linux|Unix|Windows Server|macOS|iOS|Android|Embedded|RTOS|ARM)\b",
     "platform", "Platforms"),
    (r"\b(Git|GitHub|GitLab|Bitbucket|SVN|Jira|Confluence|Notion|Slack)\b",
     "tool", "Development Tools"),
    (r"\b(PMP|AWS Certified|CKA|CKAD|CISSP|CISM|CEH|CompTIA|Google Cloud Certified|Azure Certified|Scrum Master|SAFe)\b",
     "certification", "Certifications"),
    (r"\b(English|Chinese|Mandarin|Spanish|French|German|Japanese|Korean|Portuguese|Arabic|Hindi|Russian)\b",
     "language", "Languages"),
)

# --- Fixed values: the platform-neutral enrichment groups -------------------------------------
# name -> (strategy, required fields, outputs, sources or source key, least confidence)
FIELD_GROUPS = {
    "about_summary": (
        "generative_only", ("about", "headline"),
        (("about_summary", "string"), ("about_topics", "array<string>"), ("about_sentiment", "string")),
        (), None,
    ),
    "standardized_job_title": (
        "extractive_then_generative", ("headline",),
        (("standardized_job_title", "string"), ("seniority_level", "string"), ("job_function_category", "string")),
        ("lookup", "headline"), 0.8,
    ),
    "skills_extraction": (
        "extractive_then_generative", ("plain_text",),
        (("skills_extracted", "array<string>"), ("skill_categories", "array<string>")),
        ("regex", "plain_text"), 0.7,
    ),
    "summaries": ("generative_only", (), (("summary", "string"),), (), None),
    "classifications": (
        "extractive_only", (), (("classification", "string"),), ("lookup", "resource_type"), 0.8,
    ),
    "linkables": (
        "extractive_only", (), (("linkable_identifier", "string"),), ("regex", "canonical_url"), 0.8,
    ),
    "multimodal": (
        "passthrough", (), (("multimodal_signal", "string"),), ("image_url", "media_url", "thumbnail"), None,
    ),
    "behavior": (
        "passthrough", (), (("behavior_signal", "string"),), ("behavior", "activity", "actions"), None,
    ),
    "risk": ("passthrough", (), (("risk_signal", "string"),), ("risk", "severity", "issue"), None),
    "code": (
        "passthrough", (), (("code_signal", "string"),), ("code_url", "repo", "language", "filename"), None,
    ),
    "figures": (
        "passthrough", (), (("figure_signal", "string"),), ("figure_url", "figure_caption", "figure_id"), None,
    ),
}
#: Text keys offered to every group besides its required fields.
SOURCE_TEXT_KEYS = ("plain_text", "markdown", "title", "summary", "headline", "about", "description")
