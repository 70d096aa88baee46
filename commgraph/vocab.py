"""Closed vocabularies of the data model (fixed values, in their order)."""

STAGES = ("discover", "scrape", "filter", "summarize", "extract", "categorize", "graph")
STATUSES = ("COMPLETED", "FAILED", "FILTERED")
CONTENT_TYPES = ("speech", "debate", "interview", "presentation", "other", "unknown")
TOPICS = (
    "economics",
    "immigration",
    "elections",
    "technology",
    "foreign_affairs",
    "healthcare",
    "energy_climate",
    "defense",
    "social",
    "government",
    "legal",
    "media",
    "personnel",
    "sports",
    "other",
)
ENTITY_TYPES = ("organization", "location", "person", "program", "product", "event", "other")
SENTIMENTS = ("positive", "negative", "neutral", "unclear")
INDUSTRIES = ("politics", "technology", "finance", "healthcare", "energy", "media", "academia")
DATE_WEIGHTS = {"datetime_attr": 7, "schema_org": 5, "url_path": 3, "near_title": 2, "metadata": 1}
