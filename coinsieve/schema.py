"""Entity schemas as DDL text, and the fixed category list."""

# Category names in precedence order, and the default label.
CATEGORIES = [
    "Entertainment", "Food", "Payments", "Shopping", "Travel", "Fees",
    "Subscriptions", "Insurance", "Investments", "Rent", "Income",
]
UNCATEGORIZED = "Uncategorized"

RAW_TXN = (
    "txn_id string, seq bigint, raw_date string, raw_amount string, "
    "description string, source string, file string"
)

TXN = (
    "txn_id string, seq bigint, date date, amount double, description string, "
    "normalized_desc string, source string, file string"
)

ENRICHMENT = (
    "category string, confidence double, reasoning string, match_type string"
)

RULE = (
    "rule_ord bigint, description string, amount double, day_range array<int>, category string"
)

SUGGESTION = (
    "suggestion_ord bigint, description string, amount double, day_range array<int>, "
    "category string, confidence double, reasoning string"
)

KEYWORD = ("cat_ord int, category string, kw_ord int, keyword string")

NORMALIZE_CACHE = (
    "key string, original string, result string, ts timestamp, hits bigint, "
    "error string, batch_processed boolean, fallback_used boolean"
)

CATEGORIZE_CACHE = (
    "key string, key_kind string, "
    "result struct<category:string,confidence:double,reasoning:string>, ts timestamp, "
    "hits bigint, rule_based boolean, match_type string, error string"
)

CORRECTION = (
    "txn_id string, seq bigint, date date, amount double, description string, "
    "normalized_desc string, original_category string, new_category string"
)

CALL_LOG = (
    "model string, context string, prompt_chars bigint, response_chars bigint, error string, tries int"
)

# Column order of the final report file.
FINAL_COLUMNS = [
    "Date", "Description", "NormalizedDesc", "Amount", "Source", "File",
    "Category", "Confidence", "Reasoning", "IsDuplicate", "DedupeReasoning",
]
