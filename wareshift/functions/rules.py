"""Fixed values of the query-log workload, stated as data in their
original order.  The operators in ``wareshift.operators.querylog`` fold
over these lists with built-in column functions.
"""

from __future__ import annotations

# Error categories, first match wins.  Each rule is
# (category, [(field, [needle, ...]), ...]); the groups are AND-ed, the
# needles inside a group are OR-ed.  Fields are the lowered statement
# text ("sql") or the lowered error message ("err").  The tableau rule
# is matched against the lowered form of "/*& requestId" (the original
# tested a capitalised needle against lowered text and never matched).
ERROR_RULES = [
    ("ignore_duplicate_insert", [("err", ["duplicate entry"]), ("err", ["insert into"])]),
    ("modify_group_by", [("err", ["only_full_group_by"])]),
    ("modify_date_format", [("err", ["incorrect datetime value"])]),
    ("modify_full_join", [("sql", ["full join", "full outer join"])]),
    ("modify_wrong_sql", [("err", ["cannot be null"])]),
    ("delay", [("err", ["invalid transaction"])]),
    ("modify_func_not_support", [("sql", ["regexp_replace", "regexp_extract", "instr("])]),
    ("ignore_etl", [("sql", ["background:true"])]),
    ("ignore_tableau", [("sql", ["x___", "/*& requestid"])]),
    ("ignore_schema_mismatch", [("err", ["table"]), ("err", ["doesn't exist"])]),
    ("modify_sql_too_big", [("err", ["sql文本长度超过最大解析长度"])]),
]
DEFAULT_CATEGORY = "not_processed"
TIMEOUT_CATEGORY = "timeout"
TRANSLATE_ERROR_CATEGORY = "translate_error"

# Categories that are neither recorded nor counted.
IGNORED_CATEGORIES = ["ignore_duplicate_insert", "ignore_etl"]

# Statements holding any of these (case-sensitive) are
# dropped before they are stored.
NOISE_MARKERS = ["_parquet_", "NDV(", "background:true", "impala_query_log"]
# Tableau-generated statements, dropped as well.
TABLEAU_MARKERS = ["x___", "/*& requestId"]
# A translation error naming an unsupported function with one
# of these names is a known problem and is not stored.
UNSUPPORTED_FUNCTION_ERROR = "不支持转换的函数"
UNSUPPORTED_FUNCTIONS = ["regexp_replace", "regexp_extract", "instr"]

# Ordered literal rewrites of statement text.  Order matters:
# the last rule produces "isnull(" after the isnull( -> ifnull( rules ran,
# and "--" -> "-- " is not idempotent.
TEXT_REWRITES_BEFORE_RENAMES = [
    ("NULLS FIRST", ""),
    ("isnull(", "ifnull("),
    ("isNull(", "ifnull("),
    ("--", "-- "),
]
TEXT_REWRITES_AFTER_RENAMES = [
    ("cast ", "cast"),
    ("nullvalue(", "isnull("),
]
# Default schema renames of the migration.
DEFAULT_DB_RENAMES = {"default": "global_platform"}
DEFAULT_TEXT_RENAMES = [("global_dw.", "global_dw_1.")]
# cast(x as string) -> concat(x), lazy, case-insensitive.
CAST_STRING_PATTERN = r"(?i)cast\((.+?) as string\)"
CAST_STRING_REPLACEMENT = "concat($1)"

# Optimiser hints embedded in logged statements, greedy within
# one line.
HINT_PATTERN = r"(?d)(/\*&.*\*/)"
# User names of the form <tenant>_internal_write|read.
TENANT_USER_PATTERN = r"(.*)_internal_(write|read)"
TENANT_DB_SUFFIX = "_custom"
TENANT_PLACEHOLDER = "{{tenant}}"
