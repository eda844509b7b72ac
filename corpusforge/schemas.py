"""Fixed schemas (DDL) of the tables that cross a stage boundary."""

from __future__ import annotations

CODE_BLOCKS = "array<struct<code:string,language:string>>"

# One nullable superset for all sources, because the values have mixed types.
METADATA = (
    "struct<path:string,repo:string,sha:string,size:bigint,search_term:string,"
    f"code_blocks:{CODE_BLOCKS}>"
)

DOCUMENT = (
    "id string, source string, url string, title string, content string, "
    f"content_type string, language string, metadata {METADATA}, collected_at string"
)

PAIR_FIELDS = ("instruction", "response", "source_id", "source_url", "category", "concepts")

QA_PAIR = (
    "instruction string, response string, source_id string, source_url string, "
    "category string, concepts array<string>"
)

# What one document contributes before it is joined with the document's own fields.
DRAFT_PAIRS = "array<struct<instruction:string,response:string,category:string,concepts:array<string>>>"

PAGE_SNAPSHOT = "url string, html string, status int, fetched_at timestamp"

REPO_FILE = (
    "repo string, path string, name string, html_url string, sha string, size bigint, content_b64 string"
)
