"""Schemas of the evidence tables. Every table may carry a leading repo_id; operators take it as a grouping key."""

COMMITS = "ordinal long, sha string, parent_shas array<string>, author_name string, author_email string, authored_at string, committer_name string, committer_email string, committed_at string, refs array<string>, subject string, body string, is_merge boolean, changed_files array<struct<path:string,additions:long,deletions:long,binary:boolean>>, additions long, deletions long"
PULL_REQUESTS = "number long, title string, body string, state string, draft boolean, author string, labels array<string>, base_ref string, head_ref string, created_at string, updated_at string, closed_at string, merged_at string, merge_commit_sha string, html_url string"
LINKS = "commit_sha string, pr_number long, method string"
FILES = "path string, module string, is_test boolean, source_sha256 string, syntax_error string"
SYMBOLS = "path string, id string, kind string, name string, qualified_name string, line int, end_line int, column int, end_column int, parent string, bases array<string>, decorators array<string>, signature string, docstring string, is_test boolean, is_public boolean, ordinal int"
IMPORTS = "path string, line int, module string, name string, alias string, level int, scope string, guard string, bound_name string, ordinal int"
CALLS = "path string, line int, column int, expression string, scope string, ordinal int"
EDGES = "kind string, source string, target string, path string, line int, expression string"
UNRESOLVED = "kind string, expression string, source string, path string, line int, reason string"
COVERAGE_LINES = "path string, line int, test_id string"
CASE_RESULTS = "task_id string, run string, test_id string, status string, failure_class string, signature string"
LLM_CALLS = "cache_key string, model string, prompt_tokens long, completion_tokens long, cost double, latency double"
