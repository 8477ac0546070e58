"""Text queries: scrubbing, flags, leakage, tokens, hashing, titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import texts
from .tables import Catalogue, Tables

Q = Catalogue()


@Q.add("""WITH f AS (SELECT doc_id, length(trim(text)) < 120 AS a, length(text) > 5000 AS b, regexp_matches(trim(split_part(text, chr(10), 1)), '(?i)^(?:stable|main|master|merge\\b|sync\\b|release\\b|move to src\\b)') AS c, length(text) - length(replace(text, '[', '')) <> length(text) - length(replace(text, ']', '')) AS d, regexp_matches(text, '(?i)\\b(?:TODO|TBD|describe-only constraint)\\b') AS e FROM documents)
SELECT doc_id, concat_ws(',', CASE WHEN a THEN 'too_short' END, CASE WHEN b THEN 'too_long' END, CASE WHEN c THEN 'generic_title' END, CASE WHEN d THEN 'broken_markdown' END, CASE WHEN e THEN 'template_placeholder' END) AS flags FROM f""")
def q51_text_flags(t: Tables):
    flags = texts.quality_flags(F.split_part("text", F.lit("\n"), F.lit(1)), F.col("text"))
    return t.documents.select("doc_id", F.array_join(flags, ",").alias("flags"))


TOK = "regexp_extract_all({0}, '[A-Za-z_][A-Za-z0-9_]*|[^A-Za-z0-9_ \\t\\n\\r\\f\\v]')"
SPANS = "SELECT DISTINCT {id}, lower(array_to_string(list_slice(k, i, i + 4), ' ')) AS span FROM (SELECT {id}, k, unnest(range(1, len(k) - 3)) AS i FROM (SELECT {id}, " + TOK.format("text") + " AS k FROM {table}) WHERE len(k) >= 5)"


@Q.add(f"WITH d AS ({SPANS.format(id='doc_id', table='documents')}), b AS ({SPANS.format(id='item_id', table='benchmark')}) SELECT doc_id, item_id, count(*) AS spans FROM d JOIN b USING (span) GROUP BY 1, 2")
def q54_ngram_overlap(t: Tables):
    return texts.overlap(t.documents.select("doc_id", "text"), t.benchmark, "doc_id", "item_id")


CLEAN = "left(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '(?s)```.*?```', ' ', 'g'), '(?m)^[+-][^+-].*$', ' ', 'g'), '(?m)^(?: {{4}}|\\t).*$', ' ', 'g'), '`[^`]*`', ' ', 'g'), 'https?://[^ \\t\\n\\r]+', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g')), 1200)"


@Q.add(f"SELECT conv_id, turn, md5({CLEAN.format('text')}) AS clean_md5 FROM conversations")
def q56_sanitize(t: Tables):
    return t.conversations.select("conv_id", "turn", F.md5(T.sanitize(F.col("text"))).alias("clean_md5"))


@Q.add(r"""WITH p AS (SELECT doc_id, coalesce(list_filter(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda x : trim(x)), lambda x : NOT regexp_matches(x, '^(\.\.[ \t]|:[A-Za-z0-9_]+:|=+$|-+$|~+$)')), lambda x : trim(regexp_replace(regexp_replace(regexp_replace(x, ':[A-Za-z0-9_]+:`~?([^`]*)`', '\1', 'g'), '[*`]+', '', 'g'), ' +', ' ', 'g'))), lambda x : length(x) >= 12)[1], '') AS s FROM documents)
SELECT doc_id, CASE WHEN length(s) > 200 THEN regexp_replace(regexp_replace(left(s, 200), ' [^ ]*$', ''), '[,;:]+$', '') || '…' ELSE s END AS summary FROM p""")
def q57_first_paragraph(t: Tables):
    return t.documents.select("doc_id", T.first_paragraph(F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("summary"))


@Q.add("SELECT p_partkey, trim(replace(p_name, '_', ' ')) AS phrase FROM part")
def q58_humanise(t: Tables):
    node = F.concat(F.lit("tests/test_"), F.col("p_partkey").cast("string"), F.lit(".py::test_"), F.replace("p_name", F.lit(" "), F.lit("_")))
    return t.part.select("p_partkey", T.humanise(node).alias("phrase"))


@Q.add("WITH f AS (SELECT c_mktsegment, string_agg(n, '; ' ORDER BY n) AS head, max(n) AS last, count(*) AS k FROM (SELECT DISTINCT c_mktsegment, c_nationkey::VARCHAR AS n FROM customer) GROUP BY 1) SELECT c_mktsegment, CASE WHEN k = 1 THEN head ELSE left(head, length(head) - length(last) - 2) || '; and ' || last END AS phrase FROM f")
def q59_phrase_list(t: Tables):
    names = t.customer.groupBy("c_mktsegment").agg(F.sort_array(F.collect_set(F.col("c_nationkey").cast("string"))).alias("names"))
    return names.select("c_mktsegment", T.phrase_list(F.col("names")).alias("phrase"))


@Q.add(f"SELECT doc_id, len({TOK.format('text')}) AS tokens FROM documents")
def q60_tokens(t: Tables):
    return t.documents.select("doc_id", F.size(T.tokens(F.col("text"))).cast("long").alias("tokens"))


@Q.add("SELECT sha256(text) AS text_sha, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def q68_hash_dedupe(t: Tables):
    return t.documents.groupBy(F.sha2("text", 256).alias("text_sha")).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@Q.add("SELECT page_id, regexp_replace(regexp_replace(replace(url, '://', '://user:key@'), '^([A-Za-z][A-Za-z0-9+.-]*://)[^/@ ]*@', '\\1'), 'sk-or-v1-[A-Za-z0-9]{8,}', '[redacted]', 'g') AS url FROM pages")
def q69_redact(t: Tables):
    secret = F.replace("url", F.lit("://"), F.lit("://user:key@"))
    return t.pages.select("page_id", T.redact(T.url_without_credentials(secret)).alias("url"))


@Q.add("SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents) WHERE regexp_matches(x, 'example\\.com') ORDER BY doc_id, line LIMIT 40")
def q73_grep(t: Tables):
    files = t.documents.select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    return texts.grep(files, r"example\.com").select(F.col("path").alias("doc_id"), F.col("line").cast("long").alias("line"))


@Q.add("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', ' ', 'g')) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def q77_first_title(t: Tables):
    rows = t.documents.select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    return texts.first_title(rows, [], ["doc_id"]).where("keep").select("doc_id")


@Q.add("SELECT page_id, regexp_replace(regexp_replace(lower(url), '^[a-z+]+://', ''), '(?:\\.git)?/*$', '') AS remote FROM pages")
def q79_canonical_remote(t: Tables):
    return t.pages.select("page_id", T.canonical_remote(F.col("url")).alias("remote"))
