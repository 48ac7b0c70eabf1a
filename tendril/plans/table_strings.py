"""String operators on the benchmark tables; every query reads whole texts."""

from pyspark.sql import functions as F

from ..functions import strings as S
from .registry import query


@query("b67_case_and_tests", """
    SELECT p_partkey, upper(p_name) AS up, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS cap, length(p_name) AS n,
           regexp_full_match(p_name, '[a-z]+') AS alpha, regexp_full_match(p_type, '[A-Z]+') AS upper_only,
           list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title,
           list_aggregate(list_transform(string_split(p_brand, ''), lambda c: CASE WHEN c = upper(c) THEN lower(c) ELSE upper(c) END), 'string_agg', '') AS swapped FROM part""")
def case_and_tests(t):
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", F.upper(n).alias("up"), S.capitalize(n).alias("cap"), F.length(n).alias("n"), n.rlike("^[a-z]+$").alias("alpha"),
        F.col("p_type").rlike("^[A-Z]+$").alias("upper_only"), F.initcap(n).alias("title"), S.swap_case(F.col("p_brand")).alias("swapped"))


@query("b68_contains_count_findall", """
    SELECT doc_id, contains(text, 'the') AS has, starts_with(text, 'The') AS starts, ends_with(text, '.') AS ends,
           len(regexp_extract_all(text, '[A-Z][a-z]+')) AS n, len(list_distinct(regexp_extract_all(text, '[0-9]+'))) AS numbers FROM documents""")
def contains_count(t):
    x = F.col("text")
    return t.documents.select(
        "doc_id", x.contains("the").alias("has"), x.startswith("The").alias("starts"), x.endswith(".").alias("ends"),
        F.regexp_count(x, F.lit("[A-Z][a-z]+")).alias("n"), F.size(F.array_distinct(F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0)))).alias("numbers"))


@query("b69_replace_translate_slice", """
    SELECT c_custkey, regexp_replace(c_name, '#0*', '-', 'g') AS short, translate(c_mktsegment, 'AEIOU', '12345') AS vowels, substr(c_name, 3, 5) AS part,
           substr(c_name, 1, 2) || '**' || substr(c_name, 6) AS masked FROM customer""")
def replace_translate(t):
    return t.customer.select(
        "c_custkey", F.regexp_replace("c_name", "#0*", "-").alias("short"), F.translate("c_mktsegment", "AEIOU", "12345").alias("vowels"),
        F.substring("c_name", 3, 5).alias("part"), F.overlay("c_name", F.lit("**"), 3, 3).alias("masked"))


@query("b70_extract", """
    SELECT p_partkey, regexp_extract(p_brand, '([A-Za-z]+)#([0-9]+)', 1) AS word, regexp_extract(p_brand, '([A-Za-z]+)#([0-9]+)', 2) AS number FROM part""")
def extract(t):
    pattern = "([A-Za-z]+)#([0-9]+)"
    return t.part.select("p_partkey", F.regexp_extract("p_brand", pattern, 1).alias("word"), F.regexp_extract("p_brand", pattern, 2).alias("number"))


@query("b70_extract_all", """
    SELECT page_id, (i - 1)::INT AS match, regexp_extract(m, 'href="(/[a-z]*)', 1) AS target FROM
      (SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[a-z]*)')) AS m, generate_subscripts(regexp_extract_all(html, 'href="(/[a-z]*)'), 1) AS i FROM pages)""")
def extract_all(t):
    return S.extract_all(t.pages.select("page_id", "html"), "html", 'href="(/[a-z]*)', ["target"]).drop("html")


@query("b71_split_partition_join", """
    SELECT page_id, string_split(url, '/')[3] AS host, len(string_split(url, '/')) AS parts, list_aggregate(string_split(url, '/')[4:], 'string_agg', '>') AS path,
           string_split(url, '://')[1] AS scheme FROM pages""")
def split_join(t):
    parts = F.split("url", "/")
    return t.pages.select("page_id", F.try_element_at(parts, F.lit(3)).alias("host"), F.size(parts).alias("parts"),
                          F.array_join(F.slice(parts, 4, 1000), ">").alias("path"), F.substring_index("url", "://", 1).alias("scheme"))


@query("b72_strip_pad_repeat", """
    SELECT p_partkey, trim('  ' || p_name || ' ') AS stripped, lpad(p_size::VARCHAR, 6, '0') AS zfilled, rpad(p_type, 12, '.') AS padded, repeat(p_type[1], 3) AS rep FROM part""")
def strip_pad(t):
    return t.part.select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("stripped"), F.lpad(F.col("p_size").cast("string"), 6, "0").alias("zfilled"),
                         F.rpad("p_type", 12, ".").alias("padded"), F.repeat(F.substring("p_type", 1, 1), 3).alias("rep"))


@query("b72_unicode_normalise_and_fold", "SELECT doc_id, nfc_normalize(text) AS nfc, strip_accents(text) AS folded FROM documents")
def unicode_normalise(t):
    return t.spread("documents").select("doc_id", S.normalize(F.col("text")).alias("nfc"), S.strip_accents(F.col("text")).alias("folded"))


@query("b72_wrap")
def wrap(t):
    return t.spread("documents").select("doc_id", S.wrap(F.col("text"), 72).alias("wrapped"))


@query("b73_find_rfind", """
    SELECT page_id, instr(url, '/') - 1 AS first_slash, length(url) - instr(reverse(url), '/') AS last_slash, instr(url, 'zzz') - 1 AS missing FROM pages""")
def find_rfind(t):
    u = F.col("url")
    return t.pages.select("page_id", S.find(u, "/").alias("first_slash"), S.rfind(u, "/").alias("last_slash"), S.find(u, "zzz").alias("missing"))
