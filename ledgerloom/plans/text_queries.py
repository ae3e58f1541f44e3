"""Cleaning, keys, domains and URL queries."""

from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import registry
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.catalog import query
from ledgerloom.sources import lines, sinks

query(
    "p2_clean_text",
    f"SELECT doc_id, {c.clean('text')} AS cleaned, {c.clean('source')} AS source FROM @documents",
)(lambda t: t.documents.select("doc_id", text.clean("text").alias("cleaned"), text.clean("source").alias("source")))

query(
    "p3_match_keys",
    f"SELECT doc_id, {c.key('text')} AS text_normalized, {c.key('lang')} AS lang_normalized FROM @documents",
)(lambda t: registry.with_match_keys(t.documents.select("doc_id", "text", "lang"), ["text", "lang"]).drop("text", "lang"))

query(
    "p4_strict_keys",
    f"""SELECT src_ordinal, src_tie, certified_company, {c.key('certified_company')} AS certified_company_normalized,
        {c.strict('certified_company')} AS certified_company_normalized_strict FROM a_registry""",
)(lambda t: registry.with_match_keys(
    t.a_registry.select("src_ordinal", "src_tie", "certified_company"), ["certified_company"], strict=True))

query(
    "p5_record_key",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sha256({c.clean('l_orderkey')} || '|' || {c.clean('l_partkey')} || '|' ||
        {c.clean('l_returnflag')} || '|' || {c.clean('l_linestatus')}) AS record_key FROM @lineitem""",
)(lambda t: t.lineitem.select(
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    text.record_key("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus").alias("record_key")))

query(
    "p6_domain_attribution",
    f"""WITH d AS (SELECT id, {c.domain('configurator_url')} AS h1, {c.domain('alternative_url')} AS h2, {c.domain('database_detail_url')} AS h3 FROM a_configurators),
        e AS (SELECT id, h1, list_filter([h1, CASE WHEN h2 <> h1 THEN h2 ELSE '' END, CASE WHEN h3 <> h1 AND h3 <> h2 THEN h3 ELSE '' END], lambda h: h <> '') AS hs FROM d)
        SELECT id, array_to_string(hs, ' | ') AS domains, len(hs) AS domain_count, cast({c.matchable('h1')} AS int) AS first_matchable FROM e""",
)(lambda t: t.a_configurators.select(
    "id", text.distinct_domains("configurator_url", "alternative_url", "database_detail_url").alias("d"),
    text.domain_of("configurator_url").alias("h1"),
).select("id", text.encode_list("d").alias("domains"), F.size("d").alias("domain_count"),
         text.is_matchable_domain("h1").cast("int").alias("first_matchable")))

query(
    "p6_registry_domain",
    f"""WITH d AS (SELECT src_ordinal, src_tie, {c.domain('source_url')} AS registry_domain FROM a_registry)
        SELECT *, cast({c.matchable('registry_domain')} AS int) AS matchable FROM d""",
)(lambda t: t.a_registry.select("src_ordinal", "src_tie", text.domain_of("source_url").alias("registry_domain"))
  .withColumn("matchable", text.is_matchable_domain("registry_domain").cast("int")))

query(
    "p7_url_canonical",
    f"""WITH u AS (SELECT page_id, split_part(split_part({c.clean('url')}, '#', 1), '?', 1) AS x FROM @pages)
        SELECT page_id, CASE WHEN regexp_matches(x, '^[a-z]+://[^/]*/*$') THEN regexp_extract(x, '^[a-z]+://[^/]*') || '/' ELSE rtrim(x, '/') END AS canonical_url,
               regexp_extract(x, '^[a-z]+://[^/]*') || '/' AS site_root FROM u""",
)(lambda t: t.pages.select("page_id", text.canonical_url("url").alias("canonical_url"), text.site_root("url").alias("site_root")))

query(
    "s4_line_table",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_number FROM @documents)
        SELECT doc_id AS source_file, line_number, {c.clean('raw')} AS raw_line FROM l WHERE {c.clean('raw')} <> ''""",
)(lambda t: lines.line_table(t.documents.select(F.col("doc_id").alias("source_file"), "text")))

query(
    "s6_truncated_text",
    f"""SELECT doc_id, CASE WHEN length({c.clean('text')}) > 2800 THEN substr({c.clean('text')}, 1, 2800) || ' [...]' ELSE {c.clean('text')} END AS text,
        {c.clean('lang')} AS lang FROM @documents""",
)(lambda t: sinks.truncate_strings(t.documents.select("doc_id", "text", "lang")))
