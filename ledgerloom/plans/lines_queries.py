"""Line, record and field queries over document lines."""

from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values, text
from ledgerloom.operators import lines as ln
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.catalog import query
from ledgerloom.sources.lines import line_table

#: Countries as the certificate list writes them; lines of each noise pattern in turn.
_GRS_COUNTRIES = "United Arab Emirates|United Kingdom|United States|South Korea|Czech Republic|Switzerland|Bangladesh|Netherlands|Pakistan|Portugal|Germany|Ireland|Türkiye|Turkey|France|Poland|India|Spain|Italy|Italia|taly|China|USA|Taiwan|Tunisia|Romania|Bulgaria|Austria|Belgium|Greece|Croatia|Denmark|Finland|Sweden|Norway|Canada|Mexico|Brazil|Morocco|Egypt|Vietnam|Japan|Thailand|Indonesia|Sri Lanka"
_NOISE_LINES = "ICEA - GRS M.0403 rev|Last update 2021|Pag. 3|Page 12|LICENSEE|CERTIFICATE|CERTIFIED PRODUCTS AND|PROCESSES|Facilities|GRS Version|Company name|State|Web|N° Certificate|First issue|Revision|Expiring|Product / Process description|No.|date|issue|LEGENDA 1|Legend of|IT EN|Nuove certificazioni di|SOMMARIO x|Index|Registro delle ditte a|Register of textile b|Maggio, 2021|May, 2021|GRS M0403|17"
_PART = "split_part('{}', '|', cast(source_file % {} + 1 AS int))"
_COUNTRY, _NOISE = (_PART.format(v, v.count("|") + 1) for v in (_GRS_COUNTRIES, _NOISE_LINES))

# Document lines; by position some become headings, noise, certificate lines and continuations.
_LINE = f"""CASE WHEN line_number % 11 = 1 THEN concat('<< Filati ', cast(source_file % 5 AS string), ' - Yarns >>')
    WHEN line_number % 11 = 3 THEN concat('Acme ', cast(source_file AS string), ' Tessuti ', {_COUNTRY}, ' www.acme.it GRS 2021 - 00', cast(source_file % 9 + 1 AS string), ' 12-jan-2021 3 feb 2022 04-mar-23 recycled wool 3 GRS 4.0')
    WHEN line_number % 11 = 4 THEN 'Holding srl' WHEN line_number % 11 = 5 THEN concat('pre - consumer part ', cast(source_file AS string), ' 9 GRS 1.0') WHEN line_number % 11 = 6 THEN {_NOISE}
    WHEN line_number % 11 = 8 THEN concat('Beta ', cast(source_file AS string), ' GRS 2020-123 5 gen 2020') ELSE raw_line END"""


def a_lines(t):
    return line_table(t.documents.select(F.col("doc_id").alias("source_file"), "text")).select("source_file", "line_number", F.expr(_LINE).alias("raw_line"))


LINES = f"""
    WITH l0 AS (SELECT doc_id AS source_file, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_number FROM @documents),
    l1 AS (SELECT source_file, line_number, {c.clean('raw')} AS raw_line FROM l0 WHERE {c.clean('raw')} <> ''),
    lines AS (SELECT source_file, line_number, replace(regexp_replace({_LINE}, '[\u2010\u2011\u2013\u2014]', '-', 'g'), 'pre - consumer', 'pre-consumer') AS raw_line FROM l1),
    k AS (SELECT *, nullif(regexp_extract(raw_line, '^<<\\s*(.+?)\\s*>>$', 1), '') AS section, (line_number % 11 = 6 OR raw_line = 'Legend' OR regexp_matches(raw_line, '^[0-9]+$')) AS noise,
                 regexp_matches(raw_line, '\\bGRS\\s*[0-9]{{4}}\\s*-\\s*[0-9]{{3}}\\b') AS start FROM lines),
    m AS (SELECT *, coalesce(last_value(section IGNORE NULLS) OVER w, '') AS category, max(CASE WHEN section IS NOT NULL THEN line_number END) OVER w AS h,
                 max(CASE WHEN section IS NULL AND NOT noise AND start THEN line_number END) OVER w AS record_line FROM k
          WINDOW w AS (PARTITION BY source_file ORDER BY line_number ROWS UNBOUNDED PRECEDING)),
    j AS (SELECT *, CASE WHEN section IS NOT NULL THEN 'section_heading' WHEN noise THEN 'header_footer_or_noise'
                 WHEN record_line IS NULL OR record_line < coalesce(h, 0) THEN 'unassigned_line_without_current_record' END AS reason FROM m),
    rec AS (SELECT source_file, record_line, category AS product_category_raw, max(raw_line) FILTER (WHERE line_number = record_line) AS start_line,
                   coalesce(string_agg(raw_line, ' ' ORDER BY line_number) FILTER (WHERE raw_line = 'Holding srl'), '') AS company_lines,
                   coalesce(string_agg(raw_line, ' ' ORDER BY line_number) FILTER (WHERE raw_line <> 'Holding srl' AND line_number > record_line), '') AS description_lines,
                   string_agg(raw_line, ' | ' ORDER BY line_number) AS evidence_text
            FROM j WHERE reason IS NULL GROUP BY 1, 2, 3)"""
query("w7_assembled_records", LINES + "SELECT * FROM rec")(lambda t: ln.assemble_records(a_lines(t))[0])
query("u3_rejected_lines", LINES + "SELECT source_file, line_number, raw_line, reason, category AS product_category_raw FROM j WHERE reason IS NOT NULL")(
    lambda t: ln.assemble_records(a_lines(t))[1]
)
query("t2_certificate_lines", LINES + f"""
    , acme AS (SELECT *, starts_with(start_line, 'Acme') AS a FROM rec)
    SELECT source_file, record_line, trim((CASE WHEN a THEN 'Acme ' || source_file || ' Tessuti' ELSE 'Beta ' || source_file END) || ' ' || company_lines) AS company_name,
           CASE WHEN NOT a THEN '' WHEN {_COUNTRY} IN ('taly', 'Italia') THEN 'Italy' ELSE {_COUNTRY} END AS country,
           CASE WHEN a THEN 'www.acme.it' ELSE '' END AS web, CASE WHEN a THEN 'GRS 2021-00' || (source_file % 9 + 1) ELSE 'GRS 2020-123' END AS certificate_number,
           CASE WHEN a THEN '12-jan-2021' ELSE '5gen2020' END AS first_issue_date, CASE WHEN a THEN '3feb2022' ELSE '' END AS revision_date, CASE WHEN a THEN '04-mar-23' ELSE '' END AS expiring_date,
           trim((CASE WHEN a THEN 'recycled wool' ELSE '' END) || ' ' || description_lines) AS product_process_description, CASE WHEN a THEN '3' ELSE '' END AS facilities_no, CASE WHEN a THEN 'GRS 4.0' ELSE '' END AS grs_version,
           round((40 + CASE WHEN a THEN 30 ELSE 0 END + CASE WHEN a OR description_lines <> '' THEN 20 ELSE 0 END + CASE WHEN product_category_raw <> '' THEN 10 ELSE 0 END) / 100.0, 2) AS parse_confidence FROM acme""")(
    lambda t: ln.parse_certificate_lines(ln.assemble_records(a_lines(t))[0]).select(
        "source_file", "record_line", "company_name", "country", "web", "certificate_number", "first_issue_date", "revision_date", "expiring_date",
        "product_process_description", "facilities_no", "grs_version", "parse_confidence")
)

query("w8_compressed_text", f"""
    WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_number FROM @documents),
    l1 AS (SELECT doc_id, line_number, {c.clean('raw')} AS raw_line FROM l0 WHERE {c.clean('raw')} <> ''),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(raw_line) ORDER BY line_number) AS rn FROM l1),
    s AS (SELECT *, sum(length(raw_line) + 1) OVER (PARTITION BY doc_id ORDER BY line_number) AS used FROM f WHERE rn = 1)
    SELECT doc_id, string_agg(raw_line, chr(10) ORDER BY line_number) AS compressed_text, count(*) AS lines_kept FROM s WHERE used <= 6000 GROUP BY 1""")(
    lambda t: ln.compressed_text(line_table(t.documents.select("doc_id", "text")), "doc_id")
)

_TAGGED = "CASE WHEN line_number = 2 THEN 'Standard' WHEN line_number = 4 THEN 'Version' WHEN line_number = 9 THEN 'Products' ELSE raw_line END"
_T = LINES.replace(_LINE, _TAGGED).split("    k AS (")[0].rstrip().rstrip(",")


def tagged(t):
    return line_table(t.documents.select(F.col("doc_id").alias("source_file"), "text")).select("source_file", "line_number", F.expr(_TAGGED).alias("raw_line"))


query("w10_section_after_heading", _T + """
    , h AS (SELECT source_file, min(line_number) AS head FROM lines WHERE lower(raw_line) = 'standard' GROUP BY 1),
    a AS (SELECT l.* FROM lines l JOIN h USING (source_file) WHERE line_number > head), s AS (SELECT source_file, min(line_number) AS stop FROM a WHERE contains(lower(raw_line), 'product') GROUP BY 1),
    i AS (SELECT a.*, stop, row_number() OVER (PARTITION BY a.source_file ORDER BY line_number) AS n FROM a LEFT JOIN s USING (source_file))
    SELECT source_file, coalesce(string_agg(raw_line, ' ' ORDER BY line_number) FILTER (WHERE stop IS NULL OR line_number < stop), '') AS section_text,
           cast(count(*) FILTER (WHERE stop IS NULL OR line_number < stop) AS integer) AS section_lines FROM i WHERE n <= 8 GROUP BY 1""")(
    lambda t: ln.section_lines(tagged(t), "source_file", "Standard", ["Product"], 8)
)
query("w10_value_after_label", _T + """
    , h AS (SELECT source_file, min(line_number) AS head FROM lines WHERE lower(raw_line) = 'version' GROUP BY 1)
    SELECT source_file, arg_min(raw_line, line_number) AS value FROM lines JOIN h USING (source_file) WHERE line_number > head AND lower(raw_line) NOT IN ('standard', 'version', 'products') GROUP BY 1""")(
    lambda t: ln.value_after_label(tagged(t), "source_file", "Version", ["Standard", "Version", "Products"])
)

_LABELS = "CASE doc_id % 4 WHEN 0 THEN concat('Fair  for Life, ', lang) WHEN 1 THEN 'FOR LIFE | fair for life' WHEN 2 THEN 'for life' ELSE text END"
query("t1_delimited_labels", f"""
    WITH x AS (SELECT doc_id, {_LABELS} AS v FROM @documents)
    SELECT DISTINCT doc_id, 'Fair for Life' AS label FROM x WHERE regexp_matches(v, '(?i)\\bFair\\s+for\\s+Life\\b')
    UNION ALL SELECT DISTINCT doc_id, 'For Life' FROM x WHERE regexp_matches(regexp_replace(v, '(?i)\\bFair\\s+for\\s+Life\\b', '', 'g'), '(?i)\\bFor\\s+Life\\b')""")(
    lambda t: ln.delimited_labels(t.documents.select("doc_id", F.expr(_LABELS).alias("labels")), ["doc_id"])
)

_FSC_NAMES = "|".join(fixed_values.FSC_COUNTRIES).replace("'", "''")
_OF_DOC = "split_part('{}', '|', cast(doc_id % {} + 1 AS int))"
_ROLE, _STATUS, _FSC_COUNTRY, _REGION = (_OF_DOC.format(v, v.count("|") + 1) for v in (
    "Certificate holder|Participating site|Group member|Outsourcing contractor|Site", "Valid|Suspended and blocked|Suspended|Terminated and blocked|Terminated", _FSC_NAMES, "|".join(fixed_values.BLUESIGN_COUNTRIES)))
_FSC = f"""concat('Select all FSC-C', cast(doc_id AS string), ' NC-COC-00', cast(doc_id AS string), ' Valid Yes 2020-01-0', cast(doc_id % 9 + 1 AS string), ' 2025-01-01 ', lang, ' Timber Ltd ', {_ROLE}, ' ', {_STATUS}, ' North Shire ', {_FSC_COUNTRY}, ' Select Row FSC-D',
    cast(doc_id AS string), ' XX-FM-1 ', {_STATUS}, ' No 2019-05-05 2024-05-05 Wood GmbH Site Suspended Germany FSC-BROKEN ', text)"""
query("t3_licence_rows", f"""
    SELECT doc_id, 'FSC-C' || doc_id AS licence, 'NC-COC-00' || doc_id AS certificate_code, 'Valid' AS cert_status, 'Yes' AS cw_dds, '2020-01-0' || (doc_id % 9 + 1) AS date_from, '2025-01-01' AS valid_to,
           lang || ' Timber Ltd' AS organization_name, {_ROLE} AS role, 'North Shire' AS state_province, {_FSC_COUNTRY} AS country_area FROM @documents
    UNION ALL SELECT doc_id, 'FSC-D' || doc_id, 'XX-FM-1', {_STATUS}, 'No', '2019-05-05', '2024-05-05', 'Wood GmbH', 'Site', '', 'Germany' FROM @documents""")(
    lambda t: ln.split_licence_rows(t.documents.select("doc_id", F.expr(_FSC).alias("text")), "doc_id").select(
        "doc_id", "licence", "certificate_code", "cert_status", "cw_dds", "date_from", "valid_to", "organization_name", "role", "state_province", "country_area")
)


def _fields(t):
    d = t.documents.select("doc_id", "lang", "source", "text", F.concat_ws(" ", "lang", "source", F.expr(_REGION)).alias("line"))
    name, country = ln.split_name_country("line")
    place, region = ln.split_location(F.when(F.col("doc_id") % 3 == 0, F.concat_ws(", ", "lang", "source", F.lit("Peru"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Lima "), "source")).otherwise(""))
    label, count = ln.counted_label(F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit(" ("), "doc_id", F.lit(")"))).otherwise(F.col("source")))
    return d, (name, country), (place, region), (label, count)


query("t4_suffix_split", f"SELECT doc_id, lang || ' ' || source AS brand_name, {_REGION} AS country FROM @documents")(
    lambda t: _fields(t)[0].select("doc_id", _fields(t)[1][0].alias("brand_name"), _fields(t)[1][1].alias("country"))
)
_BRAND_LINE = """CASE doc_id % 9 WHEN 0 THEN concat(lang, ' Brand & Co  south KOREA') WHEN 1 THEN concat('Acme ', source, ' USA') WHEN 2 THEN concat(source, ' Atlantis') WHEN 3 THEN 'Germany' WHEN 4 THEN 'Page 3 of 12' WHEN 5 THEN concat('april ', doc_id % 28 + 1, ', 2024')
    WHEN 6 THEN ' ' WHEN 7 THEN 'List of system partners (brands only)' ELSE concat('Élan ', lang, ' united arab emirates') END"""
_BRAND_SPLIT = f"""WITH l AS (SELECT source AS source_file, doc_id AS line_number, {_BRAND_LINE} AS raw_line FROM @documents), x AS (SELECT *, {c.clean('raw_line')} AS ln FROM l),
    s AS (SELECT *, regexp_extract(ln, '(?i)^(.+?)\\s+(South Korea|USA|Germany|United Arab Emirates)$', 1) AS brand_name, lower(regexp_extract(ln, '(?i)^(.+?)\\s+(South Korea|USA|Germany|United Arab Emirates)$', 2)) AS lc,
          ln = '' OR regexp_matches(ln, '(?i)^April\\s+\\d{{1,2}},\\s+\\d{{4}}$') OR regexp_matches(ln, '(?i)^List of system partners \\(brands only\\)$') OR regexp_matches(ln, '(?i)^Page\\s+\\d+\\s+of\\s+\\d+$') AS noise FROM x),
    d AS (SELECT source_file, arg_min(ln, line_number) AS registry_date FROM x WHERE regexp_matches(ln, '(?i)^April\\s') GROUP BY 1)"""


def _brand_lines(t):
    return t.documents.select(F.col("source").alias("source_file"), F.col("doc_id").alias("line_number"), F.expr(_BRAND_LINE).alias("raw_line"))


query("u3_brand_records", _BRAND_SPLIT + f""" SELECT source_file, line_number, brand_name, {c.key('brand_name')} AS brand_name_normalized, CASE lc WHEN 'south korea' THEN 'South Korea' WHEN 'usa' THEN 'USA' WHEN 'germany' THEN 'Germany' ELSE 'United Arab Emirates' END AS country_region,
    coalesce(registry_date, '') AS registry_date, ln AS evidence_text FROM s LEFT JOIN d USING (source_file) WHERE NOT noise AND brand_name <> '' AND lc <> ''""")(lambda t: ln.brand_records(_brand_lines(t))[0])
query("u3_rejected_brand_lines", _BRAND_SPLIT + """ SELECT source_file, line_number, raw_line, CASE WHEN noise THEN 'header/footer/empty' ELSE 'could_not_split_brand_and_country' END AS reason FROM s WHERE noise OR brand_name = '' OR lc = ''""")(
    lambda t: ln.brand_records(_brand_lines(t))[1])
_C2C = "array('C2C Certified® ' || lang, 'c2c certified Material Health gold version 3.1', 'GOLD ' || source, 'Version ' || doc_id)"
query("t5_certification_facets", "SELECT doc_id, 'General | Material Health' AS certification_types, 'Gold' AS certification_levels, CASE WHEN doc_id = 3 THEN '3.1 | 3' ELSE '3.1 | ' || doc_id END AS certification_versions FROM @documents")(
    lambda t: ln.certification_facets(t.documents.select("doc_id", F.expr(_C2C).alias("texts"))).drop("texts")
)
query("t6_positional_tags", """
    SELECT doc_id, lang AS product_category, source AS organization_name, CASE WHEN doc_id % 2 = 0 THEN 'Global' ELSE '' END AS geographical_scope, '' AS epd_type, lang || ' | ' || source || CASE WHEN doc_id % 2 = 0 THEN ' | Global' ELSE '' END AS all_tags, '2020-01-02' AS version_date, '3/4/2025' AS validity_date FROM @documents""")(
    lambda t: ln.positional_tags(t.documents.select("doc_id", F.expr("filter(array('', lang, ' ', source, if(doc_id % 2 = 0, 'Global', '')), x -> true)").alias("tags"),
                                                    F.concat(F.lit("Version date: 2020-01-02 Validity  date: 3/4/2025 "), "text").alias("text"))).drop("tags", "text")
)
_BRAND = "CASE p_partkey % 5 WHEN 0 THEN concat(p_brand, ' - ', p_name) WHEN 1 THEN concat('The Honest ', p_name) WHEN 2 THEN concat(p_name, ': ', p_brand) WHEN 3 THEN concat('one two three four five six - ', p_name) ELSE p_name END"
query("t7_brand_guess", """
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_brand WHEN 1 THEN 'The Honest' WHEN 2 THEN p_name WHEN 3 THEN 'one' ELSE split_part(p_name, ' ', 1) END AS brand_guess FROM @part""")(
    lambda t: t.part.select("p_partkey", F.expr(_BRAND).alias("n")).select("p_partkey", ln.brand_guess("n").alias("brand_guess"))
)
query("t8_location_split", """
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lang || ', ' || source WHEN 1 THEN 'Lima ' || source ELSE '' END AS place, CASE doc_id % 3 WHEN 0 THEN 'Peru' WHEN 1 THEN source ELSE '' END AS country FROM @documents""")(
    lambda t: _fields(t)[0].select("doc_id", _fields(t)[2][0].alias("place"), _fields(t)[2][1].alias("country"))
)
query("t9_counted_labels", """
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS name, CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE -1 END AS count, 'DE-UZ-' || doc_id AS criterion FROM @documents""")(
    lambda t: _fields(t)[0].select("doc_id", F.coalesce(_fields(t)[3][0], F.lit("")).alias("name"), F.coalesce(_fields(t)[3][1], F.lit(-1)).alias("count"),
                                   ln.criterion_code(F.concat(F.lit("see de-uz "), "doc_id", F.lit(" for "), "lang")).alias("criterion"))
)

query("w9_stable_rounds", """
    WITH r AS (SELECT event_type, event_id, greatest(cast(floor(value) AS bigint) - 3, 0) AS new_rows, user_id % 4 <> 0 AS scrolled FROM @events),
    g AS (SELECT *, sum(CASE WHEN new_rows > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY event_id) AS island FROM r),
    s AS (SELECT *, sum(CASE WHEN new_rows > 0 THEN 0 WHEN scrolled THEN 1 ELSE 2 END) OVER (PARTITION BY event_type, island ORDER BY event_id) - CASE WHEN new_rows <= 0 AND NOT scrolled THEN 1 ELSE 0 END AS n FROM g)
    SELECT event_type, event_id, CASE WHEN new_rows > 0 THEN 0 ELSE n END AS stable_rounds, (CASE WHEN new_rows > 0 THEN 0 ELSE n END >= 3)::int AS stops FROM s""")(
    lambda t: ln.stable_rounds(t.events.select("event_type", "event_id", F.greatest(F.floor("value").cast("bigint") - 3, F.lit(0)).alias("new_rows"), (F.col("user_id") % 4 != 0).alias("scrolled")),
                               "event_type", "event_id", 3, chunk_rows=1000).select("event_type", "event_id", "stable_rounds", F.col("stops").cast("int").alias("stops"))
)
