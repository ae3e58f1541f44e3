"""Supplier-source discovery: companies, candidate fan-out, page text and links, typing, scores."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import rules, text
from ledgerloom.functions.text import bound, clean, col
from ledgerloom.operators.ordered import keep_first, top_n
from ledgerloom.operators.summaries import Summary, summarise
from ledgerloom.sources.sinks import written

# --- pages ----------------------------------------------------------------------------------------

# HTML patterns and entities.
HIDDEN = "(?is)<(script|style|noscript)\\b[^>]*>.*?</(script|style|noscript)>|<!--.*?-->"
TAG = "(?s)<[^>]*>"
ANCHOR = "(?is)<a\\s[^>]*href\\s*=\\s*[\"']?([^\"'>\\s]*)[^>]*>(.*?)</a>"
ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def decoded(value) -> Column:
    out = col(value)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def inner_text(markup) -> Column:
    return clean(decoded(F.regexp_replace(col(markup), TAG, " ")))


def page_text(pages: DataFrame, html="html") -> DataFrame:
    """Title, first heading, visible text and a 500-character snippet of every page."""
    shown = pages.withColumn("_shown", F.regexp_replace(F.regexp_replace(html, "(?is)<title[^>]*>.*?</title>", " "), HIDDEN, " "))
    found = shown.withColumns({
        "title": inner_text(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)),
        "h1": inner_text(F.regexp_extract("_shown", "(?is)<h1[^>]*>(.*?)</h1>", 1)),
        "visible_text": inner_text("_shown"),
    }).drop("_shown")
    return found.withColumn("snippet", F.substring("visible_text", 1, 500))


def absolute_url(base, href) -> Column:
    """``href`` seen from ``base``."""
    return text.bound(F.struct(col(base).alias("base"), col(href).alias("href")), lambda s: _resolved(s["base"], s["href"]))


def _resolved(base, href) -> Column:
    page = F.regexp_replace(base, "[?#].*$", "")
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.when(page.rlike("^[a-z]+://[^/]*$"), F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(folder, href))
    )


def page_links(pages: DataFrame, html="html", url="url") -> DataFrame:
    """One row per anchor: position, address and text; the page itself is not carried."""
    others = [c for c in pages.columns if c != html]
    pairs = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("label"))
    rows = pages.select(*others, F.posexplode(pairs).alias("link_position", "_a")).select(*others, "link_position", "_a.href", "_a.label")
    rows = rows.select(*others, "link_position", clean(decoded("href")).alias("_href"), inner_text("label").alias("link_text"))
    return rows.filter("_href <> ''").withColumn("link_url", absolute_url(url, "_href")).drop("_href")


def keyword_pattern():
    keys = [*fixed.HIGH_VALUE_KEYWORDS, *[k for ks in fixed.SOURCE_TYPE_KEYWORDS.values() for k in ks]]
    return "|".join(dict.fromkeys(keys))


def source_links(links: DataFrame, key, limit=35) -> DataFrame:
    """Links that speak of sourcing: first ``limit`` per page, then each address once."""
    spoken = F.concat_ws(" ", "link_text", "link_url")
    kept = links.filter(text.match_key(spoken).rlike(keyword_pattern()))
    return keep_first(top_n(kept, key, [F.asc("link_position")], limit, "_rank").drop("_rank"), [key, "link_url"], "link_position")


def sitemap_urls(maps: DataFrame, key, xml="xml", limit=50) -> DataFrame:
    """Sourcing addresses of a sitemap: <loc> entries, else any address; each once."""
    locs = F.regexp_extract_all(xml, F.lit("(?i)<loc>\\s*(.*?)\\s*</loc>"), 1)
    free = F.regexp_extract_all(xml, F.lit("https?://[^\\s<>\"]+"), 0)
    rows = maps.select(key, F.posexplode(F.when(F.size(locs) > 0, locs).otherwise(free)).alias("position", "_u")).select(key, "position", clean("_u").alias("url"))
    kept = rows.filter(text.match_key("url").rlike(keyword_pattern()))
    return keep_first(top_n(kept, key, [F.asc("position")], limit, "_rank").drop("_rank"), [key, "url"], "position")


def reported_total(value, patterns) -> Column:
    """Number of the first pattern that matches, without thousands separators; null if none."""
    found = [F.nullif(F.regexp_extract(col(value), f"(?i){p}", 1), F.lit("")) for p in patterns]
    return F.replace(F.coalesce(*found), F.lit(","), F.lit("")).try_cast("bigint")


# Patterns of reported totals.
PARTNER_TOTALS = ["([0-9,]+)\\s+certified\\s+partners", "([0-9,]+)\\s+result\\(s\\)", "([0-9,]+)\\s+results"]
B_CORP_TOTALS = [
    "Showing\\s+all\\s+([0-9,]+)\\s+B\\s+Corps", "Showing\\s+[0-9,]+\\s*-\\s*[0-9,]+\\s+of\\s+([0-9,]+)", "of\\s+([0-9,]+)", "([0-9,]+)\\s+B\\s+Corps"]
EWG_TOTALS = [
    "We\\s+found\\s+([0-9,]+)\\s+items", "found\\s+([0-9,]+)\\s+items", "([0-9,]+)\\s+items\\s+that\\s+are\\s+EWG\\s+Verified"]
# Words of catalogue searches.
CATALOGUE_SEARCH_WORDS = ["configurator", "customizer", "product builder", "design your own", "configurateur", "personnaliser", "configurador", "personalizar", "konfigurator"]

# --- companies --------------------------------------------------------------------------------


def company_rows(items: DataFrame) -> DataFrame:
    """Catalogue rows with a company, its own domains and addresses."""
    rows = items.select(
        (F.col("src_ordinal") + 2).alias("row_number"), clean("company").alias("company_name"), clean("product").alias("product"),
        clean("industry").alias("industry"), clean("country").alias("country"),
        F.array(clean("configurator_url"), clean("alternative_url")).alias("urls"),
    ).filter("company_name <> ''")
    own = lambda h: (h != "") & ~text.host_within(h, fixed.UNHELPFUL_DOMAINS)
    safe = lambda u: F.when(u.rlike("(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), u))
    return rows.withColumns({
        "company_name_normalized": text.match_key("company_name", is_clean=True),
        "domains": F.array_distinct(F.filter(F.transform("urls", text.domain_of), own)),
        "urls": F.array_distinct(F.transform(F.filter("urls", lambda u: (u != "") & own(text.domain_of(u))), safe)),
    })


COMPANY_KEYS = {"company_name": "company_name", "company_name_normalized": "company_name_normalized"}


def unique_companies(rows: DataFrame) -> DataFrame:
    """One row per company with its products, industries, countries, domains and addresses."""
    spec = Summary(keys=COMPANY_KEYS, rows="configurator_rows",
                   lists={"configurator_products": ("product", 80), "industries": ("industry", 30), "countries": ("country", 30)})
    rows = written(rows)
    grouped = summarise(rows, spec, ["row_number"])
    numbers = rows.groupBy(*COMPANY_KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_set("row_number")), lambda n: n.cast("string")), " | ").alias("configurator_row_numbers"))
    result = grouped.join(numbers, list(COMPANY_KEYS))
    for source, name in (("domains", "company_domains"), ("urls", "company_urls")):
        values = rows.select(*COMPANY_KEYS, F.explode(source).alias("v")).distinct().groupBy(*COMPANY_KEYS).agg(text.encode_list(F.array_sort(F.collect_list("v"))).alias(name))
        result = result.join(values, list(COMPANY_KEYS), "left")
    return result.fillna("", subset=["company_domains", "company_urls"])


def search_name(value) -> Column:
    name = F.replace(F.regexp_replace(clean(value), "(?i)\\.(com|de|it|fr|co|uk|nl|ch|eu)$", ""), F.lit("+"), F.lit(" "))
    return F.trim(F.regexp_replace(name, "(?U)\\s+", " "))


def search_queries(companies: DataFrame, name="company_name", limit=4, templates=fixed.SEARCH_TEMPLATES) -> DataFrame:
    """First ``limit`` different queries per company; the templates are spread on the row."""
    filled = companies.withColumn("_name", search_name(name))
    queries = F.array_distinct(F.array(*[clean(F.replace(F.lit(t), F.lit("{company}"), F.col("_name"))) for t in templates]))
    listed = F.slice(F.filter(queries, lambda q: q != ""), 1, limit)
    return filled.select(*companies.columns, F.posexplode(listed).alias("query_number", "query"))


def catalogue_queries(items: DataFrame, company="company", product="product", country="country") -> DataFrame:
    """Searches for every catalogue row, in order: with and without the country for each search word, then the
    names alone. Equal ones, whatever their case, come once, and so do empty ones not at all."""
    c, p, n = (clean(x) for x in (company, product, country))
    joined = lambda *parts: clean(F.concat_ws(" ", *parts))
    listed = F.filter(F.array(
        *[joined(p, c, n, F.lit(w)) for w in CATALOGUE_SEARCH_WORDS], *[joined(p, c, F.lit(w)) for w in CATALOGUE_SEARCH_WORDS], joined(c, p, n)), lambda q: q != "")
    # All searches of a row stand in one array, so equal ones are found there and only rows are shuffled.
    lowered = lambda found: F.transform(found, lambda q: F.lower(q))
    kept = bound(listed, lambda found: bound(lowered(found), lambda keys: F.filter(found, lambda q, i: F.array_position(keys, F.lower(q)) == i + 1)))
    rows = items.distinct().select("*", F.posexplode(kept).alias("_at", "query"))
    return rows.select(*items.columns, (F.col("_at") + 1).alias("query_number"), "query")


def candidate_urls(hosts: DataFrame, host="host", paths_per_host=35) -> DataFrame:
    """Home page variants, common paths and sitemap addresses of every host."""
    h = F.col(host)
    home = [F.concat(F.lit(p), h, F.lit("/")) for p in ("https://", "https://www.", "http://", "http://www.")]
    paths = [F.concat(F.lit("https://"), h, F.lit(p)) for p in fixed.COMMON_PATHS[:paths_per_host]]
    maps = [F.concat(F.lit("https://"), h, F.lit(p)) for p in ("/sitemap.xml", "/sitemap_index.xml")]
    groups = [("official_homepage", home), ("official_common_path", paths), ("official_sitemap", maps)]
    entries = F.array(*[F.struct(F.lit(n).alias("discovery_method"), u.alias("url")) for n, us in groups for u in us])
    return hosts.filter(h != "").select(host, F.inline(F.array_distinct(entries)))


# --- typing and scoring ----------------------------------------------------------------------


def keyword_evidence(df: DataFrame, haystack) -> DataFrame:
    """High-value flag and source type: most keyword hits, the earlier type on a tie."""
    hits = df.withColumns({f"_h_{t}": rules.count_hits(haystack, ks) for t, ks in fixed.SOURCE_TYPE_KEYWORDS.items()})
    types = list(fixed.SOURCE_TYPE_KEYWORDS)
    best = F.greatest(*[F.col(f"_h_{t}") for t in types])
    chain = F.when(best == 0, fixed.SOURCE_TYPE_DEFAULT)
    for name in types:
        chain = chain.when(F.col(f"_h_{name}") == best, name)
    return hits.select(*df.columns, chain.alias("source_type"), rules.contains_any(haystack, fixed.HIGH_VALUE_KEYWORDS).alias("high_value"))


def score_sources(sources: DataFrame) -> DataFrame:
    """0-100 score with reasons for rows of company_name, company_domains (array), discovery_method,
    title, url, snippet, http_status."""
    rows = sources.withColumns({
        "haystack": text.match_key(F.concat_ws(" ", "title", "url", "snippet")),
        "company_key": text.match_key("company_name"),
        "result_domain": text.domain_of("url"),
        "result_path": F.regexp_extract(F.regexp_replace(clean("url"), "(?i)^https?://", ""), "^[^/?#]*([^?#]*)", 1),
        "lower_url": F.lower(clean("url")),
        "status": F.when(clean("http_status").rlike("^[0-9]+$"), F.col("http_status").try_cast("int")),
    })
    rows = keyword_evidence(rows, "haystack")
    tokens = F.filter(F.split("company_key", " "), lambda t: F.length(t) >= 4)
    found = F.size(F.filter(tokens, lambda t: F.contains(F.col("haystack"), t)))
    rows = rows.withColumns({
        "token_ratio": F.when(F.size(tokens) > 0, found / F.size(tokens)).otherwise(0.0),
        "own_domain": F.exists("company_domains", lambda d: (F.col("result_domain") == d) | F.endswith(F.col("result_domain"), F.concat(F.lit("."), d)) | F.endswith(d, F.concat(F.lit("."), F.col("result_domain")))) & (F.col("result_domain") != ""),
    })
    kind = F.col("source_type")
    strong, useful = ["supplier_list", "factory_list", "modern_slavery_statement"], ["sustainability_report", "responsible_sourcing", "open_supply_hub"]
    terms = [
        (F.col("discovery_method").startswith("official"), 30, "official_domain_discovery"),
        ((F.col("company_key") != "") & F.contains(F.col("haystack"), F.col("company_key")), 18, "company_name_found_in_source"),
        (F.col("token_ratio") >= 0.8, 12, "most_company_tokens_found"),
        ((F.col("token_ratio") >= 0.5) & (F.col("token_ratio") < 0.8), 7, "some_company_tokens_found"),
        (F.col("own_domain"), 35, "official_or_company_domain_match"),
        (text.host_within("result_domain", fixed.NEGATIVE_DOMAINS), -35, "negative_domain"),
        (F.contains(F.col("lower_url"), F.lit(".pdf")), 12, "pdf_source"),
        (F.col("high_value"), 24, "high_value_supplier_keyword"),
        *[(kind == t, 22, f"strong_source_type_{t}") for t in strong],
        *[(kind == t, 14, f"useful_source_type_{t}") for t in useful],
        (kind == "supply_chain_page", 12, "supply_chain_page"),
        *[(F.contains(F.col("haystack"), F.lit(k)), -8, f"negative_keyword_{k}") for k in fixed.NEGATIVE_KEYWORDS],
        (F.col("status") < 400, 5, "url_fetch_success"),
    ]
    late = [(F.contains(F.col("result_domain"), F.lit("opensupplyhub")), 18, "open_supply_hub_result")]
    failed = F.when(F.col("status") >= 400, F.concat(F.lit("http_status_"), F.col("status")))
    points = rules.total([(c, p) for c, p, _ in [*terms, *late]]) + F.when(F.col("status") >= 400, -12).otherwise(0)
    texts = F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, _, r in terms], failed, *[F.when(c, F.lit(r)) for c, _, r in late]))
    scored = rows.withColumns({"source_score": rules.clamp(points, 0, 100), "score_reasons": F.array_join(texts, " | ")})
    score = F.col("source_score")
    band = F.when(score >= 75, "High").when(score >= 50, "Medium").when(score >= 30, "Low").otherwise("Very Low")
    return scored.withColumn("source_confidence", band).select(
        *sources.columns, "source_type", "source_score", "source_confidence", "score_reasons", "result_domain", "result_path")


def kept_sources(scored: DataFrame, minimum=35) -> DataFrame:
    """Candidates from the minimum score up, each (company, address) once, the earliest one."""
    return keep_first(scored, ["company_name", "url"], "source_candidate_id", where=F.col("source_score") >= minimum)


def source_statistics(sources: DataFrame) -> DataFrame:
    level = lambda name: F.count_if(F.col("source_confidence") == name)
    return sources.groupBy("company_name").agg(
        F.count("*").alias("source_count"), level("High").alias("high_sources"), level("Medium").alias("medium_sources"),
        F.max("source_score").alias("max_source_score"))


def best_sources(sources: DataFrame) -> DataFrame:
    """Highest score per company; the earliest candidate on a tie."""
    best = F.max_by(F.struct("url", "title", "source_type"), F.struct("source_score", -F.col("source_candidate_id")))
    return sources.groupBy("company_name").agg(best.alias("_b")).select(
        "company_name", F.col("_b.url").alias("best_source_url"), F.col("_b.title").alias("best_source_title"), F.col("_b.source_type").alias("best_source_type"))


def company_summary(companies: DataFrame, sources: DataFrame) -> DataFrame:
    joined = companies.join(source_statistics(sources), "company_name", "left").join(best_sources(sources), "company_name", "left")
    counts = ["source_count", "high_sources", "medium_sources", "max_source_score"]
    return joined.fillna(0, subset=counts).fillna("", subset=["best_source_url", "best_source_title", "best_source_type"])
