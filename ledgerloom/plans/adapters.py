"""Catalogue, registry and log tables expressed over the given tables.

Each adapter is one SQL text understood both by Spark and by the checking engine, so both sides
see the same rows. ``@name`` stands for a given table, ``a_name`` for another adapter.
"""

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

ADAPTERS = {
    # One made-up company per document: a two-word name and a web host of its own.
    "a_names": """
        SELECT doc_id AS name_id,
               concat(split_part(text, ' ', 1), ' ', split_part(text, ' ', 2)) AS company_name,
               concat('c', substr(md5(split_part(text, ' ', 1)), 1, 8), '.example.com') AS host
        FROM @documents
    """,
    "a_parts": """
        SELECT p.*, p_partkey % (SELECT count(*) FROM @supplier) AS supplier_ref,
               p_partkey % (SELECT count(*) FROM @documents) AS name_ref,
               p_partkey % (SELECT count(*) FROM @pages) AS page_ref
        FROM @part p
    """,
    "a_configurators": """
        SELECT p.p_partkey AS src_ordinal, p.p_partkey + 1 AS id,
               CASE p.p_type WHEN 'ECONOMY' THEN 'House & Garden' WHEN 'SMALL' THEN 'Accessories'
                    WHEN 'MEDIUM' THEN ' Footwear ' WHEN 'PROMO' THEN 'Motor Vehicles'
                    WHEN 'STANDARD' THEN '' ELSE 'Electronics' END AS industry,
               CASE n.n_nationkey WHEN 0 THEN 'Italy' WHEN 1 THEN 'Germany'
                    WHEN 2 THEN 'United States of America' WHEN 3 THEN 'UK'
                    WHEN 4 THEN 'Czech Republic' WHEN 5 THEN '' ELSE n.n_name END AS country,
               CASE WHEN p.p_partkey % 97 = 0 THEN '  ' ELSE d.company_name END AS company,
               p.p_name AS product,
               concat('https://www.', d.host, '/configurator/', cast(p.p_partkey AS string)) AS configurator_url,
               CASE WHEN p.p_size % 5 = 0 THEN g.url ELSE '' END AS alternative_url,
               concat('https://db.example.org/item/', cast(p.p_partkey AS string)) AS database_detail_url,
               CASE p.p_size % 4 WHEN 0 THEN 'SI' WHEN 1 THEN 'no' WHEN 2 THEN ' Yes ' ELSE '' END AS active_text,
               CASE p.p_size % 3 WHEN 0 THEN 'Interactive 3D' WHEN 1 THEN 'Static 2D' ELSE '' END AS visualization_text,
               cast(p.p_size % 7 AS string) AS mobile_text,
               cast(p.p_size % 6 AS string) AS compatibility_text,
               CASE WHEN p.p_size % 8 = 7 THEN 'n/a' ELSE cast(p.p_size % 8 AS string) END AS complexity_text
        FROM a_parts p
        JOIN @supplier s ON s.s_suppkey = p.supplier_ref
        JOIN @nation n ON n.n_nationkey = s.s_nationkey
        JOIN a_names d ON d.name_id = p.name_ref
        JOIN @pages g ON g.page_id = p.page_ref
    """,
    "a_registry": """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS src_ordinal,
               l.l_partkey * 1000000 + l.l_suppkey AS src_tie,
               CASE concat(l.l_returnflag, l.l_linestatus) WHEN 'RF' THEN 'GOTS' WHEN 'NO' THEN 'B Corp'
                    WHEN 'AO' THEN 'EU Ecolabel' WHEN 'RO' THEN 'Bluesign'
                    WHEN 'NF' THEN 'Mystery Label' ELSE 'Fair for Life' END AS certification,
               CASE l.l_linenumber % 4 WHEN 0 THEN d.company_name
                    WHEN 1 THEN concat(d.company_name, ' GmbH') WHEN 2 THEN concat(replace(d.company_name, 'e', 'E'), ' S.p.A.')
                    ELSE '' END AS certified_company,
               CASE WHEN l.l_linenumber % 4 = 3 THEN p.p_brand ELSE '' END AS certified_brand,
               CASE WHEN l.l_linenumber % 3 = 0 THEN '' ELSE p.p_name END AS certified_product,
               CASE l.l_linenumber % 5 WHEN 0 THEN 'supplier' WHEN 1 THEN 'company' WHEN 3 THEN 'brand listing'
                    WHEN 4 THEN 'organization' ELSE '' END AS match_level,
               p.p_type AS product_category,
               n.n_name AS country_or_scope,
               concat(p.p_type, ' ', l.l_linestatus) AS certification_claim_or_standard,
               concat('C-', cast(l.l_orderkey AS string)) AS certificate_identifier,
               CASE WHEN l.l_linenumber % 2 = 0 THEN concat('https://www.', d.host, '/cert')
                    ELSE concat('https://www.bcorporation.net/', cast(l.l_partkey AS string)) END AS source_url,
               concat(lower(l.l_returnflag), CASE l.l_linestatus WHEN 'F' THEN '/company_rows.csv' ELSE '/product_rows.csv' END) AS source_file,
               'csv' AS source_sheet,
               concat(d.company_name, ' holds ', p.p_name) AS evidence_text,
               substr(cast(l.l_shipdate AS string), 1, 10) AS date_text,
               cast(l.l_quantity AS int) AS quantity,
               l.l_partkey AS part_ref, l.l_suppkey AS supplier_ref, n.n_nationkey AS country_id
        FROM @lineitem l
        JOIN a_parts p ON p.p_partkey = l.l_partkey
        JOIN @supplier s ON s.s_suppkey = l.l_suppkey
        JOIN @nation n ON n.n_nationkey = s.s_nationkey
        JOIN a_names d ON d.name_id = p.name_ref
    """,
    # Candidate sources: every page as a find for one company.
    "a_sources": """
        SELECT p.page_id AS source_candidate_id, d.company_name, d.host,
               CASE p.page_id % 4 WHEN 0 THEN 'official_common_path' WHEN 1 THEN 'official_sitemap' ELSE 'search_engine' END AS discovery_method,
               CASE p.page_id % 7 WHEN 0 THEN concat('https://www.', d.host, '/supplier-list.pdf') WHEN 1 THEN 'https://opensupplyhub.org/facilities'
                    WHEN 2 THEN concat('https://it.linkedin.com/in/', cast(p.page_id AS string)) ELSE p.url END AS url,
               CASE p.page_id % 5 WHEN 0 THEN '200' WHEN 1 THEN '404' WHEN 2 THEN 'n/a' ELSE '' END AS http_status,
               CASE p.page_id % 6 WHEN 0 THEN concat(d.company_name, ' factory list') WHEN 1 THEN 'Sustainability report and jobs' WHEN 2 THEN 'Our supply chain: suppliers'
                    ELSE '' END AS lead, p.html
        FROM (SELECT *, page_id % (SELECT count(*) FROM @documents) AS name_ref FROM @pages) p JOIN a_names d ON d.name_id = p.name_ref
    """,
    # Candidate pairs with ready scores, so that rules after scoring can be checked in SQL.
    "a_scored": """
        SELECT l_partkey + 1 AS configurator_id, l_orderkey * 10 + l_linenumber AS src_ordinal, l_partkey * 1000000 + l_suppkey AS src_tie,
               CASE concat(l_returnflag, l_linestatus) WHEN 'RF' THEN 'GOTS' WHEN 'NO' THEN 'B Corp' WHEN 'AO' THEN 'EU Ecolabel'
                    WHEN 'RO' THEN 'Bluesign' WHEN 'NF' THEN 'Mystery Label' ELSE 'Fair for Life' END AS certification,
               CASE l_linenumber % 5 WHEN 0 THEN 'supplier' WHEN 1 THEN 'product' WHEN 2 THEN 'product' WHEN 3 THEN 'brand' ELSE 'company' END AS evidence_level,
               50.0e0 + l_quantity AS company_score, round(l_discount * 1000) * 1.0e0 AS product_score,
               CASE WHEN round(l_tax * 100) = 0 THEN 100.0e0 ELSE 0.0e0 END AS domain_score,
               (l_quantity = 50 AND l_linenumber % 2 = 0) AS entity_exact_match, round(l_discount * 1000) = 100 AS product_exact_match,
               l_suppkey % 5 = 0 AS short_name, l_linenumber % 3 <> 0 AS has_product, l_linenumber % 4 + 1 AS stage,
               CASE l_linenumber % 4 WHEN 0 THEN 'company_or_brand_exact_normalized' WHEN 1 THEN 'domain_exact'
                    WHEN 2 THEN 'company_or_brand_fuzzy_candidate' ELSE 'product_fuzzy_candidate' END AS hint,
               concat('S', cast(l_suppkey AS string)) AS matched_registry_entity, concat('P', cast(l_partkey AS string)) AS matched_registry_product
        FROM @lineitem
    """,
}


def _used(text):
    return re.findall(r"\ba_[a-z_]+\b", text)


def _ordered(names, seen=None):
    """Adapters needed for the names, dependencies first."""
    seen = [] if seen is None else seen
    for name in names:
        if name in ADAPTERS and name not in seen:
            _ordered(_used(ADAPTERS[name]), seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_adapters(body: str) -> str:
    """Checking SQL: the adapters the body names as CTEs, then the body."""
    parts = [f"{n} AS ({ADAPTERS[n]})" for n in _ordered(_used(body))]
    sql = re.sub(r"@([a-z]+)", r"\1", ",\n".join(parts))
    body = re.sub(r"@([a-z]+)\b", r"\1", body).strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {sql},\n{body[5:]}"
    return f"WITH {sql}\n{body}"


# Row-heavy adapters and the table whose files decide how parallel they start.
SPREAD = {"a_registry": "lineitem", "a_scored": "lineitem", "a_sources": "pages"}


class Tables:
    """Given tables and adapters of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path_sql(self, sql):
        return re.sub(r"@([a-z]+)", lambda m: f"parquet.`{self.folder}/{m.group(1)}.parquet`", sql)

    def __getattr__(self, name) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in ADAPTERS:
            parts = [f"{n} AS ({ADAPTERS[n]})" for n in _ordered([name])]
            rows = self.spark.sql(self._path_sql(f"WITH {', '.join(parts)} SELECT * FROM {name}"))
            return self._spread(rows, SPREAD[name]) if name in SPREAD else rows
        raise AttributeError(name)

    def _spread(self, rows, source):
        """A table of one small file starts as one task; share its rows out before the text work.
        A table of many files keeps its partitions and is not shuffled."""
        cores = self.spark.sparkContext.defaultParallelism
        return rows if getattr(self, source).rdd.getNumPartitions() >= cores else rows.repartition(cores)
