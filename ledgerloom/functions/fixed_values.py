"""Fixed values. Word lists, patterns and thresholds that results depend on; data only, no logic."""

# Legal-form phrases; their single tokens are dropped from strict keys.
LEGAL_SUFFIXES = [
    "incorporated", "corporation", "company", "limited", "ltd", "llc", "plc", "inc", "corp", "co",
    "gmbh", "ag", "kg", "oy", "ab", "bv", "nv", "srl", "sr", "spa", "s.p.a", "sas", "sa", "s.a",
    "pte", "pte ltd", "pty", "pty ltd", "kft", "aps", "as", "a/s", "sl", "s.l", "llp", "lp",
    "group", "holdings", "holding",
]

# Registry hosts that say nothing about the certified company.
GENERIC_REGISTRY_DOMAINS = [
    "bcorporation.net", "www.bcorporation.net", "environdec.com", "www.environdec.com",
    "greencirclecertified.com", "db.greencirclecertified.com", "petaapprovedvegan.peta.org",
    "peta.org", "www.blauer-engel.de", "blauer-engel.de", "c2ccertified.org", "www.c2ccertified.org",
    "environmental-data.ec.europa.eu", "ec.europa.eu", "ewg.org", "www.ewg.org", "fairforlife.org",
    "www.fairforlife.org", "global-standard.org", "www.global-standard.org", "app.powerbi.com",
    "powerbi.com", "oeko-tex.com", "www.oeko-tex.com",
]

# Hosts that are never a company's own site.
UNHELPFUL_DOMAINS = [
    "configurators.com", "mconfigurators.com", "lemanoosh.com", "wikipedia.org", "google.com",
    "bing.com", "duckduckgo.com",
]

SUPPLIER_ORIENTED_CERTIFICATIONS = [
    "fsc", "forest stewardship council", "global organic textile standard", "gots",
    "global recycled standard", "grs", "bluesign", "fair for life",
]

DIRECT_ORIENTED_CERTIFICATIONS = [
    "b corp", "certified b corporation", "peta approved vegan", "peta-approved vegan", "blue angel",
    "cradle to cradle certified", "eu ecolabel", "ewg verified", "greencircle certified",
    "greencircle", "environmental product declaration", "epd", "oeko tex made in green",
    "oeko-tex made in green",
]

# Master registry: expected folders, file-name keywords, path keywords.
EXPECTED_FOLDERS = {
    "blue_angel": "Blue Angel",
    "bluesign": "Bluesign",
    "cradle_to_cradle": "Cradle to Cradle Certified",
    "eu_ecolabel": "EU Ecolabel",
    "ewg_verified": "EWG Verified",
    "fair_for_life": "Fair for Life",
    "gots": "Global Organic Textile Standard",
    "GRS": "Global Recycled Standard",
    "oeko_tex_made_in_green": "OEKO-TEX MADE IN GREEN",
    "b_corp": "B Corp",
    "fsc": "FSC",
    "green_circle": "GreenCircle Certified",
    "epd": "Environmental Product Declaration",
    "peta_approved_vegan": "PETA-Approved Vegan",
}

SKIP_FILE_KEYWORDS = [
    "metadata", "scrape_log", "country_summary", "countries", "domain_summary", "label_summary",
    "compliance_summary", "standards_summary", "certified_since_summary", "certification_claims",
    "product_types", "product_categories", "types", "checkpoint", "raw_pages", "debug",
    "master_certification_registry", "unmapped", "summary",
]

PRIMARY_FILE_KEYWORDS = [
    "products", "companies", "brands", "suppliers", "partners", "organizations", "organisations",
    "certificate_rows", "epds", "registry", "made_in_green", "b_corp", "fsc", "grs", "gots", "peta",
    "green_circle", "cradle", "ecolabel", "ewg", "fair_for_life", "blue", "bluesign",
]

PATH_CERTIFICATIONS = {
    "blue_angel": "Blue Angel",
    "blauer_engel": "Blue Angel",
    "bluesign": "Bluesign",
    "cradle_to_cradle": "Cradle to Cradle Certified",
    "c2c": "Cradle to Cradle Certified",
    "eu_ecolabel": "EU Ecolabel",
    "ecolabel": "EU Ecolabel",
    "ewg": "EWG Verified",
    "ewg_verified": "EWG Verified",
    "fair_for_life": "Fair for Life",
    "gots": "Global Organic Textile Standard",
    "global_organic_textile_standard": "Global Organic Textile Standard",
    "grs": "Global Recycled Standard",
    "global_recycled_standard": "Global Recycled Standard",
    "oeko_tex": "OEKO-TEX MADE IN GREEN",
    "oeko_tex_made_in_green": "OEKO-TEX MADE IN GREEN",
    "b_corp": "B Corp",
    "fsc": "FSC",
    "green_circle": "GreenCircle Certified",
    "epd": "Environmental Product Declaration",
    "peta": "PETA-Approved Vegan",
    "peta_approved_vegan": "PETA-Approved Vegan",
}

# Candidate headers per canonical registry column, in order of preference.
REGISTRY_COLUMN_CANDIDATES = {
    "certified_company": [
        "company_name", "company", "organization_name", "organisation_name", "organization",
        "organisation", "supplier", "supplier_name", "partner", "partner_name", "manufacturer",
        "producer", "owner", "certificate_holder", "certificate holder", "holder", "applicant",
        "legal_entity", "entity_name",
    ],
    "certified_brand": ["brand_name", "brand", "brands", "certified_brand", "brandname"],
    "certified_product": [
        "product_name", "product", "certified_product", "input_trade_name", "input trade name",
        "trade_name", "trade name", "product_title", "declaration_name", "epd_product_name",
    ],
    "product_category": [
        "product_category", "product category", "category", "product_type", "product type",
        "type_utilisation", "type / utilisation", "type", "output_category", "output category",
        "sector", "field_of_operation", "field of operation", "industry",
    ],
    "country_or_scope": [
        "country", "country_name", "country name", "country_area", "country/area", "country_region",
        "country/region", "geographical_scope", "geographical scope", "location", "state_province",
        "state/province",
    ],
    "certification_claim_or_standard": [
        "certification_claim", "certification claim", "standard_label", "standard label",
        "standards_labels", "standards labels", "claim", "epd_type", "epd type", "certificate_type",
        "certificate type", "certification_type", "certification type", "certification_level",
        "certification level", "compliance_label", "compliance label", "cert_status", "cert status",
        "certificate_status", "certificate status", "registry_match_level",
    ],
    "certificate_identifier": [
        "certificate_id", "certificate id", "certificate_code", "certificate code", "licence",
        "license", "epd_number", "epd number", "certification_number", "certification number",
        "registration_number", "registration number", "product_id", "product id", "id",
    ],
    "source_url": [
        "product_url", "profile_url", "website_url", "download_url", "source_url", "registry_url",
        "url", "database_detail_url",
    ],
    "evidence_text": [
        "evidence_text", "evidence text", "raw_text", "raw text", "raw_company_text",
        "raw company text", "description", "source_text", "source text",
    ],
    "match_level": [
        "registry_match_level", "match_level", "match level", "registry_section", "registry section",
    ],
}

CERTIFICATION_NAME_COLUMNS = [
    "certification_full_name", "certification_display_name", "certification", "certification_name",
]
CERTIFICATION_HEADER_WORDS = ["certification", "certification claim", "certification_claim"]

CATALOGUE_COLUMN_CANDIDATES = {
    "industry": ["Industry", "industry"],
    "country": ["Country", "country"],
    "company": ["Company", "company", "azienda"],
    "product": ["Product", "product", "prodotto"],
    "configurator_url": ["Configurator URL", "configurator_url", "ConfiguratorURL", "url"],
    "alternative_url": [
        "Configurator URL alternativa", "Configurator URL alternativa ", "alternative_url",
        "Configurator URL alternative",
    ],
    "database_detail_url": ["Database detail URL", "database_detail_url", "detail_url"],
}

MASTER_COLUMNS = [
    "master_record_id", "certification", "certification_full_name", "evidence_level",
    "registry_match_level_raw", "applies_to_configurator_product_by", "certified_entity_name",
    "certified_entity_type", "certified_entity_name_normalized",
    "certified_entity_name_normalized_strict", "certified_company", "certified_company_normalized",
    "certified_company_normalized_strict", "certified_brand", "certified_brand_normalized",
    "certified_brand_normalized_strict", "certified_product", "certified_product_normalized",
    "certified_product_normalized_strict", "product_category", "product_category_normalized",
    "country_or_scope", "country_or_scope_normalized", "certification_claim_or_standard",
    "certificate_identifier", "source_url", "source_file", "source_sheet", "source_row_number",
    "evidence_text", "created_at_utc",
]

AUDIT_COLUMNS = [
    "configurator_row_number", "configurator_id", "configurator_company", "configurator_product",
    "configurator_industry", "configurator_country", "configurator_domains", "certification",
    "registry_usage_mode", "decision", "site_claim_type", "confidence", "final_score", "match_method",
    "matched_evidence_level", "matched_registry_entity", "matched_registry_company",
    "matched_registry_brand", "matched_registry_product", "matched_product_category",
    "matched_country_or_scope", "company_score", "product_score", "domain_score",
    "entity_exact_match", "product_exact_match", "master_record_id", "certificate_identifier",
    "source_file", "source_sheet", "source_row_number", "source_url", "evidence_text",
    "review_reason", "created_at_utc",
]

# Certification name -> (source key, registry type, availability). A keyword matches when it is
# contained in the folded name; "=x" matches only the whole name.
SOURCE_CLASSES = [
    (["blue angel"], ("blue_angel", "official_product_catalogue", "HIGH")),
    (["bluesign"], ("bluesign", "official_brand_product_directory", "MEDIUM")),
    (["cradle to cradle"], ("cradle_to_cradle_certified", "official_product_registry", "HIGH")),
    (["eu ecolabel", "european ecolabel"], ("eu_ecolabel", "official_product_catalogue", "HIGH")),
    (["ewg verified"], ("ewg_verified", "official_product_database", "HIGH")),
    (["fair for life"], ("fair_for_life", "official_certified_partners_directory", "MEDIUM")),
    (["fair rubber"], ("fair_rubber", "official_members_directory", "LOW_MEDIUM")),
    (["global organic textile standard", "=gots"], ("gots", "official_certified_suppliers_database", "MEDIUM_HIGH")),
    (["global recycled standard", "=grs"], ("global_recycled_standard", "textile_exchange_certified_company_database", "MEDIUM_HIGH")),
    (["recycled claim standard", "rcs blended"], ("recycled_claim_standard_blended", "textile_exchange_certified_company_database", "MEDIUM_HIGH")),
    (["organic content standard", "ocs blended"], ("organic_content_standard_blended", "textile_exchange_certified_company_database", "MEDIUM_HIGH")),
    (["plant based fiber", "plant based fibre"], ("plant_based_fiber_blended", "amazon_climate_pledge_friendly_program_attribute", "LOW")),
    (["oeko tex standard 100", "standard 100"], ("oeko_tex_standard_100", "official_label_check", "MEDIUM")),
    (["oeko tex made in green", "made in green"], ("oeko_tex_made_in_green", "official_label_check", "MEDIUM")),
    (["altro tipo", "other certification"], ("other_certification", "fallback_detection", "VARIABLE")),
]
SOURCE_CLASS_DEFAULT = ("unmapped", "manual_review_required", "UNKNOWN")

# Industry text -> industry key.
INDUSTRY_KEYS = [
    (["accessor"], "accessories"),
    (["apparel", "fashion", "clothing"], "apparel"),
    (["beauty", "health"], "beauty-health"),
    (["electronics"], "electronics"),
    (["food", "packaging"], "food-packaging"),
    (["footwear"], "footwear"),
    (["games", "music"], "games-music"),
    (["house", "garden", "furniture"], "house-garden"),
    (["industrial", "machinery", "manufacturing"], "industrial-goods"),
    (["kids", "babies", "baby"], "kids-babies"),
    (["motor", "vehicle", "automotive"], "motor-vehicles"),
    (["office", "merchandise"], "office-merchandise"),
    (["paper", "book"], "paper-books"),
    (["pet"], "pet-supplies"),
    (["printing", "print"], "printing-platforms"),
    (["sportswear", "equipment", "sport"], "sportswear-equipment"),
]
INDUSTRY_DEFAULT = "uncategorized"

# Product text -> pictogram group (named by its first keyword).
PRODUCT_GROUPS = [
    (["chair"], "chair"), (["desk"], "desk"), (["sofa"], "sofa"), (["table"], "table"),
    (["shelf"], "shelf"), (["bag", "handbag"], "bag"), (["backpack"], "backpack"),
    (["hat", "cap"], "hat"), (["shoe", "sneaker"], "shoe"), (["sandal"], "sandal"),
    (["watch"], "watch"), (["ring"], "ring"), (["pendant"], "pendant"), (["suit"], "suit"),
    (["shirt", "t-shirt"], "shirt"), (["car"], "car"), (["trailer"], "trailer"),
    (["harvester"], "harvester"), (["bike", "bicycle"], "bike"), (["guitar"], "guitar"),
    (["pc"], "pc"), (["server"], "server"), (["cable"], "cable"), (["rug", "carpet"], "rug"),
    (["pizza"], "pizza"), (["chocolate"], "chocolate"), (["cookie"], "cookie"),
    (["cereal"], "cereal"), (["nutrition bar"], "nutrition bar"), (["razor"], "razor"),
    (["lipstick"], "lipstick"), (["shampoo"], "shampoo"), (["door"], "door"),
    (["window"], "window"), (["cage"], "cage"), (["dog tag"], "dog tag"), (["mug"], "mug"),
    (["calendar"], "calendar"), (["portrait", "photograph", "photo"], "portrait"),
    (["pencil"], "pencil"), (["skateboard"], "skateboard"), (["tent"], "tent"),
    (["plate"], "plate"), (["buggy"], "buggy"), (["energy supply"], "energy supply"),
    (["workbench"], "workbench"), (["elevator"], "elevator"),
    (["name assembly", "exhibition booth"], "assembly"), (["tea favor"], "tea favor"),
]
PRODUCT_DEFAULT = "package"

# Country name -> ISO-2.
COUNTRY_CODES = {
    "norway": "no", "sweden": "se", "finland": "fi", "denmark": "dk", "germany": "de",
    "switzerland": "ch", "austria": "at", "italy": "it", "france": "fr", "spain": "es",
    "portugal": "pt", "belgium": "be", "netherlands": "nl", "poland": "pl",
    "czech republic": "cz", "czechia": "cz", "united kingdom": "gb", "uk": "gb", "england": "gb",
    "ireland": "ie", "united states": "us", "usa": "us", "united states of america": "us",
    "canada": "ca", "australia": "au", "china": "cn", "japan": "jp", "india": "in",
}

# Visualisation text -> class: whole-value words first, then free-text signals.
VISUALISATION_WORDS = [
    (["=ar", "augmented reality", "realtà aumentata", "realta aumentata"], "Interactive 3D"),
    (["interactive", "3d", "360", "rotatable", "rotabile"], "Interactive 3D"),
    (["static", "2d", "immag"], "Static 2D"),
]
VISUALISATION_TEXT_SIGNALS = [
    (["augmented reality", "realtà aumentata", "realta aumentata", "view in your space",
      "quick look", "scene viewer", ".usdz", " rel=ar"], "Interactive 3D"),
    (["babylon.js", "three.js", "three js", "webgl", "sketchfab", "verge3d", "playcanvas",
      "model-viewer", "model viewer", "360°", "360 degree", "360-degree", "360 view",
      "drag to rotate", "rotate the model", "rotatable", "rotabile", "3d viewer",
      "3d configurator"], "Interactive 3D"),
    (["static image", "static images", "immagini statiche", "preview image", "preview images",
      "product image", "gallery image", "solo immagini", "2d preview", "2d"], "Static 2D"),
]

# Supplier-source discovery.
SEARCH_TEMPLATES = [
    '"{company}" "supplier list"',
    '"{company}" "factory list"',
    '"{company}" "supplier disclosure"',
    '"{company}" "supply chain disclosure"',
    '"{company}" "modern slavery statement"',
    '"{company}" "sustainability report" suppliers',
    '"{company}" "responsible sourcing report"',
    '"{company}" "manufacturing partners"',
    '"{company}" "supplier code of conduct"',
    '"{company}" "sourcing" "suppliers"',
    'site:opensupplyhub.org "{company}"',
]

SOURCE_TYPE_KEYWORDS = {
    "supplier_list": [
        "supplier list", "suppliers list", "list of suppliers", "supplier disclosure",
        "supply chain disclosure", "supplier directory", "supplier database",
    ],
    "factory_list": [
        "factory list", "factory disclosure", "manufacturing sites", "manufacturing facilities",
        "factory disclosure list", "facility list", "facilities list", "production sites",
        "production facilities",
    ],
    "modern_slavery_statement": [
        "modern slavery statement", "slavery statement", "human trafficking statement",
    ],
    "sustainability_report": [
        "sustainability report", "esg report", "annual report", "impact report",
        "responsibility report", "corporate responsibility report", "csr report", "sustainability",
    ],
    "responsible_sourcing": [
        "responsible sourcing", "responsible procurement", "supplier code of conduct",
        "supplier standards", "sourcing policy", "ethical sourcing", "procurement policy",
    ],
    "open_supply_hub": ["opensupplyhub", "open supply hub"],
    "supply_chain_page": [
        "supply chain", "sourcing", "suppliers", "manufacturing partners",
        "responsible supply chain", "traceability",
    ],
}
SOURCE_TYPE_DEFAULT = "other_possible_source"

HIGH_VALUE_KEYWORDS = [
    "supplier list", "factory list", "supply chain disclosure", "supplier disclosure",
    "modern slavery statement", "manufacturing facilities", "manufacturing partners",
    "supplier code of conduct", "responsible sourcing", "ethical sourcing", "open supply hub",
]

COMMON_PATHS = [
    "/sustainability", "/en/sustainability", "/sustainability/", "/en/sustainability/",
    "/responsibility", "/en/responsibility", "/corporate-responsibility", "/social-responsibility",
    "/csr", "/esg", "/impact", "/supply-chain", "/en/supply-chain", "/suppliers", "/en/suppliers",
    "/supplier", "/supplier-list", "/factory-list", "/factory-disclosure", "/manufacturing",
    "/manufacturing-partners", "/responsible-sourcing", "/ethical-sourcing", "/sourcing",
    "/procurement", "/supplier-code-of-conduct", "/code-of-conduct", "/modern-slavery-statement",
    "/modern-slavery", "/downloads", "/download", "/reports", "/annual-report",
    "/sustainability-report", "/investors", "/investor-relations", "/about/sustainability",
    "/about-us/sustainability", "/company/sustainability", "/corporate/sustainability",
]

NEGATIVE_DOMAINS = [
    "linkedin.com", "facebook.com", "instagram.com", "youtube.com", "x.com", "twitter.com",
    "tiktok.com", "pinterest.com", "glassdoor.com", "indeed.com", "wikipedia.org", "bloomberg.com",
    "crunchbase.com", "zoominfo.com",
]

NEGATIVE_KEYWORDS = [
    "jobs", "careers", "hiring", "coupon", "discount", "sale", "stock price", "press release",
    "newsroom", "facebook", "instagram", "linkedin", "youtube",
]

# GRS certificate list: countries, and patterns of lines that are no records.
GRS_COUNTRIES = [
    "United Arab Emirates", "United Kingdom", "United States", "South Korea", "Czech Republic", "Switzerland",
    "Bangladesh", "Netherlands", "Pakistan", "Portugal", "Germany", "Ireland", "Türkiye", "Turkey", "France",
    "Poland", "India", "Spain", "Italy", "Italia", "taly", "China", "USA", "Taiwan", "Tunisia", "Romania", "Bulgaria",
    "Austria", "Belgium", "Greece", "Croatia", "Denmark", "Finland", "Sweden", "Norway", "Canada", "Mexico", "Brazil",
    "Morocco", "Egypt", "Pakistan", "Vietnam", "Japan", "Thailand", "Indonesia", "Sri Lanka",
]
GRS_NOISE_PATTERNS = [
    r"^ICEA\s*-\s*GRS\s*M\.?0403", r"^Last update", r"^Pag\.", r"^Page\s+\d+", r"^LICENSEE$", r"^CERTIFICATE$",
    r"^CERTIFIED PRODUCTS", r"^PROCESSES$", r"^Facilities$", r"^GRS\s+Version$", r"^Company name$", r"^State$",
    r"^Web$", r"^N°\s*Certificate$", r"^First issue$", r"^Revision$", r"^Expiring$",
    r"^Product\s*/\s*Process description$", r"^No\.$", r"^date$", r"^issue$", r"^LEGENDA", r"^Legend", r"^IT\s+EN$",
    r"^Nuove certificazioni", r"^SOMMARIO", r"^Index$", r"^Registro delle ditte", r"^Register of textile",
    r"^Maggio,\s*\d{4}$", r"^May,\s*\d{4}$", r"^GRS\s*M0403$",
]

# FSC licence rows: statuses, roles and countries.
FSC_STATUSES = "Valid|Suspended and blocked|Suspended|Terminated and blocked|Terminated"
FSC_ROLES = "Certificate holder|Participating site|Group member|Outsourcing contractor|Site"
FSC_COUNTRIES = [
    "United Kingdom of Great Britain and Northern Ireland", "United States of America", "Russian Federation",
    "Korea, Republic of", "Korea, Democratic People's Republic of", "Iran, Islamic Republic of",
    "Tanzania, United Republic of", "Moldova, Republic of", "Venezuela, Bolivarian Republic of",
    "Bolivia, Plurinational State of", "Lao People's Democratic Republic", "Syrian Arab Republic", "Viet Nam",
    "Czech Republic", "Dominican Republic", "Central African Republic", "Bosnia and Herzegovina", "North Macedonia",
    "South Africa", "New Zealand", "Saudi Arabia", "United Arab Emirates", "Costa Rica", "Sri Lanka", "El Salvador",
    "Puerto Rico", "Hong Kong", "Taiwan", "Palestine", "Côte d'Ivoire", "Ivory Coast", "Afghanistan", "Albania",
    "Algeria", "Andorra", "Angola", "Argentina", "Armenia", "Australia", "Austria", "Azerbaijan", "Bangladesh",
    "Belarus", "Belgium", "Brazil", "Bulgaria", "Cambodia", "Cameroon", "Canada", "Chile", "China", "Colombia",
    "Croatia", "Cyprus", "Denmark", "Ecuador", "Egypt", "Estonia", "Ethiopia", "Finland", "France", "Georgia",
    "Germany", "Ghana", "Greece", "Guatemala", "Honduras", "Hungary", "India", "Indonesia", "Ireland", "Israel",
    "Italy", "Japan", "Kenya", "Latvia", "Lebanon", "Lithuania", "Luxembourg", "Malaysia", "Mexico", "Morocco",
    "Myanmar", "Nepal", "Netherlands", "Nigeria", "Norway", "Pakistan", "Panama", "Paraguay", "Peru", "Philippines",
    "Poland", "Portugal", "Romania", "Serbia", "Singapore", "Slovakia", "Slovenia", "Solomon Islands", "Spain",
    "Sweden", "Switzerland", "Thailand", "Tunisia", "Türkiye", "Turkey", "Ukraine", "Uruguay", "Uzbekistan",
    "Zimbabwe",
]

# Bluesign brand lines: countries and regions.
BLUESIGN_COUNTRIES = [
    "United Arab Emirates", "United Kingdom", "United States", "Hong Kong", "New Zealand", "South Korea",
    "Czech Republic", "South Africa", "Saudi Arabia", "Sri Lanka", "Switzerland", "Netherlands", "Philippines",
    "Indonesia", "Singapore", "Australia", "Bangladesh", "Cambodia", "Thailand", "Vietnam", "Germany", "Austria",
    "Belgium", "Bulgaria", "Canada", "China", "Croatia", "Denmark", "Finland", "France", "Greece", "Hungary",
    "Iceland", "India", "Ireland", "Italy", "Japan", "Latvia", "Lithuania", "Malaysia", "Mexico", "Norway", "Poland",
    "Portugal", "Romania", "Serbia", "Slovakia", "Slovenia", "Spain", "Sweden", "Taiwan", "Turkey", "Ukraine", "USA",
]

# Key column and key columns of each registry, in order.
REGISTRY_KEYS = {
    "grs": ("record_key", ["company_name", "country", "certificate_number", "product_category_raw", "product_process_description", "source_page"]),
    "fsc": ("record_key", ["licence", "certificate_code", "organization_name", "role", "site_status", "state_province", "country_area"]),
    "green_circle": ("record_key", ["certificate_id", "company_name", "product_name", "product_type", "certification_claim", "effective_date", "expiration_date", "location"]),
    "epd": ("record_key", ["epd_number", "product_name", "organization_name", "product_url"]),
    "gots": ("supplier_key", ["company_name", "country", "product_category", "brand_name", "detail_url"]),
    "b_corp": ("company_key", ["company_name", "profile_url", "certified_since"]),
    "peta": ("company_key", ["company_name", "website_url", "compliance_code"]),
    "fair_for_life": ("partner_key", ["normalised partner_name", "normalised location_text", "partner_url"]),
    "ewg": ("product_key", ["normalised product_name", "more_info_url"]),
    "oeko_tex": ("brand_key", ["brand_name", "website_url", "standards_raw", "country_id", "source_file"]),
}
# Registries whose rows without a key are told apart by all their columns.
WHOLE_ROW_KEYS = ["gots"]

# Header and footer lines of the brand list, and its date line.
BRAND_LIST_DATE = "(?i)^April\\s+\\d{1,2},\\s+\\d{4}$"
BRAND_LIST_NOISE = [
    BRAND_LIST_DATE, "(?i)^Company Name Country / Region$", "(?i)^LIST OF SYSTEM PARTNERS \\(BRANDS ONLY\\)$", "(?i)^Page\\s+\\d+\\s+of\\s+\\d+$",
]
