"""Hand-made cases for hub, registry, files, lines, pages and streams."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import discovery, hub, lines, pages, registry
from ledgerloom.operators.ordered import carry_forward, keep_first, running_total
from ledgerloom.sources import registry_files
from ledgerloom.streaming import jobs


def test_slugs_like_one_by_one_assignment(spark):
    names = ["x", "x", "x 2", "x", "x 2", "x 3", "y", "x 2", "", "x-2-2", "é", "E"]
    rows = spark.createDataFrame([(i, "c" if n else " ", n) for i, n in enumerate(names)], "src_ordinal long, company string, product string")
    got = {r.src_ordinal: r.slug for r in hub.assign_slugs(rows.withColumn("product", F.nullif("product", F.lit("")))).collect()}
    taken, want = set(), {}
    import unicodedata
    import re
    for i, n in enumerate(names):
        raw = unicodedata.normalize("NFD", f"{'c' if n else ' '}-{n or 'configurator'}".lower())
        base = re.sub(r"[^a-z0-9]+", "-", re.sub("[̀-ͯ]", "", raw)).strip("-")[:80]
        slug, k = base, 2
        while slug in taken:
            slug, k = f"{base}-{k}", k + 1
        taken.add(slug)
        want[i] = slug
    assert got == want


def test_running_values_cross_ranges(spark):
    rows = spark.range(100).select("id", F.lit("g").alias("g"), F.when(F.col("id") % 30 == 7, F.col("id")).alias("mark"))
    totals = {r.id: r.total for r in running_total(rows, "g", "id", {"total": F.lit(1)}, chunk_rows=9).collect()}
    assert totals == {i: i + 1 for i in range(100)}
    carried = {r.id: r.last for r in carry_forward(rows, "g", "id", {"last": F.col("mark")}, chunk_rows=9).collect()}
    assert carried == {i: (None if i < 7 else (i - 7) // 30 * 30 + 7) for i in range(100)}


def test_keep_first_is_idempotent(spark):
    rows = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, "b", 3)], "o int, k string, v int")
    once = keep_first(rows, "k", "o")
    assert sorted(map(tuple, once.collect())) == [(1, "a", 2), (2, "b", 3)]
    assert sorted(map(tuple, keep_first(once, "k", "o").collect())) == [(1, "a", 2), (2, "b", 3)]


def test_schema_resolver_prefers_exact_then_contained():
    found = registry.resolve_columns(["Brand & Co", "my_company_name", "Company", "COMPANY "], {"a": ["company_name", "company"], "b": ["brand"], "c": ["zzz"]})
    assert found == {"a": "Company", "b": "Brand & Co", "c": None}


def test_manifest_and_reading(spark, tmp_path):
    files = {"fsc/fsc_companies.csv": "Organization,Country\nAcme,Italy\n", "fsc/metadata.csv": "x\n", "GRS/other.csv": "x\n1\n", "epd/epd.xlsx": "?", "extra-one/readme.txt": "?",
             "b_corp/b_corp.csv": "company_name;certified_since\nBeta;2020\n"}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    rows = {r.expected_certification or r.actual_folder: r for r in registry_files.manifest(spark, str(tmp_path)).collect()}
    assert (rows["FSC"].selection_reason, rows["FSC"].files_found, rows["FSC"].files_selected) == ("selected_primary_csv_files", 2, 1)
    assert rows["Global Recycled Standard"].selection_reason == "fallback_selected_any_usable_csv_files" and rows["Global Recycled Standard"].fallback_used
    assert rows["Environmental Product Declaration"].files_selected == 1
    assert rows["extra-one"].folder_status == "extra_discovered_folder"
    assert rows["Bluesign"].selection_reason == "missing_folder"
    read, errors = registry_files.read_selected(spark, list(rows["FSC"].selected_files) + [str(tmp_path / "gone.csv")])
    assert [(r.certified_company, r.country_or_scope, r.source_row_number) for r in read.collect()] == [("Acme", "Italy", 2)] and len(errors) == 1
    strict = registry_files.read_strict_csv(spark, str(tmp_path / "b_corp/b_corp.csv"), ["company_name"], {"certification": "B Corp"}).collect()
    assert [(r.company_name, r.certified_since, r.certification) for r in strict] == [("Beta", "2020", "B Corp")]
    with pytest.raises(ValueError):
        registry_files.read_strict_csv(spark, str(tmp_path / "b_corp/b_corp.csv"), ["licence"])


def test_records_from_lines(spark):
    texts = ["loose", "<< Filati - Yarns >>", "Acme srl Italy www.acme.it GRS 2021-001 12-jan-2021 3 feb 2022 04-mar-23 recycled 3 GRS 4.0", "& Figli spa", "wool, post - consumer 9 GRS 1.0", "Page 2", "<< Tessuti >>", "after",
             "Beta GRS 2020 - 123 5 gen 2020 yarns"]
    rows = spark.createDataFrame([("f", i + 1, t) for i, t in enumerate(texts)], "source_file string, line_number long, raw_line string")
    records, rejected = lines.assemble_records(rows, chunk_rows=2)
    assert records.agg(F.sum(F.size(F.split("evidence_text", " \\| ")))).head()[0] + rejected.count() == len(texts)
    first, second = lines.parse_certificate_lines(records).orderBy("record_line").collect()
    assert (first.company_name, first.country, first.web, first.certificate_number) == ("Acme srl & Figli spa", "Italy", "www.acme.it", "GRS 2021-001")
    assert (first.first_issue_date, first.revision_date, first.expiring_date) == ("12-jan-2021", "3feb2022", "04-mar-23")
    assert (first.product_process_description, first.facilities_no, first.grs_version, first.parse_confidence) == ("recycled wool, post-consumer 9 GRS 1.0", "3", "GRS 4.0", 1.0)
    assert (second.company_name, second.country, second.first_issue_date, second.product_process_description, second.parse_confidence) == ("Beta", "", "5gen2020", "yarns", 0.7)


TOOL = """<title>Build</title><h2>Choose size</h2><form><label>Select colour</label><input type='radio'><input type="radio"><input type=checkbox>
<input type="checkbox"><input type="range"><button>Next</button><button>Apply</button></form>"""


def test_page_verdicts(spark):
    cases = {
        "tool": ("https://a.com/configurator", TOOL, "SI"), "parked": ("https://b.com/", "<p>hugedomains: this domain</p>", "NO"),
        "error": ("https://c.com/", "<p>404 Not Found</p>", "NO"), "job": ("https://it.upwork.com/x", "<p>hello</p>", "NO"),
        "blocked": ("https://d.com/", "<p>Your account was suspended</p>", "NO"), "plain": ("https://e.com/x", "<p>Hello there</p>", ""),
    }
    frame = spark.createDataFrame([(k, u, h) for k, (u, h, _) in cases.items()], "k string, url string, html string")
    got = {r.k: r.active for r in pages.page_verdict(pages.dom_signals(frame, page="k")).collect()}
    assert got == {k: v for k, (_, _, v) in cases.items()}


def test_brand_directory_markup(spark):
    html = "<div class='brand x' data-name='Acme &amp; Co' data-website='acme.it' data-standards='mig,std100' data-country='1'></div><div class=\"other\" data-name='no'></div>"
    row = pages.brand_rows(spark.createDataFrame([(1, html)], "p int, html string"), "p").collect()
    assert [(r.website_url, r.has_made_in_green, r.has_standard_100, r.letter_group) for r in row] == [("acme.it", True, True, "A")]


def test_incremental_append_survives_a_restart(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "src_ordinal long, record_key string"
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("src_ordinal"), (F.col("id") % 40).cast("string").alias("record_key"))
    rows(0, 30).write.parquet(source)
    jobs.append_new_records(spark, source, target, state, schema, buckets=4)
    rows(20, 100).write.mode("append").parquet(source)
    jobs.append_new_records(spark, source, target, state, schema, buckets=4)
    got = spark.read.parquet(target)
    assert got.count() == 40 and got.select("record_key").distinct().count() == 40


def test_monitor_stream_equals_table(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", F.floor("value").cast("bigint").alias("new_rows"), F.col("value").alias("seconds"))
    path = str(tmp_path / "rounds")
    table.write.parquet(path)
    stream = jobs.monitor(spark.readStream.schema(table.schema).parquet(path))
    query = stream.writeStream.format("memory").queryName("rounds_out").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("rounds_out").collect())) == sorted(map(tuple, jobs.monitor(table).collect()))


def test_top_queries_limit_before_the_shuffle(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["w4_top_per_industry"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "BatchEvalPython" not in plan and "CartesianProduct" not in plan


def test_master_build_numbers_rows_by_file(spark, tmp_path):
    files = {"fsc/fsc_companies_1.csv": "Organization,Country\nAcme,Italy\nBeta,Spain\n", "fsc/fsc_companies_2.csv": "Organization,Country\nBeta,Spain\nGamma,France\n",
             "b_corp/b_corp_companies.csv": "Company Name,Certification\nDelta,B Corporation\n"}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    master, inventory, listed = registry_files.build_master(spark, str(tmp_path))
    rows = {(r.certified_company, r.source_file.rsplit("/", 1)[-1], r.source_row_number) for r in master.collect()}
    assert rows == {("Acme", "fsc_companies_1.csv", 2), ("Beta", "fsc_companies_1.csv", 3), ("Gamma", "fsc_companies_2.csv", 3), ("Delta", "b_corp_companies.csv", 2)}
    assert {r.certification for r in master.filter("certified_company <> 'Delta'").select("certification").collect()} == {"FSC"}
    assert {(r.source_file.rsplit("/", 1)[-1], r.rows, r.error) for r in inventory.collect()} == {("fsc_companies_1.csv", 2, ""), ("fsc_companies_2.csv", 2, ""), ("b_corp_companies.csv", 1, "")}
    assert listed.filter("files_selected > 0").count() == 2


def test_catalogue_queries_shuffle_rows_and_not_their_searches(spark):
    items = spark.createDataFrame([(1, "Acme", "ACME", ""), (1, "Acme", "ACME", ""), (2, "", " ", ""), (3, "Bo", "", "Italy")], "id int, company string, product string, country string")
    found = discovery.catalogue_queries(items)
    got = {}
    for r in found.orderBy("id", "query_number").collect():
        got.setdefault(r.id, []).append((r.query_number, r.query))
    words = discovery.CATALOGUE_SEARCH_WORDS
    # Without a country both forms are equal; equal rows count once; blank names leave the search words.
    assert got[1] == list(enumerate([*[f"ACME Acme {w}" for w in words], "Acme ACME"], 1))
    assert got[2] == list(enumerate(words, 1))
    assert got[3] == list(enumerate([*[f"Bo Italy {w}" for w in words], *[f"Bo {w}" for w in words], "Bo Italy"], 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
