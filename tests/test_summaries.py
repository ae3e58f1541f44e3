"""Groups of registry rows: huge and small ones, keys that follow from others, what is shuffled."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.summaries import Summary, source_columns, summarise
from ledgerloom.sources.sinks import written

SPEC = Summary(keys={"name": "company", "name_key": "company_norm", "day": "date"}, rows="n", unique={"licences": "licence"},
               lists={"all_licences": ("licence", None), "some_types": ("type", 2), "days": ("date", None)},
               least={"low": "page"}, greatest={"high": "page"}, flags={"active": "on"}, first={"url": "url"}, evidence="{name}: {n}")
LATE = lambda: {"company_norm": ("company", F.lower("company"))}


@pytest.fixture(scope="module")
def rows(spark):
    each = [(i, None if i % 19 == 0 else f"Co {i % 19 if i % 3 else 1}", f"d{i % 2}", ["L1", "L2", "", None][i * 7 % 4], f"t{i % 5}", i % 11, i % 2 == 0, f"u{i}") for i in range(600)]
    return written(spark.createDataFrame(each, "o long, company string, date string, licence string, type string, page int, on boolean, url string"))


def by_hand(rows):
    groups = {}
    for r in rows.collect():
        groups.setdefault((r.company, r.date), []).append(r)
    for (company, date), own in groups.items():
        filled = sorted({r.licence for r in own if r.licence})
        yield (company, company and company.lower(), date, len(own), min(r.page for r in own), max(r.page for r in own), sum(r.on for r in own), min(own, key=lambda r: r.o).url,
               len({r.licence for r in own} - {None}), " | ".join(filled), date, " | ".join(sorted({r.type for r in own})[:2]), company and f"{company}: {len(own)}")


@pytest.mark.parametrize("huge", [0, 40, 20_000])
def test_huge_and_small_groups_agree(rows, huge):
    got = summarise(rows, SPEC, ["o"], LATE(), huge=huge)
    columns = ["name", "name_key", "day", "n", "low", "high", "active", "url", "licences", "all_licences", "days", "some_types", "evidence_text"]
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, by_hand(rows)))
    assert "company_norm" not in source_columns(SPEC, ["o"], LATE())


def test_small_groups_are_shuffled_once(rows):
    plan = summarise(rows, SPEC, ["o"], LATE())._jdf.queryExecution().optimizedPlan().toString()
    small = plan[plan.index("Union"):].split("LeftAnti")[0]
    assert small.count("Aggregate") == 1 and small.count("RepartitionByExpression") == 1
