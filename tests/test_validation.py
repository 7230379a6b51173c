"""Golden cases 7 and 8: one outcome per row, first failing rule, circuit breaker."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import validate
from tidemark.sources import files
from tidemark.session import scratch_dir
from tidemark.plans.generate import RAW_FIELDS

OK = {"order_id": "ORD-1", "customer_id": "C1", "country": "GE", "items": "4", "amount": 10.5,
      "order_ts": "2026-08-31T10:00:00Z", "updated_at": "2026-08-31T10:00:00Z"}


def line(**kw):
    d = dict(OK)
    for k, v in kw.items():
        if v is None:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    ("{not json", "malformed_json"),
    (line(order_id=None), "missing_order_id"),
    (line(country=None), "missing_country"),
    (line(order_ts="yesterday"), "bad_or_missing_order_ts"),
    (line(updated_at=None), "bad_or_missing_updated_at"),
    (line(amount="ten"), "bad_or_missing_amount"),
    (line(amount=-1), "negative_amount"),
    (line(items="4x"), "bad_or_missing_items"),
    (line(items=0), "non_positive_items"),
    (line(items="4"), None),
    (line(items=4), None),
    (line(items=" 4 "), None),                        # surrounding blanks are trimmed
    (line(items="4.7"), "bad_or_missing_items"),      # a fraction is not an item count
    (line(amount=-5, items=0), "negative_amount"),   # two failures: the first rule wins
]


@pytest.fixture(scope="module")
def scored(spark):
    root = scratch_dir(spark, "validation") + "/bronze"
    part = root + "/ingest_date=2026-08-31"
    spark.createDataFrame([(c[0],) for c in CASES], "value string").coalesce(1).write.text(part)
    raw = files.read_raw_json(spark, [part], RAW_FIELDS)
    return validate.score(validate.type_order_fields(raw))


def test_every_row_one_reason(scored):
    rows = scored.select("order_id", "_corrupt_record", "reject_reason", "ingest_date").collect()
    assert len(rows) == len(CASES)
    assert sorted(str(r["reject_reason"]) for r in rows) == sorted(str(c[1]) for c in CASES)
    assert {str(r["ingest_date"]) for r in rows} == {"2026-08-31"}


def test_split_is_complementary(scored):
    valid, rejected = validate.split(scored)
    assert valid.count() + rejected.count() == scored.count()
    assert valid.count() == 3


def test_profile(scored):
    prof = {r["reject_reason"]: r["n"] for r in validate.outcome_profile(scored).collect()}
    assert prof[None] == 3 and prof["negative_amount"] == 2 and sum(prof.values()) == len(CASES)


@pytest.mark.parametrize("rejected,total,tripped", [(49, 1000, False), (50, 1000, False), (51, 1000, True),
                                                    (0, 0, True)])
def test_breaker(rejected, total, tripped):
    counts = {None: total - rejected}
    if rejected:
        counts["negative_amount"] = rejected
    d = validate.breaker(counts, 0.05)
    assert d.tripped is tripped


def test_breaker_frame(spark, scored):
    r = validate.breaker_frame(scored, 0.05).first()
    assert r["rows_in"] == len(CASES) and r["rejected"] == len(CASES) - 3 and r["tripped"]


def test_broken_producer_file(spark):
    """Negative fixture: a five-line broken producer file next to a normal partition:
    two malformed lines, one bad items value, two good lines."""
    root = scratch_dir(spark, "broken-producer") + "/bronze/ingest_date=2026-08-31"
    spark.createDataFrame([(line(),)] * 3, "value string").coalesce(1).write.text(root)
    broken = ['{"order_id":"ORD-9","amount":', 'not json at all', line(items="four"), line(order_id="ORD-7"),
              line(order_id="ORD-8")]
    spark.createDataFrame([(x,) for x in broken], "value string").coalesce(1).write.mode("append").text(root)
    scored = validate.score(validate.type_order_fields(files.read_raw_json(spark, [root], RAW_FIELDS)))
    prof = {r["reject_reason"]: r["n"] for r in validate.outcome_profile(scored).collect()}
    assert prof == {None: 5, "malformed_json": 2, "bad_or_missing_items": 1}
