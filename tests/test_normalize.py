"""Payload cases by hand."""

import json

from pyspark.sql import functions as F

from postmill.functions import variants as V
from postmill.operators import normalize as N
from postmill.operators import quality as Q
from postmill.schemas import ATS_JOBS, POSTING
from postmill.sources.captures import job_entities
from postmill.sources.payloads import scan_payloads


def payloads(spark, *rows):
    data = [(p, "acme", "Acme", "https://acme.wd5.myworkdayjobs.com/en-US/External", b if isinstance(b, str) else json.dumps(b)) for p, b in rows]
    return spark.createDataFrame(data, "provider string, company_slug string, company_name string, base_url string, body string")


def test_feed_with_two_jobs(spark):
    body = {
        "jobs": [
            {"id": 1, "title": "A", "location": {"name": "Berlin"}, "absolute_url": "https://x/1", "updated_at": "2024-01-15T10:00:00Z"},
            {"id": None, "title": "no id"},
            {"id": 3, "title": ""},
            7,
        ]
    }
    rows = N.normalize_postings(scan_payloads(payloads(spark, ("greenhouse", body)))).collect()
    assert [(r.job_id, r.title, r.location, r.source_url, r.ats_provider) for r in rows] == [("1", "A", "Berlin", "https://x/1", "greenhouse")]
    assert N.normalize_postings(scan_payloads(payloads(spark, ("greenhouse", body)))).columns == POSTING.names


def test_workday_needs_base_url_and_makes_ids(spark):
    body = {"jobPostings": [{"title": "Dev", "bulletFields": ["R1"], "externalPath": "/job/1"}, {"title": "Ops", "bulletFields": []}]}
    df = payloads(spark, ("workday", body))
    rows = N.normalize_postings(scan_payloads(df)).collect()
    assert rows[0].job_id == "R1" and rows[0].source_url == "https://acme.wd5.myworkdayjobs.com/job/1"
    assert len(rows[1].job_id) == 12 and rows[1].source_url == "https://acme.wd5.myworkdayjobs.com/en-US/External"
    assert N.normalize_postings(scan_payloads(df.withColumn("base_url", F.lit("")))).count() == 0


def test_lever_object_is_empty_and_broken_text_is_skipped(spark):
    df = payloads(spark, ("lever", {"id": "x", "text": "y"}), ("lever", "{broken"), ("lever", []))
    assert N.normalize_postings(scan_payloads(df)).count() == 0


def test_comeet_list_forms(spark):
    item = {"uid": "u", "name": "Cook", "details": [{"name": "Description", "value": "a"}, {"name": "Description", "value": "b"}, {"name": "Requirements", "value": "c"}]}
    df = payloads(spark, ("comeet", [item]), ("comeet", {"data": [item]}), ("comeet", {"other": 1}))
    rows = N.normalize_comeet(scan_payloads(df)).collect()
    assert [r.job_description_raw for r in rows] == ["b\n\nc", "b\n\nc"]


def test_discovery_keeps_duplicates_and_order(spark):
    body = {
        "included": [{"entityUrn": "urn:li:FSD_JOBPOSTING:1"}, {"note": "fsd_jobPosting inside"}, {"entityUrn": "urn:li:company:2"}, 5],
        "elements": [{"id": 2}, "x"],
        "data": {"jobs": [{"id": 3}, 1], "topJob": {"id": 4}, "else": [{"id": 9}]},
    }
    df = spark.createDataFrame([(json.dumps(body),), ("[]",), ("nope",)], "body string")
    sizes = [r[0] for r in df.select(F.size(job_entities(V.parse("body")))).collect()]
    assert sizes == [5, 0, 0]


def test_flat_rows_cover_the_whole_table(spark):
    flat = spark.createDataFrame([("1", "T", "acme")], "id string, title string, company_slug string")
    out = N.to_ats_jobs(flat)
    assert out.columns == ATS_JOBS.names
    row = out.first()
    assert row.work_location_type == "not_specified" and row.education_required is None and row.required_skills == []


def test_reject_order(spark):
    def reason(ok=True, **item):
        df = spark.createDataFrame([(json.dumps(item), ok)], "b string, ok boolean")
        return df.select(Q.reject_reason(V.parse("b"), F.col("ok"))).first()[0]

    assert reason(name="General application") == Q.MISSING_UID
    assert reason(uid="u", name="General application") == Q.MISSING_URL
    assert reason(False, uid="u", position_url="x", details=[{"name": "X"}]) == Q.BAD_URL
    assert reason(uid="u", position_url="x", details=[{"name": "X"}], name="General application") == Q.NO_DESCRIPTION
    assert reason(uid="u", position_url="x", details=[], name="A General application") == Q.GENERAL_TITLE
    assert reason(uid="u", position_url="x", details=[]) is None


def test_empty_quality(spark):
    empty = spark.createDataFrame([], "t string, l string, u string")
    row = Q.extraction_quality(empty, "t", "l", "u").first()
    assert row.score == 0 and row.issues == ["No jobs extracted"]
    rows = spark.createDataFrame([("a", "b", ""), ("a", "", "")], "t string, l string, u string")
    row = Q.extraction_quality(rows, "t", "l", "u").first()
    assert row.score == 65.0 and row.issues == ["Low location coverage: 50.0%", "Low URL coverage: 0.0%"]


def test_posting_validation_splits(spark):
    rows = spark.createDataFrame(
        [("1", "T", "C", "ats", "u", "2024-01-01"), ("2", None, "C", "ats", "u", None), ("3", "T", "C", "moon", "u", None), ("4", "T", "C", "ats", "u", "x")],
        "job_id string, title string, company_name string, source string, source_url string, posted_date string",
    )
    valid, bad = Q.validate_postings(rows)
    assert [r.job_id for r in valid.collect()] == ["1"]
    assert {r.job_id: r.problem for r in bad.collect()} == {"2": "title: missing", "3": "source: not allowed", "4": "posted_date: wrong type"}
