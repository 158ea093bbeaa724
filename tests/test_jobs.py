"""The user-level jobs end to end."""

import json

from pyspark.sql import functions as F

from postmill.operators.reconcile import reconcile, same_rows
from postmill.plans import jobs as J
from postmill.plans.catalog import QUERIES, Inputs
from postmill.session import work_dir
from postmill.sources.payloads import read_json_folder, scan_payloads

SF = "/root/testdata/sf0.001"


def test_ingest_and_validate(spark):
    i = Inputs(spark, SF)
    got = J.ingest_payloads(i.view("payloads"))
    assert got.postings.count() == QUERIES["ingest_feeds"].run(i).count()
    assert got.ats_jobs.count() == QUERIES["flat_smartrecruiters"].run(i).count()
    comeet = got.items.filter("provider = 'comeet'")
    out = J.validate_comeet(comeet, i.view("comeet_details"), i.view("url_statuses"), ["payload_id", "item_pos"])
    n_valid = len(out.valid.collect())
    counts = out.counts.get
    assert counts["fetched"] == counts["valid"] + counts["rejected"] and counts["valid"] == n_valid
    assert out.rejected.count() == counts["rejected"]
    offers = J.ingest_offers(got.items.filter("provider = 'recruitee'"), i.view("offer_details"))
    assert offers.count() == QUERIES["prefer_detail"].run(i).count()


def test_classify_and_reports(spark):
    i = Inputs(spark, SF)
    rows = J.classify_postings(i.view("postings"), "description", "job_type")
    assert rows.count() == i.view("postings").count()
    table = QUERIES["ats_jobs_row"].run(i)
    labels = ["seq", "city", "work_location_type", "experience_level", "education_required", "management_level"]
    assert same_rows(rows.select(labels), table.select(labels)).first().equal
    out = J.reports(reconcile(i.discovered, i.fetched))
    assert out["totals"].first().n_jobs == sum(r.n for r in out["origins"].collect())
    assert out["companies"].first().n_jobs == max(r.n_jobs for r in out["companies"].collect())


def test_discover_stops_at_blocks(spark):
    body = json.dumps({"elements": [{"id": n, "title": "T", "company": "C"} for n in range(5)]})
    url = "https://www.linkedin.com/voyager/api/jobs/search"
    log = spark.createDataFrame(
        [(1, 1, url, 200, "application/json", body), (1, 2, url, 429, "application/json", body), (2, 1, url, 200, "text/html", body)],
        "crawl_id long, seq long, url string, status int, content_type string, body string",
    )
    assert J.discover(log).count() == 5
    assert J.discover(log, 3).count() == 3


def test_pages_only_for_companies_without_rows(spark):
    i = Inputs(spark, SF)
    pages = i.view("careers_pages").withColumn("company_slug", F.lit("acme"))
    rest = J.pages_for_missing(pages, i.fetched)
    assert 0 < rest.count() < pages.count()
    rows = J.jobs_from_pages(rest)
    assert rows.filter("job_title = ''").count() == 0 and rows.count() > rest.count()


def test_compare_and_publish(spark):
    i = Inputs(spark, SF)
    rows = i.view("postings").withColumn("description_hash", F.md5("description"))
    out = J.compare_sources(rows.filter("source = 'linkedin'"), rows.filter("source = 'ats'"))
    report = out["report"].first()
    assert report.total_analyzed == out["matches"].count()
    assert report.confirmed_duplicates == sum(r.duplicates_found for r in out["companies"].collect())
    folder = work_dir(spark, "published")
    jobs = reconcile(i.discovered, i.fetched).withColumns(
        {"source_url": F.lit("u"), "extracted_at": F.current_timestamp(), "extraction_method": F.lit("api"), "easy_apply": F.lit(False)}
    )
    J.publish(jobs, folder)
    assert spark.read.parquet(f"{folder}/table").count() == jobs.count()
    lines = [r.value for r in spark.read.text(f"{folder}/summary").collect()]
    assert f"Total Jobs Extracted: {jobs.count()}" in lines and "ATS Companies:" in lines


def test_landed_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"jobs": [{"id": "1", "title": "A"}]}, indent=2))
    (tmp_path / "b.json").write_text("{broken")
    df = read_json_folder(spark, str(tmp_path), provider="ashby", company_slug="acme")
    assert df.count() == 2 and scan_payloads(df).count() == 1
