"""Golden pages."""

from postmill.operators import html as H

PAGE = """<html><body>
<form action="/a/search"><input name="q"><select name="loc"></select><input></form>
<div class="job-item big" data-job-id="7" data-x="y"><h2>  Senior <b>Cook</b> </h2><p class="location">Rome</p><a href="/jobs/7">go</a></div>
<div class="job-item big" data-job-id="7" data-x="y"><h2>  Senior <b>Cook</b> </h2><p class="location">Rome</p><a href="/jobs/7">go</a></div>
<div data-automation-id="my-job-card"><span class="job-title"><a href="https://x/y">Guide</a></span><i class="department">Ops<br></div>
<li class="opening-item"><h3></h3></li>
<p>1,234 Jobs found</p><script>var a = "<div class='job-item'><h2>no</h2></div>";</script>
<ul class="pagination"><li class="active">3</li><a href="?page=1">1</a><a href="?start=20">2</a></ul>
</body></html>"""


def test_cards():
    out = H.read_page(PAGE, "https://site.org/list/", H.SELECTORS)
    assert [(j["title"], j["location"], j["department"], j["url"]) for j in out["jobs"]] == [
        ("SeniorCook", "Rome", None, "https://site.org/jobs/7"),
        ("Guide", None, "Ops", "https://x/y"),
    ]
    assert out["jobs"][0]["metadata"] == {"data-job-id": "7", "data-x": "y"}
    assert (out["total_jobs"], out["current_page"], out["page_links"]) == (1234, "3", 2)
    assert (out["search_url"], out["search_method"], out["search_fields"]) == ("/a/search", "GET", ["q", "loc"])
    usage = {u["selector"]: u["n_matches"] for u in out["usage"]}
    assert usage[".job-item"] == 2 and usage["[data-job-id]"] == 2 and '[data-automation-id*="job"]' in usage


def test_broken_pages():
    for text in ("", None, "<div", "<p></b></p><a href=>", "<![x<!--", "a < b & c"):
        out = H.read_page(text, "", H.SELECTORS)
        assert out["jobs"] == [] and out["current_page"] == "1"


def test_selectors():
    page = H.Page('<a class="x y" k="v1"><b><i k=v2>t</i></b></a><b k="v1">u</b>')

    def tags(selector):
        return [n.tag for n in page.select(selector)]

    assert tags(".x") == ["a"] and tags("a.x.y[k]") == ["a"] and tags("a.x.z") == []
    assert tags("[k='v1']") == ["a", "b"] and tags('[k*="v"]') == ["a", "i", "b"]
    assert tags("a i, b") == ["b", "i", "b"] and tags("b a") == []


def test_frame(spark):
    pages = spark.createDataFrame(
        [(1, PAGE, "https://site.org/list/", "greenhouse", "Acme"), (2, None, None, "other", "Acme")],
        "page_id long, html string, base_url string, provider string, company_name string",
    )
    parsed = H.parse_pages(pages)
    assert H.page_jobs(parsed).count() == 2
    totals = {r.page_id: r.total_pages for r in H.page_pagination(parsed).collect()}
    assert totals == {1: 62, 2: 1}
    urls = [r.url for r in H.page_urls(H.page_pagination(parsed, ("page_id", "base_url")), 3).orderBy("page_no").collect()]
    assert urls == ["https://site.org/list/?start=20", "https://site.org/list/?start=40"]
    cards = H.fallback_jobs(pages).collect()
    # an anchor inside the card comes after the heading, which is not among these selectors
    assert [(c.job_id, c.title, c.source_url) for c in cards] == []
