import pytest

from siftwell.llm import boilerplate

PAGES = "page_id long, url string, html string"


def test_small_hosts_keep_their_templates_among_many_pages(spark):
    many = spark.range(30_200).selectExpr("id AS page_id", "concat('http://h', id, '.example/') AS url", "'<p>x</p>' AS html")
    few = [(100_000 + i, f"http://small{i // 3}.example/", f"<footer>imprint number {'abcdefghijklmnopqrst'[i // 3]} of our house</footer>") for i in range(60)]
    fitted = boilerplate.fit_templates(many.unionByName(spark.createDataFrame(few, PAGES)))
    found = {r.key for r in fitted.sites.where("value > 0").collect()}
    assert {boilerplate.digest(f"Fimprint number {x} of our house") for x in "abcdefghijklmnopqrst"} <= found


def host_pages(spark):
    notice = "Every order is packed by hand in our barn"
    rows = [(i, "http://one.example/", f"<footer>{notice}</footer><p>{'abc'[i]} story</p>") for i in range(3)]
    rows += [(10 + i, "http://two.example/", "<p>Another story</p>") for i in range(3)]
    menu = "Subscribe to the weekly letter"
    rows += [(20 + i, f"http://many{i}.example/", f"<footer>{menu}</footer>") for i in range(30)]
    rows += [(60 + i, "http://big.example/", f"<p>{menu}</p>") for i in range(40)]
    return notice, menu, spark.createDataFrame(rows, PAGES)


def test_templates_hold_on_their_own_host(spark):
    notice, menu, pages = host_pages(spark)
    sites = ["one.example", "two.example", "big.example", "new.example"]
    rows = [(i, f"{notice}\n{menu}", f"http://{s}/x") for i, s in enumerate(sites)] + [(9, f"{notice}\n{menu}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, url string")
    found = {(r.doc_id, r.line_no) for r in boilerplate.boilerplate_lines(docs, pages).collect()}
    assert found == {(0, 1), (0, 2), (1, 2), (3, 2), (9, 2)}


def test_shared_templates_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(boilerplate, "SHARED", 0)
    assert boilerplate.fit_templates(host_pages(spark)[2]).common == {}
    test_templates_hold_on_their_own_host(spark)
    test_long_lines_are_looked_up_whole(spark)


def test_shared_elements_beyond_the_broadcast(spark, monkeypatch):
    rows = [(i, f"http://h{i}.example/", "<nav><ul><li>Visit us in the old mill by the river</li><li>Closed in the second week</li></ul></nav>") for i in range(3)]
    rows += [(10 + i, f"http://k{i}.example/", "<p>Closed in the second week</p><p>Visit us in the old mill by the river</p>") for i in range(3)]
    docs = spark.createDataFrame([(1, "Visit us in the old mill by the river\nClosed in the second week\nText here", "http://new.example/x"), (2, "Closed in the second week", None)], "doc_id long, text string, url string")
    for bound in (10, 0):
        monkeypatch.setattr(boilerplate, "SHARED", bound)
        found = {(r.doc_id, r.line_no) for r in boilerplate.template_lines(docs, spark.createDataFrame(rows, PAGES)).collect()}
        assert found == {(1, 1), (1, 2)}, bound


def test_elements_of_several_blocks_cover_runs_of_lines(spark):
    rows = [(i, "http://a.example/", f"<nav><ul><li>Visit us in the old mill by the river</li><li>Closed on the second day of {x}</li></ul></nav><p>The mill {x}.</p>") for i, x in enumerate(("spring", "spring", "spring", "autumn"))]
    many = [(10 + i, "http://a.example/", f"<p>Closed on the second day of {x}</p>") for i, x in enumerate(("winter", "summer", "may"))]
    docs = spark.createDataFrame([(1, "Visit us in the old mill by the river\nClosed on the second day of spring\nText here", "http://a.example/x"), (2, "Closed on the second day of spring", "http://a.example/y")], "doc_id long, text string, url string")
    found = {(r.doc_id, r.line_no) for r in boilerplate.template_lines(docs, spark.createDataFrame(rows + many, PAGES)).collect()}
    assert {(1, 1), (1, 2)} <= found


def test_a_large_site_is_spread_with_its_templates(spark, monkeypatch):
    monkeypatch.setattr(boilerplate, "SITE_PART", 2)
    notice, _, pages = host_pages(spark)
    docs = spark.createDataFrame([(i, notice, "http://one.example/x") for i in range(9)], "doc_id long, text string, url string")
    assert {r.doc_id for r in boilerplate.boilerplate_lines(docs, pages).collect()} == set(range(9))


LEGAL = "The editors of this paper ask readers to note that all prices are without any obligation and that orders are only taken once a written reply has been sent to the customer by post or courier"
MENU = "Harbour Council Theatre Markets Gardens Football Schools Letters Opinion Weather Transport Recipes Business Science Cinema Museums Travel Motoring Property Obituaries Crosswords"


def test_long_lines_are_looked_up_whole(spark):
    assert len(LEGAL) > boilerplate.LONG and len(MENU) > boilerplate.LONG
    rows = [(i, "http://a.example/", f"<ul>{''.join(f'<li class=m>{x}</li>' for x in MENU.split())}</ul><p>The editors of this paper met {x}.</p><footer>{LEGAL}</footer>") for i, x in enumerate(("early", "late", "twice"))]
    docs = spark.createDataFrame([(1, f"{MENU}\nThe editors of this paper met again.\n{LEGAL}", "http://a.example/x")], "doc_id long, text string, url string")
    found = {r.line_no for r in boilerplate.boilerplate_lines(docs, spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {1, 3}


def test_main_content_is_what_boilerplate_lines_leave(spark):
    name = "Reporter Jane: more of this town"
    rows = [(i, f"{name}\nStory {'abcdef'[i]} of the harbour was long.\n\n", f"http://a.example/{i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, url string")
    pages = spark.createDataFrame([], PAGES)
    assert {(r.doc_id, r.line_no) for r in boilerplate.boilerplate_lines(docs, pages).collect()} == {(i, 1) for i in range(6)}
    assert {r.text for r in boilerplate.main_content(docs, pages).collect()} == {f"Story {x} of the harbour was long." for x in "abcdef"}
