"""Template deduction on hosts whose pages name nothing, region names, deep and odd pages."""

import time

import pytest
from helpers import prose
from pyspark.sql import functions as F

from parcelgrid.llm import html as H

SCHEMA = "page_id long, url string, html string"


def extract(spark, rows):
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def neutral(i):
    """A page of a template without article element or telling names, and its article."""
    parts = [f"Title {i} {prose(i, 6)}", *(prose(100 * i + k, 40) for k in range(i % 4 + 2))]
    inner = "</p><p>".join(parts[1:])
    return (f"<html><body><div class=ka><a href=/>Start</a> <a href=/x>All texts</a></div><div class=kb><p>This site keeps no logs.</p></div>"
            f"<div class=kc><h1>{parts[0]}</h1><div class=ke>You read a text of our archive.</div><div class=kd><p>{inner}</p></div></div>"
            f"<div class=kf>Made by the archive, all hands.</div></body></html>"), "\n".join(parts)


def test_neutral_names_and_no_article(spark):
    made = {i: neutral(i) for i in range(1, 13)}
    rows = [(i, f"http://n.example/{i}", page) for i, (page, _) in made.items()]
    rows += [(100 + k, f"http://n.example/c{k}", made[1][0]) for k in range(30)]  # copies of one page do not make its text a template
    got = extract(spark, rows)
    assert all(got[i] == text for i, (_, text) in made.items())
    assert all(got[100 + k] == made[1][1] for k in range(30))


def test_classes_nest_and_hold_the_template_text(spark):
    rows = [(i, f"http://n.example/{i}", neutral(i)[0]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "id long, url string, html string").withColumn("host", H.host(F.col("url")))
    classes = H.equivalence_classes(df)
    got = {r.token: r for r in classes.collect()}
    once = got["html/body"]
    assert once.class_size == 10 and once.once and got["html/body/div[class=kc"].vector == once.vector
    assert [r.slot for r in H.main_slots(classes).collect()] == ["html/body/div[class=kc"]
    fixed = {H.text_token(t, H.Region(H.Region(H.Region(None, "html", ""), "body", ""), "div", " class=kf")) for t in ["Made by the archive, all hands."]}
    assert fixed <= {r.token for r in got.values() if not r.tag and r.vector == once.vector}
    assert len(H.template_texts(classes).first().texts) == 4


def test_few_pages_have_no_template_text(spark):
    page, text = neutral(1)
    got = extract(spark, [(i, "http://few.example/", page.replace("Title 1", f"Title {i}")) for i in range(3)])
    assert all("You read a text of our archive." in t and t.startswith(f"Title {i}") for i, t in got.items())


def test_text_of_articles_stays_however_often_it_repeats(spark):
    body = "<html><body><p>top</p><article><h1>T{}</h1><p>All rights reserved.</p><p>{}</p></article></body></html>"
    got = extract(spark, [(i, "http://a.example/", body.format(i, prose(i, 9))) for i in range(9)])
    assert all(t == f"T{i}\nAll rights reserved.\n{prose(i, 9)}" for i, t in got.items())


@pytest.mark.parametrize("name,out", [("notice-period", False), ("related-work", False), ("search-results-study", False), ("share_price", False),
                                      ("ad", True), ("ad-slot", True), ("ad_slot2", True), ("cookie-notice", True), ("related-posts", True), ("comments", True),
                                      ("comment-list", True), ("sidebar-left", True), ("nav-primary", True), ("list", False), ("", False)])
def test_the_last_word_of_a_name_decides(name, out):
    assert H.outside(name) is out


def test_names_that_only_hold_a_listed_word():
    page = "<article><p>One.</p><div class='notice-period'><p>Two.</p></div><p class='related-work'>Three</p><div class='post ad-box'>buy</div></article>"
    assert H.main_text(page, None) == "One.\nTwo.\nThree"
    assert H.main_text("<div class=search-results-study><p>Long article text here</p></div>", None) == "Long article text here"


@pytest.mark.parametrize("make", [lambda n: "<div>" * n + "deep", lambda n: "<b>" * n + "deep" + "<hr>" * n, lambda n: "<b><div>" + "<i>" * n + "</b>" * n + "deep",
                                  lambda n: "<div>" * n + "</x>" * n + "deep", lambda n: "<p>" * n + "deep", lambda n: "<ul><li>" * n + "deep",
                                  lambda n: "".join(f"<div class=a{'b' * (k % 50)}>" for k in range(n)) + "deep"])
def test_deep_pages_take_linear_time(make):
    def seconds(n):
        H.region.cache_clear()
        start = time.process_time()
        assert H.main_text(make(n), None) == "deep" and len(H.page_tokens(make(n))) >= 1
        return time.process_time() - start
    seconds(1000)
    assert seconds(100_000) < 40 * max(seconds(10_000), 0.05)


def test_long_paths_and_labels_are_bounded():
    longest = max(len(t) for t, *_ in H.page_tokens("<div class=x id='" + "long " * 500 + "'>" * 1 + "<section class=abcdef>" * 400 + "text"))
    assert longest <= H.PATH_CHARS


def test_odd_pages(spark):
    rows = [(1, None, None), (2, None, ""), (None, "http://x/", "<"), (4, "http://x/", "a" * 300_000), (4, "http://x/", "a" * 300_000), (5, "x", "</div></p>")]
    got = H.extract(spark.createDataFrame(rows, SCHEMA))
    assert sorted(len(r.text) for r in got.collect()) == [0, 0, 0, 1, 300_000, 300_000]
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0
