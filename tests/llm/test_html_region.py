"""Main text: the best run against all runs, pages with several articles, names inside articles, long pages, the sample."""

import itertools
import random
import time

from modelmon.llm import html_region as region


def test_best_run_is_the_best_of_all_runs():
    rng = random.Random(5)
    for _ in range(400):
        scores = [rng.choice([-2, -1, -0.5, 0, 0, 0.5, 1, 3]) for _ in range(rng.randrange(12))]
        runs = [(sum(scores[a:b]), -b, a) for a, b in itertools.combinations(range(len(scores) + 1), 2)]
        runs = [r for r in runs if r[0] > 0]
        if not runs:
            assert region.best_run(scores) == (0, 0)
            continue
        total, end, _ = max(runs)
        first, last = region.best_run(scores)
        # Of equal sums the first to end; zero-sum heads are left out.
        assert last == -end and sum(scores[first:last]) == total
        assert first == max(a for t, b, a in runs if t == total and b == end)


def test_every_article_and_no_gap():
    known = {}
    for gap in ("<p>gap words</p>", "<div>gap words here</div>" * 40):
        page = f"<article>{'one two ' * 40}</article>{gap}<article>three four</article>"
        assert region.main_text(page, known) == ("one two " * 40) + "three four"
    assert region.main_text("<article>w" + "<br>" * 500 + "tail</article>", known) == "w tail"
    assert region.main_text("<article><p>w</p>" + "<br>" * 500 + "<p>tail</p></article>", known) == "w tail"
    assert region.main_text("<main><p>a</p><section><p>b</p></section></main>", known) == "a b"
    assert region.main_text("<MAIN><p>only main</p></MAIN>", known) == "only main"


def test_names_inside_an_article():
    page = (
        '<article><p>Start</p><section class="share-price"><p>Price rose</p></section><p class="alert">Alert text</p>'
        '<section id="search"><h2>Search</h2></section><div class="ad">BUY</div><div class="comments"><p>hi</p></div>'
        '<div class="cookie-notice">We bake</div><ul class="share-buttons"><li>Tweet</li></ul><p hidden>no</p><p>End</p></article>'
    )
    assert region.main_text(page, {}) == "Start Price rose Alert text Search End"


def test_unclosed_marked_paragraphs_take_linear_time():
    page = "<article>" + '<p class="ad">x' * 20_000 + "</article>"
    start = time.perf_counter()
    region.main_text(page, {})
    assert time.perf_counter() - start < 5


def test_very_long_page():
    page = "<nav>menu</nav><article>" + "<p>some words stand here</p>" * 50_000 + "</article><footer>end</footer>"
    assert region.main_text(page, {}) == " ".join(["some words stand here"] * 50_000)


def test_sample_is_full_and_independent_of_order(spark, monkeypatch):
    monkeypatch.setattr(region, "LABELLED_PAGES", 20)
    rows = [(i, "u", f"<article>{'a ' * i}</article><p>foot</p>" if i % 10 == 0 else "<p>plain</p>") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    drawn = [region.learned(pages.repartition(n, "page_id").sortWithinPartitions("page_id", ascending=up)) for n, up in ((1, True), (5, False))]
    assert drawn[0] == drawn[1] and ("word", "article") in drawn[0]
    assert region.learned(pages.limit(0)) == {} == region.learned(pages.where("page_id % 10 != 0"))
