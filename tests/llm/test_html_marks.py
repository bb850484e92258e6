"""Main text: article text under odd names stays, marked parts go, unmarked templates go by counting."""

import pytest

from ledgerline.llm import op3_html

KEPT = [
    '<h2 id="related-work">Keep me</h2>', '<h2 id="social-policy">Keep me</h2>', '<p class="share-price">Keep me</p>',
    '<section id="banner-years"><p>Keep me</p></section>', '<p title="x id=menu">Keep me</p>', "<p data-x='class=\"ad\"'>Keep me</p>",
    '<math><mi>Keep me</mi></math>', '<label>Keep me</label>', '<h3 id="comments">Keep me</h3>', '<li id="menu">Keep me</li>',
    '<div class="advice column"><p>Keep me</p></div>', '<blockquote id="share">Keep me</blockquote>', '<td class="notice-period">Keep me</td>',
    '<div title="a > b class=ad">Keep me</div>', '<p class=lead id=nav>Keep me</p>', '<div class="cookies-recipe"><p>Keep me</p></div>',
    '<table><tr><th>Keep</th><td>me</td></tr></table>', '<ul class="steps"><li>Keep me</li></ul>', "<p class='notes'>Keep me</p>",
]
GONE = [
    '<div class="ad">x</div>', '<div class="ad-slot top">x</div>', '<div id="adSlot1">x</div>', '<div class="comment-list"><p>x</p></div>',
    '<section id="comments"><p>x</p></section>', '<div class="cookie-consent-banner">x</div>', '<div role="navigation">x</div>',
    '<p class="advert">x</p>', '<p hidden>x</p>', '<p style="display: none">x</p>', '<div class="col social-share">x</div>',
    '<div class="newsletter-signup">x</div>', '<div class="related-posts"><p>x</p></div>', '<form><label>x</label></form>',
    '<div aria-hidden=true>x</div>', '<aside>x</aside>', '<script>x</script>', '<div class="main-menu">x</div>', '<DIV CLASS=Sidebar>x</DIV>',
]


@pytest.mark.parametrize("part", KEPT)
def test_article_text_under_odd_names(part):
    got = op3_html.Page(f"<html><body><article><h1>Head</h1>{part}<p>End</p></article></body></html>").text(set())
    assert got.replace("Keep\nme", "Keep me") == "Head\nKeep me\nEnd"


@pytest.mark.parametrize("part", GONE)
def test_marked_parts(part):
    for page in (f"<body><article><h1>Head</h1>{part}<p>End</p></article></body>", f"<body><h1>Head</h1>{part}<p>End</p></body>"):
        assert op3_html.Page(page).text(set()) == "Head\nEnd"


def test_unmarked_templates_go_by_counting(spark):
    """A box that no name gives away: it goes where it recurs with different articles, and stays on its own."""
    box = '<div class="q7"><ul><li>All topics</li><li>Our team</li></ul></div>'
    rows = [(i, f"https://h/{i}", f"<body><article><p>Text {i}</p>{box}<p>End {i}</p></article></body>") for i in range(6)]
    rows += [(9, "https://other/9", f"<body><article><p>Text 9</p>{box}</article></body>")]
    got = {r["page_id"]: r["text"] for r in op3_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Text {i}\nEnd {i}" for i in range(6)}, 9: "Text 9\nAll topics\nOur team"}
