import pytest

from tilealg.llm.html_text import extract, main_text

ART = ("<p>This is the first paragraph of the story, and it is about what was seen by all of them at that time "
       "in the old town.</p><p>Short one.</p><p>And here is another long paragraph that has the words which one "
       "finds in the text of any article that is about a town.</p>")
WANT = ("This is the first paragraph of the story, and it is about what was seen by all of them at that time "
        "in the old town. Short one. And here is another long paragraph that has the words which one "
        "finds in the text of any article that is about a town.")


def page(body):
    return f"<!DOCTYPE html><html><head><title>Title of it</title><style>p{{x:y}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("extra", [
    "<nav><ul><li><a href='/x'>The first of the links</a></li></ul></nav>",
    "<header><h2>Site of the town</h2></header>", "<footer>&copy; 2020 the town and all of its people and the rest</footer>",
    "<div class='side-bar sidebar'><p>Read more of the news that was in the paper at the time of the event</p></div>",
    "<div class=\"ad\">Buy the best of all things that are to be had in this town for the least of it</div>",
    "<div id='cookie-notice'>We use the cookies that are needed for this and for that and it is all that we do</div>",
    "<form action='/s'><label>Search the site for what you want</label><input name=q></form>",
    "<script>if (a < b) { document.write('<p>the and of it</p>'); }</script>", "<!-- <p>the comment of it</p> -->",
    "<section class='comments'><p>I think that this is the best of the stories that I have read on this site</p></section>",
    "<p style='display: none'>The hidden text of the page that is not to be seen by the reader of it at all</p>",
    "<noscript>You have to turn the scripts on for this to be of any use to you at all</noscript>"])
def test_parts_around_and_inside_the_article_are_left_out(extra):
    assert main_text(page(f"{extra}<article>{ART}</article>{extra}")) == WANT
    assert main_text(page(f"{extra}<div>{ART}</div>{extra}")) == WANT
    if not extra.startswith("<header"):  # inside an article, a header holds its title
        assert main_text(page(f"<article>{ART}{extra}</article>")) == WANT


def test_markup_and_references():
    body = "<article><h1>On <i>A</i>&amp;B</h1><p>one&nbsp;two\n three<br>four &#233;&lt;b&gt; <b>un</b>closed<p>next</article>"
    assert main_text(body) == "On A&B one two three four é<b> unclosed next"


def test_broken_markup():
    assert main_text("<article><p>a < b and c <3 d</p><p title='x>y'>e</p><p title=\"unclosed>f</p>") == "a < b and c <3 d e f"
    assert main_text("<article><p>text that is cut <a hre") == "text that is cut"
    assert main_text("<article><p>text<!-- never closed <p>x</p>") == "text"
    assert main_text("</div></p><article>x</article></b>") == "x"
    deep = "<article>" + "<div><b>" * 20000 + "deep" + "</i>" * 20000
    assert main_text(deep) == "deep"


def test_link_lists_in_the_article_are_menus():
    links = "<ul>" + "".join(f"<li><a href='/{k}'>See the page about it</a></li>" for k in range(5)) + "</ul>"
    assert main_text(page(f"<article>{ART}{links}</article>")) == WANT


def test_short_blocks_follow_their_neighbours():
    menu = "".join(f"<div><a href='/{k}'>Item {k}</a></div>" for k in range(9))
    body = f"{menu}<div>Login now</div>{menu}<div><h1>Head</h1>{ART}</div>"
    assert main_text(page(body)) == "Head " + WANT


def test_articles_of_few_stop_words():
    assert main_text(page("<nav>the of</nav><article><p>Zxq wvu.</p><p>" + "qwx zrt " * 60 + "</p></article>")) == \
        "Zxq wvu. " + " ".join(["qwx zrt"] * 60)


def test_query_form(spark):
    rows = [(1, "u1", page(f"<article>{ART}</article>"), 0), (2, None, None, 0), (3, "", "", 0), (None, "u", "<p></p>", 0),
            (4, "x", page("<article>" + "<p>the word of it é</p>" * 20000 + "</article>"), 0)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(3)
    got = extract(spark, df).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 10
    assert by[1]["text"] == WANT and by[1]["n_chars"] == len(WANT) and by[1]["url"] == "u1"
    assert [by[k]["text"] for k in (2, 3, None)] == ["", "", ""] and by[2]["url"] is None
    assert by[4]["text"] == " ".join(["the word of it é"] * 20000)
    assert extract(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("body", [
    "<div class='content-sidebar-wrap'><article>{}</article></div>", "<div class='has-sidebar'><article>{}</article></div>",
    "<div class='has-sidebar'>{}</div>", "<main class='no-sidebar'>{}</main>", "<article class='post has-ad'>{}</article>",
    "<form action='/x'><article>{}</article></form>", "<div class='with-comments'><main>{}</main></div>",
    "<aside><main id='content'>{}</main></aside>", "<div id='header-wrapper'><main><div>{}</div></main></div>"])
def test_articles_inside_badly_named_elements(body):
    menu = "<nav><a href='/'>the and of</a></nav><div class='ad'>Buy it and see that it is the best of all</div>"
    assert main_text(page(menu + body.format(ART) + menu)) == WANT


@pytest.mark.parametrize("bad", ["comments", "comment-list", "related", "commentList", "post-comments", "ad-slot", "site-footer",
                                 "mainNav", "cookie-notice", "adverts_box", "share-bar"])
def test_articles_of_comments_and_teasers_do_not_start_clean(bad):
    other = f"<section class='{bad}'><article>{ART.replace('town', 'comment')}</article></section>"
    assert main_text(page(f"<article>{ART}</article>{other}")) == WANT
    assert main_text(page(f"<div>{ART}</div>{other}")) == WANT


def test_long_attributes_are_read():
    for size in (15_000, 25_000, 3_000_000):
        ad = f"<div class='ad' data-x={'y' * size}>Buy the best of all things that are to be had in this town</div>"
        quoted = f"<div data-x=\"{'>' * size}\" class=ad>Buy the best of all things that are to be had in this town</div>"
        assert main_text(page(f"{ad}{quoted}<article>{ART}{ad}</article>")) == WANT


def test_unclosed_quotes_take_linear_time():
    import time
    t = time.time()
    main_text("<p a=\"'" * 100_000 + ">")
    main_text("<p a='>x" * 100_001)
    assert time.time() - t < 20


POLISH = ("Wczoraj wieczorem mieszkańcy małego miasteczka zebrali się przy rynku, żeby wspólnie obejrzeć pokaz "
          "sztucznych ogni, który przygotowały lokalne władze oraz straż pożarna.")


def test_pages_in_other_languages_without_an_article():
    menu = "".join(f"<div><a href='/{k}'>Strona numer {k}</a></div>" for k in range(6))
    body = f"{menu}<div><h1>Nagłówek</h1><p>{POLISH}</p><p>{POLISH}</p></div><div class='footer'>{POLISH}</div>{menu}"
    assert main_text(page(body)) == f"Nagłówek {POLISH} {POLISH}"
    # on a page whose stop words are known, a long passage without any stays out
    assert main_text(page(f"<div>{ART}</div><div>{'qwx zrt ' * 40}</div>")) == WANT
