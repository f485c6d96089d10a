"""Odd markup around articles, and generated pages whose text is known."""

import time
from random import Random

import pytest

from saleslake.llm import html

ARTICLE = " ".join(["The river rises in the hills and runs a long way to the sea, past towns."] * 4)
MENU, FOOT = "<nav>Home About</nav>", "<footer>Rights of the site</footer>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"{MENU}<div class=post><p title=it's>{ARTICLE} don't go</p></div>{FOOT}", f"{ARTICLE} don't go"),
        (f"{MENU}<div class='post comments-open'><p>{ARTICLE}</p></div>{FOOT}", ARTICLE),
        (f"{MENU}<div class='layout with-comments'><p>{ARTICLE}</p></div>{FOOT}", ARTICLE),
        (
            f"<article><p>{ARTICLE}</p></article><section class=responses><article class=comment><p>{ARTICLE * 3}</p>"
            "</article></section>",
            ARTICLE,
        ),
        (
            f"{MENU}<main><article><p>{ARTICLE}</p></article><article class=more><p>{ARTICLE} Then</p></article></main>",
            f"{ARTICLE} {ARTICLE} Then",
        ),
        (f"{MENU}<div class=a><p>{ARTICLE}</p></div><div class=b><p>{ARTICLE} Then</p></div>{FOOT}", f"{ARTICLE} {ARTICLE} Then"),
        (f"<article><p>{ARTICLE}</p>< 5 items", f"{ARTICLE} < 5 items"),
        (f"<article><p>{ARTICLE}</p><p>end <div class='cut", f"{ARTICLE} end"),
        (
            f"<article><p>{ARTICLE}</p><p class=advert>buy<p>next</p><span class='cookie-notice'>We <span>use</span> "
            "cookies</span> end <pre>x <span class=ad>y</span></pre></article>",
            f"{ARTICLE} next end x y",
        ),
        (f"<title>Head line</title><article><p>{ARTICLE}</p></article>", ARTICLE),
        (f"{MENU}{FOOT}", ""),
        ("", ""),
    ],
)
def test_article_of_odd_markup(page, text):
    votes = html.Page(page).score()
    assert html.Page(page).main_text([]) == text
    assert votes is None or html.Page(page).main_text([votes.path()]) == text


def test_deep_and_unclosed_markup_is_read_in_linear_time():
    began = time.process_time()
    assert html.Page("<div>" * 200_000 + ARTICLE).main_text([]) == ARTICLE
    page = html.Page("<div>x " * 100_000 + "</section>" * 100_000)
    assert page.main_text([]).split() == ["x"] * 100_000
    assert time.process_time() - began < 20


def test_generated_pages_give_the_text_they_were_made_of(table, spark):
    rng = Random(5)
    words = "river hill town sea boat road stone field rain light & < é".split()
    escaped = {"&": "&amp;", "<": "&lt;", "é": "&eacute;"}

    def sentence(n):
        return [rng.choice(words) for _ in range(n)]

    rows, known = [], {}
    for page_id in range(120):
        shape = page_id % 4
        blocks = [sentence(rng.randrange(20, 60)) for _ in range(rng.randrange(2, 9))]
        known[page_id] = " ".join(w for b in blocks for w in b)
        inner = "".join(
            f"<{t}>{rng.choice([' ', chr(10)]).join(escaped.get(w, w) for w in b)}"
            + (f"</{t}>" if t != "p" or rng.random() < 0.7 else "")
            for b in blocks
            for t in [rng.choice(["p", "p", "h2", "blockquote"])]
        )
        head = "<head><title>t</title><style>p{}</style></head>" if rng.random() < 0.7 else "<title>t</title>"
        around = (
            f"<main id=c{page_id}><article>{inner}</article></main>",
            f"<div class='wrap has-sidebar'><div class='post-{page_id} comments-closed'>{inner}</div><aside>more</aside></div>",
            f"<form><div class=content>{inner}<div class=share-bar>share this</div></div></form>",
            f"<table><tr><td class=nav>menu</td><td class=story>{inner}</td></tr></table>",
        )[shape]
        rows.append((page_id, f"http://h{shape}.example/{page_id}", f"{head}<body>{MENU}{around}<!-- x -->{FOOT}</body>"))
    pages = spark.createDataFrame([*rows, (None, None, None)], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html.main_text(pages).collect()}
    assert found == known | {None: ""}
