"""The article is found by where text stands and how dense it is, not by what elements and classes are called."""

import re
import time

import pytest

from tapework.llm import htmltext

SF = "/root/testdata/sf0.01"


def renamed(page, classes):
    page = re.sub(r"<(/?)(article|header|footer|nav|aside|main)\b", r"<\1div", page)
    return page if classes else re.sub(r' class="[^"]*"', "", page)


@pytest.mark.parametrize("classes", [True, False])
def test_renamed_pages_keep_their_articles(spark, classes):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert len(pages) == 250
    for page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        want = "\n\n".join(htmltext.blocks_of(htmltext.parse(f"<body><div>{article}</div></body>")))
        assert htmltext.main_text(renamed(page, classes)) == htmltext.main_text(page) == want


P = "<p>" + "A sentence of an article that goes on for a while and says some things, one after another. " * 3 + "</p>"


def test_containers():
    menu = "<div>" + "".join(f'<li><a href="/{k}">Entry {k}</a></li>' for k in range(9)) + "</div>"
    line = "<div>Sign up for our letter today, it is free and comes weekly.</div>"
    text = " ".join(re.sub("<.*?>", "", P).split())
    # Two parts of one text stay together; bare lines and menus beside them go.
    assert htmltext.main_text(f"<body>{menu}<div><div>{P * 3}</div><div>{P * 3}</div></div>{line}</body>") == "\n\n".join([text] * 6)
    assert htmltext.main_text(f"<body><div>{menu}</div>{line}<div><h1>Title</h1>{P}</div>{line}</body>") == f"Title\n\n{text}"
    # Paragraphs without a container, and a page that tells in bare text only.
    assert htmltext.main_text(f"<body>{menu}<h1>Title</h1>{P}{P}</body>").endswith(f"Title\n\n{text}\n\n{text}")
    assert htmltext.main_text(f"<body><div>{text}<br>{text}</div></body>") == f"{text}\n\n{text}"
    # A site's name in a heading of its own does not outweigh bare text.
    assert text in htmltext.main_text(f"<body><div><h1>Site</h1></div><div>{text}<br>{text}</div></body>")


def test_any_nesting_takes_linear_time():
    for page in ("<p><body>" + "<b>" * 120_000 + "<hr>" * 120_000, "<li>" + "<b>" * 120_000 + "<li><ul>" * 60_000, "<table>" + "<td><i>" * 100_000, "<p><i>" * 100_000 + "<div>" * 100_000, "<dl>" + "<dt><b><dd>" * 80_000):
        began = time.time()
        htmltext.main_text(page)
        assert time.time() - began < 15, page[:20]
