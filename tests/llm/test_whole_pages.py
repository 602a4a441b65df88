from tapework.llm import htmltext

LINE = "Line {} of the article is long enough to count as text of its own, and it has no links in it."


def lines(a, b):
    return "".join(f"<p>{LINE.format(i)}</p>" for i in range(a, b))


def all_lines(text, n):
    return [LINE.format(i) in text for i in range(n)] == [True] * n


def test_sibling_parts_stay_together():
    menu = "<div>" + "".join(f"<a href={i}>Menu entry {i}</a> " for i in range(30)) + "</div>"
    page = f"<body>{menu}<div id=content><h1>Head</h1><div class=part>{lines(0, 10)}</div><h2>Between</h2><div class=part>{lines(10, 18)}</div><div class=part>{lines(18, 19)}</div></div></body>"
    text = htmltext.main_text(page)
    assert all_lines(text, 19) and "Head" in text and "Between" in text and "Menu" not in text
    text = htmltext.main_text(f"<body>{menu}<div class=part>{lines(0, 10)}</div><div class=part>{lines(10, 18)}</div></body>")
    assert all_lines(text, 18) and "Menu" not in text


def test_words_and_forms_around_a_page_do_not_hide_it():
    for wrapper in ("form action=x", "div class=has-sidebar", "div id='search-results'"):
        name = wrapper.split()[0]
        text = htmltext.main_text(f"<body><{wrapper}><div>{lines(0, 8)}</div><div class=sidebar>Side</div></{name}></body>")
        assert all_lines(text, 8) and "Side" not in text
    text = htmltext.main_text(f"<body><div><div>{lines(0, 8)}</div><section class=related-work>{lines(8, 14)}</section><div id=comments>{'<p>Reader says hi to all.</p>' * 9}</div></div></body>")
    assert all_lines(text, 14) and "Reader" not in text
