"""op1: density sums and thresholds against a recursive recomputation, and what decides."""

import math
import random

import pytest

from txrisk.llm import html_text

PARA = "A long sentence of the article that a reader wants to see in full. "


def tree(rng, depth=0):
    """A random block: (tag, parts); a part is a text, a link (as a tuple of one) or a block."""
    parts = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if depth < 3 and kind < 0.45:
            parts.append(tree(rng, depth + 1))
        elif kind < 0.6:
            parts.append(("x" * rng.randint(1, 30),))
        else:
            parts.append("y" * rng.randint(1, 200))
    return (rng.choice(["div", "section", "article", "blockquote"]), parts)


def markup(node):
    tag, parts = node
    inner = "".join(p if isinstance(p, str) else f"<a href='#'>{p[0]}</a>" if len(p) == 1 else markup(p) for p in parts)
    return f"<{tag}>{inner}</{tag}>"


def counts(node):
    c = t = lc = lt = 0
    for p in node[1]:
        if isinstance(p, str):
            c += len(p)
        elif len(p) == 1:
            c, t, lc, lt = c + len(p[0]), t + 1, lc + len(p[0]), lt + 1
        else:
            more = counts(p)
            c, t, lc, lt = c + more[0], t + more[1] + 1, lc + more[2], lt + more[3]
    return c, t, lc, lt


def formula(c, t, lc, lt, ratio):
    """The published formula, with zero counts as one."""
    if c == 0:
        return 0.0
    base = math.log(c / max(1, c - lc) * lc + ratio * c + math.e)
    if base <= 1:
        return c / max(1, t)
    return max(0.0, c / max(1, t) * math.log(c / max(1, lc) * (max(1, t) / max(1, lt)), base))


def all_blocks(node):
    yield node
    for p in node[1]:
        if not isinstance(p, str) and len(p) == 2:
            yield from all_blocks(p)


@pytest.mark.parametrize("seed", range(40))
def test_sums_and_threshold_by_recursion(seed):
    body = ("body", [tree(random.Random(seed)), tree(random.Random(seed + 1000)), tree(random.Random(seed + 2000))])
    c, _, lc, _ = counts(body)
    ratio = lc / max(1, c)
    dense = lambda n: formula(*counts(n), ratio)
    blocks = list(all_blocks(body))
    sums = []
    for n in blocks:
        own = ("own", [p for p in n[1] if isinstance(p, str) or len(p) == 1])
        sums.append(formula(*counts(own), ratio) + sum(dense(p) for p in n[1] if not isinstance(p, str) and len(p) == 2))

    root, nodes = html_text.parse(markup(body))
    html_text.measure(nodes)
    got = [n for n in nodes if n.block and n is not root]
    assert [n.name for n in got] == [n[0] for n in blocks]
    assert [n.density for n in got] == pytest.approx([dense(n) for n in blocks])
    assert [n.total for n in got] == pytest.approx(sums)

    chosen = html_text.content(root, nodes)
    assert chosen[0].total == pytest.approx(max(sums))
    path, at = [], chosen[0]
    while at is not root:
        path.append(at)
        at = at.parent
    low = min(n.density for n in path)
    beside = [x for n in path for x in (n.parent.children if n.parent is not root else []) if x is not n and x.block and x.density >= low]
    assert {id(n) for n in chosen[1:] if n.block} == {id(n) for n in beside}


def test_the_densities_choose_and_not_the_tag():
    """A thin article beside dense text in plain divisions: the divisions win."""
    page = f"<body><article><p>Short.</p></article><div><p>{PARA * 5}</p><p>{PARA * 5}</p></div></body>"
    root, nodes = html_text.parse(page)
    html_text.measure(nodes)
    first = html_text.content(root, nodes)[0]
    assert first.name == "div" and PARA.strip() in html_text.main_text(page)
    sums = {n.name: n.total for n in nodes if n.name in ("article", "div")}
    assert sums["div"] > 10 * sums["article"]


@pytest.mark.parametrize("inline", ["b", "em", "span", "math", "svg", "object", "label"])
def test_inline_elements_belong_to_their_block(inline):
    """A lone paragraph in inline markup keeps its heading, and the markup's text."""
    page = f"<body><nav><a href='/'>menu</a></nav><article><h1>Heading</h1><p>Start <{inline}>KEY {PARA * 9}</{inline}> end</p></article></body>"
    assert html_text.main_text(page) == f"Heading Start KEY {(PARA * 9).strip()} end"


@pytest.mark.parametrize("wrap", ["post-comments-off", "entry-social-science", "page-with-sidebar", "no-sidebar"])
def test_a_wrapper_in_doubt_is_judged_by_its_density(wrap):
    page = f"<body><nav><a href='/'>menu</a></nav><div class='{wrap}'><article><h1>Heading</h1><p>{PARA * 4}</p></article></div><div>x</div><footer>foot</footer></body>"
    text = html_text.main_text(page)
    assert text.startswith("Heading " + PARA.strip()) and "menu" not in text and "foot" not in text


@pytest.mark.parametrize("furniture", ["comments", "site-footer", "post-comments", "ad-banner", "cookie-bar"])
def test_furniture_beside_the_text_goes(furniture):
    page = f"<body><article><h1>Heading</h1><p>{PARA * 4}</p></article><div class='{furniture}'><p>KEY {PARA * 3}</p></div></body>"
    assert html_text.main_text(page) == f"Heading {(PARA * 4).strip()}"


def test_a_form_around_the_page_is_not_its_furniture():
    page = f"<body><form><h1>Heading</h1><p>{PARA * 4}</p><select><option>KEY</option></select><button>Go</button></form></body>"
    assert html_text.main_text(page) == f"Heading {(PARA * 4).strip()}"


@pytest.mark.parametrize("page", ["<nav><a href='/'>menu</a></nav>", "<body><div class='site-footer'>foot</div></body>", "<body><script>x</script></body>", "<body></body>"])
def test_a_page_of_furniture_has_no_text(page):
    assert html_text.main_text(page) == ""


def test_a_heading_goes_with_the_block_it_heads():
    block = f"<p>{PARA * 6}</p><p>{PARA * 6}</p>"
    page = f"<body><main><h1>Top</h1><div>{block}</div><h2>More to read</h2><ul><li><a href='/1'>one</a></li><li><a href='/2'>two</a></li></ul></main></body>"
    text = html_text.main_text(page)
    assert text.startswith("Top A long") and "one" not in text


def test_table_with_edge_rows(spark):
    article = f"<article><h1>T</h1><p>{PARA * 3}</p></article>"
    rows = [(1, "u", None, "x", 1, "c"), (2, None, "", None, 2, "c"), (3, "u", article, "x", 3, "c"), (3, "u", article, "x", 3, "c"), (None, "u", "<p>" * 3000 + "deep", "x", 4, "c"), (4, "u", f"<p>{PARA * 20_000}", "x", 5, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, `__html` string")
    got = sorted(((r.page_id or 0, r.text) for r in html_text.extract(pages).collect()), key=str)
    want = f"T {(PARA * 3).strip()}"
    assert got == sorted([(1, ""), (2, ""), (3, want), (3, want), (0, "deep"), (4, (PARA * 20_000).strip())], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0
