import html
import random
import re

import pytest

from storesales.llm.html_text import extract, main_text

BODY = "This is the article, with commas, and enough text to be found. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain < text &amp; more", "plain < text & more"),
        ("<p", ""),
        ("<!-- a", ""),
        ("<script>x", ""),
        ("<script>var t='</p><p>no';</script><p>yes", "yes"),
        ("<p>a<br>b  c<p>d &eacute;&#x41;", "a b c\nd éA"),
        ("<ul><li>a<li>b</ul><table><tr><td>c</td><td>d</td></tr></table>", "a\nb\nc d"),
        ('<p>x <a href="a>b">y</a></p>', "x y"),
        ('<p>x <a href="a>y</a> z</p>', "x y z"),
        ("<p>a</b>b</i></p>c", "ab\nc"),
        ("<title>t</title><h1>h</h1><textarea>no</textarea><p>p</p>", "h\np"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "beside",
    [
        "<nav><p>{}</p></nav>", "<header><h1>Site</h1><p>{}</p></header>", "<footer><p>{}</p></footer>",
        "<aside><p>{}</p></aside>", "<form><p>{}</p></form>", '<div class="side-bar sidebar"><p>{}</p></div>',
        '<div id="cookieNotice"><p>{}</p></div>', '<div class="ad"><p>{}</p></div>', "<style>{}</style>",
        '<section class="comments"><p>{}</p></section>', '<div hidden><p>{}</p></div>', "<noscript><p>{}</p></noscript>",
        '<div style="display: none"><p>{}</p></div>', '<div role="navigation"><p>{}</p></div>',
        '<ul><li><a href="x">Very long link text, with commas, a, b, c, d</a></li></ul>',
    ],
)
def test_what_stands_beside_the_article_is_left_out(beside):
    other = beside.format("Other text, also with commas, that is not part of it.")
    for page in (
        f"<body>{other}<article><h2>Title</h2><p>{BODY}</p><p>End.</p></article>{other}</body>",
        f"<body>{other}<div class='content has-sidebar'><h2>Title</h2><p>{BODY}</p><p>End.</p></div>{other}</body>",
    ):
        assert main_text(page) == f"Title\n{BODY.strip()}\nEnd."


def test_comments_inside_the_article_go_and_its_headings_stay():
    page = f"<article><header><h1>T</h1><p>by me</p></header><p>{BODY}</p><div id='comments'><p>nice, nice, nice</p></div></article>"
    assert main_text(page) == f"T\n{BODY.strip()}"


def test_siblings_of_the_best_container_are_kept():
    page = f"<div><div id='a'><p>{BODY}</p><p>{BODY}</p></div><p>{BODY}</p><div id='b'><p>{BODY}</p></div></div>"
    assert main_text(page) == "\n".join([BODY.strip()] * 4)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div><h1>Title</h1><div class='body'><p>{0}</p><p>{0}</p></div></div>", "Title\n{0}\n{0}"),
        ("<div><h1>T</h1><p>A lead.</p><div><div><p>{0}</p></div></div></div>", "T\nA lead.\n{0}"),
        ("<h1>T</h1><div><p>{0}</p><p>{0}</p></div><div><h2>Next</h2><p>Short section.</p></div>", "T\n{0}\n{0}\nNext\nShort section."),
        ("<div>Bare words.<div><p>{0}</p><p>{0}</p></div>The end.</div>", "Bare words.\n{0}\n{0}\nThe end."),
        ("<div><p><a href=x>Home, news, all</a></p><h2>T</h2><div><p>{0}</p><p>{0}</p></div><p>End.</p><p><a href=x>More</a></p><p>Imprint</p></div>", "T\n{0}\n{0}\nEnd."),
        ("<div><h2>T</h2><div class=ad><p>Buy, buy</p></div><div><p>{0}</p><p>{0}</p></div></div>", "T\n{0}\n{0}"),
    ],
)
def test_short_neighbours_of_the_container_are_kept_up_to_links(page, text):
    assert main_text(page.format(BODY)) == text.format(BODY.strip())


def test_time_grows_with_length_only():
    for page in ("<a '" * 50_000, "<" * 100_000, "<p>" * 50_000, "<div>" * 50_000, "<b>" * 50_000 + "x", '<a b="' * 50_000):
        main_text(page)


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        article = re.search("<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = [re.sub("<br>", " ", re.sub("</?b>", "", b)) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        assert r.n_chars == len(r.text)


def test_nulls_repeated_rows_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, "u", None, "x", 1), (None, None, "<p>a", "x", 1), (2, "v", "", "x", 1), (2, "v", "", "x", 1)]
    got = sorted(map(tuple, extract(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (None, None, "a", 1), (2, "v", "", 0), (2, "v", "", 0)], key=repr)
    assert extract(spark.createDataFrame([], schema)).collect() == []


def random_page(rng):
    """Elements as (parent, tag, text, text in a link) in page order, under a root that is no element; text lies in leaves."""
    nodes = [(-1, "#root", "", "")]
    boxes = [0]
    while len(nodes) < 14:
        parent = rng.choice(boxes[-4:])
        if rng.random() < 0.4 and parent == boxes[-1] or len(nodes) == 1:
            boxes.append(len(nodes))
            nodes.append((parent, rng.choice(["div", "section"]), "", ""))
        elif parent in boxes:
            # An element is written after all that came before it, so its parent must still be open.
            boxes = boxes[: boxes.index(parent) + 1]
            words = [rng.choice(["word", "other,", "longer text,", "end."]) for _ in range(rng.choice([1, 3, 12, 40]))]
            link = " ".join(words[: rng.choice([0, 0, 0, 1, len(words)])])
            nodes.append((parent, rng.choice(["p", "p", "p", "h2"]), " ".join(words), link))
    return nodes


def rendered(nodes, node=0):
    _, tag, text, link = nodes[node]
    inside = "".join(rendered(nodes, i) for i, n in enumerate(nodes) if n[0] == node)
    own = f"<a href=x>{link}</a>{text[len(link):]}" if link else text
    return inside if node == 0 else f"<{tag}>{own}{inside}</{tag}>"


def scored_by_hand(nodes):
    """The kept blocks, by the rules as they are written."""
    inside = {i: {i} for i in range(len(nodes))}
    for i in range(len(nodes) - 1, 0, -1):
        inside[nodes[i][0]] |= inside[i]
    chars = {i: sum(len(nodes[k][2]) for k in inside[i]) for i in inside}
    linked = {i: sum(len(nodes[k][3]) for k in inside[i]) for i in inside}
    points = dict.fromkeys(inside, 0.0)
    for parent, _, text, link in nodes:
        if text:
            worth = (1 + text.count(",") + min(3, len(text) / 100)) * (1 - len(link) / len(text))
            for share in (1, 2, 3):
                if parent >= 0:
                    points[parent] += worth / share
                    parent = nodes[parent][0]
    net = {i: p * (1 - linked[i] / chars[i]) if chars[i] else 0 for i, p in points.items()}
    best = max(net, key=lambda i: (net[i], -i))
    while nodes[best][0] > 0 and chars[nodes[best][0]] == chars[best]:
        best = nodes[best][0]
    kept = set(inside[best])
    if best:
        row = [i for i in range(1, len(nodes)) if nodes[i][0] == nodes[best][0] and chars[i]]
        few = {i: linked[i] < 0.25 * chars[i] for i in row}
        sure = {i for i in row if i == best or net[i] >= 0.2 * net[best] or few[i] and nodes[i][2] and chars[i] > 80}
        for k, i in enumerate(row):
            before = next((j for j in row[:k][::-1] if j in sure or not few[j]), None)
            after = next((j for j in row[k + 1 :] if j in sure or not few[j]), None)
            if i in sure or few[i] and (before in sure or after in sure):
                kept |= inside[i]
    return "\n".join(text for i, (_, _, text, _) in enumerate(nodes) if text and i in kept)


@pytest.mark.parametrize("seed", range(5))
def test_scores_of_random_trees_by_hand(seed):
    rng = random.Random(seed)
    dropped = 0
    for _ in range(200):
        nodes = random_page(rng)
        found = main_text(rendered(nodes))
        assert found == scored_by_hand(nodes), rendered(nodes)
        dropped += found != "\n".join(n[2] for n in nodes if n[2])
    assert dropped > 10
