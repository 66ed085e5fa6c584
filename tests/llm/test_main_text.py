"""Main text of pages."""

import pytest

from broadsheet.llm import main_text as M


def text_of(page, constant=()):
    return M.main_text(M.placed(page, None), set(constant))


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><h1>T</h1><p>one\n  two<b> three</b><br>four<p>five</article>", "T\none two three four\nfive"),
        ("<nav>menu</nav><div class='side-bar ad'>buy</div><p>kept</p><footer>foot</footer>", "kept"),
        ("<p>a<script>var x='</p>'</script>b</p><style>p{}</style><!-- no --><form>name</form>", "ab"),
        ("<p>cut <a href='x", "cut"),
        ("<p>cut &am", "cut &am"),
        ("<article><p>one</p><section id=comments><p>reader</p></section></article>", "one"),
        ("<header>site</header><article><header><h1>title</h1></header><p>x</article>", "title\nx"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<p>q</p><script>never ended", "q"),
        ("<p title='a > b'>x</p><p data='unbalanced>y</p>", "x\ny"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<p>x <span class=advert>ad</span> y</p>", "x\ny"),
        # Names of the page, of its article and of what is around it say nothing.
        ("<body class='post no-sidebar'><p>x</body>", "x"),
        ("<article class='has-comments'><p>x</article>", "x"),
        ("<div id='share-article'><p>x</div>", "x"),
        ("<main class='page notice-board'>x</main>", "x"),
        ("<div class='main with-sidebar'>x</div>", "x"),
        ("<div class=sidebar><article class=notice>x</article></div>", "x"),
        ("<form><article>x<form>y</form></article></form>", "x"),
        # Doubtful names outside the article, and of small and of large elements.
        ("<article>x</article><div class=related>a longer text than x</div>", "x"),
        ("<div>a longer text</div><div class=promo>small</div>", "a longer text"),
        ("<div>small</div><div class=promo>a longer text</div>", "small\na longer text"),
        ("<article></article><div class=ad>buy</div>", ""),
        ("<div class=post>x</div><div id=comments><article class=comment>reader</article></div>", "x"),
        ("<main>a longer text<div class=related-posts><article>other</article></div></main>", "a longer text"),
        ("<p>x</p><div class=cookie-banner>a longer text</div>", "x"),
        ("<div>" * 3000 + "<nav>menu<div>a</div></nav>deep<div class=ad>b<div>c</div></div>", "deep"),
    ],
)
def test_pages(page, text):
    assert text_of(page) == text


def best(a, b):
    """Simple tree matching, plainly."""
    if a[0] != b[0]:
        return 0
    table = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best(x, y))
    return table[-1][-1] + 1


def test_tree_matching():
    import random

    source = random.Random(1)

    def tree(depth):
        return (source.choice("ab"), [tree(depth - 1) for _ in range(source.randrange(4))] if depth else [])

    def run(t):
        return M.Run(t[0], [run(c) for c in t[1]], [])

    for _ in range(200):
        a, b = tree(3), tree(3)
        size, pairs = M.match_trees(run(a), run(b))
        assert size == best(a, b) == len(pairs)
        assert all(x.symbol == y.symbol for x, y in pairs)


def test_template_of_a_host(spark):
    page = "<body><div>Daily News of {h}</div><div><p>{i} article {i} that tells more than the template around it does</p><p>Thanks for reading</p></div></body>"
    rows = [(i, f"https://{h}/{i}", page.format(h=h, i=i), "x") for h in ("a.org", "b.org") for i in range(6)]
    rows += [(20, "https://c.org/1", page.format(h="c", i=1), "x"), (21, None, page.format(h="d", i=2), "x")]
    rows += [(22, "https://a.org/9", None, "x"), (22, "https://a.org/9", "", "x"), (None, "no host", "<p>z", "x")]
    # Copies of one article are no template.
    rows += [(30 + i, f"https://copies.org/{i}", "<p>the same article</p>", "x") for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {(r.page_id, r.url): r.text for r in M.extract_main_text(pages).collect()}
    assert all(got[i, f"https://{h}/{i}"] == f"{i} article {i} that tells more than the template around it does" for h in ("a.org", "b.org") for i in range(6))
    assert got[20, "https://c.org/1"] == "Daily News of c\n1 article 1 that tells more than the template around it does\nThanks for reading"
    assert got[21, None].startswith("Daily News") and got[22, "https://a.org/9"] == "" and got[None, "no host"] == "z"
    assert all(got[30 + i, f"https://copies.org/{i}"] == "the same article" for i in range(5))


def test_wide_pages():
    """Time and memory of alignment do not grow with the square of a page."""
    import time

    parts = {"<h2>a {i}</h2><p>b {i}</p>": 2, "<h2>a {i}</h2><p>b<ul><li>c</ul>": 3, "<p class=x{i}>b</p>": 1}
    for part, n in parts.items():
        page = "".join(part.format(i=i) for i in range(8000))
        begin = time.perf_counter()
        blocks = M.placed(page, M.skeleton_of(page)).blocks
        assert [b.place for b in blocks] == list(range(8000 * n))
        assert time.perf_counter() - begin < 10


def test_hosts_against_plain_counting(spark):
    """Made-up hosts: template in plain elements, copies, passages of a third of the pages."""
    import random

    source = random.Random(3)
    word = lambda: "".join(source.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for host in ("one.org", "two.org"):
        shared, copy = " ".join(word() for _ in range(30)), [" ".join(word() for _ in range(40)) for _ in range(3)]
        for i in range(30):
            body = [" ".join(word() for _ in range(source.randrange(3, 40))) for _ in range(source.randrange(1, 6))]
            if i % 3 == 0:
                body.append(shared)
            if i >= 20:
                body = copy
            page = (
                f"<body><div>All news of {host}</div><div>{''.join(f'<p>{p}</p>' for p in body)}</div>"
                f"<div class='ad'>{word()}</div><section>Write to {host}</section></body>"
            )
            rows.append((len(rows), f"https://{host}/{i}", page))
            want[len(rows) - 1] = "\n".join(body)
        # Pages of template only.
        rows.append((len(rows), f"https://{host}/none", f"<body><div>All news of {host}</div><div></div></body>"))
        want[len(rows) - 1] = ""
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in M.extract_main_text(pages).collect()}
    assert got == {i: (text, len(text)) for i, text in want.items()}
    assert M.extract_main_text(pages.limit(0)).count() == 0
