from paceline.llm.html import extract, extract_pages

LONG = "Some words stand here, and then some more of them, so that it reads like a paragraph of an article."


def p(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style><script>var a="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
    <div class="cookie-notice">{p(LONG)}</div><div id="main-menu"><ul><li><a href=1>One</a></li></ul></div>
    <article><h1>Title &amp; more</h1><p>{LONG}<p>Short.</p><form>{p(LONG)}<input></form><div class="ad">{LONG}</div>
    <ul><li>First point</li><li>Second&nbsp; point</li></ul><blockquote>Quoted<br>text</blockquote></article>
    <aside>{p(LONG)}</aside><section id="comments"><article class="comment">{p(LONG, LONG, LONG)}</article></section>
    <footer>&copy; nobody</footer></body></html>"""
    assert extract(page) == f"Title & more\n{LONG}\nShort.\nFirst point\nSecond point\nQuoted text"


def test_unmarked_container_by_points():
    page = (f"<body><div class=top><a href=a>{LONG}</a> <a href=b>{LONG}</a></div><div><h2>Head</h2>{p(LONG, LONG + ' More, and more.', 'Tiny.')}</div>"
            f"<div class='sidebar'>{p(LONG)}</div><div><a href=1>x</a><a href=2>y</a></div></body>")
    assert extract(page) == f"Head\n{LONG}\n{LONG} More, and more.\nTiny."


def test_wrappers_with_names_of_other_things():
    paragraphs = p(*[LONG] * 14)
    text = "\n".join([LONG] * 14)
    for wrapper in ("content no-sidebar", "right-sidebar", "page nav-open", "article social-science", "page has-comments", "subscriber-content"):
        assert extract(f"<body><div class='{wrapper}'>{paragraphs}</div></body>") == text, wrapper
        side = f"<div class='sidebar'>{p(LONG, LONG)}</div><div id=comments>{p(*[LONG] * 20)}</div>"
        assert extract(f"<body><div class='{wrapper}'>{paragraphs}{side}</div></body>") == text, wrapper
    assert extract(f"<body><form action=x><div>{paragraphs}</div><input><button>Go</button></form></body>") == text
    assert extract(f"<body><form id=aspnet><nav><a href=/>Home</a></nav><article>{paragraphs}</article>{p(LONG)}</form></body>") == text
    assert extract(f"<body><div class=sidebar><article>{paragraphs}</article></div></body>") == text
    assert extract(f"<article>{p(LONG)}<section id='discussion'><h2>Discussion</h2>{p(LONG)}</section></article>") == f"{LONG}\nDiscussion\n{LONG}"
    assert extract(f"<article id='discussion'>{p(LONG, LONG)}</article>") == f"{LONG}\n{LONG}"
    # Small parts with such names still go, as do cards beside the article, and replies below it.
    assert extract(f"<main><article>{paragraphs}<div class=promo>{p(LONG)}</div></article><aside><article>{p(LONG)}</article></aside>"
                   f"<section id=discussion><div class=reply>{p(LONG)}</div><div class=reply>{p(LONG)}</div></section></main>") == text
    assert extract(f"<article>{p(LONG)}<section class=discussion>{p(LONG)}<form><textarea></textarea></form></section></article>") == LONG
    assert extract(f"<div class=cookie-notice>{p(LONG)}</div>") == ""


def test_best_container_against_brute_force():
    import random
    rng = random.Random(5)

    def tree(depth):
        return [f"{'x' * rng.randint(1, 400)}{',' * rng.randint(0, 4)}" if depth == 0 or rng.random() < 0.5 else tree(depth - 1)
                for _ in range(rng.randint(1, 4))]

    def markup(node):
        return f"<p>{node}</p>" if isinstance(node, str) else f"<div>{''.join(map(markup, node))}</div>"

    def texts(node):
        return [node] if isinstance(node, str) else [t for k in node for t in texts(k)]

    def value(node, far=0):
        """Points that all paragraphs below pass up to ``node``."""
        total = 0.0
        for kid in node:
            if isinstance(kid, str):
                points = 1 + kid.count(",") + min(len(kid) / 100, 3)
                total += points if far == 0 else points / 2 if far == 1 else points / (3 * far) if far <= 5 else 0
            else:
                total += value(kid, far + 1)
        return total

    def divs(node, parent=None):
        yield node, parent
        for kid in node:
            if not isinstance(kid, str):
                yield from divs(kid, node)

    for _ in range(300):
        page = [tree(3), tree(2)]
        # The body around the two divs is a container, too.
        found = list(divs(page))
        top = max(value(n) for n, _ in found)
        ties = [n for n, _ in found if value(n) > top - 1e-9]
        if len(ties) > 1:
            continue
        best, parent = next((n, up) for n, up in found if n is ties[0])
        kept = texts(best)
        if parent is not None:
            bar = max(10.0, 0.2 * top)
            kept = [t for k in parent if k is best or isinstance(k, str) or value(k) >= bar or sum(map(len, texts(k))) >= 80 for t in texts(k)]
        assert extract(f"<body>{markup(page[0])}{markup(page[1])}</body>").split("\n") == kept


def test_odd_pages():
    assert [extract(x) for x in (None, "", "<p></p>", "<!-- only -->", "<div><div", "<")] == ["", "", "", "", "", "<"]
    assert extract("just  text\n here") == "just text here"
    assert extract("<p>a &lt;b&gt; &#233;</p>") == "a <b> é"
    assert extract("<p>open <b>bold<p>next") == "open bold\nnext"
    deep = "<div>" * 5000 + LONG + "</div>" * 5000
    assert extract(deep) == LONG
    huge = p(*[LONG] * 5000)
    assert extract(f"<article>{huge}</article>") == "\n".join([LONG] * 5000)


def test_table(spark):
    rows = [(1, None, "old"), (2, f"<article>{p(LONG)}</article>", "old"), (2, f"<article>{p(LONG)}</article>", "old"), (None, "", None)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert sorted(str((r.page_id, r.text)) for r in got) == sorted(str((a, extract(b))) for a, b, _ in rows)
    assert extract_pages(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_all_pages_against_their_markup(spark, sf_dir):
    import re
    from html import unescape
    for r in extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b)
