from starhouse.llm import html_extract as X

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">One</a></li>
<li><a href="/b">Two</a></li></ul></nav><div class="ad">Buy {i} things now.</div><article><h1>Head {i}</h1><p><b>Bold &amp; first {i}.<br><p>A   second
paragraph, with a few words more.</p><p>Sth.</p></article><footer>&copy; 2020 us</footer>{end}"""
PLAIN = """<body><header>Site <a href=x>Home</a></header><div class="cookie-notice"><p>We use cookies, as all do.</p></div><div id="content"><h2>A title</h2>
<p>First text, and more of it.</p><div class="advert">Buy this</div><p>Last&nbsp;one.</p></div><div class="sidebar"><a href=1>One</a></div>
<section id="comments"><p>Great post, thanks a lot for it!</p></section><form><label>Mail</label></form></body>"""


def test_articles_and_edges(spark):
    rows = [(i, f"u{i}", PAGE.format(i=i, end="" if i % 3 else "</body></html>"), "x") for i in range(60)]
    rows += [(100, None, None, "x"), (101, "u", "", "x"), (102, "u", PLAIN, "x"), (103, "u", "<div>" * 3000 + "deep text", "x"), (0, "u0", rows[0][2], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    model = X.fit(pages)
    out = X.extract(pages, model).collect()
    by = {r.page_id: r for r in out}
    assert len(out) == len(rows)
    for i in range(60):
        assert by[i].text == f"Head {i}\nBold & first {i}.\nA second paragraph, with a few words more.\nSth."
    assert by[100].text == by[101].text == "" and by[100].n_chars == 0
    assert by[102].text == "A title\nFirst text, and more of it.\nLast one."
    assert by[103].text in ("", "deep text")
    assert X.extract(pages.limit(0), X.fit(pages.limit(0))).count() == 0


def test_decoding_has_no_kept_node_under_a_dropped_one():
    root = X.parse(PLAIN)
    order = X.nodes_of(root)
    kept = X.keep_nodes(order, X.train([PAGE.format(i=i, end="") for i in range(5)]).margin(X.features(order)))
    assert all(n.parent is None or id(n.parent) in kept for n in order if id(n) in kept)


def test_head_without_end_tag():
    """</head> is optional: <body>, an element that can't stand in a head, or text ends the head."""
    model = X.train([PAGE.format(i=i, end="") for i in range(40)])
    want = X.extract_one(PAGE.format(i=1, end=""), model)
    assert want.startswith("Head 1")
    assert X.extract_one(PAGE.format(i=1, end="").replace("</head>", ""), model) == want
    assert X.extract_one(PAGE.format(i=1, end="").replace("</head><body>", ""), model) == want
    head = X.parse("<head><meta charset=x><title>T</title><noscript><style>a</style></noscript><p>one").children
    assert [n.tag for n in head] == ["head", "p"] and [n.tag for n in X.parse("<head>text").children] == ["head"]
    assert X.parse("<head> text").parts[-1] == (" text", False)


def test_tables_without_pages_to_learn_from(spark):
    """No rows, no markup at all, and no article or main: all text that isn't hidden is kept."""
    schema = "page_id long, url string, html string"
    rows = [(1, "u", "just text"), (2, None, "<div><p>One &amp; two</p><script>var a</script><style>b</style></div>"), (3, "u", None)]
    pages = spark.createDataFrame(rows, schema)
    assert {r.page_id: r.text for r in X.extract(pages, X.fit(pages)).collect()} == {1: "just text", 2: "One & two", 3: ""}
    empty = spark.createDataFrame([], schema)
    assert X.extract(empty, X.fit(empty)).count() == 0


def test_a_page_in_a_third_of_the_rows_counts_once(spark, monkeypatch):
    monkeypatch.setattr(X, "TRAIN_PAGES", 20)
    htmls = [PAGE.format(i=0, end="")] * 100 + [PAGE.format(i=i, end="") for i in range(1, 60)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    chosen = [r.html for r in X.learned_from(pages.repartition(4)).collect()]
    assert len(chosen) == len(set(chosen)) == 20


def test_deep_nesting_and_inline_elements():
    model = X.train([PAGE.format(i=i, end="") for i in range(40)])
    deep = "<article><h1>Head</h1>" + "<div>" * 300 + "<p>Some text, and more of it here.</p><script>var a=1;</script>" + "</div>" * 300 + "<p>After it, a last one.</p></article><footer>us</footer>"
    page = f"<html><body><nav><a href=x>One</a></nav>{deep}</body></html>"
    assert "var a" not in X.extract_one(page, model)
    order = X.nodes_of(X.parse(page))
    assert [n.parent.tag for n in order if n.tag == "p"] == ["div", "article"] and max(n.depth for n in order) > 300
    everything = X.text_of(order[0], {id(n) for n in order if n.tag not in X.HIDDEN})
    assert everything == "One\nHead\nSome text, and more of it here.\nAfter it, a last one.\nus"
    inline = "<p>Let <math><mi>x</mi></math> be <object>fallback words</object> of <svg><text>this</text></svg>, and so on.</p>"
    got = X.extract_one(PAGE.format(i=1, end="").replace("<p>Sth.</p>", inline), model)
    assert got.endswith("Let x be fallback words of this, and so on.")
