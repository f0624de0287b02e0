import json

from spacetime.llm import html_extract as H

PAGE = '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul>{nav}</ul></nav><!-- ad --><div class="ad">Buy {n}</div><div id="content">{body}</div><div class="comments"><p>Nice!</p></div><form><p>Name</p></form><footer>&copy; x {n}</footer></body></html>'


def page(n, paragraphs, nav=3):
    return PAGE.format(n=n, nav="".join(f'<li><a href="/{i}">L{i}</a></li>' for i in range(nav)), body=f"<h1>Title {n}</h1>" + "".join(f"<p>{p}" + "</p>" * (i % 2) for i, p in enumerate(paragraphs)))


def pages():
    out = []
    for n in range(30):
        ps = [f"Text {n}.{i} a &amp; b  \n <b>bold</b>&nbsp;<i>x</i>" for i in range(1 + n % 5)]
        out.append((n, f"https://h{n % 2}.example.org/p/{n}", page(n, ps, 2 + n % 3), "\n".join([f"Title {n}", *[f"Text {n}.{i} a & b bold x" for i in range(1 + n % 5)]])))
    return out


def test_main_text_of_every_page(spark):
    rows = pages()
    odd = [(100, None, None, ""), (101, "https://x.org/", "", ""), (102, "not a url", "plain &lt; text", "plain < text"), (None, "https://one.org/", "<article><p>A<br>B<p>C</article>tail", "A\nB\nC"), (103, "https://cut.org/", "<body><nav>menu</nav><p>Cut te&am", "Cut te&am"), (103, "https://cut.org/", "<body><nav>menu</nav><p>Cut te&am", "Cut te&am"), (104, "https://h0.example.org/z", "<p>other template</p><script>never ends", "other template")]
    src = spark.createDataFrame([(i, u, h, "w", "t") for i, u, h, _ in rows + odd], "page_id long, url string, html string, wrapper string, text string")
    got = H.extract(src).collect()
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in got) == sorted((str(i), str(u), t, len(t)) for i, u, _, t in rows + odd)


def test_empty_table(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_has_slots_options_and_repeats():
    nodes, key, own = H.infer([H.tokens(h) for _, _, h, _ in pages()[:8]])
    saved = json.dumps(nodes)
    assert key == "div id=content"
    assert '["plus"' in saved and '["text", null]' in saved
    assert {"Nice!", "Name"} <= set(own) and not any(t.startswith(("Title", "Text")) for t in own)
    wrapper = H.Wrapper(json.dumps([nodes, key, own]))
    assert wrapper.match is not None


def test_align_makes_one_sided_tokens_optional():
    a = H.nodes_of(H.tokens("<div><h1>A</h1><p>x</p></div>"))
    b = H.nodes_of(H.tokens("<div><p>y</p><hr></div>"))
    wrapper = H.align(a, b)
    kinds = [n[0] for n in wrapper]
    assert kinds.count("opt") == 2 and ("text", None) in wrapper
    w = H.Wrapper(json.dumps([wrapper, "div", []]))
    for h in ("<div><h1>A</h1><p>x</p></div>", "<div><p>y</p><hr></div>", "<div><h1>B</h1><p>z</p><hr></div>"):
        p = H.tokens(h)
        assert w.match("".join("t" if t[0] == "t" else w.code[t[0] + H.key_of(t)] for t in p))


def test_deep_and_long_pages_end():
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert H.main_text(deep, None) == "x"
    many = "<article>" + "<p>a</p>" * 5000 + "</article>"
    assert H.main_text(many, json.dumps(H.infer([H.tokens(many)]))) == "\n".join(["a"] * 5000)


def test_elements_of_the_same_name_nest():
    page = lambda n: f'<body><div id="main"><div class="box"><p>In {n}</p></div><p>After {n}</p></div><div class="ads">x</div></body>'
    saved = json.dumps(H.infer([H.tokens(page(n)) for n in range(4)]))
    assert H.Wrapper(saved).match is not None
    assert H.main_text(page(9), saved) == "In 9\nAfter 9"
    # a group that closes more than it opens cannot be inside the mark
    assert H.main_span([["tag", "<", "div id=a"], ["opt", [["tag", ">", "div"]]], ["tag", ">", "div"]], "div id=a") is None
    assert H.main_span([["tag", "<", "div id=a"], ["text", None]], "div id=a") == (0, 1)


def test_repeated_containers_are_all_kept():
    nav = "<nav><div><p>menu</p></div></nav><aside><article>other</article></aside>"
    for left, right in (('<div id="main">', "</div>"), ("", ""), ("<main>", "</main>")):
        for inner in ("section", "div", "article"):
            page = lambda n, k: f"<body>{nav}{left}" + "".join(f"<{inner}><p>Block {n}.{i}</p></{inner}>" for i in range(k)) + f"{right}</body>"  # noqa: B023, E731
            saved = json.dumps(H.infer([H.tokens(page(n, 1 + n % 3)) for n in range(6)]))
            for k in (1, 2, 5):
                want = "\n".join(f"Block 9.{i}" for i in range(k))
                assert H.main_text(page(9, k), saved) == want
                assert H.main_text(page(9, k), json.dumps(H.infer([H.tokens(page(9, k))]))) == want
    two = "<article><p>A</p></article><p>between</p><div class=row><article><p>B</p></article></div>"
    assert H.main_text(two, None) == "A\nB"


def boilerplate(n, k=2):
    body = "".join(f"<p>Story {n}.{i} goes on for a while, as stories do.</p>" for i in range(k))
    return f"<body><div class=top>Site name and slogan</div><div class=content><h2>Head {n}</h2>{body}</div><div class=legal>All rights reserved by the owners of this site, which are many.</div></body>"


def story(n, k=2):
    return "\n".join([f"Head {n}", *[f"Story {n}.{i} goes on for a while, as stories do." for i in range(k)]])


def test_constants_of_a_host_are_not_its_pages_text(spark):
    rows = [(n, "https://plain.example.org/" + str(n), boilerplate(n, 1 + n % 3)) for n in range(12)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {n: story(n, 1 + n % 3) for n in range(12)}


def test_copies_of_a_page_change_nothing(spark):
    base = [(n, f"https://plain.example.org/{n}", boilerplate(n)) for n in range(6)]
    copies = base + [(1000 + i, f"https://plain.example.org/c{i}", boilerplate(3)) for i in range(300)] + [(None, None, boilerplate(4))] * 50
    one = {r.page_id: r.text for r in H.extract(spark.createDataFrame(base, "page_id long, url string, html string")).collect()}
    got = H.extract(spark.createDataFrame(copies, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got if r.page_id is not None and r.page_id < 1000} == one
    assert {r.text for r in got if r.page_id is not None and r.page_id >= 1000} == {story(3)}


def test_the_main_element_is_the_innermost_with_the_top_heading():
    inner = H.main_key(H.tokens(boilerplate(1, 30)))
    assert inner == "div class=content"
    titled = "<body><div class=page><h1>Title</h1><div class=text><p>" + "word " * 200 + "</p></div></div><div class=end>x</div></body>"
    assert H.main_key(H.tokens(titled)) == "div class=page"
    assert H.main_key(H.tokens(titled.replace("h1", "h2"))) == "div class=text"


def test_articles_keep_what_all_pages_say(spark):
    rows = [(n, "https://a.example.org/" + str(n), f"<body><p>Site</p><article><h2>Summary</h2><p>Text {n}</p></article></body>") for n in range(9)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {n: f"Summary\nText {n}" for n in range(9)}


def slow_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


def test_alignment_matches_brute_force():
    import random

    r = random.Random(4)
    for _ in range(300):
        a, b = ([r.choice("abcdef"[: r.randint(1, 6)]) for _ in range(r.randint(0, 30))] for _ in range(2))
        got = H.common(a, b)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
        assert all(a[i] == b[j] for i, j in got) and len(got) == slow_common(a, b)
        row = H.lengths(a, b)
        assert row == [slow_common(a, b[:j]) for j in range(len(b) + 1)]


def test_a_widened_wrapper_takes_all_its_pages():
    """Brute force over small streams: every page that was aligned matches."""
    import random

    r = random.Random(6)
    for _ in range(60):
        made = ["<body>" + "".join(r.choice(["<p>a</p>", "<hr>", "<b>x</b>", "t", "<ul><li>1<li>2</ul>", f"<i>{r.randint(0, 9)}</i>"]) for _ in range(r.randint(0, 9))) + "</body>" for _ in range(4)]
        nodes, _, own = H.infer([H.tokens(h) for h in made])
        w = H.Wrapper(json.dumps([nodes, "body", own]))
        for h in made:
            p = H.tokens(h)
            coded = "".join("t" if t[0] == "t" else w.code[t[0] + H.key_of(t)] for t in p)
            plain = __import__("re").compile("".join(w._regex(n) for n in json.loads(json.dumps(nodes))).replace("?+", "?").replace("++", "+"))
            assert plain.fullmatch(coded), (made, h)


def test_hostile_pages_take_time_in_proportion():
    import time

    for bad in ("<a b " * 200_000, "<a \"" * 200_000, "<!x " * 200_000, "<div>" * 100_000, "<p>" * 50_000 + "</b>" * 50_000, "<div><p>x" * 30_000):
        began = time.process_time()
        H.main_text(bad, None)
        H.main_key(H.tokens(bad))
        assert time.process_time() - began < 8
