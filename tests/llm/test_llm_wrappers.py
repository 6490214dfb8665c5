import html as H
import re

from conftest import SF001

from eventsieve.llm import wrappers

PAGE = ('<!DOCTYPE html><html><head><title>t</title><style>p{a:"</p>"}</style><script>var t="</p><article>x";</script></head><body>'
        '<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>Menu</ul></nav><!-- <article>no</article> -->'
        '<div class="cookie-notice">We use cookies</div>{main}<aside>side</aside><form><p>Mail<input name=a></form>'
        '<section id="comments"><p>first!</p></section><footer>&copy; me</footer></body></html>')


def test_article_only():
    main = ('<article class="post"><header><h1>A &amp;amp; B</h1></header><p>One  <b>bo</b>ld<br>line<p>Two &lt;x&gt; &#233;\n<div class="ad">buy</div>'
            '<ul><li>i<li>j</ul><div class="share">share</div><table><tr><td>c1<td>c2</table><form>f</form><aside>q</aside></article>')
    text = "A &amp; B\n\nOne bold line\n\nTwo <x> é\n\ni\n\nj\n\nc1\n\nc2"
    assert wrappers.main_text(PAGE.replace("{main}", main), None) == text
    pages = [PAGE.replace("{main}", main.replace("One", f"One{k}") + "<p>x</p>" * k) for k in range(4)]
    w = wrappers.Wrapper(wrappers.infer(pages))
    assert wrappers.main_text(pages[2], w) == text.replace("One", "One2")
    assert wrappers.main_text(PAGE.replace("{main}", main)[:-60], w) == text


def test_slots_are_main_text_without_an_article():
    pages = [PAGE.replace("{main}", f"<div><h2>T{k}</h2><p>body {k}</p></div><div><span>Read more on our site</span></div>") for k in range(5)]
    w = wrappers.Wrapper(wrappers.infer(pages))
    assert wrappers.main_text(pages[3], w) == "T3\n\nbody 3"


def test_wrapper_has_optional_and_repeated_groups():
    pages = ["<div><p>a</p><p>b</p><p>c</p></div>", "<div><h2>t</h2><p>x</p></div>"]
    shapes = [(s, o) for s, _, o, _ in wrappers.infer(pages)]
    assert ("(p body,#body,/p)+", False) in shapes and ("h2 body", True) in shapes


def test_driver_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")

    def plain(html):
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(H.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        return "\n\n".join(b for b in blocks if b)

    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    got = wrappers.extract(pages)
    assert {r["page_id"]: r["text"] for r in got.collect()} == want
    assert got.filter("n_chars != length(text)").count() == 0


def test_odd_pages(spark):
    rows = [(1, None, "<article>x</article>", "c"), (2, "http://h.example/a", None, "c"), (2, "http://h.example/a", None, "c"), (None, "no url", "", None),
            (4, "http://h.example/b", "plain < text & more", "c"), (5, "http://h.example/c", "<article><p>" + "long text " * 50_000, "c"),
            (6, "http://h.example/d", "<script>only", "c"), (7, "http://h.example/e", "</div></p><p", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, wrapper string")
    got = {(r["page_id"], r["text"]) for r in wrappers.extract(df).collect()}
    assert {(1, "x"), (2, ""), (None, ""), (6, ""), (5, ("long text " * 50_000).strip())} <= got
    assert wrappers.extract(df).count() == 8 and wrappers.extract(df.limit(0)).count() == 0


def test_a_text_of_one_sampled_page_is_kept():
    pages = [PAGE.replace("{main}", f"<div><h2>T{k}</h2><p>body {k}</p></div>" + "<blockquote>rare</blockquote>" * (k == 2)
                          + "<div><span>Read more</span></div>") for k in range(6)]
    w = wrappers.Wrapper(wrappers.infer(pages))
    assert wrappers.main_text(pages[2], w) == "T2\n\nbody 2\n\nrare"
    assert wrappers.main_text(pages[2].replace("rare", "other"), w) == "T2\n\nbody 2\n\nother"


def test_pages_without_an_article_on_a_mixed_host():
    plain = [PAGE.replace("{main}", f"<div><h2>T{k}</h2><p>body {k}</p></div><div><span>Read more</span></div>") for k in range(4)]
    w = wrappers.Wrapper(wrappers.infer([*plain, *(PAGE.replace("{main}", f"<article><p>a {k}</p></article>") for k in range(4))]))
    assert wrappers.main_text(plain[1], w) == "T1\n\nbody 1"
    assert wrappers.main_text(PAGE.replace("{main}", "<article><p>new</p></article>"), w) == "new"


def test_hidden_and_marks_are_whole_words():
    for attrs in ("class='overflow-hidden'", "aria-hidden='false'", "data-hidden='0'", "class=no-comments", "id='has-menu'"):
        assert wrappers.main_text(f"<body><article {attrs}><p>x</p></article></body>", None) == "x", attrs
    for attrs in ("hidden", "class=a hidden", "hidden=''", "aria-hidden='true'", "style='display: none'"):
        assert wrappers.main_text(f"<body><p>x</p><div {attrs}>y</div></body>", None) == "x", attrs
    for name in ("content with-sidebar", "sidebar", "has-menu", "widget"):
        assert wrappers.main_text(f"<body><div class='{name}'><p>y</p><article><p>x</p></article></div></body>", None) == "x", name
    assert wrappers.main_text("<body><div class='with-sidebar'><p>x</p></div><div class='cookie-notice'>y</div></body>", None) == "x"
    assert wrappers.main_text("<body><article>x<div class='related'><article>y</article></div></article></body>", None) == "x"


def article(k, extra="", title=None):
    body = "".join(f"<p>body {k} {j} {'word ' * (k + j)}</p>" for j in range(2 + k % 3))
    return PAGE.replace("{main}", f"<article><h1>{title or f'T{k}'}</h1>{body}{extra}</article>")


def test_template_texts_inside_an_article_go():
    note = "<div class='box'><p>Read more on our site and tell your friends</p></div>"
    pages = [article(k, note if k % 4 else "") for k in range(12)]
    w = wrappers.Wrapper(wrappers.infer(pages))
    for k in range(12):
        assert wrappers.main_text(pages[k], w) == wrappers.main_text(article(k), None)
    assert "Read more" in wrappers.main_text(pages[1], None)
    assert wrappers.main_text(article(40, note), w) == wrappers.main_text(article(40), None)
    only = PAGE.replace("{main}", "<article>" + note + "</article>")  # nothing else: the article stays
    assert wrappers.main_text(only, w) == wrappers.main_text(only, None)


def test_copies_of_an_article_are_not_its_template():
    pages = [article(5) + f"<!-- print {k} -->" for k in range(6)] + [article(k) for k in range(6, 10)]
    w = wrappers.Wrapper(wrappers.infer(pages))
    for page in pages:
        assert wrappers.main_text(page, w) == wrappers.main_text(page, None)


def test_several_layouts_of_a_host_in_spark(spark):
    note = "<p>Read more on our site and tell your friends</p>"
    html = [article(k, f"<section>{note}</section>") for k in range(6)]
    html += [PAGE.replace("{main}", f"<div class=layout><h2>P{k}</h2><p>plain {k}</p></div><div><span>Read more</span></div>") for k in range(6)]
    rows = [(i, f"http://{h}.example/{i}", x) for h in ("a", "b") for i, x in enumerate(html)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = [wrappers.main_text(article(k), None) for k in range(6)] + [f"P{k}\n\nplain {k}" for k in range(6)]
    got = {(r["page_id"], r["url"]): r["text"] for r in wrappers.extract(df).collect()}
    assert got == {(i, u): want[i] for i, u, _ in rows}


def test_a_large_host_is_dealt_by_its_size(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "HOT_PAGES", 10)
    rows = [(i, "http://big.example/x" if i % 3 else f"http://h{i}.example/x", article(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts = wrappers.host_counts(wrappers.host_pages(df))
    assert [tuple(r) for r in wrappers._hot(counts).collect()] == [("big.example", 14)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    assert got == {i: wrappers.main_text(x, None) for i, _, x in rows}
