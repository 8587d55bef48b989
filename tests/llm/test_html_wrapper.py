import random

from helpers_llm import clashing

from streetflow.llm import html_wrapper as H

SCHEMA = "page_id long, url string, html string"


def run(spark, rows, **options):
    return {r["page_id"]: r["text"] for r in H.extract(clashing(spark.createDataFrame(rows, SCHEMA)), **options).collect()}


def page(body, title="T"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def text_of(html):
    return "\n".join(t for t, _ in H.candidates(html)[0])


def test_furniture_goes_and_blocks_join():
    html = page("""
      <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/x>Menu</a></ul></nav>
      <!-- ad --><div class="ad box">Buy!</div><div class="cookie-notice">We use cookies</div>
      <article><header><h1>The&nbsp;Title</h1></header><p>First <b>bold</b>
         and   <a href="x">linked</a> text&amp;more &#233; &#x1F600;<p>Second<br>line
         <aside>side</aside><script>var t="</p>";</script><ul><li>one<li>two</ul>
         <form><input value=x>Sign up</form><div id="comments"><p>A reader says</p></div></article>
      <div role="complementary">related</div><footer>&copy; site</footer>""")
    assert text_of(html) == "The Title\nFirst bold and linked text&more é 😀\nSecond line\none\ntwo"


def test_pages_without_article_and_broken_pages():
    assert text_of(page("<div>Some text <i>here</i></div><div><a>a</a> <a>b</a></div><p>More")) == "Some text here\nMore"
    assert text_of("just text & no tags < 3") == "just text & no tags < 3"
    assert text_of("<article><p>cut <b>off<br><p>in the mid") == "cut off\nin the mid"
    assert text_of("<article><p title='a > b'>x</p><table><tr><td>1<td>2<tr><td>3</table>") == "x\n1\n2\n3"
    assert text_of("<p>never closed <script> all the rest <p>lost") == "never closed"
    assert text_of("") == "" and text_of("<!-- only") == "" and text_of("<article></article>") == ""


def test_simple_tree_matching_is_the_largest():
    """Against trying every order-preserving choice."""
    rng = random.Random(1)

    def tree(depth):
        s = H.Slot(rng.choice("ab"))
        s.children = [tree(depth - 1) for _ in range(rng.randrange(4))] if depth else []
        return s

    def best(a, b):
        if a.kind != b.kind:
            return 0

        def rows(x, y):
            if not x or not y:
                return 0
            return max(rows(x[1:], y), rows(x, y[1:]), best(x[0], y[0]) + rows(x[1:], y[1:]))

        return 1 + rows(a.children, b.children)

    for _ in range(300):
        a, b = tree(3), tree(3)
        reference = H.load(H.json.dumps(H.dump(b)))
        assert len(H.match(a, reference)) == best(a, b)


def test_template_texts_of_a_host_go(spark):
    """Texts that all pages of a host show at one slot are template even inside the article."""
    rows = []
    for i in range(40):
        own = f"<p>Story {i} says things</p>" * (i % 3 + 1)
        rows.append((i, "https://news.example/a", page(
            f"<article><h1>Head {i}</h1><div><span>Join our list today</span></div><section>{own}</section></article>")))
        rows.append((100 + i, "https://other.example/a", page(
            f"<article><h1>Head {i}</h1><section><p>Common words {i % 2}</p>{own}</section></article>")))
    # copies of one page are one witness, not many
    rows += [(200 + i, f"https://copies.example/{i}", page("<article><h1>Same</h1><p>Copied</p></article>")) for i in range(30)]
    got = run(spark, rows)
    for i in range(40):
        story = "\n".join([f"Story {i} says things"] * (i % 3 + 1))
        assert got[i] == f"Head {i}\n{story}"
        assert got[100 + i] == f"Head {i}\nCommon words {i % 2}\n{story}"
        assert got[200 + i % 30] == "Same\nCopied"
    # with too little to broadcast the wrappers, the join gives the same
    assert run(spark, rows, broadcast_bytes=0) == got


def test_edge_cases(spark):
    rows = [(1, None, "<p>a</p>"), (2, "https://x/", None), (3, "https://x/", ""), (None, "no host", "<p>b</p>"),
            (4, "https://x/", "<p>c</p>"), (4, "https://x/", "<p>c</p>"), (5, "//y", "<div>" * 3000 + "deep"),
            (6, "https://x/", "<article><p>" + "word " * 100000 + "</p></article>")]
    out = H.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(((r["page_id"] or 0, r["text"][:10]) for r in out))
    assert got == [(0, "b"), (1, "a"), (2, ""), (3, ""), (4, "c"), (4, "c"), (5, "deep"), (6, "word word ")]
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages_that_open_alike_are_different_pages(spark):
    """A fixed or categorical first block does not make copies of a host's pages."""
    rows = [(i, "https://kicker.example/a", page(
        f"<article><span class=kick>{['News', 'Exclusive'][i % 2]}</span><h1>Head {i}</h1>"
        "<div><span>Join our list today</span></div></article>")) for i in range(40)]
    got = run(spark, rows)
    assert all(got[i] == f"{['News', 'Exclusive'][i % 2]}\nHead {i}" for i in range(40))


def test_blocks_that_the_reference_page_lacks(spark):
    """A block on other pages is template whichever page is the reference; so are those of a host with stub pages."""
    promo = "<div class=box><span>Join our list today</span></div>"
    rows = [(100 * h + i, f"https://h{h}.example/a", page(
        f"<article><h1>Head {h} {i}</h1>{promo * (i % 4 != 0)}<section><p>Story {h} {i}</p></section></article>"))
        for h in range(8) for i in range(40)]
    stubs = ["", " ", "<html></html>", "<p>Error 500</p>"]
    rows += [(2000 + 100 * h + i, f"https://s{h}.example/a", stubs[h % 4] if i % 2 else page(
        f"<article><h1>Head {h} {i}</h1>{promo}</article>")) for h in range(8) for i in range(40)]
    got = run(spark, rows)
    for h in range(8):
        assert all(got[100 * h + i] == f"Head {h} {i}\nStory {h} {i}" for i in range(40))
        assert all(got[2000 + 100 * h + i] == f"Head {h} {i}" for i in range(0, 40, 2))


def test_deep_elements_keep_their_marks_and_ends(spark):
    deep = "<div>" * 300 + "<nav>Menu</nav><p>Deep</p>" + "</div>" * 300
    html = page(f"<div><article><h1>Head</h1>{deep}<p>After</p></article></div>")
    assert text_of(html) == "Head\nDeep\nAfter"
    very = page("<article>" + "<div>" * 20000 + "<aside>x</aside>in" + "</div>" * 20000 + "<p>out</p></article>")
    assert text_of(very) == "in\nout"
    rows = [(i, "https://deep.example/", page(f"<article>{'<div>' * 2000}<p>Own {i}</p><b>Join us</b>"
                                              f"{'</div>' * 2000}</article>")) for i in range(10)]
    assert run(spark, rows) == {i: f"Own {i}" for i in range(10)}


def test_many_children_are_matched_as_largely_as_few(monkeypatch):
    rng = random.Random(2)

    def slots(n):
        top = H.Slot("")
        for _ in range(n):
            c = H.Slot(rng.choice("abc"))
            c.children = [H.Slot(rng.choice("de")) for _ in range(rng.randrange(3))]
            top.children.append(c)
        return top

    for n, m in ((60, 70), (130, 40)):
        a, b = slots(n), H.load(H.json.dumps(H.dump(slots(m))))
        monkeypatch.setattr(H, "_PAIRS", 1 << 30)
        table = H.match(a, b)
        monkeypatch.setattr(H, "_PAIRS", 0)
        assert H.match(a, b) == table
    monkeypatch.undo()
    # one more child at the front does not end the matching of a long list
    body = [k for _ in range(1100) for k in ("p", "h2")]
    a, b = H.Slot(""), H.Slot("")
    a.children, b.children = [H.Slot(k) for k in ["x", *body]], [H.Slot(k) for k in body]
    assert len(H.match(a, H.load(H.json.dumps(H.dump(b))))) == 2201


def test_marks_are_tokens_of_class_id_and_role():
    """Neither other attributes nor parts of words nor places in the text mark boilerplate."""
    for attributes in ('style="overflow:hidden"', 'aria-hidden="false"', 'title="the hidden cost"', 'data-id="related"',
                       'class="text-navy"', 'class="navy"', 'data-hidden="x"', 'title="class=nav"'):
        assert text_of(f"<article><h1>T</h1><p {attributes}>Body text.</p></article>") == "T\nBody text.", attributes
    assert text_of('<article><h2 id="related-work">R</h2><section id="search"><p>S.</p></section></article>') == "R\nS."
    for attributes in ('class="nav"', 'class="x top-nav"', 'id="cookie-banner"', "role=navigation", "hidden", 'CLASS="Ad"'):
        assert text_of(f"<article><p>Body.</p><div {attributes}>Away.</div></article>") == "Body.", attributes


def test_articles_inside_marked_elements_and_several():
    for around in ('<div class="content has-sidebar">%s</div>', '<div class="post comments-open">%s</div>',
                   "<form>%s</form>", '<div class="widget">%s</div>'):
        page = "<body><nav>Menu</nav>" + around % "<article><p>Text.</p><form>Send</form></article>" + "<footer>F</footer></body>"
        assert text_of(page) == "Text.", around
    assert text_of("<article><p>A.</p></article><article><p>B is longer.</p></article>") == "A.\nB is longer."
    assert text_of("<article><p>A.</p></article><aside><article><p>Teaser.</p></article></aside>") == "A."
    assert text_of('<article><p>A.</p></article><div class="comments"><article><p>I think.</p></article></div>') == "A."
    assert text_of("<main><p>Lead.</p><article><p>A.</p></article></main>") == "A."
