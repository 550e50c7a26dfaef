import pytest

from weftline.llm.htmltext import Page, Template, extract, main_texts


def page(i, body, menu=("Home", "News", "About"), extra=""):
    links = "".join(f'<li><a href="/{m}">{m}</a></li>' for m in menu)
    return f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t="</p>";x({i});</script></head><body><nav><ul>{links}</ul></nav><!-- ad {i} --><div class="ad">Buy {i}</div>{extra}<article><h1>Head {i}</h1>{body}</article><footer>&copy; host &middot; words {i}</footer>'


def test_article_only():
    pages = [page(i, f"<p><b>First {i}<br><p>A&amp;B&nbsp; caf&eacute;\n <i>x</i>y {i}</p><script>no()</script><p></p>") for i in range(5)]
    assert main_texts(pages) == [f"Head {i}\n\nFirst {i}\n\nA&B café xy {i}" for i in range(5)]


def test_furniture_within_and_around():
    inner = '<p>One</p><div class="advert-box">Ad</div><aside>Side</aside><form><p>Mail</p></form><section id="comments"><p>Reader</p></section><p>Two</p>'
    assert main_texts([page(1, inner, extra='<header>Site</header><div id="cookie-notice">Cookies</div>')]) == ["Head 1\n\nOne\n\nTwo"]


def test_copies_keep_their_text():
    assert main_texts([page(1, "<p>Same</p>")] * 6) == ["Head 1\n\nSame"] * 6


def test_template_within_main_is_dropped_without_names():
    box = '<div class="x7"><p>Anna writes for us.</p></div><p>All rights <i>remain</i>.</p>'
    pages = [page(i, f"<p>Text {i}</p>{'<p>Twice</p>' * (1 + i % 2)}{box}<p>End of {i}</p>") for i in range(5)]
    assert main_texts(pages) == [f"Head {i}\n\nText {i}\n\nEnd of {i}" for i in range(5)]
    assert main_texts([*pages, "", None])[:5] == main_texts(pages)
    assert main_texts([p.replace("<article>", f"<article class='post-{i}'>") for i, p in enumerate(pages)]) == main_texts(pages)
    # pages that share most are near copies, and a counter doesn't make a copy another article
    near = [page(1, f"<p>One long shared paragraph here.</p><p>{x}</p>") for x in "abcd"]
    assert main_texts(near) == [f"Head 1\n\nOne long shared paragraph here.\n\n{x}" for x in "abcd"]


def test_without_a_named_main_container():
    def plain(i):
        return f'<html><body><div class="top"><a href="/a">Alpha</a> <a href="/b">Beta</a></div><div class="c{0}"><p>Long text number {i} goes on and on.</p><p>More of {i}.</p></div><div class="bottom">fine print</div></body></html>'

    assert main_texts([plain(i) for i in range(6)]) == [f"Long text number {i} goes on and on.\n\nMore of {i}." for i in range(6)]


def test_pages_without_main_beside_pages_with_one():
    def plain(i):
        return f'<html><body><div class="top"><p>Site title</p></div><div class="c"><p>Long text number {i} goes on and on.</p><p>More of {i}.</p></div><div class="cc"><p>fine print</p></div></body></html>'

    alone = [f"Long text number {i} goes on and on.\n\nMore of {i}." for i in range(4)]
    assert main_texts([plain(i) for i in range(4)]) == alone
    named = [page(i, f"<p>Text {i}</p>") for i in range(4)]
    empty = '<html><body><div class="top"><p>Site title</p></div><article><p> </p></article><div class="bottom"><p>fine print</p></div></body></html>'
    texts = [f"Head {i}\n\nText {i}" for i in range(4)]
    assert main_texts([*(plain(i) for i in range(4)), *named, empty]) == [*alone, *texts, ""]
    assert main_texts([plain(2), *named]) == [alone[2], *texts] and main_texts([empty]) == [""]


@pytest.mark.parametrize("old, new", [("<body>", "<body class='no-sidebar'>"), ("<article>", "<div class='content has-sidebar'><article>"), ("<article>", "<article class='post comments-open'>")])
def test_a_name_alone_does_not_drop_an_article(old, new):
    inner = '<p>A text of some length, number {0}.</p><div class="advert-box"><p>Ad {0}</p></div><section id="comments"><p>Reader {0}</p></section>'
    teaser = '<div class="related"><article class="t">Teaser</article></div>'
    pages = [page(i, inner.format(i), extra=teaser).replace(old, new) for i in range(4)]
    want = [f"Head {i}\n\nA text of some length, number {i}." for i in range(4)]
    assert main_texts(pages) == want and main_texts(pages[2:3]) == want[2:3]


def test_a_name_on_a_page_without_main():
    def plain(i):
        return f'<html><body class="no-sidebar"><div class="menu-bar"><p>Menu {i}</p></div><div class="c"><p>Long text number {i} goes on and on.</p></div></body></html>'

    assert main_texts([plain(i) for i in range(4)]) == [f"Long text number {i} goes on and on." for i in range(4)]


@pytest.mark.parametrize("source", [None, "", "   ", "<", "<p", "<!-- open", "<script>never", "a < b & c", "</p></p>", "<p>x" * 3000, "<b>" * 2000])
def test_broken_markup(source):
    assert isinstance(main_texts([source])[0], str)
    assert main_texts([source, source]) == main_texts([source]) * 2


def test_classes_and_slots():
    pages = [Page(page(i, "<p>x</p>" * (i + 1), menu=[f"m{j}" for j in range(3)])) for i in range(4)]
    for p in pages:
        p.place(set())
    t = Template(pages)
    assert [k.split("|")[0] for k in t.root][:5] == ["html", "head", "/head", "body", "nav"]
    assert len(t.repeated) >= 1  # the menu's items nest in one slot


def test_table(spark):
    rows = [(i, f"http://h{i % 3}.example/{i}", page(i, f"<p>Text {i}</p>"), "x") for i in range(40)]
    rows += [(100, None, None, "x"), (101, "no url", "", "x"), (102, "http://h0.example/0", "<p>stray", "x"), (1, rows[1][1], rows[1][2], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.url or "", r.text, r.n_chars) for r in extract(df, group=5).collect())
    assert len(got) == len(rows)
    by = {(g[0], g[1]): g[2] for g in got}
    assert all(by[(i, f"http://h{i % 3}.example/{i}")] == f"Head {i}\n\nText {i}" for i in range(40))
    assert by[(100, "")] == "" and by[(101, "no url")] == "" and all(len(g[2]) == g[3] for g in got)
    assert extract(df.limit(0)).count() == 0


def test_markup_that_is_not_well_quoted():
    assert main_texts(["<main><p title=it's>Hello don't stop</p><p>next</p></main>"]) == ["Hello don't stop\n\nnext"]
    assert main_texts(["<main><script src=x />var a=1;</script><svg/><p>Text</p></main>"]) == ["Text"]
    assert main_texts(["<main><p data-x='a>b' y=\"c>d\" z>Text</p></main>"]) == ["Text"]


@pytest.mark.parametrize("open_, close", [('<div class="social-science"><p>', "</p></div>"), ('<h2 class="banner-title">', "</h2>"), ('<p>A <q class="label search">', "</q></p>"), ('<p class="x-notice-board">', "</p>")])
def test_names_that_only_sound_like_furniture(open_, close):
    pages = [f"<article><p>A first paragraph, number {i}.</p>{open_}more {i}{close}<p>The last of {i}.</p></article>" for i in range(4)]
    for texts in (main_texts(pages), main_texts(pages[:1])):
        assert all(f"more {i}" in t and "last of" in t for i, t in enumerate(texts))


def hashed(i, n=3):
    """No name tells anything: classes are hashes, and so is one that changes from page to page."""
    menu = "".join(f'<span><a href="/{m}">{m}</a></span>' for m in "abcdef")
    body = "".join(f"<div class='k{i}z9'>Paragraph {j} of page {i} tells its own story, {i * j + 7} words long.</div>" for j in range(n + i % 3))
    return f'<body><div class="q1">{menu}</div><div class="q2"><div>We use what you let us use.</div></div><div class="w{i}"><h1>Story {i}</h1><div class="q4">{body}<div class="q5">Anna wrote this for all of you.</div></div></div><div class="q6"><div>Imprint of {i}</div></div></body>'


def test_the_template_decides():
    """Without names the slots alone find the article; without a template there is no telling."""
    pages = [hashed(i) for i in range(6)]
    want = [f"Story {i}\n\n" + "\n\n".join(f"Paragraph {j} of page {i} tells its own story, {i * j + 7} words long." for j in range(3 + i % 3)) for i in range(6)]
    assert main_texts(pages) == want
    assert all("Anna" in t for p in pages for t in main_texts([p]))


def brute_classes(token_lists):
    """Classes of equal occurrence vectors by comparing every token with every other."""
    vector = lambda t: tuple(x.count(t) for x in token_lists)
    every = {t for x in token_lists for t in x if all(t in y for y in token_lists)}
    return {frozenset(u for u in every if vector(u) == vector(t)): vector(t) for t in every}


@pytest.mark.parametrize("make", [lambda i: page(i, "<p>x y</p>" * (i + 1)), hashed])
def test_deduction_equals_brute_force(make):
    pages = [Page(make(i)) for i in range(5)]
    for p in pages:
        p.place(set())
    t = Template(pages)
    classes = brute_classes(t.tokens)
    once = next(c for c, v in classes.items() if v == (1,) * 5)
    assert set(t.root) <= once
    orders = [[x for x in y if x in once] for y in t.tokens]
    if all(o == orders[0] for o in orders):
        assert set(t.root) == once
    # root tokens ascend in every page, and none that always stands between its neighbours was left out
    assert all([x for x in y if x in t.number] == t.root for y in t.tokens)
    for left in once - set(t.root):
        assert not any(all([x for x in y if x in t.number or x == left] == t.root[:k] + [left] + t.root[k:] for y in t.tokens) for k in range(len(t.root) + 1))
    # every slot's text is what stands between two root tokens
    for i, (p, tokens) in enumerate(zip(pages, t.tokens)):
        gaps, k = {}, 0
        for x in tokens:
            if x in t.number:
                k = t.number[x]
            elif x[0] == "'":
                gaps[k] = gaps.get(k, 0) + len(x.split("|")[0]) - 1
        got = {}
        for _, _, _, own in t.placed(i, p.steps):
            for s, n in own.items():
                got[s] = got.get(s, 0) + n
        assert got == gaps
