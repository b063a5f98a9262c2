import pytest
from pyspark.sql import functions as F

from folioflow.functions import markup as M
from folioflow.operators import bodies
from folioflow.settings import Site


def run(spark, html, *steps):
    """The page after some steps on its tokens."""
    df = bodies.with_tokens(spark.createDataFrame([(html, ["Tule Lake"])], "html string, guide array<string>"))
    for step in steps:
        df = df.withColumn("tokens", step("tokens"))
    return df.select(M.render("tokens")).first()[0]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p><b>x", "<p><b>x</b></p>"),
        ("<p>a<p>b</p>c", "<p>a<p>b</p>c</p>"),
        ("<div><p>a</div>b</p>", "<div><p>a</p></div>b"),
        ("a</i>b", "ab"),
        ("a<br>b<br/>", "a<br/>b<br/>"),
        ("<div/>x", "<div></div>x"),
        ('<script>if (a<b) "</p>"</script>', '<script>if (a<b) "</p>"</script>'),
        ("&copy; &lt;b&gt; a < b &amp;c", "© &lt;b&gt; a &lt; b &amp;c"),
        ("<!DOCTYPE html><!-- c --><A HREF='x\"y' b>t</A>", "<!DOCTYPE html><!-- c --><a href='x\"y' b=\"\">t</a>"),
        ("", ""),
    ],
)
def test_tokens(spark, html, expected):
    assert run(spark, html) == expected


def test_drop_titles(spark):
    out = run(spark, '<div>Top<h1 id="t">A <i>page</i></h1></div><h2>kept</h2>', lambda t: M.drop(t, M.page_title))
    assert out == "<div>Top</div><h2>kept</h2>"


def test_drop_edit_links(spark):
    html = '<h3>History <span class="small mw-editsection"><a href="/e">edit</a></span></h3><span class="plain">s</span>'
    assert run(spark, html, lambda t: M.drop(t, M.edit_link)) == '<h3>History </h3><span class="plain">s</span>'


def test_nested_removals(spark):
    """An element inside a removed one, and one right behind it."""
    html = '<p>a</p><div class="nopublish-encycfront">b<a class="new" href="/x">c</a><img></div><a class="new" href="/y">d</a>e'
    assert run(spark, html, lambda t: M.drop(t, M.front_hidden, M.upload_link)) == "<p>a</p>e"


def test_sections(spark):
    early = '<h2><span class="mw-headline" id="Early">Early <b>years</b></span></h2>'
    sea = '<h3><span class="mw-headline" id="Sea">At sea</span></h3>'
    html = f"<p>Intro.</p>{early}<ul><li>one</li></ul>{sea}<p>two</p><h4>Plain</h4><p>three</p>"
    df = bodies.with_tokens(spark.createDataFrame([("x", html)], "page string, html string"))
    df = df.withColumn("sections", M.section_bounds("tokens"))
    out = df.withColumn("tokens", M.wrap_sections("tokens", "sections")).select(M.render("tokens")).first()[0]
    assert out == (
        f'<p>Intro.</p><div class="section" id="Early">{early}<div class="section_content"><ul><li>one</li></ul></div></div>'
        f'<div class="section" id="Sea">{sea}<div class="section_content"><p>two</p></div></div><h4>Plain</h4><p>three</p>'
    )
    rows = bodies.sections(df, "page").orderBy("section_no").collect()
    assert [(r.section_id, r.heading, r.content) for r in rows] == [("Early", "Early years", "<ul><li>one</li></ul>"), ("Sea", "At sea", "<p>two</p>")]


def test_sections_end_with_their_parent(spark):
    html = '<div><h3><span class="mw-headline" id="a">A</span></h3>x</div>y<h3><span class="mw-headline" id="b">B</span></h3>z'
    df = bodies.with_tokens(spark.createDataFrame([(html,)], "html string")).withColumn("sections", M.section_bounds("tokens"))
    out = df.withColumn("tokens", M.wrap_sections("tokens", "sections")).select(M.render("tokens")).first()[0]
    a = '<div class="section" id="a"><h3><span class="mw-headline" id="a">A</span></h3><div class="section_content">x</div></div>'
    b = a.replace('"a"', '"b"').replace("A<", "B<").replace(">x<", ">z<")
    assert out == f"<div>{a}</div>y{b}"


@pytest.mark.parametrize(
    "href, expected",
    [
        ("http://h/mediawiki/index.php?title=Nisei&action=edit&redlink=1", "http://h/mediawiki/index.php/Nisei"),
        ("http://h/index.php?title=Test_Page&pagefrom=Another+Page", "http://h/index.php/Test_Page?pagefrom=Another+Page"),
        ("http://h/index.php?title=Test_Page&pageuntil=Another+Page", "http://h/index.php/Test_Page?pageuntil=Another+Page"),
        ("http://h/?title=x", "http://h/?title=x"),
    ],
)
def test_rewritten_links(spark, href, expected):
    df = spark.createDataFrame([(href,)], "h string")
    assert df.select(M.rewrite_href("h")).first()[0] == expected


@pytest.mark.parametrize(
    "link, classes",
    [
        ('<a href="#top" class="rg">', ""),
        ('<a href="/File:x.jpg">', ""),
        ('<a href="https://e.org/" class="ext encyc">', "ext offsite"),
        ('<a href="/wiki/Tule_Lake/">', "encyc rg"),
        ('<a href="/Tule Lake">', "encyc rg"),
        ('<a href="/Manzanar" class="a">', "a encyc notrg"),
        ('<a href="/x?u=http">', "encyc notrg"),
        ('<a href="">', "encyc notrg"),
    ],
)
def test_marked_links(spark, link, classes):
    out = run(spark, link + "t</a>", lambda t: M.mark_links(t, "/wiki", "guide"))
    assert f'class="{classes}"' in out


def test_links_without_href_stay(spark):
    assert run(spark, '<a name="x">t</a>', lambda t: M.mark_links(t, "/wiki", "guide")) == '<a name="x">t</a>'


def test_drop_status_markers(spark):
    html = '<p>BEFORE</p><div class="alert alert-success published"><p>done</p></div><div class="alert">stays</div>'
    assert run(spark, html, lambda t: M.drop(t, M.status_marker)) == '<p>BEFORE</p><div class="alert">stays</div>'


def test_top_links(spark):
    html = "".join(f"<h2>HEADER{i}</h2><p>P{i}</p>" for i in range(1, 5))
    out = run(spark, html, M.add_top_links)
    assert out == (
        "<h2>HEADER1</h2><p>P1</p><h2>HEADER2</h2><p>P2</p>"
        + M.TOP_LINK + "<h2>HEADER3</h2><p>P3</p>" + M.TOP_LINK + "<h2>HEADER4</h2><p>P4</p>" + M.TOP_LINK
    )


def test_source_images(spark):
    one, two = "en-archive-i37-00239-1", "en-archivevh-ffrank-01-0025-1"
    html = "".join(
        f'<div><a href="/File:{n}.jpg" class="image"><img src="/images/thumb/a/a1/{n}.jpg/200px-{n}.jpg"  /></a></div>' for n in (one, two)
    )
    df = bodies.with_tokens(spark.createDataFrame([(html, [one, "x"])], "html string, ids array<string>"))
    df = df.withColumn("tokens", M.drop("tokens", M.source_image("tokens", "ids")))
    out = df.select(M.render("tokens")).first()[0]
    assert out.startswith("<div></div><div><a") and two in out


def test_hidden_tags(spark):
    html = '<div id="x">a<div id="x">b</div></div><p class="k x">c</p>'
    assert run(spark, html, lambda t: M.hide_tags(t, "id=x")) == '<!--"x" removed--><p class="k x">c</p>'
    assert run(spark, html, lambda t: M.hide_tags(t, "class=k", comments=False)) == html.split("<p")[0]


def test_upload_links_and_front_hidden(spark):
    html = '<a class="new" href="/x">u</a><div class="y nopublish-encycfront">z</div>k'
    assert run(spark, html, lambda t: M.drop(t, M.upload_link, M.front_hidden)) == "k"
    df = bodies.with_tokens(spark.createDataFrame([(html,), ("<p>",)], "html string"))
    assert sorted(r[0] for r in df.select(M.not_published_encyc("tokens")).collect()) == [False, True]


def test_empty_paragraphs(spark):
    html = "<p><br />\n</p>a<p><br/>\n</p><p><br />\n x</p>"
    out = run(spark, html, lambda t: M.drop(t, M.empty_paragraph(t)))
    assert out == "a<p><br/>\n</p><p><br/>\n x</p>"


@pytest.mark.parametrize("stub", ["/mediawiki/index.php", "/mediawiki", ""])
def test_wiki_paths(spark, stub):
    df = spark.createDataFrame([(f'<a href="http://e.com{stub}/Page Title">',)], "h string")
    assert df.select(M.strip_wiki_paths("h")).first()[0] == '<a href="http://e.com/Page Title">'


def test_bare_tags(spark):
    df = spark.createDataFrame([('<html><body><p>Some text</p></body></html><body class="x">',)], "h string")
    assert df.select(M.strip_bare_tags("h")).first()[0] == '<p>Some text</p><body class="x">'


def test_databoxes(spark):
    html = """<div id="databox-Books" style="display:none;"><p>Title:A: B;
Illustrator:;
X: y
no colon
TITLE:C;
<i>K</i>:v
</p><p>z:1</p></div><div id="databox-Films" style="display: none;"><p>a:b</p></div><div id="databox-Empty" style="display:none;"></div>"""
    tokens = bodies.with_tokens(spark.createDataFrame([("p", html)], "page string, html string"))
    rows = bodies.databox_table(tokens, "page").filter("pos is not null").orderBy("pos").collect()
    assert [(r.databox, r.name, r.raw, r.parts) for r in rows] == [
        ("databox-Books", "title", "C;", ["C"]),
        ("databox-Books", "illustrator", ";", []),
        ("databox-Books", "x", " y", None),
        ("databox-Books", "<i>k</i>", "v", None),
    ]
    named = bodies.databox_table(tokens, "page", ["databox-Films", "databox-None"]).collect()
    assert [(r.databox, r.name) for r in named] == [("databox-Films", "a")]
    names, odd, errors = bodies.databox_report(tokens, "page")
    assert [r[0] for r in names.collect()] == ["databox-Books", "databox-Empty"]
    assert [(r.page, r.databox) for r in odd.collect()] == [("p", "databox-Books")]
    assert [(r.databox, r.error) for r in errors.collect()] == [("databox-Empty", "no paragraph")]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p></p><p>a;\nb</p><p> First <b>one</b>. </p><p>Second</p>", "First one."),
        ("<p>\n</p><p>x</p>", ""),
        ("<div>x</div>", ""),
        ("<p>a<p>b", "ab"),
    ],
)
def test_description(spark, html, expected):
    df = bodies.with_tokens(spark.createDataFrame([(html,)], "html string"))
    assert df.select(M.description("tokens")).first()[0] == expected


def test_clean_bodies_by_list_and_by_table(spark):
    pages = spark.createDataFrame([("p", '<h1>T</h1><p>a <a href="/wiki/Tule_Lake">l</a></p>')], "url_title string, html string")
    guide = spark.createDataFrame([("Tule Lake",)], "id string")
    expected = '<p>a <a href="/wiki/Tule_Lake" class="encyc rg">l</a></p>'
    # A long list is turned into a table.
    for given in (["Tule Lake"], guide, [*map(str, range(2000)), "Tule Lake"]):
        assert bodies.clean_bodies(pages, given, printed=True).first().body == expected


def test_migration_keeps_status_markers(spark):
    pages = spark.createDataFrame([("p", '<div class="alert published">x</div>')], "url_title string, html string")
    site = Site(hidden_tags=[])
    assert bodies.clean_bodies(pages, site=site, printed=True, migration=True).first().body == '<div class="alert published">x</div>'
    assert bodies.clean_bodies(pages, site=site, printed=True).first().body == ""


def test_scrub(spark):
    docs = spark.createDataFrame([("p", '<div class="alert published">x</div><p>y</p>'), ("q", None)], "url_title string, body string")
    assert {r.url_title: r.body for r in bodies.scrub_bodies(docs).collect()} == {"p": "<p>y</p>", "q": None}


def test_guide_titles_with_underscores(spark):
    links = spark.createDataFrame([(t, "/" + t) for t in ("A_b", "A b", "C_d", "C d", "E_f_g", "")], "title string, href string")
    guide = spark.createDataFrame([("A b",), ("C_d",), ("E_f g",), ("",)], "id string")
    out = {r.title: r.in_guide for r in bodies.classify_links(links, guide).collect()}
    assert out == {"A_b": True, "A b": True, "C_d": True, "C d": False, "E_f_g": False, "": False}


def test_links_without_tokens(spark):
    html = '<a HREF="/wiki/X_y/" href="/b">x</a><A href>y</A><a name="n">z</a><script><a href="/no"></script><!-- <a href="/c"> --><a href="/q&amp;r"/>'
    pages = spark.createDataFrame([("p", html), ("q", None), ("r", ""), ("s", "<a href='/wiki/T'>" * 3)], "page string, html string")
    lean = bodies.linked_titles(pages, "page", "/wiki")
    whole = bodies.page_links(bodies.with_tokens(pages), "page", "/wiki").drop("pos")
    assert lean.columns == whole.columns
    assert sorted(lean.collect()) == sorted(whole.collect()) and lean.count() == 6


def test_guide_tables_short_and_long(spark):
    html = '<p><a href="/wiki/T_1">a</a><a href="/wiki/T 2/">b</a><a href="/wiki/U">c</a><a href="/">d</a></p>'
    pages = spark.createDataFrame([("p", html), ("p", '<a href="/wiki/U">c</a>'), (None, html)], "url_title string, html string")
    titles = spark.createDataFrame([("T 1",), ("T 2",), ("T 2",), (None,), ("",)], "id string")
    more = titles.union(spark.range(bodies.LITERAL_TITLES + 1).selectExpr("concat('x', id)"))
    assert bodies.short_titles(titles) == ["", "T 1", "T 2"] and bodies.short_titles(more) is None
    short, long = bodies.clean_bodies(pages, titles, printed=True), bodies.clean_bodies(pages, more, printed=True)
    assert sorted(short.collect(), key=repr) == sorted(long.collect(), key=repr)
    assert sorted(r.body.count('"encyc rg"') for r in short.collect()) == [0, 0, 2]
    # Pages are tokenized once, and for a short guide not read for their links before.
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (short, long)]
    assert [(p.count("ArrowEvalPython [tokens("), p.count("ArrowEvalPython [hrefs(")) for p in plans] == [(1, 0), (1, 1)]
