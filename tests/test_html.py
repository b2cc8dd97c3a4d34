from pyspark.sql import functions as F

from siftweb.functions import html as H
from siftweb.functions.urls import LinkConstraint
from siftweb.operators import nodes as N

PAGE = (
    "<!DOCTYPE html><html lang=\"de\"><head><title>T &amp; U</title>"
    "<style>p{x:1}</style><script>var a='<a  href=\"/js/link\" >';</script></head>"
    "<body><!-- <a href=\"/hidden\">x</a> --><p>  Erste   Zeile </p><p>zwei&nbsp;</p>"
    "<a href=\"/a\">A</a><a name=\"x\">no href</a><a href='rel/b'>B</a>"
    "<div>&lt;b&gt; &amp;amp;</div></body></html>"
)


def _one(spark, html, url="http://h.example.com/dir/page"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_extraction(spark):
    df = _one(spark, PAGE).select(H.clean_html(F.col("html")).alias("c"), "html")
    r = df.select(H.title(F.col("c")).alias("t"), H.language(F.col("c")).alias("l"),
                  H.segments(F.col("c")).alias("s"), H.anchor_hrefs(F.col("c")).alias("a"),
                  H.script_hrefs(F.col("html")).alias("js")).first()
    assert r.t == "T & U"
    assert r.l == "de"
    assert r.s == ["T & U", "Erste   Zeile", "zwei", "A", "no href", "B", "<b> &amp;"]
    assert r.a == ["/a", "rel/b"]
    assert r.js == ["/js/link"]


def test_script_link_quirk(spark):
    df = spark.createDataFrame([("<a  href=\"xyz\" >",), ("<a href=\"xyz\">",)], "t string")
    html = F.concat(F.lit("<script>"), F.col("t"), F.lit("</script>"))
    got = [r.x for r in df.select(H.script_hrefs(html).alias("x")).collect()]
    assert got == [["xyz"], []]


def test_validity_and_empty_text(spark):
    df = spark.createDataFrame([(1, "http://a/", "<html><body></body></html>"),
                                (2, "http://b/", "<p>no html</p>"),
                                (3, "http://c/", None)], "page_id long, url string, html string")
    nodes = N.parse_pages(df).collect()
    assert [n.id for n in nodes] == [1]
    assert nodes[0].content == [""]
    assert nodes[0].url == "http://a"


def test_page_node_links(spark):
    n = N.parse_pages(_one(spark, PAGE)).first()
    assert n.out_links == ["http://h.example.com/a", "http://h.example.com/dir/rel/b",
                           "http://h.example.com/js/link"]
    assert n.title == "T & U" and n.language == "de"
    assert n.importance == -1.0


def test_long_inputs_do_not_overflow(spark):
    """Regex evaluation stays iterative on huge tags and links (a repeated
    alternation group would recurse per character in the JVM)."""
    page = ("<html><body>" + "<a " + 'z="1" ' * 100000 + 'href="/x">t</a>'
            + '<a href="/' + "b" * 300000 + '">u</a></body></html>')
    df = spark.createDataFrame([(1, "http://h/p", page)], "page_id long, url string, html string")
    n = N.parse_pages(df).first()
    assert n.content == ["t", "u"]
    assert [len(x) for x in n.out_links] == [10, 300009]


def test_anchor_attribute_rules(spark):
    html = ('<a title="see href=/no" href="/yes">1</a><a href="/1" HREF=\'/2\'>2</a>'
            '<a href>3</a><a name=x>4</a><a href=/bare?a=1&amp;b=2 >5</a>')
    df = spark.createDataFrame([(html,)], "h string")
    got = df.select(H.anchor_hrefs(F.col("h")).alias("a")).first().a
    assert got == ["/yes", "/2", "", "/bare?a=1&b=2"]


def test_language_attribute(spark):
    rows = [('<html><head><meta content="x lang=en"></head><body lang="de-AT"></body></html>',),
            ("<html LANG=fr><body></body></html>",), ("<html><body>lang</body></html>",)]
    df = spark.createDataFrame(rows, "h string")
    got = [r.l for r in df.select(H.language(F.col("h")).alias("l")).collect()]
    assert got == ["de-AT", "fr", ""]


def test_scripts_styles_and_comments_in_order(spark):
    """Whatever opens first decides (expected values written by hand)."""
    head = "<html><body>"
    cases = [
        ('<script>var s="<!--";</script><p>kept text</p>', ["kept text"], []),
        ('<script><!--\n<a class="x" href="/in" >y</a>\n//--></script><p>a</p>', ["a"], ["/in"]),
        ("<!-- <script> --><p>b</p><!-- </script> -->", ["b"], []),
        ("<style-x>shown</style-x><script-y>too</script-y>", ["shown", "too"], []),
        ("<style>p{}<!-- </style><p>c</p>", ["c"], []),
        ("<p>d</p><script>never closed <p>e</p>", ["d"], []),
    ]
    for body, texts, links in cases:
        df = spark.createDataFrame([(1, "http://h/", head + body)], "page_id long, url string, html string")
        row = df.select(H.segments(H.clean_html(F.col("html"))).alias("s"), H.script_hrefs(F.col("html")).alias("j")).first()
        assert (row.s, row.j) == (texts, links), body
        assert N.parse_pages(df).first().content == texts


def test_parts_of_a_page_are_worked_out_once(spark):
    """Each pattern stands once in its expression, however often its result is used."""
    df = spark.createDataFrame([("<p lang=en>",)], "c string")

    def named(col, word):
        return df.select(col.alias("x"))._jdf.queryExecution().analyzed().toString().split("LogicalRDD")[0].count(word)
    c = F.col("c")
    assert named(H.segments(c), "split(c#") == 1
    assert named(H.language(c), "regexp_extract_all(c#") == 1
    assert named(H.language(c), "regexp_extract_all(") == 3            # the tags, their names, their values
    assert named(H.anchor_hrefs(c), "regexp_extract_all(c#") == 1
    assert named(H.anchor_hrefs(c), "regexp_extract_all(") == 3 + 2    # two of the references, for values with '&'
    accepted = LinkConstraint().accepts(c)
    assert named(accepted, "regexp") == 0                              # no rule looks at the parts


def test_strip_cuts_all_whitespace_of_python(spark):
    spaces = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    cases = [spaces, f"{spaces}a{spaces}b{spaces}", "", "x", " \U0001d4b3 ", "\u200bx\u200b", None]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, s string").select("i", H.strip_ws(F.col("s")).alias("s")).collect()
    assert {r.i: r.s for r in rows} == {i: c if c is None else c.strip() for i, c in enumerate(cases)}
