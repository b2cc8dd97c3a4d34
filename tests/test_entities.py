import html
import random

from pyspark.sql import functions as F

from siftweb.functions import html as H

PARTS = ["&amp;", "&amp", "&lt;", "&ampx", "&notit;", "&notin;", "&#65;", "&#x41;", "&#X1F600;",
         "&#128;", "&#0;", "&#xD800;", "&#99999999;", "&#1", "&copy", "&", "&;", "&#;", "&#x;",
         "abc", " ", "ü", "&AElig", "&zz;", "&#13;", "&#x7f;", "&#65536;", "&nbsp", "&amp;lt;",
         "&#00065;", "&#x0000041;", "&rsquo;", "&eacute;"]


def test_decode_matches_html_unescape(spark):
    rnd = random.Random(11)
    cases = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 6))) for _ in range(300)] + PARTS
    df = spark.createDataFrame([(x,) for x in cases], "t string")
    for r in df.select("t", H.decode_entities(F.col("t")).alias("d")).collect():
        assert r.d == html.unescape(r.t), r.t
