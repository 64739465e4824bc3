"""Cases of the review operators that the second review found."""

import html
from html.entities import html5

from pyspark.sql import functions as F

from reviewlens.functions.text import html_to_text


def test_every_character_reference_is_decoded(spark):
    names = [f"x&{n} y" for n in html5 if n.endswith(";")]
    numbers = ["caf&#233;&#8217;s&hellip;&#x2019;&#X1F600;&#039;", "&#150;&#x80;", "&#0;|&#xD800;|&#1114112;|&#99999999999999999999;", "&amp;lt; &amp;#39; &amp;amp;", "&unheardof; & &; a&b;c", "no reference", "", "&eacute;", "&#233;&#233;"]
    rows = names + numbers
    out = spark.createDataFrame(list(enumerate(rows)), "i int, h string").select("i", html_to_text(F.col("h")).alias("t")).collect()
    assert {rows[r.i]: r.t for r in out} == {x: html.unescape(x) for x in rows}
