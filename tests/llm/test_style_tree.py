"""HTML extraction: planted pages of one site and awkward rows."""

from pyspark.sql import functions as F

from rivulet.llm import style_tree

from .data import CLASHING

PAGE = (
    "<html><head><title>T</title><style>p{{}}</style><script>var a = '<p>x</p>';</script></head><body><nav><a href='/'>Home</a> <a>News</a></nav>"
    "<article><h1>Story {0}</h1><p>First  part\n of {0} &amp; more &eacute;.</p><p>Second <b>part</b> of {0}.</p></article>"
    "<aside>Read also</aside><footer>All rights reserved</footer></body></html>"
)


def text(i):
    return f"Story {i}\n\nFirst part of {i} & more é.\n\nSecond part of {i}."


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(CLASHING))).repartition(3)


def test_pages(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.format(i)) for i in range(30)]
    rows += [(100, None, None), (101, "https://b.example/", ""), (None, "https://a.example/x", PAGE.format(77)), rows[3], rows[3]]
    rows += [(102, "no address", "<p>one"), (103, None, PAGE.format("long" * 25000))]
    got = sorted((str(r.page_id), r.url or "", r.text, r.n_chars) for r in style_tree.extracted(pages(spark, rows)).collect())
    want = {100: "", 101: "", None: text(77), 102: "one", 103: text("long" * 25000)}
    want |= {i: text(i) for i in range(30)}
    assert got == sorted((str(i), u or "", want[i], len(want[i])) for i, u, _ in rows)


def test_no_pages(spark):
    assert style_tree.extracted(pages(spark, [])).collect() == []
