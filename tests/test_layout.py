from pyspark.sql import functions as F

from docloom.operators import layout


def test_lines(spark):
    df = spark.createDataFrame([(1, "a \t b\n\n c\n| x | y |\n- 12 -"), (2, None), (3, "")], "doc_id long, text string")
    got = [tuple(r) for r in layout.ordered_lines(df, "doc_id", "text").orderBy("doc_id", "line_order").collect()]
    assert got == [
        (1, 100, "a b", False, False),
        (1, 101, "- c", False, False),
        (1, 102, "| x | y |", True, False),
        (1, 103, "- 12 -", False, True),
    ]


def test_blocks(spark):
    html = "<h1>A title that is long</h1><p>short</p><p>[1] a cited source</p><li>an item of a list</li><p>Note: read this first</p><p class='x'>a long paragraph</p>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "none")], "page_id long, html string")
    got = [(r["pos"], r["block_type"]) for r in layout.html_blocks(df, "page_id", "html").orderBy("pos").collect()]
    assert got == list(enumerate(["heading", "heading", "citation", "bullet", "note", "paragraph"], 1))


def test_overlap(spark):
    boxes = "struct<x0:double,y0:double,x1:double,y1:double>"
    rows = [((0.0, 0.0, 10.0, 10.0), (5.0, 0.0, 20.0, 10.0)), ((0.0, 0.0, 1.0, 1.0), (2.0, 2.0, 3.0, 3.0)), ((0.0, 0.0, 0.5, 0.5), (0.0, 0.0, 9.0, 9.0))]
    df = spark.createDataFrame(rows, f"a {boxes}, b {boxes}")
    assert [r[0] for r in df.select(layout.covered_share("a", "b")).collect()] == [0.5, 0.0, 0.25]
    union = layout.box_union(df.select(F.lit(1).alias("k"), "a.*"), "k").collect()
    assert [tuple(r) for r in union] == [(1, 0.0, 0.0, 10.0, 10.0)]
