"""Files, pages and the registry."""

import pytest
from pyspark.errors import AnalysisException

from statloom.sources import html, tables

PAGE = """<html><body><table id="stats_x"><tr><td>not in a comment</td></tr></table>
<!-- stats_x is mentioned only --><!-- <div><table id="stats_x" class="a">
<thead><tr><th></th><th colspan="2">Group</th></tr><tr><th>Player</th><th>Min</th><th>Gls</th></tr></thead>
<tbody><tr><td><a href="/p">Ben
 Mee</a></td><td>1,234</td><td></td></tr><tr><td>A &amp; B</td><td>90</td><td>2</td></tr>
<tr><th>Player</th><th>Min</th><th>Gls</th></tr><tr><td>C</td><td>5</td><td>1.50</td></tr></tbody>
</table></div> --><!-- <table id="stats_x"><tr><td>second</td></tr></table> --></body></html>"""


def pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_id bigint, html string")


def test_commented_table(spark):
    source = pages(spark, "<html><!-- stats_x --></html>", PAGE, "<html></html>")
    table = html.commented_table(source, "stats_x")
    assert table.columns == ["page_id", "row_ord", "Unnamed: 0", "Group", "Group.1"]
    assert [tuple(r) for r in table.orderBy("row_ord").collect()] == [
        (1, 1, "Player", "Min", "Gls"),
        (1, 2, "Ben Mee", "1234", None),
        (1, 3, "A & B", "90", "2"),
        (1, 4, "Player", "Min", "Gls"),
        (1, 5, "C", "5", "1.50"),
    ]
    assert html.commented_table(source, "stats_none") is None


def test_class_rows_keep_lines_and_skip_short_rows(spark):
    body = (
        "<div class='list transfer-table'><table><tr><th>h</th></tr><tr><td> Omar<br>Marm </td>"
        "<td><div>Club</div>x</td><td>€75M</td></tr><tr><td>ad</td></tr></table></div>"
        "<table class='transfer-table'><tr><td>later</td><td>y</td></tr></table>"
    )
    got = html.class_table_rows(pages(spark, body, "<p>none</p>"), "transfer-table").collect()
    assert [(r.page_id, r.cells) for r in got] == [(0, ["Omar\nMarm", "Club\nx", "€75M"])]


def test_header_names():
    assert html.header_names(["", "a", "a", "", "b", "a"]) == [
        "Unnamed: 0", "a", "a.1", "Unnamed: 3", "b", "a.2",
    ]


def test_headers_by_page_and_spans(spark):
    first = """<!--<table id="s"><tr><th>A</th><th>B</th></tr><tr><td rowspan="2">a1</td><td>b1</td></tr>
    <tr><td>b2</td></tr><tr><td colspan="2">both</td></tr></table>-->"""
    second = """<!--<table id="s"><tr><th>B</th><th>A</th></tr><tr><td>b3</td><td rowspan="3">a3</td></tr>
    <tr><td>b4</td><td>more</td></tr></table>-->"""
    table = html.commented_table(pages(spark, first, second), "s")
    assert table.columns == ["page_id", "row_ord", "A", "B", "Unnamed: 2"]
    assert [tuple(r) for r in table.orderBy("page_id", "row_ord").collect()] == [
        (0, 1, "a1", "b1", None),
        (0, 2, "a1", "b2", None),
        (0, 3, "both", "both", None),
        (1, 1, "a3", "b3", None),
        (1, 2, "a3", "b4", "more"),
    ]
    chosen = html.commented_table(pages(spark, first, second), "s", ["B"])
    assert [r.B for r in chosen.orderBy("page_id", "row_ord").collect()] == ["b1", "b2", "both", "b3", "b4"]


def test_page_numbers(spark):
    def largest(*bodies):
        return html.max_page(pages(spark, *bodies)).first().pages

    bar = "<ul class='x pagination'><li><a href='x'>1</a><a>Next</a><a> 14 </a><a>3.5</a></li></ul>"
    assert largest(bar, "<div class='pagination'><a>99</a></div>") == 14  # the first page counts
    assert largest(f"<a>2024</a>{bar}<a>2025</a>") == 14
    assert largest("<nav class='pagination'><a><span>7</span></a></nav>") == 7
    assert largest("<nav class='pagination'><a>Next</a></nav>") == 1
    assert largest("<nav class='pagination'></nav>") == 1
    assert largest("<a>Next</a><a>5</a>") == 22
    assert html.max_page(pages(spark, "<p></p>").limit(0)).first().pages == 22
    urls = tables.page_urls(spark, "http://x/", 2).orderBy("page").collect()
    assert [tuple(u) for u in urls] == [(1, "http://x/1"), (2, "http://x/2")]


@pytest.mark.parametrize("missing", ["N/A", ""])
def test_csv_round_trip(spark, tmp_path, missing):
    schema = "`a b` string, `x%` double, n bigint"
    rows = [("q, \"w\"", 1.5, 1), (None, None, None), ("Ødegaard", 2.0, 3)]
    path = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame(rows, schema).coalesce(1), path, missing)
    assert sorted(map(repr, map(tuple, tables.read_csv(spark, path, schema, missing or "N/A").collect()))) == sorted(
        map(repr, rows)
    )


def test_csv_byte_order_mark_and_empty_cells(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Player,Minutes\nA,N/A\n,5\n", encoding="utf-8-sig")
    got = tables.read_csv(spark, str(path), "Player string, Minutes bigint").collect()
    assert [tuple(r) for r in got] == [("A", None), (None, 5)]


def test_registry_skips_or_fails(spark, tmp_path):
    loaders = [
        ("there", lambda: spark.range(1)),
        ("gone", lambda: spark.read.parquet(str(tmp_path / "none"))),
        ("empty", lambda: None),
    ]
    assert list(tables.load_sources(loaders)) == ["there"]
    with pytest.raises(AnalysisException):
        tables.load_sources(loaders, on_missing="fail")
    assert tables.optional_source(loaders[1][1]) is None


def test_ranking_written_by_statistic(spark, tmp_path):
    rows = spark.createDataFrame([("x", "1st"), ("y", "1st")], "stat string, rank string")
    tables.write_ranking(rows, str(tmp_path / "r"))
    assert (tmp_path / "r" / "stat=x").is_dir()
