"""One query per operator over the test tables.

Entity = customer, group = nation, role = market segment. Its statistics come from orders, line
items and events, merged into one wide table the way the stat tables of a season are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions import numeric as num
from statloom.functions import text as txt
from statloom.functions.similarity import token_sort_ratio
from statloom.operators import cluster, features, fuzzy, histogram, merge, profile, ranking, schema
from statloom.operators import value_model as values
from statloom.operators.median import narrowed_medians
from statloom.operators.ordering import with_places
from statloom.plans import transfers
from statloom.sources import html, tables
from statloom.storage import materialize, scratch_path

STATS = ["orders_cnt", "total_price", "lines_cnt", "qty", "revenue", "events_cnt", "event_value"]
RANKED = [*STATS, "no_value"]
NEGATIVE = ["events_cnt", "no_value"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cents(column: str) -> Column:
    """Two-decimal money as whole cents, so that sums do not depend on the order of rows."""
    return F.rint(F.col(column) * 100).cast("bigint")


def units(cents_sum: Column) -> Column:
    return cents_sum.cast("double") / 100.0


def stat_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    base = (
        table(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("key"),
            F.col("c_name").alias("name"),
            "nation",
            F.col("c_mktsegment").alias("segment"),
        )
    )
    orders = table(spark, d, "orders")
    order_stats = orders.groupBy(F.col("o_custkey").alias("key")).agg(
        F.count(F.lit(1)).cast("double").alias("orders_cnt"),
        units(F.sum(cents("o_totalprice"))).alias("total_price"),
    )
    # lines are summed per order first: the join then moves one row per order
    per_order = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents("l_quantity")).alias("q"),
            F.sum(cents("l_extendedprice")).alias("r"),
        )
    )
    line_stats = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("key"))
        .agg(
            F.sum("n").cast("double").alias("lines_cnt"),
            units(F.sum("q")).alias("qty"),
            units(F.sum("r")).alias("revenue"),
        )
    )
    event_stats = (
        table(spark, d, "events")
        .groupBy(F.col("user_id").alias("key"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("events_cnt"),
            units(F.sum(cents("value"))).alias("event_value"),
        )
    )
    return {"base": base, "orders": order_stats, "lines": line_stats, "events": event_stats}


def wide(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_wide(stat_tables(spark, d), "key")


def filled(spark: SparkSession, d: str) -> DataFrame:
    return schema.zero_fill(wide(spark, d), STATS)


def ranked_input(spark: SparkSession, d: str) -> DataFrame:
    return filled(spark, d).withColumn("no_value", F.lit(0.0))


def key_is(modulus: int, rest: int = 0, key: str = "c_custkey") -> Column:
    return F.col(key) % modulus == rest


# --- sources and sinks ---------------------------------------------------------------------------


def src_csv_na(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey",
        F.when(~key_is(11), F.col("c_name")).alias("name"),
        F.when(~key_is(7), F.col("c_acctbal")).alias("balance"),
    )
    path = scratch_path(spark, "csv")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


def _names_in_file(spark, d, missing):
    """Names with commas, quotes and letters beyond ASCII, and some that are missing."""
    name = F.concat(F.lit('Ø"'), F.col("c_name"), F.lit(', é"'))
    rows = table(spark, d, "customer").select("c_custkey", F.when(~key_is(7), name).alias("name"))
    path = scratch_path(spark, "csv")
    tables.write_csv(rows, path, missing)
    return tables.read_csv(spark, path, rows.schema, missing)


def src_csv_empty(spark, d):
    return _names_in_file(spark, d, "")


def src_csv_plain(spark, d):
    return _names_in_file(spark, d, txt.MISSING)


def sources_tolerant(spark, d):
    """Rows of the sources that are there; a missing file and an empty answer are skipped."""
    found = tables.load_sources(
        [
            ("customer", lambda: table(spark, d, "customer")),
            ("absent", lambda: table(spark, d, "no_such_table")),
            ("nothing", lambda: None),
            ("nation", lambda: table(spark, d, "nation")),
        ]
    )
    counts = [t.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows")) for name, t in found.items()]
    return reduce(DataFrame.unionByName, counts)


def html_comment_extract(spark, d):
    return table(spark, d, "pages").select(
        "page_id", F.posexplode(html.comments(F.col("html"))).alias("pos", "body")
    )


def html_table_rows(spark, d):
    def cells(tag: str, *texts: Column) -> Column:
        parts = [p for t in texts for p in (F.lit(f"<{tag}>"), t, F.lit(f"</{tag}>"))]
        return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))

    head = cells("th", F.lit("Player"), F.lit("Min"), F.lit("Gls"))
    data = cells(
        "td", F.col("c_name"), F.format_number(F.col("c_custkey") * 1000, 0), F.lit("A &amp; B")
    )
    pages = table(spark, d, "customer").select(
        F.col("c_custkey").alias("page_id"),
        F.concat(
            F.lit('<html><!-- about stats_x --><div><p>x</p></div><!--\n<table id="stats_x">'),
            F.lit('<tr><th></th><th colspan="2">Performance</th></tr>'),
            head, data, head,
            F.lit('</table>\n--><table id="stats_x"><tr><td>outside</td></tr></table></html>'),
        ).alias("html"),
    )
    named = html.commented_table(pages, "stats_x")
    return named.select(
        "page_id", F.col("row_ord").cast("bigint").alias("row_ord"),
        schema.quoted("Unnamed: 0").alias("name"),
        schema.quoted("Performance").alias("minutes"),
        schema.quoted("Performance.1").alias("goals"),
    )


def html_table_spans(spark, d):
    """Pages whose tables have their columns in two orders, a cell over two rows, and a wider row."""
    even = key_is(2)
    head = F.when(even, "<tr><th>Player</th><th>Min</th></tr>").otherwise("<tr><th>Min</th><th>Player</th></tr>")
    name, minutes = F.col("c_name"), F.col("c_custkey").cast("string")
    wide = F.concat(F.lit("<td>x"), minutes, F.lit("</td></tr>"))
    body = F.when(
        even,
        F.concat(
            F.lit("<tr><td rowspan='2'>"), name, F.lit("</td><td>"), minutes,
            F.lit("</td></tr><tr><td>again</td>"), wide,
        ),
    ).otherwise(
        F.concat(
            F.lit("<tr><td>"), minutes, F.lit("</td><td rowspan='2'>"), name,
            F.lit("</td></tr><tr><td>again</td>"), wide,
        )
    )
    pages = table(spark, d, "customer").select(
        F.col("c_custkey").alias("page_id"),
        F.concat(F.lit("<!--<table id='stats_y'>"), head, body, F.lit("</table>-->")).alias("html"),
    )
    named = html.commented_table(pages, "stats_y")
    return named.select(
        "page_id", F.col("row_ord").cast("bigint").alias("row_ord"), "Player", "Min",
        schema.quoted("Unnamed: 2").alias("beyond"),
    )


def html_rows_min_cells(spark, d):
    row = F.concat(
        F.lit("<tr><td> "), F.col("p_name"), F.lit("<br>"), F.col("p_brand"), F.lit("</td><td>"),
        F.col("p_type"), F.lit("</td><td> €"), F.col("p_size").cast("string"), F.lit("M</td></tr>"),
    )
    pages = table(spark, d, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.concat(
            F.lit("<div><table class='plain'><tr><td>a</td><td>b</td></tr></table>"),
            F.lit("<table class='wide transfer-table'><tr><th>Player</th></tr>"),
            row, F.lit("<tr><td>only</td></tr><tr><td>x</td><td>y</td></tr></table></div>"),
        ).alias("html"),
    )
    rows = html.class_table_rows(pages, "transfer-table")
    return rows.select(
        "page_id", F.col("row_ord").cast("bigint").alias("row_ord"),
        txt.cell_name(F.col("cells"), 0).alias("name"),
        txt.cell_price(F.col("cells")).alias("price"),
    )


LINK = r"<a\b[^>]*>([^<]*)</a>"


def cell_pick(spark, d):
    cells = F.regexp_extract_all("html", F.lit(LINK), 1)
    rows = table(spark, d, "pages").select("page_id", cells.alias("cells"))
    return rows.filter(F.size("cells") >= 2).select(
        "page_id",
        txt.cell_name(F.col("cells"), 0).alias("first_name"),
        txt.cell_name(F.col("cells"), 1).alias("second_name"),
        txt.cell_price(F.col("cells")).alias("price"),
    )


def page_count(spark, d):
    numbers = F.regexp_extract_all("url", F.lit(r"page=(\d+)"), 1)
    return tables.max_number(table(spark, d, "pages"), numbers, 22)


def page_count_links(spark, d):
    return html.max_page(table(spark, d, "pages"))


def page_count_listing(spark, d):
    """Listing pages with a pagination, a stray year beside it, and marked-up link texts."""
    key = F.col("c_custkey")
    last = F.concat(F.lit("<li><a href='x'><span> "), (key % 9 + 1).cast("string"), F.lit("</span></a></li>"))
    inside = F.when(key % 5 == 0, F.lit("<li><a>Next</a></li>")).otherwise(
        F.concat(F.lit("<li><a>3</a></li>"), last, F.lit("<li><a>3.5</a><a>Next</a></li>"))
    )
    bar = F.concat(F.lit("<div class='wide pagination'><div><ul>"), inside, F.lit("</ul></div></div>"))
    none = F.lit("<ul class='pages'><li><a>7</a></li></ul>")
    pages = table(spark, d, "customer").select(
        key.alias("page_id"),
        F.concat(
            F.lit("<html><a>2024</a>"), F.when(key % 7 == 0, none).otherwise(bar), F.lit("<a>99</a></html>")
        ).alias("html"),
    )
    return html.page_numbers(pages)


def url_list(spark, d):
    return tables.page_urls(spark, "https://example.com/list/", table(spark, d, "pages").count())


def strip_thousands(spark, d):
    amount = F.format_number(F.col("c_custkey") * 98765, 0)
    text = F.when(key_is(3), F.concat(amount, F.lit(" kg"))).otherwise(amount)
    return table(spark, d, "customer").select("c_custkey", num.strip_thousands(text).alias("text"))


# --- schema, casts, fills ------------------------------------------------------------------------


def rename_map(spark, d):
    names = {"p_partkey": "key", "p_name": "label", "p_type": "label", "absent": "other"}
    renamed = schema.rename_columns(table(spark, d, "part"), names)
    return schema.select_known(renamed, ["p_size", "label", "key", "missing"])


def first_names(spark, d):
    """Cells under a header with a repeated name: the first column of each name stays."""
    cells = F.array(F.col("p_partkey").cast("string"), "p_name", "p_type", "p_brand")
    names = schema.first_of_names(["key", "label", "key", "brand"])
    rows = table(spark, d, "part").select(cells.alias("cells"))
    return rows.select(*[F.get("cells", F.lit(i)).alias(name) for i, name in names])


def numeric_totals(spark, d):
    """Sum of every column that is not excluded, over the wide table."""
    rows = wide(spark, d)
    names = schema.numeric_names(rows, ["key", "name", "nation", "segment"])
    sums = rows.agg(*[F.sum(F.rint(schema.quoted(c) * 100)).alias(c) for c in names])
    return sums.unpivot([], names, "stat", "total").withColumn("total", F.col("total") / 100)


def conform_schema(spark, d):
    wanted = {"p_partkey": "bigint", "p_name": "string", "rating": "double", "note": "string"}
    return schema.conform(table(spark, d, "part"), wanted)


def unpivot_stats(spark, d):
    return schema.unpivot_stats(wide(spark, d), ["key"], STATS)


def coerce_numeric(spark, d):
    text = (
        F.when(key_is(7), "N/A").when(key_is(11), "x1").when(key_is(13), "NaN")
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    return table(spark, d, "customer").select("c_custkey", num.parse_number(text).alias("value"))


def coerce_int(spark, d):
    key = F.col("c_custkey").cast("string")
    text = F.when(key_is(5), F.concat(key, F.lit(".5"))).when(key_is(7), "abc").otherwise(key)
    return table(spark, d, "customer").select(
        "c_custkey", num.to_whole(num.parse_number(text)).alias("value")
    )


def fill_const(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(~key_is(4, 0, "o_orderkey"), F.col("o_totalprice")).alias("price"),
    )
    return schema.zero_fill(schema.fill_text(rows, ["priority"], txt.MISSING), ["price"])


def impute_median(spark, d):
    rows = wide(spark, d).select("key", "segment", *STATS)
    return features.impute_median(rows, STATS, group="segment")


def drop_any_null(spark, d):
    return wide(spark, d).select("key", *STATS).dropna(how="any", subset=STATS)


# --- scalar functions ----------------------------------------------------------------------------


def parse_age(spark, d):
    years, days = (F.col("c_custkey") % 40).cast("string"), (F.col("c_custkey") % 365).cast("string")
    text = (
        F.when(key_is(6), F.concat(F.lit(" "), years, F.lit("-"), days, F.lit(" ")))
        .when(key_is(6, 1), years)
        .when(key_is(6, 2), F.concat(years, F.lit("."), (F.col("c_custkey") % 1000).cast("string")))
        .when(key_is(6, 3), "1-2-3")
        .when(key_is(6, 4), F.lit("N/A"))
        .otherwise(F.concat(F.lit("-"), years))
    )
    return table(spark, d, "customer").select("c_custkey", txt.parse_age(text).alias("age"))


def _customers(spark, d):
    nation = table(spark, d, "nation")
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", "c_name", "c_mktsegment", "n_name")


def last_token(spark, d):
    text = (
        F.when(key_is(9), "   ").when(key_is(10), "N/A")
        .otherwise(F.concat_ws("  ", "n_name", "c_name"))
    )
    return _customers(spark, d).select("c_custkey", txt.last_word(text).alias("word"))


def clean_name(spark, d):
    text = (
        F.when(key_is(4), F.concat_ws(", ", "c_name", "c_mktsegment"))
        .when(key_is(4, 1), F.concat_ws(" ,", "c_name", "n_name", "c_mktsegment"))
        .when(key_is(4, 2), F.concat(F.lit("  "), "c_name", F.lit("   "), "n_name", F.lit(" ")))
        .when(key_is(8, 3), "N/A")
    )
    return _customers(spark, d).select("c_custkey", txt.clean_name(text).alias("name"))


def _long_name() -> Column:
    return (
        F.when(key_is(3), F.col("c_mktsegment"))
        .when(key_is(7), F.lit("Bobby Reid"))
        .when(key_is(5), F.concat_ws(" ", "c_mktsegment", "n_name"))
        .otherwise(F.concat_ws(" ", "c_mktsegment", "n_name", "c_name"))
    )


def name_first_two(spark, d):
    return _customers(spark, d).select("c_custkey", txt.first_two_words(_long_name()).alias("name"))


def name_first_last(spark, d):
    special = {"Bobby Reid": "Bobby Cordova-Reid"}
    return _customers(spark, d).select(
        "c_custkey", txt.first_and_last_word(_long_name(), special).alias("name")
    )


def _price_text() -> Column:
    number = F.concat((F.col("c_custkey") % 100).cast("string"), F.lit("."), (F.col("c_custkey") % 10).cast("string"))
    return (
        F.when(key_is(5), F.concat(F.lit("€"), number, F.lit("M")))
        .when(key_is(5, 1), F.concat(F.lit("£"), number, F.lit("k ")))
        .when(key_is(5, 2), F.lit("Free"))
        .when(key_is(5, 3), number)
        .otherwise(F.concat(F.lit(" € "), number, F.lit("m")))
    )


def parse_money(spark, d):
    return table(spark, d, "customer").select("c_custkey", txt.parse_money(_price_text()).alias("value"))


def _positions() -> Column:
    s = F.col("c_mktsegment")
    return (
        F.when(s == "AUTOMOBILE", "FW,MF").when(s == "BUILDING", "DF / MF")
        .when(s == "FURNITURE", "DF,GK").when(s == "MACHINERY", "MF").otherwise("Unknown")
    )


def main_role(spark, d):
    return table(spark, d, "customer").select("c_custkey", txt.main_role(_positions()).alias("role"))


def position_buckets(spark, d):
    bucket = txt.position_bucket(_positions())
    return table(spark, d, "customer").select("c_custkey", bucket.alias("bucket")).dropna()


def bucket_counts(spark, d):
    return profile.bucket_counts(position_buckets(spark, d), "bucket")


def union_roles(spark, d):
    """The parts of all segments, stacked; the segments are those of the table."""
    rows = table(spark, d, "customer")
    segments = features.known_values(rows, "c_mktsegment")
    parts = [
        values.of_role(rows, "c_mktsegment", s).select("c_custkey", "c_name", F.lit(s).alias("position"))
        for s in segments
    ]
    return reduce(DataFrame.unionByName, parts)


def sort_first_token(spark, d):
    rows = _customers(spark, d).select("c_custkey", F.concat_ws(" ", "n_name", "c_name").alias("name"))
    return schema.sort_by_first_word(rows, "name", "c_custkey")


def first_token_places(spark, d):
    """The order of ``sort_first_token`` as a column."""
    rows = sort_first_token(spark, d)
    return with_places(rows, [txt.first_word(F.col("name")), F.col("name").asc_nulls_last(), F.col("c_custkey").asc_nulls_last()])


# --- merge, look-ups, filters --------------------------------------------------------------------


def merge_wide(spark, d):
    # the filtered table leads: its keys are the only ones that stay
    tables_by_name = stat_tables(spark, d)
    ordered = [tables_by_name[name] for name in ("lines", "base", "orders", "events")]
    merged = merge.merge_wide([ordered[0].filter("qty > 90"), *ordered[1:]], "key", lead=0)
    typed = schema.coerce(merged, ["orders_cnt", "lines_cnt", "qty", "events_cnt"], ["revenue"])
    order = ["key", "name", "segment", "nation", "absent", *STATS]
    return schema.in_order(typed.filter("qty > 90"), order)


def merge_suffixes(spark, d):
    """Two tables that share a column besides the key."""
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return merge.merge_wide([customers, suppliers], "key")


def merge_skips_repeats(spark, d):
    """Orders repeat their customer, so the merge leaves them out."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), "o_totalprice")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    return merge.merge_wide([customers, orders, nations], "key", on_repeat="skip")


def merge_wide_union(spark, d):
    return wide(spark, d)


def key_violations(spark, d):
    return merge.key_violations(table(spark, d, "orders"), ["o_custkey"])


def _dictionary(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")


def lookup_first(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    return merge.lookup(rows, _dictionary(spark, d), "c_custkey", "o_orderpriority", ["o_orderkey"])


def lookup_last_default(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    return merge.lookup(
        rows, _dictionary(spark, d), "c_custkey", "o_orderpriority", ["o_orderkey"], "last", "Unknown"
    )


def lookup_hot_key(spark, d):
    """A dictionary too large to broadcast, and one key with a good half of the rows."""
    rows = table(spark, d, "lineitem").select(
        *("l_orderkey", "l_linenumber"), F.when(F.col("l_linenumber") <= 3, 1).otherwise(F.col("l_orderkey")).cast("long").alias("k")
    )
    entries = table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("k"), "o_orderkey", "o_orderpriority")
    return merge.lookup(rows, entries, "k", "o_orderpriority", ["o_orderkey"], max_rows=0)


def _orders(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def dedup_first(spark, d):
    return merge.dedup(_orders(spark, d), ["o_custkey"], ["o_orderkey"])


def dedup_last(spark, d):
    return merge.dedup(_orders(spark, d), ["o_custkey"], ["o_orderkey"], keep="last")


def filter_threshold(spark, d):
    over = {"lines": F.col("qty") > 900}
    return merge.merge_wide(stat_tables(spark, d), "key", where=over, columns=["name", "qty"])


def role_filter(spark, d):
    rows = values.of_role(table(spark, d, "customer"), "c_mktsegment", "building")
    return rows.select("c_custkey", "c_name", "c_mktsegment")


# --- profiles, rankings, histograms --------------------------------------------------------------


def global_profile(spark, d):
    return profile.group_profile(filled(spark, d), None, STATS)


def group_profile(spark, d):
    return profile.long_profile(
        profile.group_profile(filled(spark, d), "nation", STATS), "nation", STATS
    )


def group_profile_wide(spark, d):
    return profile.group_profile(filled(spark, d), "nation", STATS)


def rollup_profile(spark, d):
    return profile.rollup_profile(filled(spark, d), "nation", STATS)


def rollup_places(spark, d):
    """The order of ``rollup_profile`` as a column: the whole table, then the groups ascending."""
    return with_places(rollup_profile(spark, d), [(F.col("nation") == profile.TOTAL).desc(), F.col("nation").asc()])


def narrowed_profile(spark, d):
    """The profile by narrowing instead of in-memory medians, over raw line items."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    stats = ["l_extendedprice", "l_quantity"]
    long = narrowed_medians(rows, ["l_returnflag"], stats, sorted_values=2_000)
    return long.withColumn("median", num.round2(F.col("median")))


def group_means(spark, d):
    return profile.group_means(filled(spark, d), "nation", STATS, rounded=True)


def distinct_groups(spark, d):
    return profile.distinct_groups(wide(spark, d), "nation")


def group_places(spark, d):
    """The order of ``distinct_groups`` as a column."""
    return with_places(distinct_groups(spark, d), [F.col("nation").asc()])


def all_zero_stats(spark, d):
    return profile.all_zero_stats(ranked_input(spark, d), RANKED)


def top_bottom_n(spark, d):
    rows = materialize(ranked_input(spark, d), "ranked")
    return ranking.top_bottom_n(rows, "name", "nation", RANKED, n=3, tie=["key"])


def top_k_single(spark, d):
    return ranking.top_k(wide(spark, d).select("key", "name", "revenue"), "revenue", 3, ["key"])


def leader_per_stat(spark, d):
    return ranking.leader_per_stat(filled(spark, d), "nation", STATS)


def leader_wins(spark, d):
    return ranking.leader_wins(leader_per_stat(spark, d), NEGATIVE)


def best_group(spark, d):
    return ranking.best_group(leader_wins(spark, d))


def _measured(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")


def hist_global(spark, d):
    return histogram.histogram(_measured(spark, d), ["l_extendedprice", "l_quantity"], 20)


def hist_group(spark, d):
    return histogram.histogram(
        _measured(spark, d), ["l_extendedprice", "l_quantity"], 10, "l_returnflag"
    )


# --- approximate names ---------------------------------------------------------------------------


def _spelled(spark, d):
    """Part names with the usual deviations: order, case, dropped and added letters."""
    first, second = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    kind = F.col("p_partkey") % 5
    text = (
        F.when(kind == 0, F.col("p_name"))
        .when(kind == 1, F.concat_ws(" ", second, first))
        .when(kind == 2, F.expr("upper(substr(p_name, 2))"))
        .when(kind == 3, F.concat(F.lit("Zö-"), F.col("p_name")))
        .otherwise(F.concat(first, F.lit(" x "), F.reverse(second)))
    )
    return table(spark, d, "part").select("p_partkey", "p_name", text.alias("spelled"))


def token_sort_ratio_query(spark, d):
    score = token_sort_ratio(F.col("p_name"), F.col("spelled"))
    return _spelled(spark, d).select("p_partkey", "spelled", score.cast("bigint").alias("score"))


def _catalogue(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("known"))


def _matched(spark, d, threshold):
    left = _spelled(spark, d).select("p_partkey", "spelled")
    return fuzzy.fuzzy_best_match(
        left, _catalogue(spark, d), "spelled", "known", "ord", threshold
    ).withColumn("match_score", F.col("match_score").cast("bigint"))


def fuzzy_best_match(spark, d):
    return _matched(spark, d, 90)


def fuzzy_best_match_70(spark, d):
    return _matched(spark, d, 70)


def fuzzy_semi(spark, d):
    left = _spelled(spark, d).select("p_partkey", "spelled")
    return fuzzy.fuzzy_semi(left, _catalogue(spark, d), "spelled", "known", "ord", 80)


def fuzzy_unmatched(spark, d):
    left = _spelled(spark, d).select("p_partkey", "spelled")
    rest = fuzzy.fuzzy_anti(left, _catalogue(spark, d), "spelled", "known", "ord", 90)
    return rest.withColumn("role", F.lit("Part"))


def values_without_players(spark, d):
    """Listed values when there is no player table: every first row of a name, position unknown."""
    row = F.concat(
        F.lit("<tr><td>1</td><td> "), F.col("p_name"), F.lit("<br>Club</td><td>x</td><td>€"),
        F.col("p_partkey").cast("string"), F.lit("M</td></tr>"),
    )
    pages = table(spark, d, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.concat(F.lit("<table class='similar-players-table'>"), row, F.lit("</table>")).alias("html"),
    )
    return transfers.estimated_values(None, pages).drop("ord")


# --- features, clusters, value model -------------------------------------------------------------


def round6(column: Column) -> Column:
    """Six decimals, without negative zero."""
    return F.rint(column * 1e6) / 1e6 + 0.0


def log_features(spark, d):
    rows = features.impute_median(wide(spark, d).select("key", *STATS), STATS)
    signed = rows.withColumn("event_value", F.col("event_value") - 500)
    weighted = features.log_weighted(signed, STATS, {"qty": 1.5, "revenue": 2.0, "orders_cnt": 0.5})
    return weighted.withColumns({c: round6(F.col(c)) for c in STATS})


def clip_scale(spark, d):
    scaled = num.in_millions(num.clip(F.col("total_price") * 10, 100_000, 200_000_000))
    return wide(spark, d).select("key", scaled.alias("value_m"))


def standardize(spark, d):
    rows = materialize(ranked_input(spark, d).select("key", *RANKED), "plain")
    return features.standardize(rows, RANKED).withColumns({c: round6(F.col(c)) for c in RANKED})


def one_hot(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return features.one_hot(rows, "c_mktsegment", features.known_values(rows, "c_mktsegment"))


def split_80_20(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", features.in_training(F.col("c_custkey")).alias("train")
    )


def _vectors(spark, d):
    """The embeddings, one column per element; vectors of different lengths are an error."""
    rows = table(spark, d, "embeddings").filter("embedding IS NOT NULL")
    size = F.size("embedding")
    least, most = rows.agg(F.min(size), F.max(size)).first()
    if least != most:
        raise ValueError(f"embeddings have {least} to {most} elements")
    parts = {f"x{i}": F.get("embedding", F.lit(i)).cast("double") for i in range(least or 0)}
    rows = rows.select("vec_id", *[c.alias(n) for n, c in parts.items()])
    return materialize(cluster.feature_table(rows, ["vec_id", *parts], list(parts)), "vectors")


def wcss_k1(spark, d):
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, d, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias(cluster.VECTOR)
    )
    total = cluster.spread_of_one(rows)
    return spark.createDataFrame([(1, round(total, 4))], "k int, wcss double")


def _first_centres(vectors: DataFrame, n: int = 10) -> dict:
    """The vectors with the least ids as first centres, moved until they stand still."""
    rows = vectors.select("vec_id", cluster.VECTOR).orderBy("vec_id").limit(n).collect()
    return {"first": np.array([r[cluster.VECTOR].toArray() for r in rows]), "tolerance": 1e-12}


def elbow_curve(spark, d):
    vectors = _vectors(spark, d)
    curve = cluster.elbow_curve(vectors, **_first_centres(vectors))
    return curve.withColumn("wcss", F.round("wcss", 4))


def elbow_drawn(spark, d):
    """The curve of drawn starts, whose first point needs no luck."""
    curve = cluster.elbow_curve(_vectors(spark, d), max_k=3, starts=4)
    return curve.filter("k = 1").withColumn("wcss", F.round("wcss", 4))


def elbow_drawn_curve(spark, d):
    """The whole curve of the operator's ten drawn starts, which SQL cannot repeat."""
    return cluster.elbow_curve(_vectors(spark, d)).withColumn("wcss", F.round("wcss", 4))


def _clustered(spark, d):
    vectors = _vectors(spark, d)
    assigned = cluster.kmeans_assign(vectors, **_first_centres(vectors))
    return materialize(assigned.drop(cluster.VECTOR), "clustered")


def kmeans_assign(spark, d):
    return _clustered(spark, d).select("vec_id", "cluster")


def cluster_sizes(spark, d):
    return cluster.cluster_sizes(_clustered(spark, d))


def cluster_profile(spark, d):
    rows = _clustered(spark, d)
    return cluster.cluster_profile(rows, [c for c in rows.columns if c not in ("vec_id", "cluster")])


def pca_2d(spark, d):
    projected, _ = cluster.pca_2d(_vectors(spark, d))
    return projected.select("vec_id", round6(F.col("pc1")).alias("pc1"), round6(F.col("pc2")).alias("pc2"))


def pca_shares(spark, d):
    _, shares = cluster.pca_2d(_vectors(spark, d))
    rows = [(i + 1, share) for i, share in enumerate(shares)]
    return spark.createDataFrame(rows, "component int, share double").withColumn("share", round6(F.col("share")))


def _priced_lines(spark, d):
    lines, parts = table(spark, d, "lineitem"), table(spark, d, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        # order and line number repeat in the given tables, so part and supplier order the rows
        "l_partkey", "l_suppkey", "l_returnflag", "p_brand", "l_quantity", "l_discount", "l_tax",
        F.col("p_size").cast("double").alias("p_size"),
        (F.col("l_extendedprice") * 1000).alias("value"),
    )


FLAGS = [("Accepted", "a"), ("None", "n"), ("Returned", "r")]


def value_model(spark, d):
    numbers = ["l_quantity", "l_discount", "l_tax", "p_size"]
    configs = [
        values.RoleModel(role, code, numbers, ["p_brand"], {"l_quantity": 2.0, "p_size": 0.5})
        for role, code in FLAGS
    ]
    out = ["line", "l_partkey", "l_suppkey"]
    return values.value_all_roles(_priced_lines(spark, d), configs, "l_returnflag", "value", "line", out)


def value_places(spark, d):
    """The order of ``value_model`` as a column: highest estimate first."""
    return with_places(value_model(spark, d), [F.col("predicted_m").desc(), *map(F.col, ("line", "l_partkey", "l_suppkey"))])


def roles_skipped(spark, d):
    """Valued rows per role; a role without rows is left out."""
    rows = table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), "l_returnflag", "l_quantity",
        (F.col("l_extendedprice") * 1000).alias("value"),
    )
    configs = [values.RoleModel(r, c, ["l_quantity"]) for r, c in (("Accepted", "a"), ("Nobody", "z"))]
    valued = values.value_all_roles(rows, configs, "l_returnflag", "value", "line", ["line"])
    return valued.groupBy("position").agg(F.count(F.lit(1)).alias("rows"))


def ols_one_feature(spark, d):
    """The line of price on quantity per flag, fitted by the operator and read off at 0 and 1."""
    lines = table(spark, d, "lineitem").where("l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL")
    ends = spark.createDataFrame([(0.0,), (1.0,)], "l_quantity double")
    out = []
    for role, code in FLAGS:
        rows = lines.where(F.col("l_returnflag") == code.upper())
        if rows.isEmpty():
            continue
        fit = values.fit_values(rows, values.RoleModel(role, code, ["l_quantity"]), "l_extendedprice")
        at = {r["l_quantity"]: r["estimate"] for r in fit.estimate(ends).select("l_quantity", "estimate").collect()}
        out.append((role, at[1.0] - at[0.0], at[0.0]))
    fitted = spark.createDataFrame(out, "role string, slope double, intercept double")
    return fitted.select("role", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__.removesuffix("_query"): f
    for f in (
        src_csv_na, src_csv_empty, src_csv_plain, sources_tolerant, html_comment_extract, html_table_rows, html_rows_min_cells, cell_pick,
        html_table_spans, page_count, page_count_links, page_count_listing, url_list, strip_thousands,
        rename_map, first_names, numeric_totals, conform_schema, unpivot_stats, coerce_numeric, coerce_int, fill_const,
        impute_median, drop_any_null,
        parse_age, last_token, clean_name, name_first_two, name_first_last, parse_money, main_role,
        position_buckets, bucket_counts, union_roles, sort_first_token,
        merge_wide, merge_wide_union, merge_suffixes, merge_skips_repeats, key_violations, lookup_first, lookup_last_default, lookup_hot_key,
        dedup_first, dedup_last, filter_threshold, role_filter,
        global_profile, group_profile, group_profile_wide, rollup_profile, narrowed_profile,
        group_means, distinct_groups, all_zero_stats,
        top_bottom_n, top_k_single, leader_per_stat, leader_wins, best_group,
        hist_global, hist_group,
        token_sort_ratio_query, fuzzy_best_match, fuzzy_best_match_70, fuzzy_semi, fuzzy_unmatched,
        values_without_players,
        log_features, clip_scale, standardize, one_hot, split_80_20, wcss_k1, ols_one_feature,
        roles_skipped,
        elbow_curve, elbow_drawn, elbow_drawn_curve, kmeans_assign, cluster_sizes, cluster_profile, pca_2d, pca_shares,
        value_model,
        first_token_places, rollup_places, group_places, value_places,
    )
}
