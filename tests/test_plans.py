"""The season flows end to end on made-up pages, and relations of recorded results."""

import pytest
from pyspark.sql import functions as F
from season_pages import fee_page, players, season_pages

from statloom.functions.numeric import in_millions
from statloom.functions.text import main_role, parse_money
from statloom.operators.merge import dedup
from statloom.operators.ranking import best_group, leader_wins
from statloom.plans import flows, reports, season, transfers
from statloom.plans.wide_table import build_wide_table, merge_stat_tables
from statloom.storage import materialize

ROWS = players()
PAGE = "page_id bigint, html string"


@pytest.fixture(scope="module")
def wide(spark):
    sources = {t: spark.createDataFrame(p, PAGE) for t, p in season_pages(ROWS).items()}
    # a table no page holds is skipped
    sources["stats_missing"] = spark.createDataFrame([(9, "<html></html>")], PAGE)
    return materialize(build_wide_table(sources), "wide")


def test_schema_lists():
    assert len(season.REQUIRED) == 76 and len(season.STATS) == 72
    assert (len(season.WHOLE), len(season.DECIMAL), len(season.CLUSTERED)) == (41, 31, 64)
    renamed = {n for h in season.HEADERS.values() for n in h.values()}
    assert set(season.REQUIRED) - renamed == {"SCA", "GCA"}
    assert all(set(r.numeric) <= set(season.STATS) for r in season.ROLES)


def test_wide_table(wide):
    assert wide.columns == season.REQUIRED
    assert {dict(wide.dtypes)[c] for c in season.WHOLE} == {"bigint"}
    got = {r.Player: r for r in wide.collect()}
    expected = {r["Player"]: r for r in ROWS if r["Minutes"] > 90}
    assert set(got) == set(expected) and len(expected) < len(ROWS)
    for name, row in expected.items():
        found = got[name].asDict()
        assert found["Team"] == row["Team"] and found["Nation"] == row["Nation"].split()[-1]
        years, days = map(int, row["Age"].split("-"))
        assert found["Age"] == round(years + days / 365, 2)
        for s in season.STATS[1:]:
            held = row["Position"] == "GK" or s not in ("GA90", "Save%", "CS%", "PK Save%")
            assert found[s] == (row[s] if held else None), (name, s)


def test_statistics_report(wide):
    out = reports.statistics_report(wide)
    profile = out["profile"].collect()
    assert len(out["profile"].columns) == 1 + 3 * 72
    assert [r.Team for r in profile] == ["all", *sorted({r["Team"] for r in ROWS})]
    leaders = {r.stat: r for r in out["leaders"].collect()}
    assert len(leaders) == 72
    for stat, best in leaders.items():
        means = {r.Team: r[f"Mean of {stat}"] for r in profile if r.Team != "all"}
        assert means[best.group] == max(means.values()) == best["mean"]
    assert out["ranking"].groupBy("stat", "direction").count().filter("count > 3").isEmpty()
    assert out["ranking"].filter("direction = 'Highest'").count() == 72 * 3
    bars = out["league_histogram"].groupBy("stat").agg(F.sum("rows").alias("n"), F.count("bin").alias("b"))
    assert {(r.n, r.b) for r in bars.collect()} == {(wide.count(), 20)}
    assert out["team_histogram"].count() == 6 * 3 * 10
    assert tuple(out["best"].first())[2] == 72 - len(season.NEGATIVE)


def test_cluster_report(wide):
    out = reports.cluster_report(wide, clusters=3, max_k=4, starts=3)
    curve = [r.wcss for r in out["elbow"].orderBy("k").collect()]
    n = wide.count()
    assert abs(curve[0] - n * 64) < 1e-6 and curve == sorted(curve, reverse=True)
    sizes = [r["rows"] for r in out["sizes"].collect()]
    assert sum(sizes) == n and sizes == sorted(sizes, reverse=True)
    shares = [r.share for r in out["variance"].orderBy("component").collect()]
    assert 1 > shares[0] >= shares[1] > 0
    assert out["means"].count() == 3 and set(season.CLUSTERED) < set(out["means"].columns)


def test_transfer_flows(spark, wide):
    rows = [r for r in ROWS if r["Minutes"] > 90]
    fees = [(r["Player"].upper(), "€10M") for r in rows[:12]] + [("Somebody Quite Else", "Free")]
    pages = spark.createDataFrame([(1, fee_page(fees, "transfer-table", 0))], PAGE)
    got = [tuple(r) for r in transfers.confirmed_fees(wide, pages).collect()]
    regular = [r["Player"].upper() for r in rows[:12] if r["Minutes"] > 900]
    assert [p for p, _ in got if p in regular] == regular
    assert "Somebody Quite Else" not in [p for p, _ in got]

    values = [(r["Player"], f"€{5 + i}.5M") for i, r in enumerate(rows)]
    values += [(rows[0]["Player"], "€99M"), ("Qqq Www", "€1M")]
    pages = spark.createDataFrame([(1, fee_page(values, "similar-players-table", 1))], PAGE)
    estimated = materialize(transfers.estimated_values(wide, pages), "estimated")
    found = {r.Player: r for r in estimated.collect()}
    assert set(found) == {r["Player"] for r in rows}
    assert found[rows[0]["Player"]].Price == "€5.5M"
    assert [r.Position for r in transfers.estimated_values(wide, pages).collect()][0] == "GK"
    alone = transfers.estimated_values(None, pages).collect()
    assert len(alone) == len(rows) + 1 and {r.Position for r in alone} == {"Unknown"}

    kept = estimated.filter(F.col("Player") != rows[1]["Player"])
    report = transfers.value_report(wide, kept, order="ord")
    valued = report["values"].collect()
    price = {r["Player"]: 5.5 + i for i, r in enumerate(rows)}
    assert all(r.Actual_Transfer_Value_M == price[r.Player] for r in valued)
    predicted = [r.Predicted_Transfer_Value_M for r in valued]
    assert predicted == sorted(predicted, reverse=True) and 0.1 <= min(predicted) <= max(predicted) <= 200
    assert {r.Position for r in valued} == {r.role for r in season.ROLES}
    unmatched = {tuple(r) for r in report["unmatched"].collect()}
    assert len(valued) + len(unmatched) == len(rows)
    assert ("Defender", rows[1]["Player"]) in unmatched


# fixed values: statistic, leading team and its mean in the recorded season, in table order
RECORDED = [
    ("Age", "Fulham", 29.0),
    ("Matches Played", "Nott'ham Forest", 25.24),
    ("Starts", "Brentford", 18.33),
    ("Minutes", "Liverpool", 1643.1),
    ("Gls", "Liverpool", 3.81),
    ("Ast", "Liverpool", 2.86),
    ("crdY", "Chelsea", 3.88),
    ("crdR", "Arsenal", 0.23),
    ("xG", "Liverpool", 3.68),
    ("xAG", "Liverpool", 2.68),
    ("PrgC", "Manchester City", 41.64),
    ("PrgP", "Liverpool", 83.95),
    ("PrgR", "Liverpool", 83.05),
    ("Gls per 90", "Manchester City", 0.18),
    ("Ast per 90", "Liverpool", 0.14),
    ("xG per 90", "Liverpool", 0.18),
    ("xAG per 90", "Chelsea", 0.16),
    ("GA90", "Leicester City", 0.32),
    ("Save%", "Bournemouth", 10.43),
    ("CS%", "Brentford", 5.6),
    ("PK Save%", "Everton", 4.76),
    ("SoT%", "Nott'ham Forest", 34.8),
    ("SoT per 90", "Bournemouth", 0.54),
    ("G per Sh", "Arsenal", 0.13),
    ("Dist", "Crystal Palace", 18.12),
    ("Cmp", "Liverpool", 807.14),
    ("Cmp%", "Manchester City", 86.5),
    ("TotDist", "Liverpool", 13712.95),
    ("ShortCmp%", "Manchester City", 92.13),
    ("MedCmp%", "Manchester City", 89.52),
    ("LongCmp%", "Liverpool", 60.28),
    ("KP", "Liverpool", 22.43),
    ("Pass into 1_3", "Liverpool", 69.57),
    ("PPA", "Liverpool", 19.05),
    ("CrsPA", "Fulham", 4.65),
    ("SCA", "Liverpool", 50.81),
    ("SCA90", "Liverpool", 2.62),
    ("GCA", "Liverpool", 6.52),
    ("GCA90", "Liverpool", 0.33),
    ("Tkl", "Crystal Palace", 33.14),
    ("TklW", "Crystal Palace", 19.62),
    ("Deff Att", "Liverpool", 28.95),
    ("Lost", "Nott'ham Forest", 14.33),
    ("Blocks", "Brentford", 21.19),
    ("Sh", "Brentford", 8.71),
    ("Pass", "Crystal Palace", 14.9),
    ("Int", "Bournemouth", 14.39),
    ("Touches", "Liverpool", 1139.43),
    ("Def Pen", "Brentford", 145.57),
    ("Def 3rd", "Brentford", 366.48),
    ("Mid 3rd", "Liverpool", 513.48),
    ("Att 3rd", "Manchester City", 353.4),
    ("Att Pen", "Liverpool", 57.38),
    ("Take-Ons Att", "Arsenal", 30.59),
    ("Succ%", "Liverpool", 52.19),
    ("Tkld%", "Crystal Palace", 45.69),
    ("Carries", "Manchester City", 664.68),
    ("ProDist", "Manchester City", 2051.96),
    ("Carries 1_3", "Manchester City", 31.16),
    ("CPA", "Manchester City", 14.48),
    ("Mis", "Nott'ham Forest", 24.67),
    ("Dis", "Newcastle Utd", 17.96),
    ("Rec", "Liverpool", 798.24),
    ("Rec PrgR", "Liverpool", 83.05),
    ("Fls", "Bournemouth", 20.52),
    ("Fld", "Newcastle Utd", 18.22),
    ("Off", "Nott'ham Forest", 3.95),
    ("Crs", "Fulham", 40.05),
    ("Recov", "Bournemouth", 73.22),
    ("Aerl Won", "Brentford", 27.52),
    ("Aerl Lost", "Crystal Palace", 28.19),
    ("Aerl Won%", "Brentford", 54.89),
]


def test_recorded_leaders(spark):
    assert [stat for stat, _, _ in RECORDED] == season.STATS
    leaders = spark.createDataFrame([r[:2] for r in RECORDED], "stat string, `group` string")
    wins = leader_wins(leaders, season.NEGATIVE)
    assert {tuple(r) for r in wins.collect()} == {
        ("Liverpool", 26), ("Manchester City", 10), ("Brentford", 8), ("Crystal Palace", 5),
        ("Bournemouth", 4), ("Fulham", 3), ("Nott'ham Forest", 2), ("Arsenal", 2), ("Chelsea", 1),
        ("Everton", 1), ("Newcastle Utd", 1),
    }
    assert tuple(best_group(wins).first()) == ("Liverpool", 26, 63)


# fixed values: recorded prices with the value in millions, the positions of the valued players with
# their number, and the confirmed fees that tell no number
PRICES = [("€198.8M", 198.8), ("€62.7M", 62.7), ("€58.2M", 58.2), ("€126.5M", 126.5), ("€42.3M", 42.3), ("€37.4M", 37.4)]
POSITIONS = [
    ("DF", 150), ("DF,MF", 15), ("DF,FW", 4), ("MF", 85), ("MF,FW", 37), ("MF,DF", 8), ("FW", 64), ("FW,MF", 50),
    ("FW,DF", 3), ("GK", 39),
]
FEES = [("Omar Marmoush", "€75M", 75e6), ("Manuel Ugarte", "€50M", 50e6), ("Baylin Johnson", "Free", None)]


def test_recorded_money_and_roles(spark):
    money = spark.createDataFrame(PRICES, "text string, value double")
    parsed = money.select(in_millions(parse_money(F.col("text"))).alias("got"), "value").collect()
    assert all(r.got == r.value for r in parsed)
    fees = spark.createDataFrame(FEES, "player string, text string, value double")
    assert all(r.got == r.value for r in fees.select(parse_money(F.col("text")).alias("got"), "value").collect())
    held = spark.createDataFrame(POSITIONS, "position string, n int")
    counts = held.groupBy(main_role(F.col("position")).alias("role")).agg(F.sum("n").alias("n")).collect()
    assert {r.role: r.n for r in counts} == {"DF": 169, "MF": 130, "FW": 117, "GK": 39}


def test_flows_end_in_files(spark, tmp_path):
    pages = {t: (lambda p=p: spark.createDataFrame(p, PAGE)) for t, p in season_pages(ROWS).items()}
    pages["absent"] = lambda: spark.read.parquet(str(tmp_path / "absent"))
    result = flows.wide_flow(pages, str(tmp_path))["result"]
    played = {r["Player"] for r in ROWS if r["Minutes"] > 90}
    assert {r.Player for r in result.collect()} == played and result.columns == season.REQUIRED
    path = str(tmp_path / "result")

    stats = flows.statistics_flow(spark, path, str(tmp_path / "stats"))
    assert stats["profile"].count() == 4 and stats["leaders"].count() == 72
    assert stats["ranking"].select("stat").distinct().count() == 72
    means = {r["Team"]: r for r in stats["profile"].collect()}
    for r in stats["leaders"].collect():
        assert means[r["group"]][f"Mean of {r.stat}"] == r["mean"]

    clusters = flows.cluster_flow(spark, path, str(tmp_path / "clusters"), clusters=2, max_k=2, starts=2)
    assert clusters["sizes"].agg(F.sum("rows")).first()[0] == clusters["clustered"].count()

    rows = [r for r in ROWS if r["Minutes"] > 90]
    fees = spark.createDataFrame([(1, fee_page([(rows[0]["Player"], "€10M"), ("Xyz", "Free")], "transfer-table", 0))], PAGE)
    listed = [(r["Player"], f"€{5 + i}.5M") for i, r in enumerate(rows)]
    values = spark.createDataFrame([(1, fee_page(listed, "similar-players-table", 1))], PAGE)
    out = flows.transfer_flow(spark, path, str(tmp_path / "transfers"), fees, values)
    assert out["regular"].count() == sum(r["Minutes"] > 900 for r in rows)
    assert out["fees"].count() == (rows[0]["Minutes"] > 900)
    assert out["estimates"].count() == len(rows) and out["estimates"].columns == ["Player", "Position", "Price"]
    predicted = [r.Predicted_Transfer_Value_M for r in out["values"].collect()]
    assert predicted == sorted(predicted, reverse=True) and len(predicted) + out["unmatched"].count() == len(rows)
    alone = flows.transfer_flow(spark, str(tmp_path / "gone"), str(tmp_path / "alone"), None, values)
    assert set(alone) == {"estimates"} and {r.Position for r in alone["estimates"].collect()} == {"Unknown"}


def test_season_merge_shuffles_each_table_once(spark, tmp_path):
    tables, ids = {}, list(season.HEADERS)
    others = [c for c in season.STATS if c != "Minutes"]
    for name, column in zip(ids, ["Minutes", *others]):
        frame = spark.createDataFrame([(f"P {k}", str(100 * k), k) for k in range(30)], f"Player string, `{column}` string, ord int")
        frame.write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        tables[name] = dedup(rows, ["Player"], ["ord"]).select("Player", f"`{column}`")
    assert len(tables) == 8
    # small tables would be broadcast, and then not be shuffled at all
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_stat_tables(tables, sort=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 29
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 8
