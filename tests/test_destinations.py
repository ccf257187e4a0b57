from __future__ import annotations

from datetime import date

from parcelscope.operators.topn import top_k, top_n_per_group
from parcelscope.operators.returns import returned_by_destination
from parcelscope.plans import destinations, zones
from tests.frames import history, returns, shipments

PREV, CUR = date(2024, 1, 1), date(2024, 2, 1)
MONTHS = {"prev": PREV, "cur": CUR}


def dated(spark, *rows):
    frame = shipments(spark, *rows)
    return frame.selectExpr("*", "trunc(normal_cn_date, 'month') as month_start")


def ship(dest, month, count=1, **more):
    return [{"master_dest": dest, "dest": dest, "normal_cn_date": month} | more] * count


def test_ties_at_the_cut_rank_by_name(spark):
    rows = [("m", name, 5) for name in "DCBA"] + [("m", "Z", 9), ("m", "N", None)]
    frame = spark.createDataFrame(rows, "month_start string, master_dest string, v int")
    best = top_n_per_group(frame, ["month_start"], "v", 3, ["master_dest"]).collect()
    assert sorted((r.rank, r.master_dest) for r in best) == [(1, "Z"), (2, "A"), (3, "B")]


def test_top_k(spark):
    frame = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in top_k(frame, [frame.v.desc_nulls_last()], 2).collect()] == [3, 1]


def test_outside_a_months_top_shows_zero(spark):
    frame = dated(
        spark,
        *ship("P", PREV, 3), *ship("Q", PREV, 2),
        *ship("P", CUR, 1), *ship("Q", CUR, 4), *ship("R", CUR, 2),
    )
    table = destinations.top_by_shipments(destinations.destination_cube(frame), MONTHS, 1)
    rows = {r.master_dest: (r.shipments_prev, r.shipments_cur) for r in table.collect()}
    assert rows == {"P": (3, 0), "Q": (0, 4)}


def test_zone_a_ranks_and_destinations_without_it_drop(spark):
    frame = dated(
        spark,
        *ship("P", CUR, 1, weight=9, dest_zone="B"),
        *ship("Q", CUR, 1, weight=2, dest_zone="A"),
        *ship("Q", CUR, 1, weight=7, dest_zone="C"),
    )
    cube = destinations.destination_cube(frame)
    rows = destinations.top_by_zone_a(cube, "weight", MONTHS, 10).collect()
    assert [(r.master_dest, r.a_cur, r.b_cur, r.c_cur, r.a_prev) for r in rows] == [("Q", 2, 0, 7, 0)]


def test_share_divides_by_the_whole_month(spark):
    """The base holds every zone and every destination, ranked or not."""
    frame = dated(
        spark,
        *ship("P", CUR, 1, normal_weight_charges=60, dest_zone="A"),
        *ship("Q", CUR, 1, normal_weight_charges=30, dest_zone="B"),
        *ship("P", CUR, 1, normal_weight_charges=10, dest_zone=None),
    )
    cube = destinations.destination_cube(frame)
    (row,) = destinations.top_by_zone_a_with_share(cube, "charges", MONTHS, 10).collect()
    assert (row.master_dest, row.total_cur, row.pct_cur) == ("P", 60.0, 60.0)
    assert (row.total_prev, row.pct_prev) == (0.0, None)


def test_ratio_is_of_sums_and_within_city_is_its_own_type(spark):
    frame = dated(
        spark,
        *ship("P", CUR, 1, normal_revenue=30, weight=1, dest_zone="A"),
        *ship("P", CUR, 1, normal_revenue=10, weight=4, dest_zone="A"),
        *ship("P", CUR, 1, normal_revenue=5, weight=5, dest_zone="A", origin="P"),
    )
    cube = destinations.destination_cube(frame)
    (row,) = destinations.top_by_ratio(cube, "rpw", "revenue", "weight", MONTHS, 10).collect()
    assert (row.a_cur, row.wc_cur, row.b_cur, row.rpw_cur) == (8.0, 1.0, 0.0, 4.5)


def test_zero_weight_has_no_ratio_and_no_rank(spark):
    frame = dated(spark, *ship("P", CUR, 1, weight=0), *ship("Q", CUR, 1, weight=2))
    cube = destinations.destination_cube(frame)
    rows = destinations.top_by_ratio(cube, "rpw", "revenue", "weight", MONTHS, 10).collect()
    assert [r.master_dest for r in rows] == ["Q"]


def test_two_returns_count_twice_in_the_join_reports(spark):
    frame = dated(spark, *ship("P", CUR, 1, weight=3), *ship("Q", CUR, 1, weight=2))
    back = returns(
        spark,
        {"normal_cn": "n1", "normal_cn_date": CUR, "return_cn": "r1"},
        {"normal_cn": "n1", "normal_cn_date": CUR, "return_cn": "r2"},
        {"normal_cn": "n2", "normal_cn_date": CUR, "return_cn": None},
        {"normal_cn": "n2", "normal_cn_date": date(2023, 5, 1), "return_cn": "r3"},
    )
    returned = returned_by_destination(frame, back, list(MONTHS.values()))
    counted = destinations.top_by_returns(returned, MONTHS, 10).collect()
    assert [(r.master_dest, r.cur, r.cur_pct, r.prev) for r in counted] == [
        ("P", 2.0, 100.0, 0.0),  # of the month's two returned shipments
        ("Q", 0.0, 0.0, 0.0),
    ]
    weighed = destinations.top_by_return_weight(returned, MONTHS, 10).collect()
    assert [(r.master_dest, r.cur, r.cur_pct) for r in weighed] == [("P", 6.0, 120.0), ("Q", 2.0, 40.0)]


def test_matrix_equals_the_multiplied_join(spark):
    """Brute force: join row by row in Python, then sum."""
    sent = [
        {"weight": 1, "normal_revenue": 7, "dest_zone": z, "origin": o, "master_dest": "Y"}
        for z in ("A", "B", "C", None)
        for o in ("X", "Y", None)
    ]
    back = [
        {"normal_cn": f"n{i}", "return_cn": cn, "return_weight_charges": i}
        for i in (1, 2, 3, 5, 8, 12)
        for cn in ("r", "r", "", None)[: i % 5]
    ]
    table = zones.dest_day_sums(shipments(spark, *sent), returns(spark, *back)).first()
    expected = dict.fromkeys(["n_s", "r_s", "n_wght", "r_wght", "n_rev", "r_rev"], None)
    expected = {f"{k}_{s}": 0 for k in expected for s in ("wc", "za", "zb", "zc")}
    for i, row in enumerate(sent, start=1):
        slot = None
        if row["origin"] == "Y":
            slot = "wc"
        elif row["origin"] and row["dest_zone"]:
            slot = "z" + row["dest_zone"].lower()
        for match in [b for b in back if b["normal_cn"] == f"n{i}"] or [None]:
            if slot is None:
                continue
            expected[f"n_s_{slot}"] += 1
            expected[f"n_wght_{slot}"] += 1
            expected[f"n_rev_{slot}"] += 7
            if match and match["return_cn"]:
                expected[f"r_s_{slot}"] += 1
                expected[f"r_wght_{slot}"] += 1
                expected[f"r_rev_{slot}"] += match["return_weight_charges"]
    assert {k: int(table[k]) for k in expected} == expected


def test_return_revenue_keeps_an_absent_month_empty(spark):
    frame = shipments(spark, *ship("P", CUR), *ship("Q", PREV), *ship("Q", CUR))
    back = returns(spark, {"normal_cn": "n3", "return_weight_charges": 8})
    matrix = zones.dest_day_sums(frame, back)
    rows = destinations.top_by_return_revenue(matrix, MONTHS, 10).collect()
    assert [(r.master_dest, r.prev, r.cur) for r in rows] == [("Q", 0, 8), ("P", None, 0)]


def test_unknown_working_days_give_zero(spark):
    frame = history(
        spark,
        {"month_start": PREV, "n_wght": 40, "n_wght_za": 10},
        {"month_start": CUR, "n_wght": 60, "n_wght_za": 45},
    )
    table = zones.weight_by_zone(frame, MONTHS, {CUR: 8})
    rows = {r.description: r for r in table.collect()}
    daily = rows["per_working_day"]
    assert (daily.prev, daily.cur) == (0.0, 7.5)
    assert (rows["Zone_A"].prev_pct, rows["Zone_A"].cur_pct, rows["Zone_A"].inc_dec) == (25, 75, 35)


def test_previous_share_divides_by_its_own_month(spark):
    frame = history(
        spark,
        {"month_start": PREV, "shipments": 10, "ret_ship": 5},
        {"month_start": CUR, "shipments": 20, "ret_ship": 5},
    )
    months = {"prev1": date(2023, 12, 1), **MONTHS}
    row = zones.return_shipments_by_zone(frame, months).where("description = 'Return_Shipments'").first()
    assert (row.prev1, row.prev_pct, row.cur_pct, row.inc_dec) == (None, 50.0, 25.0, 0.0)


def test_zone_rows_and_total_lines(spark):
    frame = dated(
        spark,
        *ship("P", CUR, 1, normal_weight_charges=30, normal_revenue=50, cod=1),
        *ship("P", CUR, 1, normal_weight_charges=10, normal_revenue=25, origin="P"),
        *ship("P", PREV, 1, normal_weight_charges=20, normal_revenue=25, cod=None),
    )
    days = {PREV: 4, CUR: 5}
    sums = zones.zone_month_sums(frame, MONTHS)
    charges = {r.dest_zone_type: r for r in zones.weight_charges_by_zone(sums, MONTHS, days).collect()}
    assert set(charges) == {"A", "WC", "Normal Weight Charges", "Daily Normal Charge"}
    assert (charges["WC"].prev, charges["WC"].cur, charges["WC"].cur_pct) == (0.0, 10.0, 25.0)
    assert charges["Daily Normal Charge"].cur == 8.0
    revenue = {r.dest_zone_type: r for r in zones.revenue_by_zone_cod(sums, MONTHS, days).collect()}
    assert revenue["A"].measure == "normal_weight_charges"
    assert revenue["Total Revenue - COD"].prev == 25.0  # a missing cod is not zero
    assert revenue["Total Revenue - NCOD"].cur == 25.0
    assert revenue["Daily Normal Charge"].cur == 15.0
