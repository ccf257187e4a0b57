"""ANSI SQL for every report, over the raw tables, run by DuckDB as the correctness check."""

from __future__ import annotations

from check_sql.base import FORMS, MOM, RETURNS, SHIPMENTS, CUSTOMERS, double, pct, div, r

CUR, PREV, PREV1 = "DATE '2000-06-01'", "DATE '2000-05-01'", "DATE '2000-04-01'"
WINDOW = "month_start BETWEEN DATE '2000-01-01' AND DATE '2000-06-01'"
YEAR = "month_start BETWEEN DATE '1999-07-01' AND DATE '2000-06-01'"
PAIR_DAYS = "normal_cn_date BETWEEN DATE '2000-05-01' AND DATE '2000-06-30'"
ROLES = {"prev": PREV, "cur": CUR}
DAYS = {"prev": 23, "cur": 22}
N = 10

ORACLES: dict[str, str] = {}


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def at(role: str, value: str) -> str:
    return f"max(CASE WHEN month_start = {ROLES[role]} THEN {value} END)"


def positive_zero(value: str) -> str:
    return f"CASE WHEN {value} = 0 THEN 0.0 ELSE {value} END"


HISTORY = (SHIPMENTS, RETURNS, CUSTOMERS, MOM)
WINDOWED = (*HISTORY, f"win AS (SELECT * FROM mom WHERE {WINDOW})")

# --- account-by-month roll-up -------------------------------------------------------
_COUNTS = (
    "shipments n_s_wc n_s_za n_s_zb n_s_zc ret_ship r_s_wc r_s_za r_s_zb r_s_zc "
    "r_s_chrg r_s_nchrg kg_0_0_5 kg_0_5_1_0"
).split()
_AMOUNTS = (
    "n_wght n_wght_wc n_wght_za n_wght_zb n_wght_zc r_wght r_wght_wc r_wght_za r_wght_zb "
    "r_wght_zc r_wght_chrg r_wght_nchrg n_wght_chgs n_fsc n_oth_chgs n_rev cod n_rev_wc "
    "n_rev_za n_rev_zb n_rev_zc ret_revenue"
).split()
ORACLES["mom_history_build"] = with_(*HISTORY) + (
    "SELECT acc_no, cust_name, cust_type, sp_name, month_start, "
    "strftime(month_start, '%b-%y') AS month, "
    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _COUNTS)
    + ", "
    + ", ".join(f"{double(c)} AS {c}" for c in _AMOUNTS)
    + " FROM mom"
)

# --- month series -------------------------------------------------------------------
KPI = f"""kpi AS (
  SELECT month_start,
    {double('count(acc_no)')} AS "Active_Accounts",
    {double('sum(shipments)')} AS "Normal_Shipments",
    {double('sum(n_wght)')} AS "Normal_Weight",
    {double('sum(n_wght_chgs)')} AS "Weight_Charges",
    {double('sum(n_fsc)')} AS "fuel_Surcharge",
    {double('sum(n_oth_chgs)')} AS "Cash_handling",
    {double('sum(n_rev)')} AS "Total_normal_rev",
    {r(div('sum(n_rev)', 'sum(shipments)'))} AS "RPS",
    {r(div('sum(n_rev)', 'sum(n_wght)'))} AS "RPW",
    {r(div('sum(n_wght)', 'sum(shipments)'))} AS "WPS"
  FROM win GROUP BY month_start),
kpi_long AS (
  FROM kpi UNPIVOT INCLUDE NULLS (value FOR metric IN ("Active_Accounts", "Normal_Shipments",
    "Normal_Weight", "Weight_Charges", "fuel_Surcharge", "Cash_handling", "Total_normal_rev",
    "RPS", "RPW", "WPS")))"""
KPI_ORDER = (
    "['Active_Accounts','Normal_Shipments','Normal_Weight','Weight_Charges','fuel_Surcharge',"
    "'Cash_handling','Total_normal_rev','RPS','RPW','WPS']"
)
RET = f"""ret_kpi AS (
  SELECT b.month_start,
    {double('b.accounts')} AS "active_accounts",
    {double('b.ships')} AS "Return_Shipment",
    {r(pct('b.ships', 'a.ships'))} AS "Shipment_Ret_ration",
    {double('b.wght')} AS "Return_Weight",
    {r(pct('b.wght', 'a.wght'))} AS "Weight_ret_ratio",
    {double('b.rev')} AS "return_revenue",
    {r(div('b.rev', 'b.ships'))} AS "RPS",
    {r(div('b.rev', 'b.wght'))} AS "RPW"
  FROM (SELECT month_start, count(acc_no) AS accounts, sum(ret_ship) AS ships,
               sum(r_wght) AS wght, sum(ret_revenue) AS rev
        FROM win WHERE ret_ship <> 0 GROUP BY month_start) b
  JOIN (SELECT month_start, sum(shipments) AS ships, sum(n_wght) AS wght
        FROM win GROUP BY month_start) a ON a.month_start = b.month_start),
ret_long AS (
  FROM ret_kpi UNPIVOT INCLUDE NULLS (value FOR metric IN ("active_accounts", "Return_Shipment",
    "Shipment_Ret_ration", "Return_Weight", "Weight_ret_ratio", "return_revenue", "RPS", "RPW")))"""
RET_ORDER = (
    "['active_accounts','Return_Shipment','Shipment_Ret_ration','Return_Weight',"
    "'Weight_ret_ratio','return_revenue','RPS','RPW']"
)


def change(long: str) -> str:
    """Metric beside the previous present month, by self-join on the month rank."""
    return f"""{long}_rank AS (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY month_start) AS k FROM {long}),
{long}_change AS (
  SELECT c.month_start, c.metric, c.value, p.month_start AS prev_month, p.value AS prev_value,
         c.value - p.value AS diff, c.value / nullif(p.value, 0) - 1 AS pct_chng
  FROM {long}_rank c JOIN {long}_rank p ON c.metric = p.metric AND c.k = p.k + 1)"""


for _name, _cte, _long, _order in (
    ("monthly_kpis", KPI, "kpi_long", KPI_ORDER),
    ("monthly_returns", RET, "ret_long", RET_ORDER),
):
    ORACLES[_name] = with_(*WINDOWED, _cte) + (
        f"SELECT month_start, metric, CAST(list_position({_order}, metric) AS BIGINT) AS ord, value "
        f"FROM {_long}"
    )
    ORACLES[f"{_name}_mom_diff"] = with_(*WINDOWED, _cte, change(_long)) + (
        f"SELECT month_start, metric, CAST(list_position({_order}, metric) AS BIGINT) AS ord, diff FROM {_long}_change"
    )
    ORACLES[f"{_name}_mom_pct"] = with_(*WINDOWED, _cte, change(_long)) + (
        f"SELECT month_start, metric, CAST(list_position({_order}, metric) AS BIGINT) AS ord, pct_chng "
        f"FROM {_long}_change"
    )


def plain(value: str, digits: int) -> str:
    if digits == 0:
        return f"CAST(CAST({r(value, 0)} AS BIGINT) AS VARCHAR)"
    rounded = positive_zero(r(value, digits))
    return rf"regexp_replace(printf('%.{digits}f', {rounded}), '(\.\d+?)0+$', '\1')"


def accounting(value: str, digits: int) -> str:
    return (
        f"CASE WHEN {r(value, digits)} < 0 THEN '(' || {plain(f'(-({value}))', digits)} || ')' "
        f"ELSE {plain(value, digits)} END"
    )


def card(long: str, order: str, slide: str, separated: str, whole: bool, digits: int) -> str:
    diff = accounting("diff", 2)
    if whole:
        diff = f"CASE WHEN {separated} THEN {accounting('diff', 0)} ELSE {diff} END"
    return f"""SELECT month_start, '{slide}' AS slide, metric, CAST(list_position({order}, metric) AS BIGINT) AS ord,
  CASE WHEN {separated} THEN format('{{:,.2f}}', {r('value')}) ELSE {plain('value', 2)} END AS value_text,
  strftime(prev_month, '%b-%y') || ': ' || {plain('prev_value', 2)} AS prev_text,
  'Diff : ' || {diff} AS diff_text,
  ', ' || {accounting('pct_chng*100', digits)} || '%' AS pct_text
FROM {long}_change"""


ORACLES["kpi_cards"] = (
    with_(*WINDOWED, KPI, RET, change("kpi_long"), change("ret_long"))
    + card("kpi_long", KPI_ORDER, "kpi", "metric NOT IN ('RPS','RPW','WPS')", True, 3)
    + "\nUNION ALL\n"
    + card(
        "ret_long",
        RET_ORDER,
        "returns",
        "metric IN ('active_accounts','Return_Shipment','Return_Weight','return_revenue')",
        False,
        1,
    )
)

_SERIES = {
    "monthly_shipments": ("shipments", "CAST(sum(shipments) AS BIGINT)"),
    "monthly_weight": ("n_wght", double("sum(n_wght)")),
    "monthly_weight_charges": ("n_wght_chgs", double("sum(n_wght_chgs)")),
    "monthly_other_charges": ("n_oth_chgs", double("sum(n_oth_chgs)")),
    "monthly_revenue": ("n_rev", double("sum(n_rev)")),
    "monthly_rps": ("rps", r(div("sum(n_rev)", "sum(shipments)"))),
    "monthly_rpw": ("rpw", r(div("sum(n_rev)", "sum(n_wght)"))),
    "monthly_wps": ("wps", r(div("sum(n_wght)", "sum(shipments)"))),
}
for _name, (_column, _measure) in _SERIES.items():
    ORACLES[_name] = with_(*WINDOWED) + (
        f"SELECT month_start, strftime(month_start, '%b-%y') AS month, {_measure} AS {_column} "
        "FROM win GROUP BY month_start ORDER BY month_start"
    )


def _breakdown(name: str, cells: dict[str, str]) -> None:
    ORACLES[name] = with_(*WINDOWED) + (
        "SELECT month_start, "
        + ", ".join(f"{r(value)} AS {alias}" for alias, value in cells.items())
        + " FROM win GROUP BY month_start ORDER BY month_start"
    )


SLOTS = ("wc", "za", "zb", "zc")
_breakdown(
    "rps_breakdown",
    {
        "rps": div("sum(n_rev)", "sum(shipments)"),
        "rps_ex_fsc": div("(sum(n_rev) - sum(n_fsc))", "sum(shipments)"),
        "rps_ex_chc": div("(sum(n_rev) - sum(n_oth_chgs))", "sum(shipments)"),
        "rps_cod": div("sum(n_rev) FILTER (cod <> 0)", "sum(shipments) FILTER (cod <> 0)"),
        "rps_ncod": div("sum(n_rev) FILTER (cod = 0)", "sum(shipments) FILTER (cod = 0)"),
        **{f"rps_{s}": div(f"sum(n_rev_{s})", f"sum(n_s_{s})") for s in SLOTS},
    },
)
_breakdown(
    "rpw_breakdown",
    {
        "rpw": div("sum(n_rev)", "sum(n_wght)"),
        "rpw_ex_fsc": div("(sum(n_rev) - sum(n_fsc))", "sum(n_wght)"),
        "rpw_ex_chc": div("(sum(n_rev) - sum(n_oth_chgs))", "sum(n_wght)"),
        **{f"rpw_{s}": div(f"sum(n_rev_{s})", f"sum(n_wght_{s})") for s in SLOTS},
    },
)
_breakdown(
    "wps_breakdown",
    {
        "ws": div("sum(n_wght)", "sum(shipments)"),
        **{f"ws_{s}": div(f"sum(n_wght_{s})", f"sum(n_s_{s})") for s in SLOTS},
    },
)

# --- lifecycle ----------------------------------------------------------------------
_LIFE = {
    "prev": ("1995-03-01", "1995-03-31", "1995-02-01", "1995-02-28"),
    "cur": ("1995-04-01", "1995-04-30", "1995-03-01", "1995-03-31"),
}
_FETCHED = "SELECT acc_no FROM ship WHERE normal_cn_date BETWEEN DATE '1995-02-01' AND DATE '1995-04-30'"


def _life(role: str) -> dict[int, str]:
    start, end, before_start, before_end = _LIFE[role]
    span = f"BETWEEN DATE '{start}' AND DATE '{end}'"
    now = f"SELECT DISTINCT acc_no FROM ship WHERE normal_cn_date {span}"
    then = (
        "SELECT DISTINCT acc_no FROM ship WHERE normal_cn_date "
        f"BETWEEN DATE '{before_start}' AND DATE '{before_end}'"
    )
    approved = f"finance_approval {span} AND second_approval {span}"

    def forms(condition: str) -> str:
        return f"(SELECT count(DISTINCT acc_no) FROM forms WHERE {condition})"

    def fetched(condition: str) -> str:
        return forms(f"acc_no IN ({_FETCHED}) AND {condition}")

    def less(a: str, b: str) -> str:
        return f"(SELECT count(*) FROM (({a}) EXCEPT ({b})))"

    rows = {
        1: f"(SELECT count(*) FROM ({now}))",
        2: less(now, then),
        3: fetched(f"first_cn {span} AND year(first_cn) = 1995"),
        6: less(then, now),
        7: forms(f"creation_date {span}"),
        8: forms(approved),
        9: forms(f"creation_date {span} AND {approved}"),
        11: forms(f"creation_date {span} AND {approved} AND first_cn {span}"),
        12: fetched(
            f"first_cn {span} AND creation_date < DATE '{start}' "
            f"AND finance_approval < DATE '{start}' AND second_approval < DATE '{start}'"
        ),
    }
    rows[4] = f"({rows[2]} - {rows[3]})"
    rows[5] = f"({rows[1]} - {rows[2]})"
    rows[10] = f"({rows[8]} - {rows[9]})"
    return rows


_TITLES = (
    "Active this Month",
    "Active this Month but not in Previous Months",
    "New Active",
    "Revived",
    "Retained from Previous Month",
    "Active in Previous Month but not this month",
    "CRF Created this Month",
    "CRF Approved this Month",
    "CRF Created & Approved this Month",
    "CRF Not Created but approved this Month",
    "CRF Created, Approved and Active this Month",
    "CRF Not Created & Approved this Month but Active this Month",
)
_prev, _cur = _life("prev"), _life("cur")
ORACLES["account_lifecycle"] = (
    with_(SHIPMENTS, FORMS)
    + "SELECT CAST(ord AS BIGINT) AS ord, description, prev, cur, cur - prev AS inc_dec FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT {i} AS ord, '{title}' AS description, {_prev[i]} AS prev, {_cur[i]} AS cur"
        for i, title in enumerate(_TITLES, start=1)
    )
    + ") ORDER BY ord"
)

_MONTHS13 = (
    "months AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1996-01-01', "
    "INTERVAL 1 MONTH)) AS DATE) AS month_start)"
)


def _grid(counts: str, value: str, months: str) -> str:
    """Every sales person of `counts` with every month, zero where missing."""
    return (
        f"SELECT p.sp_name, m.month_start, CAST(coalesce(c.{value}, 0) AS BIGINT) AS {value} "
        f"FROM (SELECT DISTINCT sp_name FROM {counts}) p CROSS JOIN {months} m "
        f"LEFT JOIN {counts} c ON c.sp_name = p.sp_name AND c.month_start = m.month_start"
    )


ORACLES["approved_accounts_by_sp"] = with_(
    SHIPMENTS,
    FORMS,
    _MONTHS13,
    """counts AS (
  SELECT s.sp_name, m.month_start, count(DISTINCT f.acc_no) AS accounts
  FROM forms f JOIN ship s ON s.acc_no = f.acc_no
  JOIN months m ON f.finance_approval BETWEEN m.month_start AND last_day(m.month_start)
               AND f.second_approval BETWEEN m.month_start AND last_day(m.month_start)
  GROUP BY ALL)""",
) + _grid("counts", "accounts", "months")

_ACCOUNT_DAYS = "normal_cn_date BETWEEN DATE '1995-01-01' AND DATE '1996-01-31'"
ORACLES["new_active_by_sp"] = with_(
    SHIPMENTS,
    FORMS,
    _MONTHS13,
    f"""counts AS (
  SELECT s.sp_name, s.month_start, count(DISTINCT s.acc_no) AS accounts
  FROM ship s LEFT JOIN forms f ON s.acc_no = f.acc_no
  WHERE {_ACCOUNT_DAYS} AND year(f.first_cn) = year(s.normal_cn_date)
    AND month(f.first_cn) = month(s.normal_cn_date)
  GROUP BY ALL)""",
) + _grid("counts", "accounts", "months")

ORACLES["accounts_lost_by_sp"] = with_(
    SHIPMENTS,
    f"ranged AS (SELECT sp_name, acc_no, month_start FROM ship WHERE {_ACCOUNT_DAYS})",
    """pairs AS (
  SELECT p.month_start AS before, min(n.month_start) AS month_start
  FROM (SELECT DISTINCT month_start FROM ranged) p
  JOIN (SELECT DISTINCT month_start FROM ranged) n ON n.month_start > p.month_start
  GROUP BY p.month_start)""",
    """counts AS (
  SELECT r.sp_name, k.month_start, count(DISTINCT CASE WHEN NOT EXISTS (
      SELECT 1 FROM ranged n WHERE n.sp_name = r.sp_name AND n.acc_no = r.acc_no
        AND n.month_start = k.month_start) THEN r.acc_no END) AS lost_accounts
  FROM ranged r JOIN pairs k ON r.month_start = k.before
  GROUP BY ALL)""",
) + _grid("counts", "lost_accounts", "(SELECT DISTINCT month_start FROM pairs)")

# --- zone tables --------------------------------------------------------------------


def _compared(measures: dict[str, str], base: str, prev1: bool, rounded: bool) -> str:
    """Per-month sums in `z`, turned into one row per description."""
    value = r("value") if rounded else "value"
    inc = positive_zero(r("cur - prev", 0)) if rounded else "cur - prev"
    cells = {role: at(role, value) for role in ROLES}
    if prev1:
        cells = {"prev1": f"max(CASE WHEN month_start = {PREV1} THEN {value} END)", **cells}
    shares = {f"{role}_pct": at(role, r(pct("value", "base"))) for role in ROLES}
    lines = "\nUNION ALL\n".join(
        f"SELECT month_start, {double(base)} AS base, '{label}' AS description, "
        f"CAST({ord} AS BIGINT) AS ord, {double(expr)} AS value FROM z"
        for ord, (label, expr) in enumerate(measures.items(), start=1)
    )
    names = ", ".join([*cells, *shares])
    inner = ", ".join(f"{expr} AS {alias}" for alias, expr in (cells | shares).items())
    return (
        f"SELECT description, ord, {names}, {inc} AS inc_dec FROM (SELECT description, ord, {inner} "
        f"FROM ({lines}) GROUP BY description, ord)"
    )


def _zone_sums(columns: dict[str, str], source: str = "mom") -> str:
    sums = ", ".join(f"sum({column}) AS {label}" for label, column in columns.items())
    return (
        f"z AS (SELECT month_start, {sums} FROM {source} "
        f"WHERE month_start IN ({PREV1}, {PREV}, {CUR}) GROUP BY month_start)"
    )


_R9 = {
    "Return_Shipments": "ret_ship",
    "WC": "r_s_wc",
    "Zone_A": "r_s_za",
    "Zone_B": "r_s_zb",
    "Zone_C": "r_s_zc",
    "With_charges": "r_s_chrg",
    "With_no_charges": "r_s_nchrg",
}
ORACLES["return_shipments_by_zone"] = with_(
    *HISTORY, _zone_sums(_R9 | {"ships": "shipments"})
) + _compared({k: k for k in _R9}, "ships", True, False)

_R10 = {
    "Normal_Weight": "n_wght",
    "WC": "n_wght_wc",
    "Zone_A": "n_wght_za",
    "Zone_B": "n_wght_zb",
    "Zone_C": "n_wght_zc",
}
_DAILY = r(
    f"{double('Normal_Weight')} / CASE WHEN month_start = {PREV} THEN 23.0::DOUBLE ELSE 22.0::DOUBLE END"
)
ORACLES["weight_by_zone"] = with_(*HISTORY, _zone_sums(_R10)) + _compared(
    {k: k for k in _R10} | {"per_working_day": _DAILY}, "Normal_Weight", False, True
)

_R12 = {
    "Return_Weight": "r_wght",
    "WC": "r_wght_wc",
    "Zone_A": "r_wght_za",
    "Zone_B": "r_wght_zb",
    "Zone_C": "r_wght_zc",
    "Wght_chrgs": "r_wght_chrg",
    "Wght_no_chrgs": "r_wght_nchrg",
}
ORACLES["return_weight_by_zone"] = with_(*HISTORY, _zone_sums(_R12)) + _compared(
    {k: k for k in _R12}, "Return_Weight", False, True
)


_ZONE_PLACE = "CASE zone_type WHEN 'WC' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'C' THEN 4 ELSE 5 END"


def _zone_report(rows: list[tuple[str, str]], base: str, measure: bool) -> str:
    """Rows are (label and measure expressions, aggregate with {m} for the month filter)."""
    parts = []
    for place, (head, aggregate) in enumerate(rows, start=5):
        grouped = " GROUP BY zone_type" if head.startswith("zone_type ") else ""
        cells = ", ".join(
            f"{double(aggregate.format(m=f'month_start = {month}', d=DAYS[role]))} AS {role}"
            for role, month in ROLES.items()
        )
        ord = _ZONE_PLACE if grouped else str(place)
        parts.append(f"SELECT {head}, CAST({ord} AS BIGINT) AS ord, {cells} FROM pair{grouped}")
    bases = {
        role: f"(SELECT {double(base.format(m=f'month_start = {month}'))} FROM pair)"
        for role, month in ROLES.items()
    }
    names = "ord, dest_zone_type, measure" if measure else "ord, dest_zone_type"
    inc = positive_zero(r(f"{r('cur')} - {r('prev')}", 0))
    return (
        f"SELECT {names}, {r('prev')} AS prev, {r('cur')} AS cur, "
        f"{r(pct('prev', bases['prev']))} AS prev_pct, {r(pct('cur', bases['cur']))} AS cur_pct, "
        f"{inc} AS inc_dec FROM (\n" + "\nUNION ALL\n".join(parts) + ")"
    )


PAIR = (
    "pair AS (SELECT *, CASE WHEN origin = dest THEN 'WC' ELSE dest_zone END AS zone_type "
    f"FROM ship WHERE {PAIR_DAYS})"
)
_CHARGES = "coalesce(sum(normal_weight_charges) FILTER ({m}), 0)"
_REVENUE = "sum(normal_revenue) FILTER ({m})"
_HEAD = "{0} AS dest_zone_type, '{1}' AS measure"
ORACLES["weight_charges_by_zone"] = with_(SHIPMENTS, PAIR) + _zone_report(
    [
        (_HEAD.format("zone_type", "c"), _CHARGES),
        (_HEAD.format("'Normal Weight Charges'", "c"), _CHARGES),
        (_HEAD.format("'Daily Normal Charge'", "c"), f"{double(_CHARGES)} / {{d}}::DOUBLE"),
    ],
    _CHARGES,
    False,
)
ORACLES["revenue_by_zone_cod"] = with_(SHIPMENTS, PAIR) + _zone_report(
    [
        (_HEAD.format("zone_type", "normal_weight_charges"), _CHARGES),
        (_HEAD.format("'normal_revenue'", "normal_revenue"), _REVENUE),
        (
            _HEAD.format("'Total Revenue - COD'", "normal_revenue"),
            "sum(normal_revenue) FILTER ({m} AND cod <> 0)",
        ),
        (
            _HEAD.format("'Total Revenue - NCOD'", "normal_revenue"),
            "sum(normal_revenue) FILTER ({m} AND cod = 0)",
        ),
        (
            _HEAD.format("'Daily Normal Charge'", "normal_revenue"),
            f"{double(_REVENUE)} / {{d}}::DOUBLE",
        ),
    ],
    _REVENUE,
    True,
)

# --- destination-day matrix: the join is left to multiply rows ----------------------
_CONDITIONS = {
    "wc": "s.origin = s.dest",
    "za": "s.origin <> s.dest AND s.dest_zone = 'A'",
    "zb": "s.origin <> s.dest AND s.dest_zone = 'B'",
    "zc": "s.origin <> s.dest AND s.dest_zone = 'C'",
}
_CELLS = {
    "n_s": ("1", False),
    "r_s": ("1", True),
    "n_wght": ("s.weight", False),
    "r_wght": ("s.weight", True),
    "n_wght_chgs": ("s.normal_weight_charges", False),
    "n_rev": ("s.normal_revenue", False),
    "r_rev": ("q.return_weight_charges", True),
}
_SUMS = []
for _prefix, (_value, _returned) in _CELLS.items():
    for _slot, _condition in _CONDITIONS.items():
        _extra = " AND q.return_cn <> ''" if _returned else ""
        _kind = "BIGINT" if _value == "1" else "DECIMAL(30,4)"
        _SUMS.append(
            f"CAST(sum(CASE WHEN {_condition}{_extra} THEN {_value} ELSE 0 END) AS {_kind}) "
            f"AS {_prefix}_{_slot}"
        )
MATRIX = (
    "matrix AS (SELECT s.master_dest, s.normal_cn_date, "
    + ", ".join(_SUMS)
    + f" FROM ship s LEFT JOIN ret q ON q.normal_cn = s.normal_cn WHERE s.{PAIR_DAYS} "
    "GROUP BY s.master_dest, s.normal_cn_date)"
)
_MATRIX_NAMES = [f"{p}_{s}" for p in _CELLS for s in SLOTS]
ORACLES["dest_day_zone_matrix"] = with_(SHIPMENTS, RETURNS, MATRIX) + (
    "SELECT master_dest, normal_cn_date, "
    + ", ".join(c if c[:4] in ("n_s_", "r_s_") else f"{double(c)} AS {c}" for c in _MATRIX_NAMES)
    + " FROM matrix ORDER BY n_s_wc DESC"
)
_R19 = {"WC": "r_rev_wc", "Zone_A": "r_rev_za", "Zone_B": "r_rev_zb", "Zone_C": "r_rev_zc"}
_R19_ALL = {"Total_Ret_Revenue": "r_rev_wc + r_rev_za + r_rev_zb + r_rev_zc", **_R19}
MONTHLY_MATRIX = (
    "dated AS (SELECT *, CAST(date_trunc('month', normal_cn_date) AS DATE) AS month_start FROM matrix)"
)
ORACLES["return_revenue_by_zone"] = with_(
    SHIPMENTS, RETURNS, MATRIX, MONTHLY_MATRIX, _zone_sums(_R19_ALL, "dated")
) + _compared({k: k for k in _R19_ALL}, "Total_Ret_Revenue", False, False)
ORACLES["top_dest_return_revenue"] = with_(SHIPMENTS, RETURNS, MATRIX, MONTHLY_MATRIX) + (
    "SELECT master_dest, "
    + ", ".join(
        f"{double(f'sum(r_rev_wc + r_rev_za + r_rev_zb + r_rev_zc) FILTER (month_start = {m})')} AS {role}"
        for role, m in ROLES.items()
    )
    + f" FROM dated GROUP BY master_dest ORDER BY cur DESC NULLS LAST, master_dest LIMIT {N}"
)

# --- top destinations ---------------------------------------------------------------


def _top(metric: str, n: int = N) -> str:
    return (
        f"best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY month_start "
        f"ORDER BY {metric} DESC, master_dest) AS k FROM d WHERE {metric} IS NOT NULL) WHERE k <= {n})"
    )


def _shown(values: list[str], wrap) -> list[str]:
    return [
        f"{wrap(f'coalesce({at(role, value)}, 0)')} AS {value}_{role}"
        for value in values
        for role in ROLES
    ]


def _by_zone(measure: str, zones: str = "ABC", column: str = "dest_zone") -> str:
    return ", ".join(
        f"sum({measure}) FILTER ({column} = '{z}') AS {z.lower()}" for z in zones.split(",")
    )


# A shipment without a number is not counted.
_ONE = "CASE WHEN normal_cn IS NULL THEN 0 ELSE 1 END"
ORACLES["top_dest_shipments"] = with_(
    SHIPMENTS,
    PAIR,
    f"d AS (SELECT month_start, master_dest, {_by_zone(_ONE, 'A,B,C')}, count(normal_cn) AS shipments "
    "FROM pair GROUP BY month_start, master_dest)",
    _top("shipments"),
) + (
    "SELECT master_dest, "
    + ", ".join(_shown(["a", "b", "c", "shipments"], lambda x: f"CAST({x} AS BIGINT)"))
    + " FROM best GROUP BY master_dest"
)
ORACLES["top_dest_weight"] = with_(
    SHIPMENTS,
    PAIR,
    f"d AS (SELECT month_start, master_dest, {_by_zone('weight', 'A,B,C')} "
    "FROM pair GROUP BY month_start, master_dest)",
    _top("a"),
) + (
    "SELECT master_dest, "
    + ", ".join(_shown(["a", "b", "c"], double))
    + " FROM best GROUP BY master_dest"
)
for _name, _measure in (
    ("top_dest_weight_charges", "normal_weight_charges"),
    ("top_dest_revenue", "normal_revenue"),
):
    _sums3 = {
        role: " + ".join(double(f"coalesce({at(role, z)}, 0)") for z in "abc") for role in ROLES
    }
    _base = {
        role: f"(SELECT {double(f'sum({_measure})')} FROM pair WHERE month_start = {m})"
        for role, m in ROLES.items()
    }
    ORACLES[_name] = with_(
        SHIPMENTS,
        PAIR,
        f"d AS (SELECT month_start, master_dest, {_by_zone(_measure, 'A,B,C')} "
        "FROM pair GROUP BY month_start, master_dest)",
        _top("a"),
        "t AS (SELECT master_dest, "
        + ", ".join(_shown(["a", "b", "c"], double))
        + ", "
        + ", ".join(f"{r(s)} AS total_{role}" for role, s in _sums3.items())
        + " FROM best GROUP BY master_dest)",
    ) + (
        "SELECT *, "
        + ", ".join(f"{r(pct(f'total_{role}', _base[role]))} AS pct_{role}" for role in ROLES)
        + " FROM t"
    )

for _name, _alias, _over, _under in (
    ("top_dest_rps", "rps", "normal_revenue", _ONE),
    ("top_dest_rpw", "rpw", "normal_revenue", "weight"),
    ("top_dest_wps", "ws", "weight", _ONE),
):
    _zone_ratios = ", ".join(
        div(f"sum({_over}) FILTER (zone_type = '{z}')", f"sum({_under}) FILTER (zone_type = '{z}')")
        + f" AS {z.lower()}"
        for z in ("A", "B", "C", "WC")
    )
    ORACLES[_name] = with_(
        SHIPMENTS,
        PAIR,
        f"d AS (SELECT month_start, master_dest, {_zone_ratios}, "
        f"{div(f'sum({_over})', f'sum({_under})')} AS {_alias} "
        "FROM pair GROUP BY month_start, master_dest)",
        _top(_alias),
    ) + (
        "SELECT master_dest, "
        + ", ".join(_shown(["a", "b", "c", "wc", _alias], r))
        + " FROM best GROUP BY master_dest"
    )

for _name, _value, _column, _round in (
    ("top_dest_returns", "count(q.return_cn)", "ret_ship", False),
    ("top_dest_return_weight", "sum(s.weight)", "r_wght", True),
):
    _wrap = r if _round else (lambda x: x)
    _share = r(pct("v", "b.base"))
    _cells2 = {role: f"coalesce({at(role, double('v')).replace('month_start', 'best.month_start')}, 0)" for role in ROLES}
    _shares2 = {
        role: f"coalesce({at(role, _share).replace('month_start', 'best.month_start')}, 0)"
        for role in ROLES
    }
    ORACLES[_name] = with_(
        *HISTORY,
        "d AS (SELECT CAST(date_trunc('month', q.normal_cn_date) AS DATE) AS month_start, "
        f"s.master_dest, {_value} AS v FROM ship s JOIN ret q ON s.normal_cn = q.normal_cn "
        # Returns dated in other months belong to neither column.
        f"WHERE s.{PAIR_DAYS} AND date_trunc('month', q.normal_cn_date) IN ({PREV}, {CUR}) GROUP BY ALL)",
        _top("v"),
        f"b AS (SELECT month_start, sum({_column}) AS base FROM mom GROUP BY month_start)",
        "t AS (SELECT master_dest, "
        + ", ".join(f"{c} AS {role}" for role, c in _cells2.items())
        + ", "
        + ", ".join(f"{c} AS {role}_pct" for role, c in _shares2.items())
        + " FROM best LEFT JOIN b ON b.month_start = best.month_start GROUP BY master_dest)",
    ) + (
        "SELECT master_dest, "
        + ", ".join(f"{_wrap(c)} AS {c}" for c in ("prev", "cur", "prev_pct", "cur_pct"))
        + f", {positive_zero(_wrap('(cur - prev)'))} AS inc_dec FROM t"
    )

# --- customers ----------------------------------------------------------------------
_EDGES = (0, 1, 2, 3, 4)


def _pct_text(value: str) -> str:
    return f"printf('%.2f%%', {r(value)})"


_BANDS = ", ".join(f"({low}, {high}, '{low}-{high}')" for low, high in zip(_EDGES, _EDGES[1:]))
_BAND_CELLS = []
for _measure, _aggregate, _all, _show in (
    ("customers", "count(w.acc_no)", "(SELECT count(acc_no) FROM win)", "CAST({} AS BIGINT)"),
    ("shipments", "coalesce(sum(w.shipments), 0)", "(SELECT sum(shipments) FROM win)", "CAST({} AS BIGINT)"),
    ("weight", "coalesce(sum(w.n_wght), 0)", "(SELECT sum(n_wght) FROM win)", "CAST({} AS DOUBLE)"),
    ("revenue", "coalesce(sum(w.n_rev), 0)", "(SELECT sum(n_rev) FROM win)", "CAST({} AS DOUBLE)"),
):
    _BAND_CELLS.append(f"{_show.format(_aggregate)} AS {_measure}")
    _BAND_CELLS.append(f"{_pct_text(pct(_aggregate, _all))} AS {_measure}_pct")
ORACLES["shipment_bands"] = with_(
    *WINDOWED, f"bands(low, high, band) AS (VALUES {_BANDS})"
) + (
    "SELECT band, "
    + ", ".join(_BAND_CELLS)
    + f", coalesce({div('sum(w.n_rev)', 'count(w.month_start)')}, 0) AS rps"
    + f", coalesce({div('sum(w.n_rev)', 'sum(w.n_wght)')}, 0) AS rpw"
    + f", coalesce({div('sum(w.n_wght)', 'count(w.month_start)')}, 0) AS ws"
    + " FROM bands LEFT JOIN win w ON w.shipments >= low AND w.shipments < high GROUP BY band"
)

METRICS = f"""metrics AS (
  SELECT *,
    {r(div('n_rev', 'shipments'))} AS rps,
    {r(div('n_rev', 'n_wght'))} AS rpw,
    {r(div('n_wght', 'shipments'))} AS ws,
    {pct('ret_ship', 'shipments')} AS return_ratio,
    {pct('(r_s_wc + r_s_za)', 'shipments')} AS return_ratio_wc_za,
    {pct('(n_s_wc + n_s_za)', 'shipments')} AS wc_za,
    {pct('(kg_0_0_5 + kg_0_5_1_0)', 'shipments')} AS kg_0_1,
    {pct('n_rev', '(SELECT sum(n_rev) FROM win)')} AS revenue_pct,
    {r(div('ret_revenue', 'ret_ship'), 0)} AS return_tariff,
    {pct('n_s_zb', 'shipments')} AS zb
  FROM win)"""
ORACLES["customer_metrics"] = with_(*WINDOWED, METRICS) + (
    "SELECT acc_no, month_start, rps, rpw, ws, return_ratio, return_ratio_wc_za, wc_za, kg_0_1, "
    "revenue_pct, return_tariff, zb FROM metrics"
)
_BOARDS = (
    ("Top5Shipments", "shipments", "DESC"),
    ("Top5Revenue", "n_rev", "DESC"),
    ("Top5RPS", "rps", "DESC"),
    ("Top5RPW", "rpw", "DESC"),
    ("Top5LowestRPS", "rps", "ASC"),
    ("Top5LowestRPW", "rpw", "ASC"),
    ("Top5HighestReturnRatio", "return_ratio", "DESC"),
    ("Top5ZBShipments", "zb", "DESC"),
)


def _board(name: str, column: str, direction: str) -> str:
    zone = "zb" if column == "zb" else "wc_za"
    return f"""SELECT * FROM (SELECT '{name}' AS leaderboard,
  row_number() OVER (ORDER BY {double(column)} {direction}, acc_no, sp_name, month_start) AS rank,
  cust_name AS customer, sp_name AS sp, format('{{:,}}', CAST(shipments AS BIGINT)) AS total_shipments,
  {_pct_text(zone)} AS zone_share, {_pct_text('kg_0_1')} AS kg_0_1,
  format('{{:,.2f}}', {r(double('n_wght'))}) AS weight, format('{{:,.2f}}', {r(double('n_rev'))}) AS revenue,
  {_pct_text('revenue_pct')} AS revenue_pct, rps, rpw, ws, return_tariff,
  CAST(ret_ship AS BIGINT) AS return_shipments, {_pct_text('return_ratio')} AS return_ratio,
  {_pct_text('return_ratio_wc_za')} AS return_ratio_wc_za
FROM metrics WHERE shipments >= 2 AND ws >= 0.5 AND {column} IS NOT NULL) WHERE rank <= 5"""


ORACLES["top_customers"] = with_(*WINDOWED, METRICS) + "\nUNION ALL\n".join(
    _board(*board) for board in _BOARDS
)

_KEYS = "('C-54','C-138','C-140','C-26','C-68','C-7')"
_GROUP = "('C-140','C-26','C-68','C-7')"
_TREND_ORDER = "['Total_Shipments','Total_Weight','Total_Revenue','RPS','RPW','WS']"


def _trend(accounts: str, keys: str) -> str:
    return (
        with_(
            SHIPMENTS,
            CUSTOMERS,
            f"""t AS (
  SELECT {keys} s.month_start,
    {double('count(s.normal_cn)')} AS "Total_Shipments",
    {double('sum(s.weight)')} AS "Total_Weight",
    {double('sum(s.normal_revenue)')} AS "Total_Revenue",
    {r(div('sum(s.normal_revenue)', 'count(s.normal_cn)'))} AS "RPS",
    {r(div('sum(s.normal_revenue)', 'sum(s.weight)'))} AS "RPW",
    {r(div('sum(s.weight)', 'count(s.normal_cn)'))} AS "WS"
  FROM ship s JOIN crf c ON c.acc_no = s.acc_no
  WHERE s.acc_no IN {accounts} AND s.normal_cn_date BETWEEN DATE '1999-01-01' AND DATE '2001-06-30'
    AND s.month_start BETWEEN DATE '1999-01-01' AND DATE '2001-06-30'
  GROUP BY ALL)""",
            'l AS (FROM t UNPIVOT INCLUDE NULLS (value FOR metric IN ("Total_Shipments", '
            '"Total_Weight", "Total_Revenue", "RPS", "RPW", "WS")))',
        )
        + f"SELECT * REPLACE (coalesce(value, 0) AS value), "
        f"CAST(list_position({_TREND_ORDER}, metric) AS BIGINT) AS ord FROM l"
    )


ORACLES["key_account_trend"] = _trend(_KEYS, "c.cust_name AS customer,")
ORACLES["key_account_group_trend"] = _trend(_GROUP, "")

ORACLES["all_data_extract"] = with_(*HISTORY) + f"""
SELECT month_start, cust_type, acc_no, sp_name, CAST(shipments AS BIGINT) AS shipments,
  {double('n_wght')} AS weight, {double('n_wght_chgs')} AS weight_charges,
  {double('n_oth_chgs')} AS other_charges, {double('n_rev')} AS revenue,
  CAST(n_s_za AS BIGINT) AS shipment_zone_a, {double('n_fsc')} AS fsc,
  {double('n_rev - n_fsc')} AS revenue_without_fsc, 'Normal' AS type
FROM mom WHERE {YEAR}
UNION ALL
SELECT month_start, cust_type, acc_no, sp_name, CAST(ret_ship AS BIGINT), {double('r_wght')},
  {double('r_wght_chrg')}, 0, {double('ret_revenue')}, CAST(r_s_za AS BIGINT), 0,
  {double('ret_revenue')}, 'Return'
FROM mom WHERE {YEAR} AND ret_ship <> 0"""

_NOW = f"now AS (SELECT * FROM mom WHERE month_start = {CUR})"


def _or0(value: str) -> str:
    return f"coalesce({value}, 0)"


ORACLES["sp_customer_scorecard"] = with_(
    *HISTORY,
    _NOW,
    """g AS (
  SELECT sp_name, cust_name, acc_no, sum(shipments) AS shipment, sum(n_s_wc) AS wc,
    sum(n_s_za) AS za, sum(n_s_zb) AS zb, sum(n_s_zc) AS zc,
    sum(kg_0_0_5 + kg_0_5_1_0) AS light, sum(n_wght) AS n_wght, sum(n_rev) AS n_rev,
    sum(r_s_chrg) AS ret_ship_chrg, sum(r_s_za) AS r_s_za, sum(ret_ship) AS ret_ship,
    sum(ret_revenue) AS ret_revenue
  FROM now GROUP BY ALL)""",
) + f"""
SELECT g.sp_name, cust_name, acc_no, CAST(shipment AS BIGINT) AS shipment,
  {double('g.n_wght')} AS n_wght, {double('g.n_rev')} AS n_rev,
  CAST(ret_ship_chrg AS BIGINT) AS ret_ship_chrg, CAST(r_s_za AS BIGINT) AS r_s_za,
  CAST(ret_ship AS BIGINT) AS ret_ship, {double('ret_revenue')} AS ret_revenue,
  {_or0(r(pct('wc', 'shipment')))} AS wc_pct, {_or0(r(pct('za', 'shipment')))} AS za_pct,
  {_or0(r(pct('zb', 'shipment')))} AS zb_pct, {_or0(r(pct('zc', 'shipment')))} AS zc_pct,
  {_or0(r(pct('light', 'shipment')))} AS kg_0_1_pct,
  {_or0(r(pct('g.n_rev', '(SELECT sum(n_rev) FROM now)')))} AS revenue_share_total,
  {_or0(r(pct('g.n_rev', 'sum(g.n_rev) OVER (PARTITION BY g.sp_name)')))} AS revenue_share_sp,
  {_or0(r(div('n_rev', 'shipment'), 0))} AS rps, {_or0(r(div('n_rev', 'n_wght'), 0))} AS rpw,
  {_or0(r(div('n_wght', 'shipment'), 0))} AS ws,
  {_or0(pct('r_s_za', '(SELECT sum(n_s_za) FROM now)'))} AS zone_a_return_pct,
  {_or0(r(pct('ret_ship', 'shipment')))} AS return_ratio
FROM g"""
ORACLES["sp_totals"] = with_(*HISTORY, _NOW) + f"""
SELECT sp_name, {r(pct('sum(n_s_wc)', 'sum(shipments)'))} AS wc_pct,
  {r(pct('sum(n_s_za)', 'sum(shipments)'))} AS za_pct,
  {r(pct('sum(kg_0_0_5 + kg_0_5_1_0)', 'sum(shipments)'))} AS kg_0_1_pct
FROM now GROUP BY sp_name"""
ORACLES["sp_list"] = with_(SHIPMENTS) + "SELECT DISTINCT upper(trim(sp_name)) AS sp_name FROM ship"
