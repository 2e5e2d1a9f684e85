"""CTE fragments: the raw layer of FIXTURES.md in DuckDB SQL.

Money is carried in integer cents, ratios are rounded half-up in integer
arithmetic and exposed as double, so both engines produce identical values.
"""

from __future__ import annotations

SK = "(2440588 + datediff('day', DATE '1970-01-01', CAST({c} AS DATE)))"

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (deps, body)


cte("date_dim", [], """
SELECT CAST(2440588 + datediff('day', DATE '1970-01-01', cal_dt) AS BIGINT) AS d_date_sk,
       cal_dt,
       CAST(dayofweek(cal_dt) AS BIGINT) AS day_of_wk_num,
       CAST((dayofyear(cal_dt) - 1 + dayofweek(make_date(year(cal_dt), 1, 1))) // 7 + 1 AS BIGINT) AS wk_num,
       CAST(month(cal_dt) AS BIGINT) AS mnth_num,
       CAST(year(cal_dt) AS BIGINT) AS yr_num
FROM (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS cal_dt
      FROM (SELECT year(min(l_shipdate)) AS y0, year(max(l_shipdate)) AS y1 FROM lineitem) span) days
""")

_LINES = """
SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS ec, CAST(l_quantity AS BIGINT) AS q,
       CAST(round(l_discount * 100) AS BIGINT) AS dp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE {cond}
"""


def _sales(p: str, cond: str, cust_col: str, extra: str) -> str:
    return f"""
SELECT CAST(CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE {SK.format(c='l_shipdate')} END AS BIGINT) AS {p}_sold_date_sk,
       CAST(l_partkey AS BIGINT) AS {p}_item_sk,
       CAST(CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_suppkey END AS BIGINT) AS {p}_warehouse_sk,
       CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE q END AS {p}_quantity,
       CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE ec // (10 * q) END AS {p}_price_cents,
       CASE WHEN l_orderkey % 47 = 0 THEN NULL ELSE ec * (100 - dp) // 1000 - 9000 * q END AS {p}_profit_cents,
       CAST(CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE o_custkey END AS BIGINT) AS {cust_col}{extra}
FROM ({_LINES.format(cond=cond)}) x
"""


_CS_EXTRA = f""",
       CAST(l_orderkey % 1440 AS BIGINT) AS cs_sold_time_sk,
       CAST({SK.format(c='l_shipdate')} + l_linenumber AS BIGINT) AS cs_ship_date_sk,
       CAST(o_custkey AS BIGINT) AS cs_bill_customer_sk,
       CAST(o_custkey % 50 + 1 AS BIGINT) AS cs_bill_cdemo_sk,
       CAST(CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE o_custkey % 20 + 1 END AS BIGINT) AS cs_bill_hdemo_sk,
       CAST(o_custkey % 25 + 1 AS BIGINT) AS cs_bill_addr_sk,
       CAST(o_custkey % 50 + 1 AS BIGINT) AS cs_ship_cdemo_sk,
       CAST(CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE o_custkey % 20 + 1 END AS BIGINT) AS cs_ship_hdemo_sk,
       CAST(l_orderkey % 6 + 1 AS BIGINT) AS cs_call_center_sk,
       CAST(l_orderkey % 100 + 1 AS BIGINT) AS cs_catalog_page_sk,
       CAST(l_orderkey % 20 + 1 AS BIGINT) AS cs_ship_mode_sk,
       CAST(l_orderkey % 30 + 1 AS BIGINT) AS cs_promo_sk"""
_WS_EXTRA = """,
       CAST(l_orderkey % 60 + 1 AS BIGINT) AS ws_web_page_sk,
       CAST(l_orderkey % 12 + 1 AS BIGINT) AS ws_web_site_sk"""

cte("catalog_sales", [], _sales("cs", "l_linenumber <= 4", "cs_ship_customer_sk", _CS_EXTRA))
cte("web_sales", [], _sales("ws", "l_linenumber > 4", "ws_bill_customer_sk", _WS_EXTRA))

cte("item", [], "SELECT CAST(p_partkey AS BIGINT) AS i_item_sk, p_name AS i_product_name, p_type AS i_item_desc FROM part")

cte("warehouse", [], "SELECT DISTINCT CAST(s_suppkey AS BIGINT) AS w_warehouse_sk FROM supplier")

cte("inventory", ["date_dim"], f"""
SELECT CAST(d AS INTEGER) AS inv_date_sk, CAST(i AS INTEGER) AS inv_item_sk,
       CAST(CASE WHEN (i * 31 + w * 17 + d // 7) % 13 = 0 THEN NULL
                 ELSE (i * 31 + w * 17 + (d // 7) * 7) % 60 END AS INTEGER) AS inv_quantity_on_hand,
       CAST(w AS INTEGER) AS inv_warehouse_sk
FROM (SELECT i, w, dow, sunday + dow AS d
      FROM (SELECT DISTINCT l_partkey AS i, l_suppkey AS w, sk - (sk + 1) % 7 AS sunday
            FROM (SELECT l_partkey, l_suppkey, {SK.format(c='l_shipdate')} AS sk FROM lineitem) l) p, (VALUES (0), (3)) t(dow)) x
WHERE (dow = 0 AND (i + w + d // 7) % 11 <> 0) OR (dow = 3 AND i % 20 = 7)
""")


def _customer(batch: int) -> str:
    last = "c_name"
    hdemo = "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey % 20 + 1 END"
    sal = ("CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Mr.' "
           "WHEN c_custkey % 3 = 1 THEN 'Ms.' ELSE 'Dr.' END")
    src = "SELECT *, c_custkey AS ident FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"
    if batch >= 2:
        changed = "c_custkey % 10 = 3" + (" AND c_custkey % 20 <> 3" if batch >= 3 else "")
        last = f"CASE WHEN {changed} THEN c_name || '-x' ELSE c_name END"
        hdemo = f"CASE WHEN c_custkey % 23 = 0 AND c_custkey % 10 = 4 THEN 0 ELSE {hdemo} END"
        src = (f"SELECT * FROM ({src}) b WHERE c_custkey % 17 <> 5 UNION ALL "
               f"SELECT * REPLACE (c_custkey + 1000000000 AS ident) FROM ({src}) b2 "
               f"WHERE c_custkey IN (1, 2)")
    if batch >= 3:
        sal = f"CASE WHEN c_custkey % 31 = 0 THEN 'Mr.' ELSE {sal} END"
    return f"""
SELECT {sal} AS c_salutation,
       CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
       CAST(CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey % 365 + 2449719 END AS BIGINT) AS c_first_sales_date_sk,
       CAST(ident AS BIGINT) AS c_customer_sk,
       '' AS c_login,
       CAST(c_custkey % 50 + 1 AS BIGINT) AS c_current_cdemo_sk,
       c_mktsegment AS c_first_name,
       CAST({hdemo} AS BIGINT) AS c_current_hdemo_sk,
       CAST(CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_nationkey + 1 END AS BIGINT) AS c_current_addr_sk,
       {last} AS c_last_name,
       'C' || CAST(ident AS VARCHAR) AS c_customer_id,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 100 + 2451000 END AS BIGINT) AS c_last_review_date_sk,
       CAST(c_custkey % 12 + 1 AS BIGINT) AS c_birth_month,
       n_name AS c_birth_country,
       CAST(c_custkey % 60 + 1940 AS BIGINT) AS c_birth_year,
       CAST(c_custkey % 28 + 1 AS BIGINT) AS c_birth_day,
       lower(c_mktsegment) || CAST(ident AS VARCHAR) || '@example.com' AS c_email_address,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 365 + 2449750 END AS BIGINT) AS c_first_shipto_date_sk
FROM ({src}) s
"""


for _b in (1, 2, 3):
    cte(f"customer_b{_b}", [], _customer(_b))

cte("customer_address", [], """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS ca_address_sk,
       'Street ' || CAST(n_nationkey + 1 AS VARCHAR) AS ca_street_name,
       'Suite ' || CAST((n_nationkey + 1) * 10 AS VARCHAR) AS ca_suite_number,
       r_name AS ca_state,
       CASE WHEN (n_nationkey + 1) % 3 = 0 THEN 'apartment' WHEN (n_nationkey + 1) % 3 = 1 THEN 'condo'
            ELSE 'single family' END AS ca_location_type,
       n_name AS ca_country,
       'A' || CAST(n_nationkey + 1 AS VARCHAR) AS ca_address_id,
       n_name || ' County' AS ca_county,
       CAST((n_nationkey + 1) * 7 % 1000 AS VARCHAR) AS ca_street_number,
       lpad(CAST((n_nationkey + 1) * 1231 % 100000 AS VARCHAR), 5, '0') AS ca_zip,
       'City ' || CAST(n_nationkey + 1 AS VARCHAR) AS ca_city,
       CAST(-((n_nationkey + 1) % 6) - 5 AS DOUBLE) AS ca_gmt_offset
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")

cte("customer_demographics", [], """
SELECT k AS cd_demo_sk,
       CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS cd_gender,
       (['M', 'S', 'D', 'W', 'U'])[k % 5 + 1] AS cd_marital_status,
       (['Primary', 'Secondary', 'College', '2 yr Degree', '4 yr Degree', 'Advanced Degree', 'Unknown'])[k % 7 + 1]
           AS cd_education_status,
       CAST(k % 20 * 500 + 500 AS BIGINT) AS cd_purchase_estimate,
       (['Good', 'Low Risk', 'High Risk', 'Unknown'])[k % 4 + 1] AS cd_credit_rating,
       CAST(k % 7 AS BIGINT) AS cd_dep_count,
       CAST(k % 5 AS BIGINT) AS cd_dep_employed_count,
       CAST(k % 3 AS BIGINT) AS cd_dep_college_count
FROM (SELECT DISTINCT CAST(c_custkey % 50 + 1 AS BIGINT) AS k FROM customer) d WHERE k < 50
""")

cte("household_demographics", [], """
SELECT k AS hd_demo_sk, CAST(k % 5 + 1 AS BIGINT) AS hd_income_band_sk,
       (['0-500', '501-1000', '1001-5000', '5001-10000', '>10000', 'Unknown'])[k % 6 + 1] AS hd_buy_potential,
       CAST(k % 10 AS BIGINT) AS hd_dep_count, CAST(k % 5 AS BIGINT) AS hd_vehicle_count
FROM (SELECT DISTINCT CAST(c_custkey % 20 + 1 AS BIGINT) AS k FROM customer) h
""")

cte("income_band", ["household_demographics"], """
SELECT k AS ib_income_band_sk, CAST((k - 1) * 10000 + 1 AS BIGINT) AS ib_lower_bound,
       CAST(k * 10000 AS BIGINT) AS ib_upper_bound
FROM (SELECT DISTINCT hd_income_band_sk AS k FROM household_demographics) b
""")

for _name, (_lo, _hi, _col) in {
    "time_dim": (0, 1439, "t_time_sk"), "call_center": (1, 5, "cc_call_center_sk"),
    "catalog_page": (1, 100, "cp_catalog_page_sk"), "ship_mode": (1, 20, "sm_ship_mode_sk"),
    "promotion": (1, 29, "p_promo_sk"), "web_page": (1, 60, "wp_web_page_sk"),
    "web_site": (1, 12, "web_site_sk"),
}.items():
    cte(_name, [], f"SELECT CAST(range AS BIGINT) AS {_col} FROM range({_lo}, {_hi + 1})")


def with_ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH clause holding ``names`` (plus dependencies) and extra CTEs."""
    order: list[str] = []

    def add(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            add(d)
        order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTE[n][1].strip()})" for n in order]
    parts += [f"{n} AS ({body.strip()})" for n, body in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"


def ratio6(num: str, den: str) -> str:
    """HALF_UP(num / den, 6 places) as double; num, den integers, den > 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CAST(sign({n}) * ((abs({n}) * 2000000 + {d}) // (2 * {d})) AS DOUBLE) / 1000000.0)"


def cents(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 100.0)"
