"""DuckDB SQL for every registered query (the correctness oracle).

Only the driver tables are registered in DuckDB, so each statement carries
the input adapters and the pipeline steps as CTEs.  Money is summed as
DECIMAL and published as DOUBLE, exactly as the Spark side does.
"""

from __future__ import annotations


# --- fixed values, written here a second time so that a slip on the Spark side shows ----
UNMAPPED = "Need Mapping"
REVENUE_CATEGORIES = (("Service", "Services"), ("Support", "Support"), ("Product", "Products"))
OPPORTUNITY_CATEGORIES_V1 = (("Services:", "Services"), ("Support:", "Support"), ("Products:", "Products"))
OPPORTUNITY_CATEGORIES = (*OPPORTUNITY_CATEGORIES_V1, ("Product:", "Products"))
MONTHS_LEFT = (("July", 11), ("August", 10), ("September", 9), ("October", 8), ("November", 7),
               ("December", 6), ("January", 5), ("February", 4), ("March", 3), ("April", 2),
               ("May", 1), ("June", 0))
CALENDAR_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
                   "September", "October", "November", "December")
BANDS = (("$0 to $10,000", 0, 10000), ("$10000 to $50,000", 10000, 50000),
         ("$50000 to $100,000", 50000, 100000), ("$100,000 to $200,000", 100000, 200000))
REVENUE_TYPES = {"A": "Actuals", "N": "Partner Fee", "R": "Registration Fee"}
PART_CATEGORIES = {"STANDARD": "Standard Services", "MEDIUM": "Medium Service Desk",
                   "LARGE": "Large Support", "SMALL": "Small Products",
                   "ECONOMY": "Economy Product", "PROMO": "Promo Bundle"}
PRODUCTS = {"1-URGENT": "Services: Urgent", "2-HIGH": "Support: High",
            "3-MEDIUM": "Products: Medium", "4-NOT SPECIFIED": "Product: Unspecified"}
TARGET_CATEGORIES = {0: "Services", 1: "Support", 2: "Products"}
# --- end of fixed values ------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {expr} = {_q(k) if isinstance(k, str) else k} THEN {_q(v)}"
                     for k, v in mapping.items())
    return f"CASE {whens} END"


def _categorise(expr: str, rules) -> str:
    whens = " ".join(f"WHEN {expr} LIKE {_q('%' + needle + '%')} THEN {_q(cat)}"
                     for needle, cat in rules)
    return f"CASE {whens} ELSE {_q(UNMAPPED)} END"


def _months_left(expr: str, include_current: bool = False) -> str:
    whens = []
    for name, after in MONTHS_LEFT:
        left = after + (1 if include_current else 0)
        whens.append(f"WHEN {expr} LIKE {_q('%' + name + '%')} THEN {left}")
    return "CASE " + " ".join(whens) + " END"


def _band(expr: str) -> str:
    whens = [f"WHEN {expr} < 0 THEN 'Below $0'"]
    whens += [f"WHEN {expr} BETWEEN {lo} AND {hi} THEN {_q(label)}" for label, lo, hi in BANDS]
    return "CASE " + " ".join(whens) + " ELSE '$200,000 +' END"


def _acct(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 8, '0')"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


def _fmt(expr: str) -> str:
    return f"format('{{:,.2f}}', CAST({expr} AS DOUBLE))"


def _parse(expr: str) -> str:
    return f"TRY_CAST(replace({expr}, ',', '') AS DECIMAL(38,6))"


KEYS = ("Account_No", "Fiscal_Month", "Product_Category")


def _full(a: str, b: str, am, bm) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in KEYS)
    cols = [f"COALESCE(a.{k}, b.{k}) AS {k}" for k in KEYS]
    cols += [f"COALESCE(a.{m}, 0) AS {m}" for m in am]
    cols += [f"COALESCE(b.{m}, 0) AS {m}" for m in bm]
    return f"SELECT {', '.join(cols)} FROM {a} a FULL JOIN {b} b ON {on}"


def _union_sum(parts, keys=KEYS) -> str:
    measures = []
    for _, ms in parts:
        measures += [m for m in ms if m not in measures]
    sels = []
    for name, ms in parts:
        cols = [*keys] + [(f"CAST({m} AS DECIMAL(38,6)) AS {m}" if m in ms
                           else f"CAST(0 AS DECIMAL(38,6)) AS {m}") for m in measures]
        sels.append(f"SELECT {', '.join(cols)} FROM {name}")
    sums = ", ".join(f"COALESCE(SUM({m}), 0) AS {m}" for m in measures)
    k = ", ".join(keys)
    return f"SELECT {k}, {sums} FROM ({' UNION ALL '.join(sels)}) u GROUP BY {k}"


_MONTH_ARRAY = "[" + ", ".join(_q(m) for m in CALENDAR_MONTHS) + "]"
REV_M = ("Revenue", "Partner_Fee", "Registration_Fee")
OPP_M = ("Opportunity_Usage", "Opportunity_Extrapolation")
P12_M = (*REV_M, *OPP_M, "Baseline", "Target", "Opportunities_Into_RR")
MONTH_ATTRS = ("Fiscal_Quarter", "Fiscal_Year", "Month_ID")
ACCOUNT_ATTRS = ("Account_Name", "Industry", "Vertical", "Segment", "Store_Manager_Alias",
                 "Potential_Account", "Vertical_Manager_Alias")
SELLER_ATTRS = ("General_Seller", "Services_Seller", "Product_Seller", "Support_Seller")
DETAIL = ("Account_No", "Product_Category", "Fiscal_Month", "Product", "Opportunity_ID",
          "Opportunity_Name", "Project_Status", "Opportunity_Status", "Opportunity_Stage")


def _ctes() -> list[tuple[str, str]]:
    ctes: list[tuple[str, str]] = []
    add = lambda n, s: ctes.append((n, s))

    # ---- adapters ----------------------------------------------------------
    add("cal", f"""
SELECT CAST(d AS DATE) AS Date_Value,
       {_MONTH_ARRAY}[month(d)] || ', ' || CAST(year(d) AS VARCHAR) AS Fiscal_Month,
       'Q' || CAST(((month(d) + 5) % 12) // 3 + 1 AS VARCHAR) AS Fiscal_Quarter,
       'FY' || CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS VARCHAR) AS Fiscal_Year,
       CAST(year(d) * 12 + month(d) AS INTEGER) AS Month_ID
FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-06-30',
                                    INTERVAL 1 DAY)) AS d) g""")
    add("rev_raw", f"""
SELECT {_acct('o.o_custkey')} AS StoreNo,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS "Month",
       {_case_map('l.l_returnflag', REVENUE_TYPES)} AS Revenue_Type,
       l.l_linestatus AS Revenue_Motion,
       {_case_map("split_part(p.p_type, ' ', 1)", PART_CATEGORIES)} AS Product_Category,
       o.o_orderpriority AS Motion,
       CASE WHEN l.l_shipdate < TIMESTAMP '2001-02-01' THEN {_money('l.l_extendedprice')}
            ELSE CAST(0 AS DECIMAL(18,2)) END AS Revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey""")
    add("rev_dirty", f"""
SELECT {_acct('o.o_custkey')} AS StoreNo,
       CASE WHEN l.l_orderkey % 79 = 0 THEN '2001-13-01'
            ELSE CAST(CAST(date_trunc('month', l.l_shipdate) AS DATE) AS VARCHAR) END AS "Month",
       {_case_map('l.l_returnflag', REVENUE_TYPES)} AS Revenue_Type,
       l.l_linestatus AS Revenue_Motion,
       {_case_map("split_part(p.p_type, ' ', 1)", PART_CATEGORIES)} AS Product_Category,
       o.o_orderpriority AS Motion,
       CASE WHEN l.l_orderkey % 97 = 0 THEN 'n/a' WHEN l.l_orderkey % 89 = 0 THEN '12.345'
            WHEN l.l_orderkey % 83 = 0 THEN '1e30'
            WHEN l.l_shipdate < TIMESTAMP '2001-02-01' THEN CAST({_money('l.l_extendedprice')} AS VARCHAR)
            ELSE '0.00' END AS Revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey""")
    amount = _fmt(_money("o_totalprice"))
    add("opp_base", f"""
SELECT o_orderkey AS _key,
       {_acct('o_custkey')} AS Store_No,
       CAST(o_orderdate AS DATE) AS Opportunity_Est_Date,
       CASE WHEN o_orderpriority = '5-LOW'
            THEN CASE WHEN o_orderkey % 2 = 0 THEN 'NULL' END
            ELSE {_case_map('o_orderpriority', PRODUCTS)} END AS Product,
       CAST(o_orderkey AS VARCHAR) AS Opportunity_ID,
       'Opportunity ' || CAST(o_orderkey AS VARCHAR) AS Opportunity_Name,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Inactive'
            ELSE 'Active' END AS Project_Status,
       o_orderstatus AS Opportunity_Status,
       o_orderpriority AS Opportunity_Stage,
       CASE WHEN o_orderkey % 17 = 0 THEN 'NULL'
            WHEN o_orderkey % 10 = 0 THEN '-' || {amount}
            ELSE {amount} END AS Opportunity_Usage
FROM orders""")
    add("opp_raw", "SELECT * EXCLUDE (_key) FROM opp_base")
    add("opp_dirty", """
SELECT * EXCLUDE (_key) REPLACE (CASE WHEN _key % 97 = 0 THEN 'n/a' WHEN _key % 89 = 0 THEN '1e60'
  WHEN _key % 83 = 0 THEN '1,234.5600001' ELSE Opportunity_Usage END AS Opportunity_Usage) FROM opp_base""")
    scaled = _fmt(f"CAST({_parse('Opportunity_Usage')} * 0.9 AS DECIMAL(18,2))")
    add("opp_prev", f"""
SELECT Store_No,
       CASE WHEN _key % 11 = 0 THEN Opportunity_Est_Date - 30 ELSE Opportunity_Est_Date END
         AS Opportunity_Est_Date,
       Product, Opportunity_ID, Opportunity_Name, Project_Status, Opportunity_Status,
       Opportunity_Stage,
       CASE WHEN _key % 7 = 0 AND Opportunity_Usage <> 'NULL' THEN {scaled}
            ELSE Opportunity_Usage END AS Opportunity_Usage
FROM opp_base WHERE _key % 13 <> 0
UNION ALL
SELECT Store_No, Opportunity_Est_Date, Product, CAST(_key + 100000000 AS VARCHAR),
       Opportunity_Name, Project_Status, Opportunity_Status, Opportunity_Stage, Opportunity_Usage
FROM opp_base WHERE _key % 23 = 0""")
    add("tgt_raw", f"""
SELECT {_acct('o_custkey')} AS Store_Number,
       {_case_map('o_orderkey % 3', TARGET_CATEGORIES)} AS Product_Category,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS Fiscal_Month,
       CAST(SUM({_money('o_totalprice')}) AS DECIMAL(18,2)) AS Target
FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-07-01' AND o_orderdate < TIMESTAMP '2001-07-01'
GROUP BY 1, 2, 3""")
    add("acct", f"""
SELECT {_acct('c.c_custkey')} AS AccountNo, c.c_name AS Store, c.c_mktsegment AS Industry,
       r.r_name AS Vertical, n.n_name AS Segment,
       'm' || CAST(c.c_custkey % 8 AS VARCHAR) AS Store_Manager_Alias,
       CASE WHEN c.c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS Potential_Account,
       'v' || CAST(n.n_regionkey AS VARCHAR) AS Vertical_Manager_Alias
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                JOIN region r ON n.n_regionkey = r.r_regionkey""")
    add("sell", f"""
SELECT {_acct('c_custkey')} AS Store_ID, c_name AS Company,
       'g' || CAST(c_custkey % 8 AS VARCHAR) AS General_Seller,
       's' || CAST(c_custkey % 68 AS VARCHAR) AS Services_Seller,
       'u' || CAST(c_custkey % 30 AS VARCHAR) AS Support_Seller,
       'p' || CAST(c_custkey % 10 AS VARCHAR) AS Product_Seller
FROM customer WHERE c_custkey % 5 <> 0""")

    # ---- calendar dimensions -------------------------------------------------
    add("cal_days", "SELECT DISTINCT Date_Value, Fiscal_Month FROM cal")
    add("cal_wide", "SELECT DISTINCT Date_Value, Fiscal_Month, Fiscal_Year, Month_ID FROM cal")
    add("cal_months", "SELECT DISTINCT Fiscal_Month, Month_ID FROM cal")
    add("month_dim", "SELECT DISTINCT Fiscal_Month, Fiscal_Quarter, Fiscal_Year, Month_ID FROM cal")

    # ---- revenue ---------------------------------------------------------------
    add("rev_rows", f"""
SELECT StoreNo AS Account_No, "Month" AS Fiscal_Month, Revenue_Type, Revenue_Motion,
       Product_Category, Motion AS Account_Motion,
       {_categorise('Product_Category', REVENUE_CATEGORIES)} AS Product_Category_2,
       CASE WHEN Revenue_Type = 'Actuals' THEN Revenue ELSE 0 END AS Revenue_Actuals,
       CASE WHEN Revenue_Type = 'Partner Fee' THEN Revenue ELSE 0 END AS Partner_Fee,
       CASE WHEN Revenue_Type = 'Registration Fee' THEN Revenue ELSE 0 END AS Registration_Fee
FROM rev_raw""")
    add("p1", """
SELECT Account_No, Fiscal_Month, Product_Category_2 AS Product_Category,
       SUM(Revenue_Actuals) AS Revenue, SUM(Partner_Fee) AS Partner_Fee,
       SUM(Registration_Fee) AS Registration_Fee
FROM rev_rows GROUP BY Account_No, Fiscal_Month, Product_Category_2""")
    add("p2", """
SELECT p1.Account_No, d.Fiscal_Month, p1.Product_Category, p1.Revenue, p1.Partner_Fee,
       p1.Registration_Fee
FROM p1 LEFT JOIN cal_days d ON p1.Fiscal_Month = d.Date_Value""")

    # ---- opportunities -----------------------------------------------------------
    add("opp_rows", f"""
SELECT Store_No AS Account_No, Opportunity_Est_Date, Product,
       {_categorise('Product', OPPORTUNITY_CATEGORIES)} AS Product_Category,
       Opportunity_ID, Opportunity_Name, Project_Status, Opportunity_Status, Opportunity_Stage,
       {_parse('Opportunity_Usage')} AS Opportunity_Usage
FROM opp_raw
WHERE Product IS NOT NULL AND Product <> 'NULL' AND Opportunity_Usage <> 'NULL'""")
    add("opp_active", f"SELECT * FROM opp_rows WHERE Project_Status <> 'Inactive'")
    add("p3_sum", """
SELECT o.Account_No, o.Product_Category, d.Fiscal_Month, SUM(o.Opportunity_Usage) AS Opportunity_Usage
FROM opp_active o LEFT JOIN cal_days d ON o.Opportunity_Est_Date = d.Date_Value
GROUP BY o.Account_No, o.Product_Category, d.Fiscal_Month""")
    add("p3", f"""
SELECT Account_No, Product_Category, Fiscal_Month, Opportunity_Usage, Extrap_Month_Left_For_FY,
       CASE WHEN Opportunity_Usage < 0 THEN 0
            ELSE Extrap_Month_Left_For_FY * Opportunity_Usage END AS Opportunity_Extrapolation
FROM (SELECT *, {_months_left('Fiscal_Month')} AS Extrap_Month_Left_For_FY FROM p3_sum) x""")

    # ---- fiscal context ------------------------------------------------------------
    add("cutoff", 'SELECT MAX("Month") AS Cutoff_Date FROM rev_raw WHERE Revenue <> 0')
    add("ctx", """
SELECT DISTINCT k.Cutoff_Date, c.Fiscal_Month, c.Fiscal_Year, c.Month_ID
FROM cutoff k LEFT JOIN cal c ON c.Date_Value = k.Cutoff_Date""")
    add("fut", """
SELECT DISTINCT c.Fiscal_Month, c.Month_ID FROM cal c, ctx
WHERE c.Date_Value > ctx.Cutoff_Date AND c.Fiscal_Year = ctx.Fiscal_Year
  AND c.Fiscal_Month <> ctx.Fiscal_Month""")

    # ---- baseline, targets, run rate -------------------------------------------------
    add("p7", """
SELECT p2.Account_No, f.Fiscal_Month, p2.Product_Category, p2.Partner_Fee + p2.Revenue AS Baseline
FROM p2 JOIN ctx ON p2.Fiscal_Month = ctx.Fiscal_Month CROSS JOIN fut f""")
    add("p8", """
SELECT t.Store_Number AS Account_No, t.Product_Category, d.Fiscal_Month, t.Target
FROM tgt_raw t LEFT JOIN cal_days d ON t.Fiscal_Month = d.Date_Value""")
    add("p9", _full("p7", "p8", ("Baseline",), ("Target",)))
    add("rr_orig", """
SELECT o.Account_No, o.Product_Category, d.Fiscal_Month, d.Month_ID,
       SUM(o.Opportunity_Usage) AS Opportunity_Usage
FROM opp_active o JOIN cal_wide d ON o.Opportunity_Est_Date = d.Date_Value CROSS JOIN ctx
WHERE o.Opportunity_Est_Date > ctx.Cutoff_Date AND d.Fiscal_Year = ctx.Fiscal_Year
GROUP BY o.Account_No, o.Product_Category, d.Fiscal_Month, d.Month_ID""")
    add("rr_spread", """
SELECT r.Account_No, r.Product_Category, r.Fiscal_Month, r.Month_ID,
       f.Fiscal_Month AS Future_Fiscal_Months, f.Month_ID AS Future_Month_ID, r.Opportunity_Usage
FROM rr_orig r JOIN fut f ON r.Month_ID <= f.Month_ID""")
    add("rr_shift", """
SELECT s.Account_No, s.Product_Category, s.Future_Month_ID + 1 AS Est_Month_Id,
       CASE WHEN s.Opportunity_Usage < 0 THEN 0 ELSE s.Opportunity_Usage END AS Opportunities_Into_RR
FROM rr_spread s""")
    add("rr", """
SELECT s.Account_No, s.Product_Category, m.Fiscal_Month, s.Opportunities_Into_RR
FROM rr_shift s LEFT JOIN cal_months m ON s.Est_Month_Id = m.Month_ID""")
    add("rr_summed", """
SELECT Account_No, Product_Category, Fiscal_Month, SUM(Opportunities_Into_RR) AS Opportunities_Into_RR
FROM rr GROUP BY Account_No, Product_Category, Fiscal_Month""")
    add("rr_clipped", """
SELECT s.Account_No, s.Product_Category, m.Fiscal_Month, s.Opportunities_Into_RR
FROM rr_shift s LEFT JOIN cal_months m ON s.Est_Month_Id = m.Month_ID
WHERE s.Est_Month_Id <= (SELECT MAX(Month_ID) FROM fut)""")

    # ---- combined facts ------------------------------------------------------------------
    add("p6", _full("p2", "p3", REV_M, OPP_M))
    add("p11", _full("p9", "rr", ("Baseline", "Target"), ("Opportunities_Into_RR",)))
    add("p12", _full("p6", "p11", (*REV_M, *OPP_M), ("Baseline", "Target", "Opportunities_Into_RR")))
    add("p12u", _union_sum([("p2", REV_M), ("p3", OPP_M), ("p7", ("Baseline",)),
                            ("p8", ("Target",)), ("rr", ("Opportunities_Into_RR",))]))

    def summary(src: str) -> str:
        return f"""
SELECT f.Account_No, f.Fiscal_Month, f.Product_Category, {', '.join('f.' + m for m in P12_M)},
       m.Fiscal_Quarter, m.Fiscal_Year, m.Month_ID,
       a.Store AS Account_Name, a.Industry, a.Vertical, a.Segment, a.Store_Manager_Alias,
       a.Potential_Account, a.Vertical_Manager_Alias,
       s.General_Seller, s.Services_Seller, s.Product_Seller, s.Support_Seller
FROM {src} f LEFT JOIN month_dim m ON f.Fiscal_Month = m.Fiscal_Month
             LEFT JOIN acct a ON f.Account_No = a.AccountNo
             LEFT JOIN sell s ON f.Account_No = s.Store_ID"""
    add("p13", summary("p12"))
    add("p13u", summary("p12u"))

    # ---- opportunity summary ---------------------------------------------------------------
    add("p14_sum", f"""
SELECT {', '.join('o.' + c if c != 'Fiscal_Month' else 'd.Fiscal_Month' for c in DETAIL)},
       SUM(o.Opportunity_Usage) AS Opportunity_Usage
FROM opp_rows o LEFT JOIN cal_days d ON o.Opportunity_Est_Date = d.Date_Value
GROUP BY ALL""")
    add("p14_detail", f"""
SELECT *, CASE WHEN Opportunity_Usage < 0 THEN 0
               ELSE Extrap_Month_Left_For_FY * Opportunity_Usage END AS Opportunity_Extrapolation
FROM (SELECT *, {_months_left('Fiscal_Month', True)} AS Extrap_Month_Left_For_FY FROM p14_sum) x""")
    add("p14_full", f"""
SELECT {', '.join('x.' + c for c in DETAIL)}, x.Opportunity_Usage, x.Extrap_Month_Left_For_FY,
       x.Opportunity_Extrapolation,
       {_band('x.Opportunity_Usage')} AS Opportunity_Usage_Range,
       {_band('x.Opportunity_Extrapolation')} AS Opportunity_Extrapolation_Range,
       m.Fiscal_Quarter, m.Fiscal_Year, m.Month_ID,
       a.Store AS Account_Name, a.Industry, a.Vertical, a.Segment, a.Store_Manager_Alias,
       a.Potential_Account, a.Vertical_Manager_Alias,
       s.General_Seller, s.Services_Seller, s.Product_Seller, s.Support_Seller
FROM p14_detail x LEFT JOIN month_dim m ON x.Fiscal_Month = m.Fiscal_Month
                  LEFT JOIN acct a ON x.Account_No = a.AccountNo
                  LEFT JOIN sell s ON x.Account_No = s.Store_ID""")

    # ---- week-on-week --------------------------------------------------------------------------
    for name, src in (("snap_prev", "opp_prev"), ("snap_cur", "opp_raw")):
        fields = ("Opportunity_Est_Date", "Opportunity_Stage", "Opportunity_Status", "Project_Status")
        add(name, f"""
SELECT Opportunity_ID, Product, SUM(amount) AS Opportunity_Usage,
       {', '.join(f'MAX(CASE WHEN latest = 1 THEN {c} END) AS {c}' for c in fields)}
FROM (SELECT *, {_parse('Opportunity_Usage')} AS amount,
             row_number() OVER (PARTITION BY Opportunity_ID, Product
                                ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in fields)}) AS latest FROM {src}) x
GROUP BY Opportunity_ID, Product""")
    return ctes


def _with(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in _ctes())
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _pub(src: str, money=(), where: str = "", cols: str = "*") -> str:
    if cols != "*":
        src = f"(SELECT {cols} FROM {src} {where}) x"
        where = ""
    rep = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in money)
    star = f"* REPLACE ({rep})" if rep else "*"
    return f"SELECT {star} FROM {src} {where}"


def _bodies() -> dict[str, str]:
    b: dict[str, str] = {}
    b["scan_preview"] = "SELECT * FROM acct ORDER BY AccountNo LIMIT 10"
    b["csv_ingest"] = "SELECT * FROM sell"
    b["publish_view"] = _pub("p13", P12_M, "WHERE Fiscal_Year = 'FY2001'")
    b["rename_project"] = """
SELECT StoreNo AS Account_No, "Month" AS Fiscal_Month, Revenue_Type, Revenue_Motion,
       Product_Category, Motion AS Account_Motion, CAST(Revenue AS DOUBLE) AS Revenue FROM rev_raw"""
    b["measure_split"] = """
SELECT Account_No, Fiscal_Month, Revenue_Type, Revenue_Motion, Product_Category, Account_Motion,
       CAST(Revenue_Actuals AS DOUBLE) AS Revenue, CAST(Partner_Fee AS DOUBLE) AS Partner_Fee,
       CAST(Registration_Fee AS DOUBLE) AS Registration_Fee FROM rev_rows"""
    b["category_map_revenue"] = """
SELECT Account_No, Fiscal_Month, Revenue_Type, Product_Category, Product_Category_2,
       CAST(Revenue_Actuals AS DOUBLE) AS Revenue, CAST(Partner_Fee AS DOUBLE) AS Partner_Fee,
       CAST(Registration_Fee AS DOUBLE) AS Registration_Fee FROM rev_rows"""
    opp_text = lambda rules: f"""
SELECT Store_No AS Account_No, Opportunity_Est_Date, Product,
       {_categorise('Product', rules)} AS Product_Category,
       Opportunity_ID, Opportunity_Name, Project_Status, Opportunity_Status, Opportunity_Stage,
       Opportunity_Usage
FROM opp_raw WHERE Product IS NOT NULL AND Product <> 'NULL'"""  # noqa: E731
    b["category_map_opportunity"] = opp_text(OPPORTUNITY_CATEGORIES)
    b["sentinel_filter"] = f"""
SELECT * FROM opp_raw WHERE Product IS NOT NULL AND Product <> 'NULL'
  AND Opportunity_Usage <> 'NULL'"""
    b["status_filter"] = f"SELECT * FROM opp_raw WHERE Project_Status <> 'Inactive'"
    opp_months = ("(SELECT DISTINCT d.Fiscal_Month FROM opp_raw o "
                  "LEFT JOIN cal_days d ON o.Opportunity_Est_Date = d.Date_Value) m")
    b["months_left"] = (f"SELECT Fiscal_Month, {_months_left('Fiscal_Month')} "
                        f"AS Extrap_Month_Left_For_FY FROM {opp_months}")
    b["months_left_incl"] = (f"SELECT Fiscal_Month, {_months_left('Fiscal_Month', True)} "
                             f"AS Extrap_Month_Left_For_FY FROM {opp_months}")
    dated = ("(SELECT o.*, d.Fiscal_Month FROM opp_rows o "
             "LEFT JOIN cal_days d ON o.Opportunity_Est_Date = d.Date_Value) r")
    b["extrapolation_clamp"] = f"""
SELECT Opportunity_ID, Fiscal_Month, CAST(Opportunity_Usage AS DOUBLE) AS Opportunity_Usage,
       Extrap_Month_Left_For_FY,
       CAST(CASE WHEN Opportunity_Usage < 0 THEN 0
                 ELSE Extrap_Month_Left_For_FY * Opportunity_Usage END AS DOUBLE)
         AS Opportunity_Extrapolation
FROM (SELECT r.Opportunity_ID, r.Fiscal_Month, r.Opportunity_Usage,
             {_months_left('r.Fiscal_Month')} AS Extrap_Month_Left_For_FY FROM {dated}) x"""
    b["negative_clamp"] = f"""
SELECT Opportunity_ID, CAST(Opportunity_Usage AS DOUBLE) AS Opportunity_Usage,
       CAST(CASE WHEN Opportunity_Usage < 0 THEN 0 ELSE Opportunity_Usage END AS DOUBLE)
         AS Opportunities_Into_RR
FROM {dated}"""
    b["value_bands"] = f"""
SELECT Opportunity_ID, Fiscal_Month, CAST(Opportunity_Usage AS DOUBLE) AS Opportunity_Usage,
       {_band('Opportunity_Usage')} AS Opportunity_Usage_Range,
       CAST(Opportunity_Extrapolation AS DOUBLE) AS Opportunity_Extrapolation,
       {_band('Opportunity_Extrapolation')} AS Opportunity_Extrapolation_Range
FROM p14_detail"""
    months_in = ", ".join(_q(m) for m in ("February, 2001", "March, 2001", "April, 2001",
                                           "May, 2001", "June, 2001"))
    b["month_in_list"] = _pub("p12", P12_M, f"WHERE Fiscal_Month IN ({months_in})")
    b["parse_amount_sum"] = """
SELECT o.Account_No, o.Product_Category, d.Fiscal_Month,
       CAST(SUM(o.Opportunity_Usage) AS DOUBLE) AS Opportunity_Usage
FROM opp_rows o LEFT JOIN cal_days d ON o.Opportunity_Est_Date = d.Date_Value
GROUP BY o.Account_No, o.Product_Category, d.Fiscal_Month"""
    b["left_date_lookup"] = "SELECT r.Opportunity_ID, r.Opportunity_Est_Date, r.Fiscal_Month FROM " + dated
    b["left_wide_calendar"] = """
SELECT o.Opportunity_ID, o.Opportunity_Est_Date, d.Fiscal_Month, d.Fiscal_Year, d.Month_ID
FROM opp_active o LEFT JOIN cal_wide d ON o.Opportunity_Est_Date = d.Date_Value"""
    b["cross_future_months"] = """
SELECT r.Account_No, r.Product_Category, r.Fiscal_Month, r.Month_ID,
       f.Fiscal_Month AS Future_Fiscal_Months, f.Month_ID AS Future_Month_ID,
       CAST(r.Opportunity_Usage AS DOUBLE) AS Opportunity_Usage
FROM rr_orig r CROSS JOIN fut f"""
    b["theta_month_join"] = _pub("rr_spread", ("Opportunity_Usage",))
    b["left_next_month"] = """
SELECT s.Account_No, s.Product_Category, s.Fiscal_Month, s.Future_Month_ID + 1 AS Est_Month_Id,
       m.Fiscal_Month AS Est_Fiscal_Month, CAST(s.Opportunity_Usage AS DOUBLE) AS Opportunity_Usage
FROM rr_spread s LEFT JOIN cal_months m ON s.Future_Month_ID + 1 = m.Month_ID"""
    b["lookup_calendar"] = _pub(
        "p2 LEFT JOIN month_dim m ON p2.Fiscal_Month = m.Fiscal_Month", REV_M,
        cols="p2.*, m.Fiscal_Quarter, m.Fiscal_Year, m.Month_ID")
    b["lookup_account"] = _pub(
        "p2 LEFT JOIN acct a ON p2.Account_No = a.AccountNo", REV_M,
        cols="p2.*, a.Store AS Account_Name, a.Industry, a.Vertical, a.Segment, "
             "a.Store_Manager_Alias, a.Potential_Account, a.Vertical_Manager_Alias")
    b["lookup_seller"] = _pub(
        "p2 LEFT JOIN sell s ON p2.Account_No = s.Store_ID", REV_M,
        cols="p2.*, s.General_Seller, s.Services_Seller, s.Product_Seller, s.Support_Seller")
    b["full_outer_coalesce"] = _pub(f"({_full('p2', 'p8', REV_M, ('Target',))}) j",
                                    (*REV_M, "Target"))
    b["sum_three_keys"] = """
SELECT Account_No, Fiscal_Month, Product_Category, CAST(SUM(Revenue) AS DOUBLE) AS Revenue,
       CAST(SUM(Partner_Fee) AS DOUBLE) AS Partner_Fee,
       CAST(SUM(Registration_Fee) AS DOUBLE) AS Registration_Fee
FROM p2 GROUP BY Account_No, Fiscal_Month, Product_Category"""
    b["sum_four_keys"] = _pub("rr_orig", ("Opportunity_Usage",))
    b["sum_nine_keys"] = (f"SELECT {', '.join(DETAIL)}, CAST(Opportunity_Usage AS DOUBLE) "
                          "AS Opportunity_Usage FROM p14_sum")
    b["distinct_months"] = """
SELECT DISTINCT d.Fiscal_Month, d.Month_ID
FROM opp_raw o LEFT JOIN cal_wide d ON o.Opportunity_Est_Date = d.Date_Value"""
    b["distinct_categories"] = "SELECT DISTINCT Product_Category FROM rev_raw"
    b["scalar_cutoff"] = "SELECT Cutoff_Date FROM ctx"
    b["fiscal_context"] = "SELECT * FROM ctx"
    b["clean_revenue"] = _pub("p1", REV_M)
    b["revenue_by_fiscal_month"] = _pub("p2", REV_M)
    b["clean_opportunity"] = _pub("p3", OPP_M)
    b["future_months"] = "SELECT * FROM fut"
    b["revenue_opportunity"] = _pub("p6", (*REV_M, *OPP_M))
    b["baseline"] = _pub("p7", ("Baseline",))
    b["targets_by_fiscal_month"] = _pub("p8", ("Target",))
    b["baseline_target"] = _pub("p9", ("Baseline", "Target"))
    b["run_rate_origin"] = _pub("rr", ("Opportunities_Into_RR",))
    b["run_rate_summed"] = _pub("rr_summed", ("Opportunities_Into_RR",))
    b["run_rate_clipped"] = _pub("rr_clipped", ("Opportunities_Into_RR",))
    b["baseline_target_run_rate"] = _pub("p11", ("Baseline", "Target", "Opportunities_Into_RR"))
    b["all_transactional"] = _pub("p12", P12_M)
    b["all_transactional_union"] = _pub("p12u", P12_M)
    b["revenue_summary"] = _pub("p13", P12_M)
    b["revenue_summary_summed"] = _pub("p13u", P12_M)
    b["opportunity_summary"] = _pub("p14_full", OPP_M)
    b["opportunity_summary_compat"] = f"""
SELECT {', '.join(DETAIL)}, CAST(Opportunity_Usage AS DOUBLE) AS Opportunity_Usage,
       Extrap_Month_Left_For_FY, CAST(Opportunity_Extrapolation AS DOUBLE) AS Opportunity_Extrapolation,
       Opportunity_Usage_Range, Opportunity_Extrapolation_Range, Fiscal_Quarter, Fiscal_Year,
       Month_ID AS Account_Name, Industry, Vertical, Segment, Store_Manager_Alias, Potential_Account,
       Vertical_Manager_Alias AS General_Seller, Services_Seller, Product_Seller, Support_Seller
FROM p14_full"""

    # ---- insights ----------------------------------------------------------------
    def trend(measures) -> str:
        sums = ", ".join(f"SUM({m}) AS {m}" for m in measures)
        cols = ", ".join(f"CAST(c.{m} AS DOUBLE) AS {m}, CAST(p.{m} AS DOUBLE) AS {m}_Prev, "
                         f"CAST(c.{m} - p.{m} AS DOUBLE) AS {m}_Change" for m in measures)
        return f"""
WITH monthly AS (
  SELECT d.Fiscal_Year, d.Month_ID, s.* FROM (SELECT Fiscal_Month, {sums} FROM p2 GROUP BY Fiscal_Month) s
  LEFT JOIN month_dim d ON s.Fiscal_Month = d.Fiscal_Month)
SELECT c.Fiscal_Year, c.Month_ID, c.Fiscal_Month, {cols}
FROM monthly c LEFT JOIN monthly p ON c.Month_ID = p.Month_ID + 1"""
    b["revenue_trend"] = trend(["Revenue"])
    b["fee_trend"] = trend(["Partner_Fee", "Registration_Fee"])
    rvt = _union_sum([("(SELECT Fiscal_Month, Product_Category, Revenue + Partner_Fee AS Actual FROM p2) a",
                       ("Actual",)), ("p8", ("Target",))], ("Fiscal_Month", "Product_Category"))
    b["revenue_vs_target"] = f"""
SELECT Fiscal_Month, Product_Category, CAST(Actual AS DOUBLE) AS Actual,
       CAST(Target AS DOUBLE) AS Target, CAST(Actual - Target AS DOUBLE) AS Gap,
       CASE WHEN CAST(Target AS DOUBLE) <> 0 THEN CAST(Actual AS DOUBLE) / CAST(Target AS DOUBLE) END
         AS Attainment
FROM ({rvt}) v"""
    b["forecast_year_end"] = """
WITH bm AS (
  SELECT Fiscal_Month, SUM(Revenue + Partner_Fee) AS Actual,
         SUM(Baseline + Opportunity_Usage + Opportunities_Into_RR) AS Projected
  FROM p12u GROUP BY Fiscal_Month),
yr AS (
  SELECT m.Fiscal_Year, m.Month_ID, m.Fiscal_Month,
         COALESCE(bm.Actual, 0) AS Actual, COALESCE(bm.Projected, 0) AS Projected,
         CASE WHEN m.Month_ID <= ctx.Month_ID THEN COALESCE(bm.Actual, 0)
              ELSE COALESCE(bm.Projected, 0) END AS Forecast
  FROM month_dim m JOIN ctx ON m.Fiscal_Year = ctx.Fiscal_Year
  LEFT JOIN bm ON m.Fiscal_Month = bm.Fiscal_Month)
SELECT Fiscal_Year, Month_ID, Fiscal_Month, CAST(Actual AS DOUBLE) AS Actual,
       CAST(Projected AS DOUBLE) AS Projected, CAST(Forecast AS DOUBLE) AS Forecast,
       CAST(SUM(Forecast) OVER (PARTITION BY Fiscal_Year ORDER BY Month_ID
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         AS Cumulative_Forecast
FROM yr"""

    def baseline_avg(n: int) -> str:
        return f"""
WITH w AS (
  SELECT p1.Account_No, p1.Product_Category,
         CAST(SUM(p1.Partner_Fee + p1.Revenue) AS DOUBLE) / CAST({n} AS DOUBLE) AS Baseline
  FROM p1 JOIN cal_wide d ON p1.Fiscal_Month = d.Date_Value CROSS JOIN ctx
  WHERE d.Month_ID >= ctx.Month_ID - {n - 1} AND d.Month_ID <= ctx.Month_ID
  GROUP BY p1.Account_No, p1.Product_Category)
SELECT w.Account_No, f.Fiscal_Month, w.Product_Category, w.Baseline FROM w CROSS JOIN fut f"""
    b["baseline_avg3"] = baseline_avg(3)
    b["baseline_avg6"] = baseline_avg(6)
    b["slice_rollup"] = """
SELECT Fiscal_Year, Product_Category, Vertical, CAST(SUM(Revenue) AS DOUBLE) AS Revenue,
       CAST(SUM(Baseline) AS DOUBLE) AS Baseline, CAST(SUM(Target) AS DOUBLE) AS Target,
       CAST(SUM(Opportunities_Into_RR) AS DOUBLE) AS Opportunities_Into_RR,
       CAST(GROUPING(Fiscal_Year, Product_Category, Vertical) AS INTEGER) AS Grouping_Level
FROM p13u GROUP BY ROLLUP (Fiscal_Year, Product_Category, Vertical)"""
    b["slice_cube"] = """
SELECT Product_Category, Industry, CAST(SUM(Revenue) AS DOUBLE) AS Revenue,
       CAST(SUM(Opportunity_Usage) AS DOUBLE) AS Opportunity_Usage,
       CAST(GROUPING(Product_Category, Industry) AS INTEGER) AS Grouping_Level
FROM p13u GROUP BY CUBE (Product_Category, Industry)"""
    changed = " OR ".join(f"p.{f} IS DISTINCT FROM c.{f}" for f in (
        "Opportunity_Usage", "Opportunity_Est_Date", "Opportunity_Stage",
        "Opportunity_Status", "Project_Status"))
    b["wow_tracking"] = f"""
SELECT COALESCE(p.Opportunity_ID, c.Opportunity_ID) AS Opportunity_ID, COALESCE(p.Product, c.Product) AS Product,
       CASE WHEN p.here IS NULL THEN 'New' WHEN c.here IS NULL THEN 'Dropped'
            WHEN {changed} THEN 'Changed' ELSE 'Unchanged' END AS Change_Type,
       CAST(p.Opportunity_Usage AS DOUBLE) AS Usage_Prev, CAST(c.Opportunity_Usage AS DOUBLE) AS Usage_Cur,
       CAST(COALESCE(c.Opportunity_Usage, 0) - COALESCE(p.Opportunity_Usage, 0) AS DOUBLE) AS Usage_Change
FROM (SELECT *, 1 AS here FROM snap_prev) p FULL JOIN (SELECT *, 1 AS here FROM snap_cur) c
  ON p.Opportunity_ID IS NOT DISTINCT FROM c.Opportunity_ID AND p.Product IS NOT DISTINCT FROM c.Product"""
    b["wow_stream"] = f"SELECT *, 25 AS Week FROM ({b['wow_tracking']}) w"
    b["wow_fields"] = """
WITH s AS (SELECT *, 24 AS Week FROM snap_prev UNION ALL SELECT *, 25 AS Week FROM snap_cur),
l AS (
  SELECT Opportunity_ID, Product, Week, Opportunity_Usage, Opportunity_Est_Date, Opportunity_Stage,
         Opportunity_Status,
         LAG(Week) OVER w AS pw, LAG(Opportunity_Usage) OVER w AS pu,
         LAG(Opportunity_Est_Date) OVER w AS pd, LAG(Opportunity_Stage) OVER w AS pst,
         LAG(Opportunity_Status) OVER w AS pss
  FROM s WINDOW w AS (PARTITION BY Opportunity_ID, Product ORDER BY Week))
SELECT Opportunity_ID, Product, Week, CAST(pu AS DOUBLE) AS Usage_Prev,
       CAST(Opportunity_Usage AS DOUBLE) AS Usage_Cur,
       CAST(Opportunity_Usage - pu AS DOUBLE) AS Usage_Delta,
       CASE WHEN CAST(pu AS DOUBLE) <> 0
            THEN CAST(Opportunity_Usage - pu AS DOUBLE) / CAST(pu AS DOUBLE) END AS Usage_Delta_Pct,
       CAST(Opportunity_Est_Date - pd AS INTEGER) AS Est_Date_Shift_Days,
       Opportunity_Stage IS DISTINCT FROM pst AS Stage_Changed,
       Opportunity_Status IS DISTINCT FROM pss AS Status_Changed
FROM l WHERE pw = Week - 1"""

    # ---- data quality ------------------------------------------------------------------
    b["audit_unmapped"] = f"""
SELECT Source, Raw_Value, COUNT(*) AS Row_Count FROM (
  SELECT 'revenue' AS Source, Product_Category AS Raw_Value,
         {_categorise('Product_Category', REVENUE_CATEGORIES)} AS m FROM rev_raw
  UNION ALL
  SELECT 'opportunities', Product, {_categorise('Product', OPPORTUNITY_CATEGORIES)}
  FROM opp_raw WHERE Product IS NOT NULL AND Product <> 'NULL') u
WHERE m = 'Need Mapping' GROUP BY Source, Raw_Value"""
    b["audit_unmapped_v1"] = f"""
SELECT Store_No AS Account_No, Opportunity_Est_Date, Product,
       {_categorise('Product', OPPORTUNITY_CATEGORIES_V1)} AS Product_Category,
       Opportunity_ID, Opportunity_Name, Project_Status, Opportunity_Status, Opportunity_Stage,
       CAST({_parse('Opportunity_Usage')} AS DOUBLE) AS Opportunity_Usage
FROM opp_raw
WHERE Product IS NOT NULL AND Product <> 'NULL' AND Opportunity_Usage <> 'NULL'
  AND {_categorise('Product', OPPORTUNITY_CATEGORIES_V1)} = 'Need Mapping'"""
    b["audit_parse"] = f"""
SELECT * FROM (
  SELECT Opportunity_ID, Opportunity_Usage,
    CASE WHEN TRY_CAST(replace(Opportunity_Usage, ',', '') AS DOUBLE) IS NULL THEN 'unparsable'
         WHEN {_parse('Opportunity_Usage')} IS NULL THEN 'overflow'
         WHEN regexp_matches(Opportunity_Usage, '\\.[0-9]{{6}}[0-9]*[1-9]') THEN 'rounded' END AS Issue
  FROM opp_dirty WHERE Opportunity_Usage IS NOT NULL AND Opportunity_Usage <> 'NULL') x
WHERE Issue IS NOT NULL"""
    b["csv_accepted"] = """
SELECT StoreNo, CAST("Month" AS DATE) AS "Month", Revenue_Type, Revenue_Motion, Product_Category, Motion,
       CAST(CAST(Revenue AS DECIMAL(18,2)) AS DOUBLE) AS Revenue
FROM rev_dirty WHERE "Month" <> '2001-13-01' AND Revenue NOT IN ('n/a', '12.345', '1e30')"""
    line = " || ',' || ".join(f"COALESCE({c}, '')" for c in (
        "StoreNo", '"Month"', "Revenue_Type", "Revenue_Motion", "Product_Category", "Motion", "Revenue"))
    b["csv_rejects"] = f"""
SELECT {line} AS line, 'Month' AS "column", 'not a date' AS reason FROM rev_dirty WHERE "Month" = '2001-13-01'
UNION ALL
SELECT {line}, 'Revenue', CASE Revenue WHEN 'n/a' THEN 'not a decimal(18,2)' WHEN '12.345' THEN 'more than 2 decimals'
  ELSE 'too large for decimal(18,2)' END
FROM rev_dirty WHERE Revenue IN ('n/a', '12.345', '1e30')"""
    b["audit_category_coverage"] = """
SELECT COALESCE(r.Product_Category, t.Product_Category) AS Product_Category,
       r.Product_Category IS NOT NULL AS In_Revenue, t.Product_Category IS NOT NULL AS In_Targets
FROM (SELECT DISTINCT Product_Category_2 AS Product_Category FROM rev_rows) r
FULL JOIN (SELECT DISTINCT Product_Category FROM tgt_raw) t ON r.Product_Category = t.Product_Category"""
    dup = lambda step, src: (f"SELECT '{step}' AS Step, Account_No, Fiscal_Month, Product_Category, "  # noqa: E731
                             f"COUNT(*) AS Row_Count FROM {src} "
                             "GROUP BY Account_No, Fiscal_Month, Product_Category HAVING COUNT(*) > 1")
    lookup = lambda t, account, month: (
        f"(SELECT CAST({account} AS VARCHAR) AS Account_No, CAST({month} AS VARCHAR) AS Fiscal_Month, "
        f"CAST(NULL AS VARCHAR) AS Product_Category FROM {t}) k")
    b["audit_key_uniqueness"] = " UNION ALL ".join(
        dup(s, t) for s, t in (("revenue", "p2"), ("opportunity", "p3"), ("baseline", "p7"),
                               ("target", "p8"), ("run_rate", "rr"),
                               ("accounts", lookup("acct", "AccountNo", "NULL")),
                               ("sellers", lookup("sell", "Store_ID", "NULL")),
                               ("months", lookup("month_dim", "NULL", "Fiscal_Month"))))
    ledger = (("revenue_raw", "rev_raw"), ("p1_clean_revenue", "p1"), ("opportunities_raw", "opp_raw"),
              ("p3_clean_opportunity", "p3"), ("p5_future_months", "fut"), ("p7_baseline", "p7"),
              ("p8_targets", "p8"), ("p9_baseline_target", "p9"), ("p10_run_rate_origins", "rr_orig"),
              ("p10_run_rate", "rr"), ("p11_baseline_target_run_rate", "p11"),
              ("p6_revenue_opportunity", "p6"), ("p12_all_transactional", "p12"),
              ("p14_opportunity_summary", "p14_full"))
    b["row_ledger"] = " UNION ALL ".join(
        f"SELECT '{s}' AS Step, COUNT(*) AS Row_Count FROM {t}" for s, t in ledger)
    # the maintained aggregate equals a rebuild from the whole week-25 feed
    b["clean_revenue_refresh"] = b["clean_revenue"]
    b["baseline_target_refresh"] = b["baseline_target"]
    return b


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _bodies().items()}
