"""The same figures in SQL for DuckDB, computed in whole cents so that both engines round exactly alike.

``oracle_sql`` returns one statement per query of the registry. Each statement is self-contained:
shared views are prepended as common table expressions.
"""

from __future__ import annotations

from statistics import NormalDist


def half_away(numerator: str, denominator: str, places: int) -> str:
    """numerator / denominator of whole numbers, rounded half away from zero; null over zero."""
    n, d, scale = f"cast({numerator} AS hugeint)", f"cast({denominator} AS hugeint)", 10**places
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"sign({n}) * sign({d}) * ((2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d}))) / {float(scale)}e0 END)"
    )


def usd(cents: str) -> str:
    return f"({cents}) / 1e2"


def pct(part: str, whole: str, places: int = 2) -> str:
    return half_away(f"100 * ({part})", whole, places)


# -- shared views -------------------------------------------------------------------------

# Sales, profit, net sales and cost in cents; discount and margin in 1/10000.
_VIEWS = {
    "cents": """
        SELECT *,
            cast(round(cast(l_extendedprice AS decimal(12,2)) * cast(0.002 AS decimal(4,3)), 2) * 100 AS bigint)
                AS sales_c,
            cast(cast(l_discount AS decimal(5,4)) * 80000 AS bigint) AS disc_e4
        FROM lineitem""",
    "profits": f"""
        SELECT *, cast({half_away("sales_c * (20000 + (l_partkey % 10) * 2000 - 6 * disc_e4)", "100000", 0)} AS bigint)
            AS profit_c
        FROM cents""",
    "lines": f"""
        SELECT cast(l_orderkey AS varchar) AS order_id, l_orderkey, l_partkey, l_suppkey, l_linenumber,
            l_extendedprice, l_quantity, l_discount, cast(l_quantity AS integer) AS quantity,
            sales_c, disc_e4, profit_c, sales_c - profit_c AS cogs_c,
            cast({half_away("sales_c * (10000 - disc_e4)", "10000", 0)} AS bigint) AS net_c,
            coalesce(cast({half_away("profit_c * 1000000", "sales_c", 0)} AS bigint), 0) AS margin_e4
        FROM profits""",
    "headers": """
        SELECT o_orderkey, o_custkey, cast(cast(o_orderdate AS date) + INTERVAL 20 YEAR AS date) AS order_date,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
                WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS ship_mode,
            CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 2
                WHEN '3-MEDIUM' THEN 3 ELSE 5 END AS usual_days
        FROM orders""",
    "buyers": """
        SELECT c_custkey, cast(c_custkey AS varchar) AS customer_id, c_name AS customer_name,
            c_mktsegment AS segment, n_name AS state, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "goods": """
        SELECT p_partkey, cast(p_partkey AS varchar) AS product_id,
            p_name || ' ' || cast(p_partkey % 10 AS varchar) AS product_name,
            p_type AS category, p_brand AS sub_category
        FROM part""",
    "sold": """
        SELECT lines.*, headers.*, cast(order_date + CAST(usual_days + l_linenumber % 3 AS integer) AS date) AS ship_date,
            usual_days + l_linenumber % 3 AS shipping_days
        FROM lines JOIN headers ON l_orderkey = o_orderkey""",
    "sold_to": "SELECT * FROM sold JOIN buyers ON o_custkey = c_custkey",
    "sold_goods": "SELECT * FROM sold JOIN goods ON l_partkey = p_partkey",
    "goods_lines": "SELECT * FROM lines JOIN goods ON l_partkey = p_partkey",
    "sold_all": "SELECT * FROM sold_to JOIN goods ON l_partkey = p_partkey",
    "numbered": """
        SELECT *, o_custkey AS c_custkey, cast(o_custkey AS varchar) AS customer_id,
            cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                l_extendedprice, l_quantity, l_discount) AS integer) AS row_id
        FROM sold""",
    "staging": """
        SELECT n.*, customer_name, segment, state, region, goods.*,
            'United States' AS country, cast(NULL AS varchar) AS city, cast(NULL AS varchar) AS postal_code
        FROM numbered n JOIN buyers ON n.o_custkey = buyers.c_custkey JOIN goods ON l_partkey = p_partkey""",
    "raw": """
        SELECT CASE WHEN p_partkey % 79 <> 0 THEN cast(row_id AS varchar) END AS row_id, order_id,
            CASE WHEN l_orderkey % 101 = 0 THEN 'bad' WHEN l_orderkey % 2 = 1 THEN strftime(order_date, '%-m/%-d/%Y')
                ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
            strftime(ship_date, '%Y-%m-%d') AS ship_date,
            CASE WHEN l_orderkey % 103 <> 0 THEN ship_mode END AS ship_mode,
            customer_id, customer_name, segment, country, city, state, postal_code,
            CASE WHEN c_custkey % 83 <> 0 THEN region END AS region,
            product_id, category, sub_category, product_name,
            CASE WHEN p_partkey % 97 = 0 THEN 'N/A' ELSE cast(cast(sales_c AS decimal(14,0)) / 100 AS decimal(12,2))::varchar
                END AS sales,
            CASE WHEN p_partkey % 89 <> 0 THEN cast(quantity AS varchar) END AS quantity,
            cast(cast(disc_e4 / 1e4 AS decimal(5,4)) AS varchar) AS discount,
            cast(cast(profit_c / 1e2 AS decimal(12,2)) AS varchar) AS profit
        FROM staging, LATERAL (SELECT unnest(range(CASE WHEN l_orderkey % 50 = 0 THEN 2 ELSE 1 END)))""",
    "dated": """
        SELECT DISTINCT * REPLACE (
            coalesce(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%-m/%-d/%Y'))::date AS order_date,
            try_strptime(ship_date, '%Y-%m-%d')::date AS ship_date)
        FROM raw WHERE order_date <> 'bad'""",
    "numbers": """
        SELECT * REPLACE (try_cast(row_id AS double) AS row_id, try_cast(sales AS double) AS sales, try_cast(quantity AS double) AS quantity,
            try_cast(discount AS double) AS discount, try_cast(profit AS double) AS profit)
        FROM dated""",
    "filled": """
        SELECT * REPLACE (
            round(coalesce(row_id, (SELECT median(row_id) FROM numbers)), 6) AS row_id,
            round(coalesce(sales, (SELECT median(sales) FROM numbers)), 6) AS sales,
            round(coalesce(quantity, (SELECT median(quantity) FROM numbers)), 6) AS quantity,
            round(coalesce(discount, (SELECT median(discount) FROM numbers)), 6) AS discount,
            round(coalesce(profit, (SELECT median(profit) FROM numbers)), 6) AS profit)
        FROM numbers""",
    "clean": """
        SELECT * REPLACE (cast(round(row_id) AS integer) AS row_id, cast(round(quantity) AS integer) AS quantity,
            coalesce(ship_mode, 'Unknown') AS ship_mode, coalesce(region, 'Unknown') AS region,
            coalesce(city, 'Unknown') AS city, coalesce(postal_code, 'Unknown') AS postal_code)
        FROM filled""",
    "months": """
        SELECT cast(date_trunc('month', order_date) AS date) AS ds, sum(sales_c) AS sales_c, sum(profit_c) AS profit_c,
            count(DISTINCT order_id) AS orders, sum(quantity) AS units
        FROM sold GROUP BY 1""",
    "days": """
        SELECT cast(unnest(generate_series(date_trunc('year', min(order_date)),
            date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS date) AS day
        FROM headers""",
    "buyer_totals": f"""
        SELECT c_custkey, customer_id, customer_name, segment, region, max(order_date) AS last_order_date,
            date_diff('day', max(order_date), DATE '2021-12-31') AS recency_days,
            count(DISTINCT order_id) AS frequency, sum(net_c) AS net_c
        FROM sold_to GROUP BY ALL""",
    "scored": """
        SELECT *, ntile(5) OVER (ORDER BY recency_days, customer_id) AS r,
            ntile(5) OVER (ORDER BY frequency DESC, customer_id) AS f,
            ntile(5) OVER (ORDER BY net_c DESC, customer_id) AS m
        FROM buyer_totals""",
    "segments": """
        SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
            WHEN r >= 3 AND f >= 3 THEN 'Loyal Customers'
            WHEN r >= 4 AND f <= 2 THEN 'Recent Customers'
            WHEN r <= 2 AND f >= 3 AND m >= 3 THEN 'At Risk'
            WHEN r <= 2 AND f <= 2 THEN 'Lost'
            WHEN m >= 4 THEN 'Big Spenders' ELSE 'Potential Loyalists' END AS rfm_segment
        FROM scored""",
}


def _series_views(prefix: str, key: str, source: str) -> dict[str, str]:
    """History, trend, seasonal index and spread of monthly series keyed by ``key`` (an expression)."""
    p = prefix
    return {
        f"{p}_hist": f"""
            SELECT k, ds, y, month(ds) AS mn,
                (year(ds) * 12 + month(ds)) - min(year(ds) * 12 + month(ds)) OVER (PARTITION BY k) AS t
            FROM (SELECT {key} AS k, cast(date_trunc('month', order_date) AS date) AS ds, sum(sales_c) / 1e2 AS y
                FROM {source} GROUP BY 1, 2) WHERE y > 0""",
        f"{p}_line": f"""
            SELECT k, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, count(*) AS n, min(ds) AS first_ds,
                max(ds) AS last_ds, max(t) AS last_t, avg(y) * 0.01 AS least
            FROM {p}_hist GROUP BY k""",
        f"{p}_raw": f"""
            SELECT k, mn, avg(y / greatest(a + b * t, least)) AS raw FROM {p}_hist JOIN {p}_line USING (k)
            GROUP BY k, mn""",
        f"{p}_si": f"SELECT k, mn, raw / avg(raw) OVER (PARTITION BY k) AS si FROM {p}_raw",
        f"{p}_sd": f"""
            SELECT k, stddev_samp(y / (greatest(a + b * t, least) * coalesce(si, 1)) - 1) AS sd
            FROM {p}_hist JOIN {p}_line USING (k) LEFT JOIN {p}_si USING (k, mn)
            GROUP BY k""",
        f"{p}_grid": f"""
            SELECT k, ds, t, y FROM {p}_hist
            UNION ALL SELECT k, cast(last_ds + to_months(cast(s AS integer)) AS date), last_t + s, NULL
            FROM {p}_line, (SELECT unnest(range(1, 7)) AS s)""",
        f"{p}_curve": f"""
            SELECT g.k, g.ds, g.y, greatest(a + b * g.t, least) AS trend, coalesce(si, 1) AS si,
                greatest(a + b * g.t, least) * coalesce(si, 1) AS yhat, sd, n, last_ds
            FROM {p}_grid g JOIN {p}_line USING (k) JOIN {p}_sd USING (k)
                LEFT JOIN {p}_si s ON s.k = g.k AND s.mn = month(g.ds)""",
    }


_VIEWS |= _series_views("tot", "1", "sold") | _series_views("cat", "category", "sold_goods")
_Z95, _Z90 = NormalDist().inv_cdf(0.975), NormalDist().inv_cdf(0.95)

_VIEWS |= {
    "cutoffs": """
        SELECT cast(last_ds - CAST(90 + 30 * i AS integer) AS date) AS cutoff
        FROM tot_line, (SELECT unnest(range(0, 200)) AS i)
        WHERE n >= 18 AND last_ds - CAST(90 + 30 * i AS integer) >= first_ds + CAST(floor(n * 0.6 * 30) AS integer)""",
    "bt_train": "SELECT cutoff, ds, y, t, mn FROM tot_hist JOIN cutoffs ON ds <= cutoff",
    "bt_line": """
        SELECT cutoff, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, avg(y) * 0.01 AS least
        FROM bt_train GROUP BY cutoff""",
    "bt_raw": """
        SELECT cutoff, mn, avg(y / greatest(a + b * t, least)) AS raw FROM bt_train JOIN bt_line USING (cutoff)
        GROUP BY cutoff, mn""",
    "bt_si": "SELECT cutoff, mn, raw / avg(raw) OVER (PARTITION BY cutoff) AS si FROM bt_raw",
    "bt_points": """
        SELECT cutoff, ds, ds - cutoff AS ahead, y, greatest(a + b * t, least) * coalesce(si, 1) AS yhat
        FROM tot_hist JOIN cutoffs ON ds > cutoff AND ds <= cutoff + 90
            JOIN bt_line USING (cutoff) LEFT JOIN bt_si USING (cutoff, mn)""",
}

_ERRORS = "folds bigint, points bigint, unforecast bigint, mae double, rmse double, mape_pct double"
_ERROR_SUMS = """count(DISTINCT cutoff) AS folds, count(*) AS points, count(*) FILTER (WHERE yhat IS NULL) AS unforecast,
    round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
    round(avg(abs(y - yhat) / y) * 100, 4) AS mape_pct"""

_RAW_COLUMNS = (
    "row_id varchar, order_id varchar, order_date {date}, ship_date {date}, ship_mode varchar, customer_id varchar, "
    "customer_name varchar, segment varchar, country varchar, city varchar, state varchar, postal_code varchar, "
    "region varchar, product_id varchar, category varchar, sub_category varchar, product_name varchar, "
    "sales {number}, quantity {number}, discount {number}, profit {number}"
)
_RAW_TEXT = _RAW_COLUMNS.format(date="varchar", number="varchar")
_DATED = _RAW_COLUMNS.format(date="date", number="varchar")
_CLEAN = (
    _RAW_COLUMNS.format(date="date", number="double")
    .replace("row_id varchar", "row_id integer").replace("quantity double", "quantity integer")
)
_NUMBER_ID = "order_id varchar, row_id double, "
_ID = "order_id varchar, row_id integer, "
_RAW_ID = "order_id varchar, row_id varchar, "
_PRODUCT = "product_name varchar, category varchar, sub_category varchar, "

_NET, _PROFIT = "sum(net_c)", "sum(profit_c)"
_MONEY = f"{usd(_NET)} AS net_revenue, {usd(_PROFIT)} AS total_profit"
_MARGIN = half_away("sum(margin_e4)", "10000 * count(*)", 2)
_REVENUE = usd("sum(sales_c)")
_GROSS_PROFIT = usd(_PROFIT)
_NDV = "count(DISTINCT order_id)"

_CALENDAR_PARTS = """year(order_date) AS order_year, month(order_date) AS order_month,
    quarter(order_date) AS order_quarter, weekofyear(order_date) AS order_week, dayname(order_date) AS order_dow"""
_LTV = "sum(sales_c) OVER (PARTITION BY c_custkey) / 1e2"
_RANK = "row_number() OVER (PARTITION BY c_custkey ORDER BY order_date, order_id, row_id)"
_LINE_MARGIN = f"coalesce({pct('profit_c', 'sales_c')}, 0)"
_PER_UNIT = f"coalesce({half_away('sales_c', '100 * quantity', 2)}, sales_c / 1e2)"
_GROWTH = f"""
    SELECT year(ds) AS order_year, month(ds) AS order_month, sales_c / 1e2 AS monthly_total,
        coalesce({pct('sales_c - before', 'before')}, 0) AS sales_growth_pct
    FROM (SELECT *, lag(sales_c) OVER (ORDER BY ds) AS before FROM months)"""
_HIGH = "sales_c / 1e2 > (SELECT quantile_cont(sales_c / 1e2, 0.75) FROM numbered)"

_FACT_COLUMNS = f"""{{keys}} quantity, {half_away('sales_c', '100 * greatest(quantity, 1)', 2)} AS unit_price,
    disc_e4 / 1e4 AS discount_rate, sales_c / 1e2 AS gross_sales, net_c / 1e2 AS net_sales, cogs_c / 1e2 AS cogs,
    profit_c / 1e2 AS profit, margin_e4 / 1e4 AS profit_margin_pct,
    {half_away('sales_c', '100 * greatest(quantity, 1)', 2)} AS revenue_per_unit, shipping_days"""
_DATE_KEY = "year({0}) * 10000 + month({0}) * 100 + day({0})"

_RULES = {
    "nonneg_sales": "sales_c < 0",
    "nonneg_quantity": "quantity < 0",
    "order_date_present": "order_date IS NULL",
    "customer_id_present": "o_custkey IS NULL",
}


def _rule(name: str) -> str:
    return (
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {_RULES[name]}) AS violations, "
        f"count(*) FILTER (WHERE {_RULES[name]}) = 0 AS passed FROM sold"
    )


def _measures(*names: str) -> str:
    every = {
        "total_revenue": _REVENUE,
        "total_profit": _GROSS_PROFIT,
        "total_orders": _NDV,
        "total_units": "sum(quantity)",
        "avg_order_value": f"coalesce({_REVENUE} / nullif({_NDV}, 0), 0)",
        "profit_margin": f"coalesce({_GROSS_PROFIT} / nullif({_REVENUE}, 0), 0) * 100",
        "total_customers": "count(DISTINCT o_custkey)",
        "avg_customer_ltv": f"coalesce({_REVENUE} / nullif(count(DISTINCT o_custkey), 0), 0)",
        "revenue_per_customer": f"coalesce({_REVENUE} / nullif(count(DISTINCT o_custkey), 0), 0)",
        "loss_lines": "count(*) FILTER (WHERE profit_c < 0)",
        "high_discount_lines": "count(*) FILTER (WHERE disc_e4 >= 3000)",
        "avg_shipping_days": "sum(shipping_days) / cast(count(*) AS double)",
    }
    return ", ".join(f"{every[n]} AS {n}" for n in names or every)


_MEASURE_TYPES = {
    n: "bigint" for n in ("total_orders", "total_units", "total_customers", "loss_lines", "high_discount_lines")
}


def _measure_query(by: str, source: str, *names: str) -> tuple[str, str]:
    shown = names or (
        "total_revenue", "total_profit", "total_orders", "total_units", "avg_order_value", "profit_margin",
        "total_customers", "avg_customer_ltv", "revenue_per_customer", "loss_lines", "high_discount_lines",
        "avg_shipping_days",
    )
    types = ", ".join(f"{n} {_MEASURE_TYPES.get(n, 'double')}" for n in shown)
    groups = ", ".join(f"{b.strip()} varchar" for b in by.split(","))
    return f"{groups}, {types}", f"SELECT {by}, {_measures(*names)} FROM {source} GROUP BY ALL"


def _to_date(column: str, period: str) -> str:
    return (
        f"sum(sum({column})) OVER (PARTITION BY date_trunc('{period}', order_date) ORDER BY order_date) / 1e2"
    )


_CURVE = "ds, y, trend, si AS seasonal_index, yhat, yhat - {z} * sd * yhat AS yhat_lower, yhat + {z} * sd * yhat AS yhat_upper"
_FUTURE = (
    "SELECT ds AS forecast_month, round(yhat, 2) AS predicted_sales, round(yhat - {z} * sd * yhat, 2) AS lower_bound, "
    "round(yhat + {z} * sd * yhat, 2) AS upper_bound{more} FROM {p}_curve WHERE ds > last_ds AND n >= {n}"
)
_TOTAL_FUTURE = _FUTURE.format(z=_Z95, p="tot", n=2, more="")
_FORECAST_TYPES = "forecast_month date, predicted_sales double, lower_bound double, upper_bound double"
_MONTH_LY = """
    SELECT {keys} year(order_date) AS year, month(order_date) AS month_num, sum(sales_c) AS c
    FROM {source} GROUP BY ALL"""


_LY_TYPES = "total_revenue double, revenue_ly double, yoy_growth_pct double"


def _last_year(keys: str, source: str, now: tuple[str, str], ago: tuple[str, str], where: str = "true") -> str:
    """Sales between two pairs of days per group, and the growth."""
    spans = [f"order_date BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in (now, ago)]
    return f"""SELECT * EXCLUDE (c, b), c / 1e2 AS total_revenue, b / 1e2 AS revenue_ly,
            (coalesce(c, 0) / 1e2 - b / 1e2) / nullif(abs(b / 1e2), 0) * 100 AS yoy_growth_pct
        FROM (SELECT {keys}, sum(sales_c) FILTER ({spans[0]}) AS c, sum(sales_c) FILTER ({spans[1]}) AS b
            FROM {source} WHERE {where} AND (({spans[0]}) OR ({spans[1]})) GROUP BY ALL)"""


def _dense_to_date(key: str, source: str, last: str, where: str = "true") -> str:
    """To-date figures of every day from each group's first sale on."""
    sums = ", ".join(
        f"sum({c}) OVER (PARTITION BY {key}, date_trunc('{p}', order_date) ORDER BY order_date) / 1e2 AS {name}"
        for name, c, p in (("revenue_mtd", "s", "month"), ("revenue_qtd", "s", "quarter"), ("revenue_ytd", "s", "year"), ("profit_ytd", "p", "year"))
    )
    return f"""WITH d AS (SELECT {key}, order_date, sum(sales_c) AS s, sum(profit_c) AS p FROM {source} WHERE {where} GROUP BY ALL),
        g AS (SELECT {key}, cast(unnest(generate_series(min(order_date), {last}, INTERVAL 1 DAY)) AS date) AS order_date FROM d GROUP BY 1)
        SELECT {key}, order_date, {sums}
        FROM (SELECT {key}, order_date, coalesce(s, 0) AS s, coalesce(p, 0) AS p FROM g LEFT JOIN d USING ({key}, order_date))"""


def _inside(step: str) -> str:
    """The condition that a row lies in the member that a step chose."""
    return f"(SELECT CASE place WHEN 0 THEN region = member WHEN 1 THEN segment = member ELSE category = member END FROM {step})"


def _split(where: str) -> str:
    """Every member of every dimension with its loss, that of all, and how far it exceeds an even share."""
    each = " UNION ALL ".join(
        f"SELECT {i} AS place, '{d}' AS dimension, {d} AS member, sum(l) AS loss, sum(p) AS total_profit FROM base WHERE {where} GROUP BY {d}"
        for i, d in enumerate(("region", "segment", "category"))
    )
    return f"""SELECT *, sum(loss) OVER (PARTITION BY place) AS node,
        loss - sum(loss) OVER (PARTITION BY place) / count(*) OVER (PARTITION BY place) AS excess FROM ({each})"""


_TO_DATE_TYPES = "order_date date, revenue_mtd double, revenue_qtd double, revenue_ytd double, profit_ytd double"


def _unique(rule: str, key: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) AS violations, count(*) = 0 AS passed "
        f"FROM (SELECT {key} FROM {source} GROUP BY ALL HAVING count(*) > 1)"
    )


def _none(rule: str, source: str, condition: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) AS violations, count(*) = 0 AS passed FROM {source} WHERE {condition}"
    )


_ONE_BUYER = "(SELECT DISTINCT c_custkey, customer_id, customer_name, segment FROM staging)"
_ONE_GOOD = "(SELECT DISTINCT p_partkey, product_id, product_name, category, sub_category FROM staging)"
_MODES = "(VALUES ('Standard Class'), ('Second Class'), ('First Class'), ('Same Day')) modes(name)"
_CAL = "(SELECT unnest(generate_series(DATE '2015-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS day)"
_OUTSIDE = "{0} NOT BETWEEN DATE '2015-01-01' AND DATE '2025-12-31'"
_CONSTRAINTS = " UNION ALL ".join(
    [
        _unique("dim_customers.customer_sk unique", "c_custkey", _ONE_BUYER),
        _unique("dim_customers.customer_id unique", "customer_id", _ONE_BUYER),
        _none("dim_customers mandatory columns", _ONE_BUYER,
              "customer_id IS NULL OR customer_name IS NULL OR segment IS NULL"),
        _unique("dim_products.product_sk unique", "p_partkey", _ONE_GOOD),
        _unique("dim_products.product_id unique", "product_id", _ONE_GOOD),
        _none("dim_products mandatory columns", _ONE_GOOD,
              "product_id IS NULL OR product_name IS NULL OR category IS NULL OR sub_category IS NULL"),
        _unique("dim_date.date_sk unique", "strftime(day, '%Y%m%d')", _CAL),
        _unique("dim_date.full_date unique", "day", _CAL),
        _unique("dim_ship_mode.ship_mode_name unique", "name", _MODES),
        _unique("fact_sales.order_id,row_id unique", "order_id, row_id", "staging"),
        _none("fact_sales mandatory columns", "staging", "order_id IS NULL OR order_date IS NULL OR quantity IS NULL"),
        _none("fact_sales.order_date_sk resolves", "staging", _OUTSIDE.format("order_date")),
        _none("fact_sales.ship_date_sk resolves", "staging", _OUTSIDE.format("ship_date")),
        _none("fact_sales.customer_sk resolves", "staging", "c_custkey NOT IN (SELECT c_custkey FROM customer)"),
        _none("fact_sales.product_sk resolves", "staging", "p_partkey NOT IN (SELECT p_partkey FROM part)"),
        _none("fact_sales.ship_mode_sk resolves", "staging", f"ship_mode NOT IN (SELECT name FROM {_MODES})"),
        _unique("agg_monthly_sales.year,month_num,category,region unique", "y, m, category, region",
                "(SELECT DISTINCT year(order_date) AS y, month(order_date) AS m, category, region FROM staging)"),
    ]
)

_ETL_SUMMARY_TYPES = (
    "first_date date, last_date date, total_orders bigint, unique_customers bigint, total_revenue double, "
    "total_profit double, avg_margin_pct double, repeat_line_pct double"
)

# Key -> (columns with types, query).
_QUERIES: dict[str, tuple[str, str]] = {
    "read_raw_sales": (_RAW_TEXT, "SELECT * FROM raw"),
    "read_clean_sales": (_CLEAN, "SELECT * FROM clean"),
    "write_clean_sales": ("ship_mode varchar, lines bigint", "SELECT ship_mode, count(*) AS lines FROM clean GROUP BY 1"),
    "load_staging": (
        "region varchar, category varchar, lines bigint, units bigint",
        "SELECT region, category, count(*) AS lines, sum(quantity) AS units FROM clean GROUP BY 1, 2",
    ),
    "write_star": (
        "order_year integer, order_month integer, lines bigint, net_sales double",
        "SELECT year(order_date) AS order_year, month(order_date) AS order_month, count(*) AS lines, "
        f"{usd(_NET)} AS net_sales FROM staging GROUP BY 1, 2",
    ),
    "write_forecast": (_FORECAST_TYPES, _TOTAL_FUTURE),
    "read_forecast": (
        "total_forecast double", f"SELECT round(sum(predicted_sales), 2) AS total_forecast FROM ({_TOTAL_FUTURE})"
    ),
    "dedupe_rows": (_RAW_TEXT, "SELECT DISTINCT * FROM raw"),
    "dedupe_report": (
        "rows_before bigint, rows_after bigint, removed bigint",
        "SELECT (SELECT count(*) FROM raw) AS rows_before, count(*) AS rows_after, "
        "(SELECT count(*) FROM raw) - count(*) AS removed FROM (SELECT DISTINCT * FROM raw)",
    ),
    "normalize_columns": (_RAW_TEXT, "SELECT * FROM raw"),
    "select_known_columns": (_RAW_TEXT, "SELECT * FROM raw"),
    "parse_dates_drop_bad": (_DATED, "SELECT * FROM dated"),
    "coerce_numeric": (_NUMBER_ID + "sales double, quantity double, discount double, profit double", "SELECT * FROM numbers"),
    "impute_median": (_NUMBER_ID + "sales double, quantity double, discount double, profit double", "SELECT * FROM filled"),
    "fill_unknown": (
        _RAW_ID + "ship_mode varchar, region varchar, city varchar, postal_code varchar",
        """SELECT order_id, coalesce(row_id, 'Unknown') AS row_id, coalesce(ship_mode, 'Unknown') AS ship_mode,
            coalesce(region, 'Unknown') AS region, 'Unknown' AS city, 'Unknown' AS postal_code FROM dated""",
    ),
    "rejected_input": (
        "reason varchar, field varchar, value varchar, different_rows bigint, copies bigint",
        """SELECT 'unreadable date' AS reason, 'order_date' AS field, order_date AS value, count(*) AS different_rows, cast(sum(n) AS bigint) AS copies
        FROM (SELECT raw.*, count(*) AS n FROM raw WHERE order_date = 'bad' GROUP BY ALL) GROUP BY ALL""",
    ),
    "cleaning_balance": (
        "rows_in bigint, rows_out bigint, rejected bigint, repeats bigint, balanced boolean",
        """SELECT (SELECT count(*) FROM raw) AS rows_in, count(*) FILTER (order_date <> 'bad') AS rows_out,
            count(*) FILTER (order_date = 'bad') AS rejected, (SELECT count(*) FROM raw) - count(*) AS repeats, true AS balanced
        FROM (SELECT DISTINCT * FROM raw)""",
    ),
    "clean_with_rejects": (_CLEAN, "SELECT * FROM clean"),
    "clean_sales": (_CLEAN, "SELECT * FROM clean"),
    "date_parts": (
        _ID + "order_year integer, order_month integer, order_quarter integer, order_week integer, order_dow varchar",
        f"SELECT *, {_CALENDAR_PARTS} FROM numbered",
    ),
    "shipping_days": (_ID + "shipping_days integer", "SELECT * FROM numbered"),
    "profit_margin_pct": (_ID + "profit_margin_pct double", f"SELECT *, {_LINE_MARGIN} AS profit_margin_pct FROM numbered"),
    "discounted_revenue": (_ID + "discounted_revenue double", "SELECT *, net_c / 1e2 AS discounted_revenue FROM numbered"),
    "cogs": (_ID + "cogs double", "SELECT *, cogs_c / 1e2 AS cogs FROM numbered"),
    "customer_ltv": (_ID + "customer_ltv double", f"SELECT *, {_LTV} AS customer_ltv FROM numbered"),
    "customer_order_rank": (_ID + "customer_order_rank integer", f"SELECT *, {_RANK} AS customer_order_rank FROM numbered"),
    "is_repeat_customer": (
        _ID + "is_repeat_customer integer", f"SELECT *, cast({_RANK} > 1 AS integer) AS is_repeat_customer FROM numbered"
    ),
    "sorted_output": (_ID + "customer_id varchar, order_date date", "SELECT * FROM numbered"),
    "monthly_sales_growth": (
        "order_year integer, order_month integer, monthly_total double, sales_growth_pct double", _GROWTH
    ),
    "attach_monthly_growth": (
        _ID + "sales_growth_pct double",
        f"SELECT * FROM numbered JOIN ({_GROWTH}) ON year(order_date) = order_year AND month(order_date) = order_month",
    ),
    "revenue_per_unit": (_ID + "revenue_per_unit double", f"SELECT *, {_PER_UNIT} AS revenue_per_unit FROM numbered"),
    "is_high_value_order": (
        _ID + "is_high_value_order integer", f"SELECT *, cast({_HIGH} AS integer) AS is_high_value_order FROM numbered"
    ),
    "is_loss_order": (_ID + "is_loss_order integer", "SELECT *, cast(profit_c < 0 AS integer) AS is_loss_order FROM numbered"),
    "enrich_sales": (
        _ID + "order_year integer, order_month integer, order_quarter integer, order_week integer, order_dow varchar, "
        "shipping_days integer, profit_margin_pct double, discounted_revenue double, cogs double, customer_ltv double, "
        "customer_order_rank integer, is_repeat_customer integer, sales_growth_pct double, revenue_per_unit double, "
        "is_high_value_order integer, is_loss_order integer",
        f"""SELECT s.*, g.sales_growth_pct, {_LINE_MARGIN} AS profit_margin_pct, net_c / 1e2 AS discounted_revenue,
            cogs_c / 1e2 AS cogs, {_PER_UNIT} AS revenue_per_unit, cast({_HIGH} AS integer) AS is_high_value_order,
            cast(profit_c < 0 AS integer) AS is_loss_order
        FROM (SELECT *, {_CALENDAR_PARTS}, {_LTV} AS customer_ltv, {_RANK} AS customer_order_rank,
                cast({_RANK} > 1 AS integer) AS is_repeat_customer FROM numbered) s
            JOIN ({_GROWTH}) g USING (order_year, order_month)""",
    ),
    "validate_sales": (
        "rule varchar, violations bigint, passed boolean", " UNION ALL ".join(_rule(r) for r in _RULES)
    ),
    **{f"dq_{r}": ("rule varchar, violations bigint, passed boolean", _rule(r)) for r in _RULES},
    "etl_summary": (
        _ETL_SUMMARY_TYPES,
        f"""SELECT min(order_date) AS first_date, max(order_date) AS last_date, {_NDV} AS total_orders,
            count(DISTINCT c_custkey) AS unique_customers, {_REVENUE} AS total_revenue,
            {_GROSS_PROFIT} AS total_profit,
            {half_away(f"sum(cast(round({_LINE_MARGIN} * 100) AS bigint))", "100 * count(*)", 2)} AS avg_margin_pct,
            {pct("count(*) - count(DISTINCT c_custkey)", "count(*)")} AS repeat_line_pct
        FROM numbered""",
    ),
    "run_etl": (
        _ETL_SUMMARY_TYPES,
        f"""SELECT min(order_date) AS first_date, max(order_date) AS last_date, {_NDV} AS total_orders,
            count(DISTINCT customer_id) AS unique_customers,
            {half_away("sum(s3)", "1000", 2)} AS total_revenue, {half_away("sum(p3)", "1000", 2)} AS total_profit,
            {half_away(f"sum(cast(round(coalesce({pct('p3', 's3')}, 0) * 100) AS bigint))", "100 * count(*)", 2)}
                AS avg_margin_pct,
            {pct("count(*) - count(DISTINCT customer_id)", "count(*)")} AS repeat_line_pct
        FROM (SELECT *, cast(round(sales * 1000) AS bigint) AS s3, cast(round(profit * 1000) AS bigint) AS p3
            FROM clean)""",
    ),
    "dq_constraints": ("rule varchar, violations bigint, passed boolean", _CONSTRAINTS),
    "dim_date": (
        "date_sk integer, full_date date, day_of_week integer, day_name varchar, day_of_month integer, "
        "day_of_year integer, week_of_year integer, month_num integer, month_name varchar, quarter integer, "
        "year integer, is_weekend boolean, is_holiday boolean, fiscal_quarter varchar, fiscal_year integer",
        f"""SELECT {_DATE_KEY.format("day")} AS date_sk, day AS full_date, isodow(day) AS day_of_week,
            dayname(day) AS day_name, day(day) AS day_of_month, dayofyear(day) AS day_of_year,
            weekofyear(day) AS week_of_year, month(day) AS month_num, monthname(day) AS month_name,
            quarter(day) AS quarter, year(day) AS year, isodow(day) IN (6, 7) AS is_weekend, false AS is_holiday,
            'FY' || strftime(day, '%y') || 'Q' || quarter(day) AS fiscal_quarter, year(day) AS fiscal_year
        FROM days""",
    ),
    "dim_customers": (
        "customer_id varchar, customer_name varchar, segment varchar, city varchar, state varchar, "
        "postal_code varchar, country varchar, region varchar, customer_ltv double, is_repeat boolean",
        f"""SELECT customer_id, customer_name, segment, city, state, postal_code, country, region,
            {_REVENUE} AS customer_ltv, {_NDV} > 1 AS is_repeat
        FROM staging GROUP BY ALL""",
    ),
    "dim_products": (
        "product_id varchar, product_name varchar, category varchar, sub_category varchar, brand varchar, "
        "is_active boolean",
        "SELECT DISTINCT product_id, product_name, category, sub_category, NULL AS brand, true AS is_active FROM staging",
    ),
    "dim_ship_mode": (
        "ship_mode_name varchar, avg_days integer, cost_tier varchar, orders bigint",
        """SELECT name AS ship_mode_name, days AS avg_days, tier AS cost_tier, count(o_orderkey) AS orders
        FROM (VALUES ('Standard Class', 5, 'Low'), ('Second Class', 3, 'Medium'), ('First Class', 2, 'High'),
            ('Same Day', 0, 'Express')) modes(name, days, tier) LEFT JOIN headers ON ship_mode = name
        GROUP BY ALL""",
    ),
    "fact_derive": (
        "order_date_sk integer, ship_date_sk integer, customer_id varchar, product_id varchar, ship_mode varchar, "
        "order_id varchar, row_id integer, quantity integer, unit_price double, discount_rate double, "
        "gross_sales double, net_sales double, cogs double, profit double, profit_margin_pct double, "
        "revenue_per_unit double, shipping_days integer",
        "SELECT " + _FACT_COLUMNS.format(
            keys=f"{_DATE_KEY.format('order_date')} AS order_date_sk, {_DATE_KEY.format('ship_date')} AS ship_date_sk, "
            "customer_id, product_id, ship_mode, order_id, row_id,"
        ) + " FROM staging",
    ),
    "fact_dim_lookup": (
        _ID + "customer_id varchar, product_id varchar, ship_mode_name varchar, net_sales double",
        "SELECT *, ship_mode AS ship_mode_name, net_c / 1e2 AS net_sales FROM staging",
    ),
    "fact_incremental": (
        _ID + "order_date_sk integer, net_sales double",
        f"""SELECT s.*, {_DATE_KEY.format('order_date')} AS order_date_sk, net_c / 1e2 AS net_sales FROM staging s
        WHERE NOT EXISTS (SELECT 1 FROM staging loaded WHERE loaded.order_date <= DATE '2019-12-31'
            AND loaded.order_id = s.order_id AND loaded.row_id = s.row_id)""",
    ),
    "fact_rejects": (
        "missing varchar, value varchar, lines bigint",
        f"""SELECT 'ship_mode' AS missing, ship_mode AS value, count(*) AS lines FROM clean
        WHERE ship_mode NOT IN (SELECT name FROM {_MODES}) GROUP BY ALL""",
    ),
    "agg_monthly_sales": (
        "year integer, month_num integer, month_name varchar, category varchar, region varchar, total_orders bigint, "
        "total_quantity bigint, gross_revenue double, net_revenue double, total_profit double, avg_profit_margin double",
        f"""SELECT year(order_date) AS year, month(order_date) AS month_num, monthname(order_date) AS month_name,
            category, region, {_NDV} AS total_orders, sum(quantity) AS total_quantity, {_REVENUE} AS gross_revenue,
            {_MONEY}, {half_away("sum(margin_e4)", "10000 * count(*)", 4)} AS avg_profit_margin
        FROM sold_all GROUP BY ALL""",
    ),
    "load_star": (
        "customer_id varchar, customer_name varchar, region varchar, customer_ltv double, is_repeat boolean, "
        "lines bigint, net_sales double, products bigint",
        f"""SELECT customer_id, customer_name, region, {_REVENUE} AS customer_ltv, {_NDV} > 1 AS is_repeat,
            count(*) AS lines, {usd(_NET)} AS net_sales, count(DISTINCT product_id) AS products
        FROM staging GROUP BY ALL""",
    ),
    "monthly_trend": (
        "year integer, month_num integer, month_name varchar, total_orders bigint, units_sold bigint, "
        "net_revenue double, total_profit double, avg_margin_pct double",
        f"""SELECT year(order_date) AS year, month(order_date) AS month_num, monthname(order_date) AS month_name,
            {_NDV} AS total_orders, sum(quantity) AS units_sold, {_MONEY}, {_MARGIN} AS avg_margin_pct
        FROM sold GROUP BY ALL ORDER BY 1, 2""",
    ),
    "top_products": (
        _PRODUCT + "total_revenue double, total_profit double, avg_margin_pct double, units_sold bigint",
        f"""SELECT product_name, category, sub_category, {usd(_NET)} AS total_revenue, {usd(_PROFIT)} AS total_profit,
            {_MARGIN} AS avg_margin_pct, sum(quantity) AS units_sold
        FROM goods_lines GROUP BY ALL ORDER BY total_revenue DESC, product_name, category, sub_category LIMIT 10""",
    ),
    "region_performance": (
        "region varchar, orders bigint, unique_customers bigint, net_revenue double, total_profit double, "
        "profit_margin_pct double, avg_order_value double",
        f"""SELECT region, {_NDV} AS orders, count(DISTINCT c_custkey) AS unique_customers, {_MONEY},
            {pct(_PROFIT, _NET)} AS profit_margin_pct, {half_away(_NET, f"100 * {_NDV}", 2)} AS avg_order_value
        FROM sold_to GROUP BY ALL""",
    ),
    "category_margin": (
        "category varchar, sub_category varchar, net_revenue double, total_profit double, total_cogs double, "
        "avg_margin_pct double, blended_margin_pct double, order_count bigint",
        f"""SELECT category, sub_category, {_MONEY}, {usd("sum(cogs_c)")} AS total_cogs, {_MARGIN} AS avg_margin_pct,
            {pct(_PROFIT, _NET)} AS blended_margin_pct, {_NDV} AS order_count
        FROM goods_lines GROUP BY ALL""",
    ),
    "repeat_rate": (
        "customer_type varchar, customer_count bigint, pct_of_total double, avg_orders_per_customer double",
        f"""SELECT CASE WHEN n > 1 THEN 'Repeat' ELSE 'One-Time' END AS customer_type, count(*) AS customer_count,
            {pct("count(*)", "sum(count(*)) OVER ()")} AS pct_of_total,
            {half_away("sum(n)", "count(*)", 2)} AS avg_orders_per_customer
        FROM (SELECT o_custkey, {_NDV} AS n FROM sold GROUP BY 1) GROUP BY 1""",
    ),
    "monthly_trend_any_year": (
        "year integer, month_num integer, month_name varchar, total_orders bigint, units_sold bigint, "
        "net_revenue double, total_profit double, avg_margin_pct double, year_revenue double",
        f"""SELECT year(day) AS year, month(day) AS month_num, monthname(day) AS month_name,
            {_NDV} AS total_orders, sum(quantity) AS units_sold, {_MONEY}, {_MARGIN} AS avg_margin_pct,
            sum(sum(net_c)) OVER (PARTITION BY year(day)) / 1e2 AS year_revenue
        FROM (SELECT sold.*, cast(cast(o_orderdate AS date) + to_years(shift) AS date) AS day
            FROM sold JOIN orders USING (o_orderkey), (SELECT unnest([10, 40]) AS shift))
        GROUP BY 1, 2, 3""",
    ),
    "yoy_growth": (
        "year integer, net_revenue double, total_profit double, prev_year_revenue double, "
        "yoy_revenue_growth_pct double, yoy_profit_growth_pct double",
        f"""SELECT year, net / 1e2 AS net_revenue, profit / 1e2 AS total_profit, net0 / 1e2 AS prev_year_revenue,
            {pct("net - net0", "net0")} AS yoy_revenue_growth_pct,
            {pct("profit - profit0", "abs(profit0)")} AS yoy_profit_growth_pct
        FROM (SELECT year(order_date) AS year, {_NET} AS net, {_PROFIT} AS profit, lag({_NET}) OVER w AS net0,
            lag({_PROFIT}) OVER w AS profit0 FROM sold GROUP BY 1 WINDOW w AS (ORDER BY year(order_date)))""",
    ),
    "aov_segment_region": (
        "segment varchar, region varchar, total_orders bigint, net_revenue double, avg_order_value double",
        f"""SELECT segment, region, {_NDV} AS total_orders, {usd(_NET)} AS net_revenue,
            {half_away(_NET, f"100 * {_NDV}", 2)} AS avg_order_value FROM sold_to GROUP BY ALL""",
    ),
    "rfm_customers": (
        "customer_id varchar, customer_name varchar, segment varchar, region varchar, last_order_date date, "
        "recency_days integer, frequency bigint, monetary double, r_score integer, f_score integer, m_score integer, "
        "rfm_total integer, rfm_segment varchar",
        "SELECT *, net_c / 1e2 AS monetary, r AS r_score, f AS f_score, m AS m_score, r + f + m AS rfm_total FROM segments",
    ),
    "rfm_segments": (
        "rfm_segment varchar, customer_count bigint, avg_recency_days double, avg_frequency double, "
        "avg_monetary double, total_segment_revenue double",
        f"""SELECT rfm_segment, count(*) AS customer_count,
            {half_away("sum(recency_days)", "count(*)", 0)} AS avg_recency_days,
            {half_away("sum(frequency)", "count(*)", 1)} AS avg_frequency,
            {half_away(_NET, "100 * count(*)", 2)} AS avg_monetary, {usd(_NET)} AS total_segment_revenue
        FROM segments GROUP BY 1""",
    ),
    "top_loss_products": (
        _PRODUCT + "order_count bigint, net_revenue double, total_profit double, avg_discount_pct double",
        f"""SELECT product_name, category, sub_category, {_NDV} AS order_count, {_MONEY},
            {half_away("sum(disc_e4)", "100 * count(*)", 1)} AS avg_discount_pct
        FROM goods_lines WHERE profit_c < 0 GROUP BY ALL
        ORDER BY total_profit, product_name, category, sub_category LIMIT 10""",
    ),
    "discount_bands": (
        "discount_band varchar, order_lines bigint, net_revenue double, total_profit double, avg_margin_pct double, "
        "loss_orders bigint",
        f"""SELECT CASE WHEN disc_e4 = 0 THEN '0% — No Discount' WHEN disc_e4 BETWEEN 100 AND 1000 THEN '1-10%'
                WHEN disc_e4 BETWEEN 1100 AND 2000 THEN '11-20%' WHEN disc_e4 BETWEEN 2100 AND 3000 THEN '21-30%'
                WHEN disc_e4 BETWEEN 3100 AND 5000 THEN '31-50%' ELSE '50%+' END AS discount_band,
            count(*) AS order_lines, {_MONEY}, {_MARGIN} AS avg_margin_pct,
            count(*) FILTER (WHERE profit_c < 0) AS loss_orders
        FROM lines GROUP BY 1""",
    ),
    "ship_mode_performance": (
        "ship_mode_name varchar, orders bigint, avg_shipping_days double, net_revenue double, total_profit double, "
        "avg_margin_pct double",
        f"""SELECT ship_mode AS ship_mode_name, {_NDV} AS orders,
            {half_away("sum(shipping_days)", "count(*)", 1)} AS avg_shipping_days, {_MONEY}, {_MARGIN} AS avg_margin_pct
        FROM sold GROUP BY 1""",
    ),
    "state_heatmap": (
        "state varchar, region varchar, customers bigint, orders bigint, net_revenue double, total_profit double, "
        "margin_pct double",
        f"""SELECT state, region, count(DISTINCT c_custkey) AS customers, {_NDV} AS orders, {_MONEY},
            {pct(_PROFIT, _NET)} AS margin_pct FROM sold_to GROUP BY ALL""",
    ),
    "clv_tiers": (
        "clv_tier varchar, segment varchar, customer_count bigint, avg_ltv double, total_ltv double",
        f"""SELECT CASE WHEN net_c >= 500000 THEN 'Platinum (≥ $5K)' WHEN net_c >= 200000 THEN 'Gold ($2K-$5K)'
                WHEN net_c >= 100000 THEN 'Silver ($1K-$2K)' WHEN net_c >= 50000 THEN 'Bronze ($500-$1K)'
                ELSE 'Standard (< $500)' END AS clv_tier, segment, count(*) AS customer_count,
            {half_away(_NET, "100 * count(*)", 2)} AS avg_ltv, {usd(_NET)} AS total_ltv
        FROM buyer_totals GROUP BY 1, 2""",
    ),
    "qoq_growth": (
        "year integer, quarter integer, category varchar, net_revenue double, prev_qtr_revenue double, "
        "qoq_growth_pct double",
        f"""SELECT year, quarter, category, net / 1e2 AS net_revenue, net0 / 1e2 AS prev_qtr_revenue,
            {pct("net - net0", "net0")} AS qoq_growth_pct
        FROM (SELECT *, lag(net) OVER (PARTITION BY category ORDER BY year, quarter) AS net0
            FROM (SELECT year(order_date) AS year, quarter(order_date) AS quarter, category, {_NET} AS net
                FROM sold_goods GROUP BY ALL))""",
    ),
    "rolling_daily": (
        "full_date date, daily_revenue double, daily_profit double, rolling_7d_revenue double, mtd_revenue double",
        f"""SELECT order_date AS full_date, net / 1e2 AS daily_revenue, profit / 1e2 AS daily_profit,
            {half_away("sum(net) OVER w7", "100 * count(*) OVER w7", 2)} AS rolling_7d_revenue,
            sum(net) OVER (PARTITION BY date_trunc('month', order_date) ORDER BY order_date) / 1e2 AS mtd_revenue
        FROM (SELECT order_date, {_NET} AS net, {_PROFIT} AS profit FROM sold GROUP BY 1)
        WINDOW w7 AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    ),
    "kpi_snapshot": (
        "total_net_revenue double, total_profit double, overall_margin_pct double, total_orders bigint, "
        "total_units_sold bigint, avg_order_value double, total_customers bigint",
        f"""SELECT {usd(_NET)} AS total_net_revenue, {usd(_PROFIT)} AS total_profit,
            {pct(_PROFIT, _NET)} AS overall_margin_pct, {_NDV} AS total_orders, sum(quantity) AS total_units_sold,
            {half_away(_NET, f"100 * {_NDV}", 2)} AS avg_order_value, count(DISTINCT o_custkey) AS total_customers
        FROM sold""",
    ),
    "bi_calendar": (
        "date date, year integer, month_num integer, month_name varchar, quarter varchar, week integer, "
        "weekday varchar, year_month varchar",
        """SELECT day AS date, year(day) AS year, month(day) AS month_num, strftime(day, '%b') AS month_name,
            'Q' || quarter(day) AS quarter, cast(strftime(day, '%U') AS integer)
                + CASE WHEN dayofweek(date_trunc('year', day)) = 0 THEN 0 ELSE 1 END AS week,
            strftime(day, '%a') AS weekday, strftime(day, '%Y-%m') AS year_month
        FROM days""",
    ),
    "calendar_join": (
        "order_id varchar, product_sk bigint, order_date date, sales double, quantity integer, year integer, "
        "month_num integer, month_name varchar, quarter varchar, week integer, weekday varchar, year_month varchar",
        """SELECT order_id, l_partkey AS product_sk, order_date, sales_c / 1e2 AS sales, quantity,
            year(order_date) AS year, month(order_date) AS month_num, strftime(order_date, '%b') AS month_name,
            'Q' || quarter(order_date) AS quarter, cast(strftime(order_date, '%U') AS integer)
                + CASE WHEN dayofweek(date_trunc('year', order_date)) = 0 THEN 0 ELSE 1 END AS week,
            strftime(order_date, '%a') AS weekday, strftime(order_date, '%Y-%m') AS year_month
        FROM sold""",
    ),
    "total_revenue": _measure_query("segment", "sold_to", "total_revenue"),
    "total_profit": _measure_query("segment", "sold_to", "total_profit"),
    "total_orders": _measure_query("category", "goods_lines", "total_orders"),
    "total_units": _measure_query("category", "goods_lines", "total_units"),
    "avg_order_value": _measure_query("region", "sold_to", "avg_order_value"),
    "profit_margin": _measure_query("category", "goods_lines", "profit_margin"),
    "total_customers": _measure_query("region, segment", "sold_to", "total_customers"),
    "avg_customer_ltv": _measure_query("segment", "sold_to", "avg_customer_ltv"),
    "revenue_per_customer": _measure_query("region", "sold_to", "revenue_per_customer"),
    "loss_lines": _measure_query("category", "goods_lines", "loss_lines"),
    "high_discount_lines": _measure_query("category", "goods_lines", "high_discount_lines"),
    "avg_shipping_days_measure": _measure_query("ship_mode", "sold_to", "avg_shipping_days"),
    "measure_table": _measure_query("region, category", "sold_all"),
    "revenue_ly": (
        "year integer, month_num integer, total_revenue double, revenue_ly double",
        f"""WITH m AS ({_MONTH_LY.format(keys="", source="sold")})
        SELECT a.year, a.month_num, a.c / 1e2 AS total_revenue, b.c / 1e2 AS revenue_ly
        FROM m a LEFT JOIN m b ON b.year = a.year - 1 AND b.month_num = a.month_num""",
    ),
    "yoy_growth_measure": (
        "region varchar, year integer, month_num integer, total_revenue double, revenue_ly double, yoy_growth_pct double",
        f"""WITH m AS ({_MONTH_LY.format(keys="region,", source="sold_to")})
        SELECT a.region, a.year, a.month_num, a.c / 1e2 AS total_revenue, b.c / 1e2 AS revenue_ly,
            (a.c / 1e2 - b.c / 1e2) / nullif(abs(b.c / 1e2), 0) * 100 AS yoy_growth_pct
        FROM m a LEFT JOIN m b ON b.region = a.region AND b.year = a.year - 1 AND b.month_num = a.month_num""",
    ),
    "revenue_to_date": (
        "order_date date, revenue_mtd double, revenue_qtd double, revenue_ytd double",
        f"""SELECT order_date, {_to_date("sales_c", "month")} AS revenue_mtd, {_to_date("sales_c", "quarter")} AS revenue_qtd,
            {_to_date("sales_c", "year")} AS revenue_ytd FROM sold GROUP BY order_date""",
    ),
    "profit_ytd": (
        "order_date date, profit_ytd double",
        f"SELECT order_date, {_to_date('profit_c', 'year')} AS profit_ytd FROM sold GROUP BY order_date",
    ),
    "period_cards": (
        "as_of date, revenue_mtd double, revenue_qtd double, revenue_ytd double, profit_ytd double",
        """SELECT last AS as_of,
            sum(sales_c) FILTER (WHERE order_date >= date_trunc('month', last)) / 1e2 AS revenue_mtd,
            sum(sales_c) FILTER (WHERE order_date >= date_trunc('quarter', last)) / 1e2 AS revenue_qtd,
            sum(sales_c) FILTER (WHERE order_date >= date_trunc('year', last)) / 1e2 AS revenue_ytd,
            sum(profit_c) FILTER (WHERE order_date >= date_trunc('year', last)) / 1e2 AS profit_ytd
        FROM sold, (SELECT max(order_date) AS last FROM sold) GROUP BY last""",
    ),
    "repeat_customer_rate": (
        "region varchar, repeat_customer_rate double",
        f"""SELECT region, count(*) FILTER (WHERE n > 1) / cast(count(*) AS double) * 100 AS repeat_customer_rate
        FROM (SELECT region, c_custkey, {_NDV} AS n FROM sold_to GROUP BY ALL) GROUP BY 1""",
    ),
    "apply_slicers": (
        "region varchar, segment varchar, category varchar, total_revenue double, total_orders bigint, total_units bigint",
        f"""SELECT region, segment, category, {_measures("total_revenue", "total_orders", "total_units")} FROM sold_all
        WHERE year(order_date) IN (2018, 2019) AND order_date BETWEEN DATE '2018-03-01' AND DATE '2019-09-30'
            AND segment IN ('BUILDING', 'MACHINERY') AND region IN ('ASIA', 'EUROPE')
            AND category IN ('ECONOMY', 'PROMO') GROUP BY ALL""",
    ),
    "revenue_ly_year_slicer": (
        "year integer, month_num integer, total_revenue double, revenue_ly double",
        "SELECT * EXCLUDE (yoy_growth_pct) FROM ("
        + _last_year("2020 AS year, cast(month(order_date) AS integer) AS month_num", "sold", ("2020-01-01", "2020-12-31"), ("2019-01-01", "2019-12-31"))
        + ")",
    ),
    "yoy_growth_region_slicer": (
        "region varchar, year integer, quarter integer, " + _LY_TYPES,
        _last_year("region, 2020 AS year, cast(quarter(order_date) AS integer) AS quarter", "sold_to", ("2020-01-01", "2020-12-31"),
                   ("2019-01-01", "2019-12-31"), "region IN ('ASIA', 'EUROPE')"),
    ),
    "yoy_growth_leap_range": (
        "segment varchar, year integer, month_num integer, " + _LY_TYPES,
        _last_year("segment, 2020 AS year, cast(month(order_date) AS integer) AS month_num", "sold_to", ("2020-02-10", "2020-03-20"),
                   ("2019-02-10", "2019-03-20")),
    ),
    "yoy_growth_february": (
        "category varchar, " + _LY_TYPES,
        _last_year("category", "sold_all", ("2021-01-01", "2021-02-28"), ("2020-01-01", "2020-02-29"), "region IN ('ASIA', 'EUROPE')"),
    ),
    "yoy_growth_every_day": (
        "order_date date, " + _LY_TYPES,
        """WITH d AS (SELECT order_date, sum(sales_c) AS c FROM sold GROUP BY 1),
        ago AS (SELECT day, cast(day - INTERVAL 1 YEAR AS date) AS before FROM days
            UNION SELECT day, last_day(cast(day - INTERVAL 1 YEAR AS date)) FROM days WHERE day = last_day(day)),
        b AS (SELECT day, sum(c) AS b FROM ago JOIN d ON before = order_date GROUP BY 1)
        SELECT day AS order_date, c / 1e2 AS total_revenue, b / 1e2 AS revenue_ly,
            (coalesce(c, 0) / 1e2 - b / 1e2) / nullif(abs(b / 1e2), 0) * 100 AS yoy_growth_pct
        FROM days LEFT JOIN d ON day = order_date LEFT JOIN b USING (day) WHERE c IS NOT NULL OR b IS NOT NULL""",
    ),
    "to_date_by_region": ("region varchar, " + _TO_DATE_TYPES, _dense_to_date("region", "sold_to", "(SELECT max(order_date) FROM d)")),
    "to_date_by_category": ("category varchar, " + _TO_DATE_TYPES, _dense_to_date("category", "sold_goods", "(SELECT max(order_date) FROM d)")),
    "to_date_sliced": (
        "segment varchar, " + _TO_DATE_TYPES,
        "SELECT * FROM ("
        + _dense_to_date("segment", "sold_to", "DATE '2020-03-20'", "order_date BETWEEN DATE '2020-01-01' AND DATE '2020-03-20'")
        + ") WHERE order_date >= DATE '2020-02-10'",
    ),
    "kpi_cards_range": (
        "total_revenue double, total_profit double, profit_margin double, total_orders bigint, yoy_growth_pct double",
        f"""SELECT s / 1e2 AS total_revenue, p / 1e2 AS total_profit, {pct("p", "s")} AS profit_margin,
            n AS total_orders, {pct("s - ly", "ly")} AS yoy_growth_pct
        FROM (SELECT sum(sales_c) AS s, sum(profit_c) AS p, {_NDV} AS n FROM sold
                WHERE order_date BETWEEN DATE '2020-03-05' AND DATE '2021-02-28'),
            (SELECT sum(sales_c) AS ly FROM sold WHERE order_date BETWEEN DATE '2019-03-05' AND DATE '2020-02-29')""",
    ),
    "kpi_cards": (
        "total_revenue double, total_profit double, profit_margin double, total_orders bigint, yoy_growth_pct double",
        f"""SELECT s / 1e2 AS total_revenue, p / 1e2 AS total_profit, {pct("p", "s")} AS profit_margin,
            n AS total_orders, {pct("s - ly", "ly")} AS yoy_growth_pct
        FROM (SELECT sum(sales_c) AS s, sum(profit_c) AS p, {_NDV} AS n FROM sold WHERE year(order_date) = 2020),
            (SELECT sum(sales_c) AS ly FROM sold WHERE year(order_date) = 2019)""",
    ),
    "trend_line": (
        "year_month varchar, total_revenue double, total_profit double, avg_revenue double",
        f"""SELECT strftime(ds, '%Y-%m') AS year_month, sales_c / 1e2 AS total_revenue, profit_c / 1e2 AS total_profit,
            {half_away("sum(sales_c) OVER ()", "100 * count(*) OVER ()", 2)} AS avg_revenue FROM months""",
    ),
    "revenue_by_category": (
        "category varchar, region varchar, total_revenue double",
        f"SELECT category, region, {_REVENUE} AS total_revenue FROM sold_all GROUP BY ALL",
    ),
    "state_map": _measure_query("state", "sold_to", "total_revenue", "total_profit", "profit_margin", "total_orders"),
    "region_columns": _measure_query("region", "sold_to", "total_revenue", "total_profit"),
    "state_matrix": (
        "state varchar, level bigint, total_revenue double, total_profit double, profit_margin double, total_orders bigint",
        f"""SELECT state, grouping(state) AS level,
            {_measures("total_revenue", "total_profit", "profit_margin", "total_orders")}
        FROM sold_to GROUP BY ROLLUP (state)""",
    ),
    "state_scatter": (
        "state varchar, total_revenue double, total_profit double, total_orders bigint, side varchar",
        f"""SELECT state, {_measures("total_revenue", "total_profit", "total_orders")},
            CASE WHEN sum(profit_c) < 0 THEN 'loss' ELSE 'profit' END AS side FROM sold_to GROUP BY state""",
    ),
    "top_n_products_bi": (
        "product_name varchar, total_revenue double, total_profit double, profitable boolean",
        f"""SELECT product_name, {_measures("total_revenue", "total_profit")}, sum(profit_c) > 0 AS profitable
        FROM goods_lines GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10""",
    ),
    "subcategory_treemap": _measure_query("category, sub_category", "goods_lines", "total_revenue", "profit_margin"),
    "discount_profit_scatter": (
        "sub_category varchar, avg_discount double, total_profit double",
        f"""SELECT sub_category, {half_away("sum(disc_e4)", "10000 * count(*)", 4)} AS avg_discount,
            {_GROSS_PROFIT} AS total_profit FROM goods_lines GROUP BY 1""",
    ),
    "pricing_review": (
        "product_name varchar, avg_discount double, total_profit double",
        f"""SELECT product_name, {half_away("sum(disc_e4)", "10000 * count(*)", 4)} AS avg_discount,
            {_GROSS_PROFIT} AS total_profit FROM goods_lines GROUP BY 1 HAVING avg_discount > 0.2 AND sum(profit_c) < 0""",
    ),
    "category_share": (
        "category varchar, total_revenue double, share_pct double",
        f"""SELECT category, {_REVENUE} AS total_revenue,
            {pct("sum(sales_c)", "sum(sum(sales_c)) OVER ()")} AS share_pct FROM goods_lines GROUP BY 1""",
    ),
    "loss_makers": (
        "product_name varchar, category varchar, total_orders bigint, total_revenue double, total_profit double, "
        "avg_discount double",
        f"""SELECT product_name, category, {_measures("total_orders", "total_revenue", "total_profit")},
            {half_away("sum(disc_e4)", "10000 * count(*)", 4)} AS avg_discount
        FROM goods_lines GROUP BY 1, 2 HAVING sum(profit_c) < 0""",
    ),
    "seasonal_heatmap": (
        "year integer, " + ", ".join(f"m{i:02d} double" for i in range(1, 13)),
        "SELECT year(ds) AS year, "
        + ", ".join(f"sum(sales_c) FILTER (WHERE month(ds) = {i}) / 1e2 AS m{i:02d}" for i in range(1, 13))
        + " FROM months GROUP BY 1",
    ),
    "profit_waterfall": (
        "month_num integer, month_name varchar, category varchar, total_profit double, profit_change double",
        """SELECT month_num, month_name, category, c / 1e2 AS total_profit,
            (c - lag(c) OVER (PARTITION BY category ORDER BY month_num)) / 1e2 AS profit_change
        FROM (SELECT month(order_date) AS month_num, strftime(order_date, '%b') AS month_name, category,
            sum(profit_c) AS c FROM sold_goods GROUP BY ALL)""",
    ),
    "area_trend": (
        "ds date, total_revenue double, total_profit double, trend double, forecast double, lower_bound double, "
        "upper_bound double",
        f"""SELECT t.ds, round(y, 2) AS total_revenue, round(profit_c / 1e2, 2) AS total_profit, round(trend, 2) AS trend,
            CASE WHEN t.ds > last_ds THEN round(yhat, 2) END AS forecast,
            CASE WHEN t.ds > last_ds THEN round(yhat - {_Z95} * sd * yhat, 2) END AS lower_bound,
            CASE WHEN t.ds > last_ds THEN round(yhat + {_Z95} * sd * yhat, 2) END AS upper_bound
        FROM tot_curve t LEFT JOIN months m ON m.ds = t.ds""",
    ),
    "actuals_plus_forecast": (
        "series varchar, month date, value double, lower_bound double, upper_bound double",
        f"""SELECT 'actual' AS series, ds AS month, y AS value, NULL AS lower_bound, NULL AS upper_bound FROM tot_hist
        UNION ALL SELECT 'forecast', forecast_month, predicted_sales, lower_bound, upper_bound FROM ({_TOTAL_FUTURE})""",
    ),
    "profit_decomposition": (
        "region varchar, segment varchar, category varchar, total_profit double, level bigint",
        f"""SELECT region, segment, category, {_GROSS_PROFIT} AS total_profit,
            grouping(region, segment, category) AS level
        FROM sold_all GROUP BY ROLLUP (region, segment, category)""",
    ),
    "loss_decomposition": (
        "step integer, dimension varchar, member varchar, loss double, share_pct double, total_profit double",
        f"""WITH base AS (SELECT region, segment, category, sum(greatest(-profit_c, 0)) / 1e2 AS l, sum(profit_c) / 1e2 AS p FROM sold_all GROUP BY ALL),
        s1 AS (SELECT 1 AS step, * FROM ({_split("true")}) ORDER BY excess DESC, place, member LIMIT 1),
        s2 AS (SELECT 2 AS step, n.* FROM ({_split(_inside("s1"))}) n, s1 WHERE n.place <> s1.place ORDER BY n.excess DESC, n.place, n.member LIMIT 1),
        s3 AS (SELECT 3 AS step, n.* FROM ({_split(_inside("s1") + " AND " + _inside("s2"))}) n, s1, s2
            WHERE n.place NOT IN (s1.place, s2.place) ORDER BY n.excess DESC, n.place, n.member LIMIT 1)
        SELECT step, dimension, member, round(loss, 6) AS loss, round(loss / node * 100, 6) AS share_pct, round(total_profit, 6) AS total_profit
        FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)""",
    ),
    "segment_repeat_ltv": (
        "segment varchar, customers bigint, repeat_rate_pct double, avg_ltv double",
        f"""SELECT segment, count(*) AS customers, {pct("count(*) FILTER (WHERE n > 1)", "count(*)")} AS repeat_rate_pct,
            {half_away("sum(s)", "100 * count(*)", 2)} AS avg_ltv
        FROM (SELECT segment, c_custkey, {_NDV} AS n, sum(sales_c) AS s FROM sold_to GROUP BY ALL) GROUP BY 1""",
    ),
    "loss_rate_by_discount": (
        "lines bigint, loss_lines bigint, loss_rate_pct double",
        f"""SELECT count(*) AS lines, count(*) FILTER (WHERE profit_c < 0) AS loss_lines,
            {pct("count(*) FILTER (WHERE profit_c < 0)", "count(*)")} AS loss_rate_pct FROM lines WHERE disc_e4 > 3000""",
    ),
    "discount_profit_corr": (
        "corr_profit double, corr_margin double",
        """SELECT round(corr(disc_e4 / 1e4, profit_c / 1e2), 6) AS corr_profit,
            round(corr(disc_e4 / 1e4, margin_e4 / 1e4), 6) AS corr_margin FROM lines""",
    ),
    "seasonal_multiple": (
        "season_mean double, overall_mean double, seasonal_multiple double",
        f"""SELECT {half_away("s", "100 * n", 2)} AS season_mean, {half_away("a", "100 * m", 2)} AS overall_mean,
            {half_away("s * m", "a * n", 4)} AS seasonal_multiple
        FROM (SELECT sum(sales_c) FILTER (WHERE month(ds) IN (11, 12)) AS s, sum(sales_c) AS a, count(*) AS m,
            count(*) FILTER (WHERE month(ds) IN (11, 12)) AS n FROM months)""",
    ),
    "region_extremes": (
        "top_revenue_region varchar, top_revenue double, lowest_margin_region varchar, lowest_margin_pct double",
        f"""WITH g AS (SELECT region, {usd(_NET)} AS net, {pct(_PROFIT, _NET)} AS margin FROM sold_to GROUP BY 1)
        SELECT (SELECT region FROM g ORDER BY net DESC, region DESC LIMIT 1) AS top_revenue_region,
            (SELECT max(net) FROM g) AS top_revenue,
            (SELECT region FROM g ORDER BY margin, region LIMIT 1) AS lowest_margin_region,
            (SELECT min(margin) FROM g) AS lowest_margin_pct""",
    ),
    "category_extremes": (
        "best_category varchar, best_margin_pct double, worst_category varchar, worst_margin_pct double",
        f"""WITH g AS (SELECT category, {pct(_PROFIT, _NET)} AS margin FROM goods_lines GROUP BY 1)
        SELECT (SELECT category FROM g ORDER BY margin DESC, category DESC LIMIT 1) AS best_category,
            (SELECT max(margin) FROM g) AS best_margin_pct,
            (SELECT category FROM g ORDER BY margin, category LIMIT 1) AS worst_category,
            (SELECT min(margin) FROM g) AS worst_margin_pct""",
    ),
    "monthly_series": (
        "ds date, y double, profit double, orders bigint, units bigint",
        "SELECT ds, sales_c / 1e2 AS y, profit_c / 1e2 AS profit, orders, units FROM months WHERE sales_c > 0",
    ),
    "fit_trend_season": (
        "month_num integer, slope double, intercept double, seasonal_index double, residual_sd double, months bigint, "
        "first_month date, last_month date",
        """SELECT mn AS month_num, round(b, 6) AS slope, round(a, 6) AS intercept, round(si, 6) AS seasonal_index,
            round(sd, 6) AS residual_sd, n AS months, first_ds AS first_month, last_ds AS last_month
        FROM tot_line JOIN tot_si USING (k) JOIN tot_sd USING (k)""",
    ),
    "forecast_horizon": (
        "ds date, y double, trend double, seasonal_index double, yhat double, yhat_lower double, yhat_upper double",
        f"SELECT ds, round(COLUMNS(* EXCLUDE (ds)), 2) FROM (SELECT {_CURVE.format(z=_Z95)} FROM tot_curve)",
    ),
    "backtest": (_ERRORS, f"SELECT {_ERROR_SUMS} FROM bt_points"),
    "backtest_points": (
        "cutoff date, ds date, horizon_days integer, y double, yhat double",
        "SELECT cutoff, ds, ahead AS horizon_days, y, round(yhat, 4) AS yhat FROM bt_points",
    ),
    "backtest_metrics": (
        "horizon_days integer, " + _ERRORS,
        f"SELECT ahead AS horizon_days, {_ERROR_SUMS} FROM bt_points GROUP BY ahead",
    ),
    "grouped_forecast": (
        "category varchar, ds date, y double, trend double, seasonal_index double, yhat double, yhat_lower double, "
        "yhat_upper double",
        f"""SELECT category, ds, round(COLUMNS(* EXCLUDE (ds, category)), 2)
        FROM (SELECT k AS category, {_CURVE.format(z=_Z90)} FROM cat_curve WHERE n >= 6)""",
    ),
    "forecast_table": (_FORECAST_TYPES, _TOTAL_FUTURE),
    "forecast_total": (
        "total_forecast double", f"SELECT round(sum(predicted_sales), 2) AS total_forecast FROM ({_TOTAL_FUTURE})"
    ),
    "forecast_components": (
        "ds date, trend double, seasonal_index double",
        "SELECT ds, round(trend, 6) AS trend, round(si, 6) AS seasonal_index FROM tot_curve",
    ),
    "actual_vs_forecast": (
        "ds date, y double, yhat double, is_future boolean, error_down double, error_up double",
        f"""SELECT ds, y, round(yhat, 2) AS yhat, ds > last_ds AS is_future, round(yhat - lower, 2) AS error_down,
            round(upper - yhat, 2) AS error_up
        FROM (SELECT *, yhat - {_Z95} * sd * yhat AS lower, yhat + {_Z95} * sd * yhat AS upper FROM tot_curve)""",
    ),
    "holiday_sales": (
        "year integer, holiday varchar, day date, observed date, total_revenue double, total_units bigint",
        """WITH y AS (SELECT DISTINCT cast(year(order_date) AS integer) AS year FROM sold),
        d AS (SELECT year, cast(unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 31), INTERVAL 1 DAY)) AS date) AS day FROM y),
        n AS (SELECT year, day, month(day) AS mo, dayofmonth(day) AS dd, isodow(day) AS w, (dayofmonth(day) + 6) // 7 AS nth,
            dayofmonth(day) + 7 > dayofmonth(last_day(day)) AS is_last FROM d),
        named AS (SELECT *, CASE
            WHEN mo = 1 AND dd = 1 THEN 'New Year''s Day' WHEN mo = 1 AND w = 1 AND nth = 3 AND year >= 1986 THEN 'Martin Luther King Jr. Day'
            WHEN mo = 2 AND w = 1 AND nth = 3 THEN 'Washington''s Birthday' WHEN mo = 5 AND w = 1 AND is_last THEN 'Memorial Day'
            WHEN mo = 6 AND dd = 19 AND year >= 2021 THEN 'Juneteenth' WHEN mo = 7 AND dd = 4 THEN 'Independence Day'
            WHEN mo = 9 AND w = 1 AND nth = 1 THEN 'Labor Day' WHEN mo = 10 AND w = 1 AND nth = 2 THEN 'Columbus Day'
            WHEN mo = 11 AND dd = 11 THEN 'Veterans Day' WHEN mo = 11 AND w = 4 AND nth = 4 THEN 'Thanksgiving'
            WHEN mo = 12 AND dd = 25 THEN 'Christmas Day' END AS holiday FROM n),
        s AS (SELECT order_date, sum(sales_c) / 1e2 AS total_revenue, cast(sum(quantity) AS bigint) AS total_units FROM sold GROUP BY 1)
        SELECT year, holiday, day,
            cast(day + CASE WHEN holiday IN ('New Year''s Day', 'Juneteenth', 'Independence Day', 'Veterans Day', 'Christmas Day')
                THEN CASE w WHEN 6 THEN -1 WHEN 7 THEN 1 ELSE 0 END ELSE 0 END AS date) AS observed,
            total_revenue, coalesce(total_units, 0) AS total_units
        FROM named LEFT JOIN s ON day = order_date WHERE holiday IS NOT NULL""",
    ),
    "run_forecast": (
        "category varchar, " + _FORECAST_TYPES,
        f"""SELECT 'all categories' AS category, * FROM ({_TOTAL_FUTURE})
        UNION ALL BY NAME {_FUTURE.format(z=_Z90, p="cat", n=6, more=", k AS category")}""",
    ),
}


def _needed(text: str) -> list[str]:
    """Shared views that ``text`` mentions, directly or through others, in order of definition."""
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    found: set[str] = set()
    for name in reversed(_VIEWS):
        if name in words:
            found.add(name)
            body = _VIEWS[name]
            words |= set(body.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    return [name for name in _VIEWS if name in found]


def _statement(columns: str, body: str) -> str:
    views = "".join(f"{name} AS ({_VIEWS[name]}),\n" for name in _needed(body))
    casts = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(", "))
    return f"WITH {views}answer AS ({body})\nSELECT {casts} FROM answer"


def oracle_sql() -> dict[str, str]:
    """Query name -> DuckDB statement."""
    return {name: _statement(columns, body) for name, (columns, body) in _QUERIES.items()}


def oracle_columns() -> dict[str, dict[str, str]]:
    """Query name -> column name -> DuckDB type."""
    return {
        name: dict(c.rsplit(" ", 1) for c in columns.split(", ")) for name, (columns, _) in _QUERIES.items()
    }
