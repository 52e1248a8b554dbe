"""Check SQL for a second engine: plain statements of what each query must return, over the same test tables."""

from __future__ import annotations

from checks.registry import CATEGORIES
from parcelmart.sources.testdata import BASE_TABLES, SOURCE_SQL

WM = "TIMESTAMP '1998-01-01'"
RAW = {name: f"({SOURCE_SQL[name].format(**{t: t for t in BASE_TABLES})})" for name in SOURCE_SQL}
TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def ts(col: str) -> str:
    return TS.format(col)


def singular(w: str) -> str:
    return (
        f"CASE WHEN {w} LIKE '%ies' AND length({w}) > 3 THEN left({w}, length({w}) - 3) || 'y' "
        f"WHEN {w} LIKE '%sses' THEN left({w}, length({w}) - 2) WHEN {w} LIKE '%es' THEN {w} "
        f"WHEN {w} LIKE '%s' AND {w} NOT LIKE '%ss' THEN left({w}, length({w}) - 1) ELSE {w} END"
    )


def category(col: str) -> str:
    word = f"regexp_replace(lower(trim({col})), '\\s+', '', 'g')"
    return f"NULLIF({singular(word)}, '')"


def gender(col: str) -> str:
    word = f"lower(trim({col}))"
    return f"CASE WHEN {word} IN ('f', 'female') THEN 'F' WHEN {word} IN ('m', 'male') THEN 'M' END"


def day_of(col: str) -> str:
    return (
        f"CASE WHEN regexp_matches({col}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') "
        f"THEN CAST(try_strptime({col}, '%m/%d/%Y') AS DATE) ELSE CAST(try_cast({col} AS TIMESTAMP) AS DATE) END"
    )


def calendar(day: str) -> str:
    return (
        f"CAST(strftime({day}, '%Y%m%d') AS INT) AS date_id, CAST(year({day}) AS INT) AS year, "
        f"CAST(quarter({day}) AS INT) AS quarter, CAST(month({day}) AS INT) AS month, CAST(day({day}) AS INT) AS day, "
        f"CAST(isodow({day}) - 1 AS INT) AS day_of_week, isodow({day}) IN (6, 7) AS is_weekend"
    )


def half_up(num: str, den: str) -> str:
    """num / den hundredths, rounded half away from zero on whole numbers, as a double."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den})))) / 100.0"


def cents(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(30,2)) * 100 AS HUGEINT)"


def cte(name: str, body: str) -> str:
    return f"{name} AS ({body})"


_PRODUCT = f"""SELECT id AS product_id, name, {category('category')} AS category, price AS current_price, "updatedAt"
    FROM {RAW['products']} QUALIFY row_number() OVER (PARTITION BY id ORDER BY "updatedAt" DESC) = 1"""
_USER = f"""SELECT id AS user_id, city, country, {gender('gender')} AS gender, {day_of('"dateOfBirth"')} AS date_of_birth,
    "updatedAt" FROM {RAW['users']} QUALIFY row_number() OVER (PARTITION BY id ORDER BY "updatedAt" DESC) = 1"""
_RIDER = f"""SELECT r.id AS rider_id, r."vehicleType" AS vehicle_type, k.name AS courier_name, r.gender,
    greatest(r."updatedAt", k."updatedAt") AS "updatedAt"
    FROM {RAW['riders']} r LEFT JOIN {RAW['couriers']} k ON r."courierId" = k.id"""
_DAYS = f"""SELECT DISTINCT {day_of('"deliveryDate"')} AS day FROM {RAW['orders']} WHERE {day_of('"deliveryDate"')} IS NOT NULL"""
_ITEMS = f"""SELECT i."OrderId" AS order_id, i."ProductId" AS product_id, o."userId" AS user_id,
    o."deliveryRiderId" AS rider_id, CAST(strftime({day_of('o."deliveryDate"')}, '%Y%m%d') AS INT) AS delivery_date_id,
    i.quantity, p.price AS unit_price, i.quantity * p.price AS total_price,
    greatest(o."updatedAt", i."updatedAt") AS updated_at, p."updatedAt" AS price_updated
    FROM {RAW['order_items']} i LEFT JOIN {RAW['orders']} o ON i."OrderId" = o.id
    LEFT JOIN {RAW['products']} p ON i."ProductId" = p.id"""
_FACT = """SELECT order_id, product_id, user_id, coalesce(rider_id, -1) AS rider_id, delivery_date_id,
    coalesce(quantity, 0) AS quantity, coalesce(unit_price, 0) AS unit_price, coalesce(total_price, 0) AS total_price,
    updated_at, price_updated FROM items WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND user_id IS NOT NULL"""

WITH = "WITH " + ",\n".join(
    [
        cte("dim_product", _PRODUCT),
        cte("dim_user", _USER),
        cte("dim_rider", _RIDER),
        cte("days", _DAYS),
        cte("dim_date", f"SELECT {calendar('day')} FROM days"),
        cte("items", _ITEMS),
        cte("fact", _FACT),
    ]
)

FACT_VALUES = "quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_price AS DOUBLE) AS total_price"
FACT_KEYS = "order_id, product_id, user_id, rider_id, delivery_date_id"
PRODUCT_COLS = "product_id, name, category, CAST(current_price AS DOUBLE) AS current_price"
USER_COLS = "user_id, city, country, gender, CAST(date_of_birth AS VARCHAR) AS date_of_birth"
RIDER_COLS = "rider_id, vehicle_type, courier_name, gender"
DATE_COLS = "date_id, year, quarter, month, day, day_of_week, is_weekend"


def q(body: str, *more: tuple[str, str]) -> str:
    """A query over the warehouse tables, with more named steps before it."""
    steps = "".join(f",\n{cte(name, step)}" for name, step in more)
    return f"{WITH}{steps}\n{body}"


def source(name: str, columns: str) -> str:
    return f"SELECT {columns} FROM {RAW[name]}"


_DATES = f'{ts(chr(34) + "createdAt" + chr(34))} AS "createdAt", {ts(chr(34) + "updatedAt" + chr(34))} AS "updatedAt"'
_UPDATED = f'{ts(chr(34) + "updatedAt" + chr(34))} AS "updatedAt"'

NEWEST = f"SELECT {ts('max(' + chr(34) + 'updatedAt' + chr(34) + ')')} AS run_date FROM {RAW['order_items']}"
_SLASHED = "regexp_matches(\"deliveryDate\", '^\\d{1,2}/\\d{1,2}/\\d{4}$')"

SCANS = {
    "s1_orders": source("orders", f'id, "orderNumber", "userId", "deliveryDate", "deliveryRiderId", {_DATES}'),
    "s2_order_items": source("order_items", f'"OrderId", "ProductId", quantity, notes, {_DATES}'),
    "s3_products": source(
        "products", f'id, "productCode", category, description, name, CAST(price AS DOUBLE) AS price, {_DATES}'
    ),
    "s4_users": source("users", f'id, city, country, gender, "dateOfBirth", {_UPDATED}'),
    "s5_riders": source("riders", f'id, "vehicleType", "courierId", gender, {_UPDATED}'),
    "s6_couriers": source("couriers", f"id, name AS courier_name, {_DATES}"),
    "s7_last_run": NEWEST,
    "s9_date_keys": q("SELECT date_id FROM dim_date"),
}

# Facts after two loads: an untouched order keeps the price known at the first load, 0 where the product was unknown.
_TOUCHED = f"SELECT DISTINCT order_id FROM fact WHERE updated_at > {WM}"
_KNOWN = f"(f.order_id IN (SELECT order_id FROM touched) OR f.price_updated <= {WM})"
_LOADED = (
    ("touched", _TOUCHED),
    (
        "loaded",
        f"""SELECT {FACT_KEYS}, quantity, CASE WHEN {_KNOWN} THEN unit_price ELSE 0 END AS unit_price,
        CASE WHEN {_KNOWN} THEN total_price ELSE 0 END AS total_price FROM fact f""",
    ),
)
_TWO_LOADS = q(f"SELECT {FACT_KEYS}, {FACT_VALUES} FROM loaded", *_LOADED)

_CITY = "'  ' || city || ' '"
_FACT_ORDER = "delivery_date_id // 100, order_id, product_id, user_id, rider_id, delivery_date_id, quantity"
TRANSFORMS = {
    "t1_dim_product": q(f"SELECT {PRODUCT_COLS}, {_UPDATED} FROM dim_product"),
    "t2_projection": source("riders", 'id AS rider_id, "vehicleType" AS vehicle_type, "courierId" AS courier_id'),
    "t3_category": source("products", f"id, category, {category('category')} AS normalized"),
    "t4_singular": source("products", f"id, {singular('lower(trim(category))')} AS singular"),
    "t5_dedup": source("orders", f'"userId", id, "deliveryDate", {_UPDATED}')
    + ' src QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY src."updatedAt" DESC, id DESC, "deliveryDate" DESC) = 1',
    "t6_timestamps": source("orders", f"id, CASE WHEN id % 7 <> 0 THEN {ts(chr(34) + 'updatedAt' + chr(34))} END AS updated"),
    "t7_dim_user": q(f"SELECT {USER_COLS}, {_UPDATED} FROM dim_user"),
    "t8_gender": source("users", f"id, {gender('gender')} AS gender"),
    "t3_white_space": source("products", f"id, {category('category')} AS normalized"),
    "t8_white_space": source("users", f"id, {gender('gender')} AS gender"),
    "t10_more_formats": source("orders", f"""id, CAST({day_of('"deliveryDate"')} AS VARCHAR) AS day"""),
    "t10_trailing_digits": source(
        "orders", f"""id, CASE WHEN NOT {_SLASHED} THEN CAST({day_of('"deliveryDate"')} AS VARCHAR) END AS day"""
    ),
    "t9_clean_text": source("users", f"id, CASE WHEN id % 5 = 4 THEN trim({_CITY}) END AS city"),
    "t10_delivery_date": source("orders", f"""id, "deliveryDate", CAST({day_of('"deliveryDate"')} AS VARCHAR) AS day"""),
    "t10_birth_date": source("users", f"""id, "dateOfBirth", CAST({day_of('"dateOfBirth"')} AS VARCHAR) AS day"""),
    "t11_date_of_birth": q("SELECT user_id, CAST(date_of_birth AS VARCHAR) AS date_of_birth FROM dim_user"),
    "t12_dim_rider": q(f"SELECT {RIDER_COLS}, {_UPDATED} FROM dim_rider"),
    "t13_latest": q(f"SELECT rider_id, {_UPDATED} FROM dim_rider"),
    "t14_dim_date": q(f"SELECT {DATE_COLS} FROM dim_date"),
    "t15_calendar": f"SELECT o_orderkey AS order_id, {calendar('CAST(o_orderdate AS DATE)')} FROM orders",
    "t16_days": q("SELECT CAST(day AS VARCHAR) AS day FROM days"),
    "t17_items_orders": q(
        f"SELECT order_id, product_id, user_id, rider_id, quantity, {ts('updated_at')} AS updated_at FROM items"
    ),
    "t18_price": q("SELECT order_id, product_id, CAST(unit_price AS DOUBLE) AS unit_price FROM items"),
    "t19_date_id": q("SELECT order_id, product_id, delivery_date_id FROM items"),
    "t20_measures": q(f"SELECT order_id, product_id, {FACT_VALUES} FROM items"),
    "t21_fact_id": q(
        f"SELECT row_number() OVER (ORDER BY {_FACT_ORDER}) AS fact_id, {FACT_KEYS}, {FACT_VALUES} FROM fact"
    ),
    "t22_fact_columns": q(f"SELECT {FACT_KEYS}, {FACT_VALUES}, {ts('updated_at')} AS updated_at FROM items"),
    "t23_defaults": q(f"SELECT order_id, rider_id, {FACT_VALUES} FROM fact"),
    "t24_fact": q(f"SELECT {FACT_KEYS}, {FACT_VALUES}, {ts('updated_at')} AS updated_at FROM fact"),
    "t25_quality": q(
        "SELECT count(*) AS total_rows, "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}"
            for c in ("product_id", "user_id", "rider_id", "delivery_date_id", "unit_price")
        )
        + " FROM items"
    ),
}

_MODE = "CASE WHEN n_changed = 0 THEN 'none' WHEN n_changed < n_all THEN 'incremental' ELSE 'full' END AS mode"


def mode(table: str, col: str, since: str) -> str:
    counts = f"SELECT count(*) FILTER (WHERE {col} > {since}) AS n_changed, count(*) AS n_all FROM {table}"
    return q(f"SELECT n_changed, n_all, {_MODE} FROM ({counts})")


_EARLY = f"""SELECT DISTINCT {day_of('"deliveryDate"')} AS day FROM {RAW['orders']} WHERE "updatedAt" <= {WM}"""
_DELIVERY_MONTH = "CAST(coalesce(delivery_date_id // 100, 0) AS INT)"


def _kept_sums(keys: str) -> str:
    """Sums of the facts after two loads."""
    return (
        f"SELECT {keys}, CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_price, "
        f"CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS items FROM ({_TWO_LOADS}) GROUP BY ALL"
    )


LOADS = {
    "ld1_changed_since": source("order_items", f'"OrderId", "ProductId", quantity, notes, {_DATES}')
    + f' src WHERE src."updatedAt" > {WM}',
    "ld2_load_mode": mode("dim_product", '"updatedAt"', WM),
    "ld2_load_mode_full": mode("dim_user", '"updatedAt"', "TIMESTAMP '1970-01-01'"),
    "ld2_load_mode_none": mode("fact", "updated_at", "TIMESTAMP '2002-01-01'"),
    "ld3_upsert": q(
        f"""SELECT product_id, name, category,
        CAST(current_price + CASE WHEN "updatedAt" > {WM} THEN 0 ELSE 1 END AS DOUBLE) AS current_price FROM dim_product"""
    ),
    "ld4_full_refresh": q(f"SELECT {USER_COLS} FROM dim_user"),
    "ld5_drop_control": q(f"SELECT {RIDER_COLS} FROM dim_rider"),
    "ld6_insert_new": q(
        f"""SELECT date_id, year, quarter, month, d.day, day_of_week,
        CASE WHEN e.early_id IS NULL THEN is_weekend ELSE NOT is_weekend END AS is_weekend
        FROM dim_date d LEFT JOIN early e ON d.date_id = e.early_id""",
        ("early", f"SELECT CAST(strftime(day, '%Y%m%d') AS INT) AS early_id FROM ({_EARLY}) WHERE day IS NOT NULL"),
    ),
    "ld7_replace_orders": q(
        f"""SELECT {FACT_KEYS}, quantity + CASE WHEN order_id IN (SELECT order_id FROM touched) THEN 0 ELSE 100 END
        AS quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_price AS DOUBLE) AS total_price FROM fact""",
        ("touched", _TOUCHED),
    ),
    "ld8_touched_orders": q(_TOUCHED),
    "ld9_bulk_write": TRANSFORMS["t24_fact"],
    "ld10_run_log": f"SELECT '1998-01-01 00:00:00' AS run_date UNION ALL {NEWEST}",
    "ld11_watermark": NEWEST,
    "ld11_watermark_first": f"SELECT '1970-01-01 00:00:00' AS run_date, count(\"updatedAt\") AS n_changed FROM {RAW['orders']}",
    "ld12_fact_orders": _TWO_LOADS,
    "ld12_fact_ids": q("SELECT count(*) AS facts, count(*) AS ids FROM fact"),
    "ld12_dim_product": q(f"SELECT {PRODUCT_COLS} FROM dim_product"),
    "ld12_dim_user": q(f"SELECT {USER_COLS} FROM dim_user"),
    "ld12_dim_rider": q(f"SELECT {RIDER_COLS} FROM dim_rider"),
    "ld12_dim_date": q(f"SELECT {DATE_COLS} FROM dim_date"),
    "ld12_removed_rows": q(f"SELECT {FACT_KEYS}, {FACT_VALUES} FROM fact"),
    "ld12_no_change_date": q(f"SELECT {FACT_KEYS}, {FACT_VALUES} FROM fact"),
    "ld12_lost_keys": q(
        f"SELECT {FACT_KEYS}, {FACT_VALUES} FROM fact WHERE order_id % 6 <> 0 AND (order_id % 10 <> 1 OR quantity % 2 <> 0)"
    ),
    "ld12_quality": TRANSFORMS["t25_quality"],
    "ld1_text_dates": q(f"SELECT {FACT_KEYS}, {FACT_VALUES} FROM fact WHERE order_id % 9 <> 0 OR order_id % 7 = 0"),
    "ld10_one_winner": q("SELECT 1 AS version, count(*) AS last_fact_id, 'refused' AS second FROM fact"),
    "ld9_compacted": TRANSFORMS["t21_fact_id"],
    "ld8_order_months": q(f"SELECT DISTINCT order_id, {_DELIVERY_MONTH} AS delivery_month FROM fact"),
    "ld12_sums_user": _kept_sums(f"{_DELIVERY_MONTH} AS delivery_month, user_id"),
    "ld12_sums_rider": _kept_sums(f"{_DELIVERY_MONTH} AS delivery_month, rider_id"),
    "ld12_sums_product": _kept_sums(f"{_DELIVERY_MONTH} AS delivery_month, delivery_date_id, product_id"),
    "ld7_change_rows": q(f"SELECT {FACT_KEYS}, {FACT_VALUES} FROM fact"),
    "ld3_change_rows": q(f"SELECT {USER_COLS} FROM dim_user"),
    "ld3_change_rows_riders": q(f"SELECT {RIDER_COLS} FROM dim_rider"),
    "ld6_change_rows": q(f"SELECT {DATE_COLS} FROM dim_date"),
}
SCANS["s8_warehouse_fact"] = _TWO_LOADS

_JOIN_DATE = "JOIN dim_date d ON f.delivery_date_id = d.date_id"
_JOIN_USER = "JOIN dim_user u ON f.user_id = u.user_id"
_JOIN_PRODUCT = "JOIN dim_product p ON f.product_id = p.product_id"
_JOIN_RIDER = "JOIN dim_rider r ON f.rider_id = r.rider_id"


def q1(start: int, end: int, period: str, where: str = "TRUE") -> str:
    return f"""SELECT {period} AS period, CAST(sum(total_price) AS DOUBLE) AS revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold FROM fact f {_JOIN_PRODUCT} {_JOIN_DATE}
    WHERE d.date_id BETWEEN {start} AND {end} AND {where} GROUP BY {period} ORDER BY period"""


_MONTH = "strftime(strptime(CAST(d.date_id AS VARCHAR), '%Y%m%d'), '%Y-%m')"
_DAY = "strftime(strptime(CAST(d.date_id AS VARCHAR), '%Y%m%d'), '%Y-%m-%d')"
_YEAR = "strftime(strptime(CAST(d.date_id AS VARCHAR), '%Y%m%d'), '%Y')"


def q2() -> str:
    return """SELECT country, city, count(DISTINCT user_id) AS total_customers,
    CAST(grouping(country, city) AS INT) AS gid FROM dim_user GROUP BY ROLLUP (country, city)"""


def q3(n: int, where: str = "TRUE") -> str:
    return f"""SELECT p.name AS product_name, p.category, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
    CAST(sum(total_price) AS DOUBLE) AS total_sales FROM fact f {_JOIN_PRODUCT} {_JOIN_USER} WHERE {where}
    GROUP BY p.name, p.category ORDER BY sum(total_price) DESC, p.name, p.category LIMIT {n}"""


def q4(where: str = "TRUE") -> str:
    frame = "OVER (PARTITION BY country ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    mean = half_up(f"sum({cents('total_sales')}) {frame}", f"count(*) {frame}")
    return f"""SELECT year, month, country, CAST(total_sales AS DOUBLE) AS total_sales, {mean} AS moving_avg_3_month
    FROM (SELECT d.year, d.month, u.country, sum(total_price) AS total_sales FROM fact f {_JOIN_DATE} {_JOIN_USER}
          WHERE {where} GROUP BY d.year, d.month, u.country)"""


def q5(where: str = "TRUE") -> str:
    return f"""SELECT country, rider_id, courier_name, total_deliveries,
    rank() OVER (ORDER BY total_deliveries DESC) AS delivery_rank
    FROM (SELECT u.country, r.rider_id, r.courier_name, count(*) AS total_deliveries FROM fact f {_JOIN_RIDER} {_JOIN_USER}
          WHERE {where} GROUP BY u.country, r.rider_id, r.courier_name)"""


def q6(where: str = "TRUE") -> str:
    return f"""SELECT d.year, d.month, r.vehicle_type, count(*) AS total_deliveries,
    CAST(grouping(d.year, d.month, r.vehicle_type) AS INT) AS gid FROM fact f {_JOIN_RIDER} {_JOIN_DATE} WHERE {where}
    GROUP BY ROLLUP (d.year, d.month, r.vehicle_type)"""


def q7(year: int, quarter: int, percentile: int, country: str = "ASIA") -> str:
    last_year, last_quarter = (year, quarter - 1) if quarter > 1 else (year - 1, 4)
    by_rider = "OVER (PARTITION BY country, rider_id ORDER BY year, quarter)"
    in_quarter = "PARTITION BY country, year, quarter"
    growth = half_up("(cur - prev) * 10000", "NULLIF(prev, 0)")
    # percent_rank = (rank - 1) / (n - 1), and 0 where there is one row only.
    pct = half_up("CAST(pos - 1 AS HUGEINT) * 10000", "greatest(n - 1, 1)")
    return f"""SELECT country, period, rider_id, total_sales, prev_quarter_sales, sales_growth_pct, customers_served,
    sales_percentile FROM (
      SELECT country, concat(year, '-Q', quarter) AS period, year, quarter, rider_id, CAST(sales AS DOUBLE) AS total_sales,
      CAST(prev / 100.0 AS DOUBLE) AS prev_quarter_sales, {growth} AS sales_growth_pct, customers_served,
      {pct} AS sales_percentile
      FROM (SELECT *, {cents('sales')} AS cur, lag({cents('sales')}) {by_rider} AS prev,
            rank() OVER ({in_quarter} ORDER BY sales DESC) AS pos, count(*) OVER ({in_quarter}) AS n
            FROM (SELECT u.country, f.rider_id, d.year, d.quarter, sum(total_price) AS sales,
                  count(DISTINCT f.user_id) AS customers_served FROM fact f {_JOIN_DATE} {_JOIN_USER}
                  WHERE u.country = '{country}' AND ((d.year = {year} AND d.quarter = {quarter})
                        OR (d.year = {last_year} AND d.quarter = {last_quarter}))
                  GROUP BY u.country, f.rider_id, d.year, d.quarter)))
    WHERE year = {year} AND quarter = {quarter} AND sales_percentile <= {percentile}"""


def revenue(year: int, where: str = "TRUE", having: str = "TRUE") -> str:
    """The revenue rollup with its grouping id; ``having`` filters result rows by their keys."""
    joins = f"{_JOIN_RIDER} {_JOIN_USER} {_JOIN_DATE} {_JOIN_PRODUCT}"
    keys = ("country", "city", "category")
    labels = {"country": "Grand Total", "city": "All Cities", "category": "All Categories"}
    named = ", ".join(f"CASE WHEN grouping({k}) = 1 THEN '{labels[k]}' ELSE {k} END AS {k}" for k in keys)
    return f"""SELECT {named}, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
    count(DISTINCT rider_id) AS unique_riders, CAST(sum(total_price) AS DOUBLE) / count(*) AS average_order_value,
    CAST(grouping(country, city, category) AS INT) AS gid
    FROM (SELECT u.country, u.city, p.category, r.rider_id, total_price FROM fact f {joins}
          WHERE d.year = {year} AND {where}) b
    GROUP BY ROLLUP (country, city, category) HAVING {having}"""


def having(**values: str) -> str:
    """Result rows whose keys have these values: a key that is totalled is NULL and never matches."""
    return " AND ".join(f"(grouping(b.{k}) = 0 AND b.{k} = '{v}')" for k, v in values.items())


def q8(year: int, where: str = "TRUE") -> str:
    return f"SELECT country, city, category, total_revenue, unique_riders FROM ({revenue(year, having=where)})"


def q9(year: int, where: str = "TRUE") -> str:
    return f"""SELECT country, city, category, total_revenue, unique_riders, average_order_value
    FROM ({revenue(year, where)})"""


_CITY_1998 = {"country": "ASIA", "city": "NATION_2"}
_CITY_WHERE = "country = 'ASIA' AND city = 'NATION_2'"
_LISTED_Q2 = "SELECT country, city, total_customers"
_LISTED_Q6 = "SELECT year, month, vehicle_type, total_deliveries"
ANALYTICS = {
    "q1": q(q1(19980101, 19981231, _MONTH)),
    "q1_day_category": q(q1(19980101, 19981231, _DAY, "p.category = 'ring'")),
    "q1_year": q(q1(19950101, 20011231, _YEAR)),
    "q1_unknown_granularity": q(q1(19950101, 20011231, "CAST(NULL AS VARCHAR)")),
    "q2": q(f"{_LISTED_Q2} FROM ({q2()})"),
    "q3": q(q3(10)),
    "q3_country": q(q3(5, "u.country = 'ASIA'")),
    "q3_city_category": q(q3(5, "u.country = 'ASIA' AND u.city = 'NATION_2' AND p.category = 'ring'")),
    "q4": q(q4()),
    "q4_country": q(q4("u.country = 'ASIA'")),
    "q5": q(q5()),
    "q5_country": q(q5("u.country = 'ASIA'")),
    "q6": q(f"{_LISTED_Q6} FROM ({q6()})"),
    "q6_year": q(f"{_LISTED_Q6} FROM ({q6('d.year = 1998')})"),
    "q6_year_month": q(f"{_LISTED_Q6} FROM ({q6('d.year = 1998 AND d.month = 10')})"),
    "q6_month": q(f"{_LISTED_Q6} FROM ({q6('d.month = 10')})"),
    "q7": q(q7(1998, 2, 10)),
    "q7_first_quarter": q(q7(1998, 1, 25)),
    "q7_no_previous": q(q7(1995, 1, 50)),
    "q7_all_riders": q(q7(1998, 2, 100)),
    "q8": q(q8(1998)),
    "q8_country": q(q8(1998, having(country="ASIA"))),
    "q8_city": q(q8(1998, having(**_CITY_1998))),
    "q8_city_category": q(q8(1998, having(**_CITY_1998, category="ring"))),
    "q8_category": q(q8(1998, having(category="ring"))),
    "q8_no_data": q(q8(2030)),
    "q9": q(q9(1998)),
    "q9_country": q(q9(1998, "country = 'ASIA'")),
    "q9_city": q(q9(1998, _CITY_WHERE)),
    "q9_city_category": q(q9(1998, f"{_CITY_WHERE} AND category = 'ring'")),
    "q9_category": q(q9(1998, "category = 'ring'")),
    "q9_no_data": q(q9(2030)),
}



def stored(body: str) -> str:
    """The same query on the warehouse stored by two loads."""
    return q(body.replace("FROM fact f", "FROM loaded f"), *_LOADED)


SCANS |= {
    "s8_warehouse_q1": stored(q1(19980101, 19981231, _MONTH)),
    "s8_warehouse_q2": ANALYTICS["q2"],
    "s8_warehouse_q3": stored(q3(5, "u.country = 'ASIA'")),
    "s8_warehouse_q4": stored(q4()),
    "s8_warehouse_q5": stored(q5()),
    "s8_warehouse_q6": stored(f"{_LISTED_Q6} FROM ({q6('d.month = 10')})"),
    "s8_warehouse_q7": stored(q7(1998, 1, 25)),
    "s8_warehouse_q8": stored(q8(1998, having(**_CITY_1998))),
    "s8_warehouse_q9": stored(q9(1998)),
}

_ASIA = ("drill", revenue(1998, having=having(country="ASIA")))
_ASIA_FILTERED = ("drill", revenue(1998, "country = 'ASIA'"))
_IN_CITY = ("drill", revenue(1998, having=having(**_CITY_1998)))
_ALL_1998 = ("drill", revenue(1998))
_VEHICLES = ("v", f"SELECT * FROM ({q6()}) WHERE gid = 0")
_DRILL_COLS = "country, city, category, total_revenue, unique_riders, average_order_value"
_ROLLUP_COLS = "country, city, category, total_revenue, unique_riders"
_RANKED = "SELECT city, row_number() OVER (ORDER BY {} DESC, city) AS city_rank FROM drill WHERE gid = {} AND country = 'ASIA'"


def countries(where: str = "TRUE", label: str = "All Categories") -> str:
    return f"""SELECT u.country, '{label}' AS category, CAST(sum(total_price) AS DOUBLE) AS total_revenue,
    count(DISTINCT f.rider_id) AS unique_riders, CAST(sum(total_price) AS DOUBLE) / count(*) AS average_order_value
    FROM fact f {_JOIN_RIDER} {_JOIN_USER} {_JOIN_DATE} {_JOIN_PRODUCT} WHERE d.year = 1998 AND {where} GROUP BY u.country"""


def extremes(rows: str, label: str, within: tuple[str, ...] = ()) -> str:
    ties = ", ".join([label, *within])
    pick = "(SELECT {0} FROM x ORDER BY total_revenue {1}, " + ties + " LIMIT 1)"
    more = "".join(f", {pick.format(c, 'DESC')} AS highest_{c}, {pick.format(c, 'ASC')} AS lowest_{c}" for c in within)
    return (
        f"SELECT {pick.format(label, 'DESC')} AS highest, {pick.format('total_revenue', 'DESC')} AS highest_value, "
        f"{pick.format(label, 'ASC')} AS lowest, {pick.format('total_revenue', 'ASC')} AS lowest_value{more}"
    )


_TEXT = "format('{:,.2f}', total_revenue) AS total_revenue, CAST(unique_riders AS VARCHAR) AS unique_riders"
_MATRIX = ", ".join(f"coalesce(max(total_revenue) FILTER (WHERE category = '{c}'), 0) AS {c}" for c in CATEGORIES)
_TOP_3 = ("best", f"SELECT * FROM ({_RANKED.format('total_revenue', 1)}) WHERE city_rank <= 3")

REPORTS = {
    "r1_customers_by_country": q(f"SELECT country, total_customers FROM ({q2()}) WHERE gid = 1 AND country IS NOT NULL"),
    "r2_customers_listing": q(
        f"""SELECT country, CASE WHEN gid = 1 THEN 'Total' ELSE city END AS city, total_customers
        FROM ({q2()}) WHERE gid < 3"""
    ),
    "r3_iso_codes": q(
        f"""SELECT country, total_customers, CASE WHEN country <> 'EUROPE' THEN upper(left(country, 3)) END AS iso_alpha
        FROM ({q2()}) WHERE gid = 1"""
    ),
    "r4_city_detail": q(f"SELECT city, total_customers FROM ({q2()}) WHERE gid = 0 AND country = 'ASIA'"),
    "r5_top_products_view": q(q3(10)),
    "r6_sales_series": q(
        """SELECT CAST(make_date(year, month, 1) AS VARCHAR) AS date, country, 'total_sales' AS measure,
        total_sales AS value FROM m UNION ALL
        SELECT CAST(make_date(year, month, 1) AS VARCHAR), country, 'moving_avg_3_month', moving_avg_3_month FROM m""",
        ("m", q4()),
    ),
    "r7_rider_leaderboard": q(f"SELECT * FROM ({q5()}) ORDER BY delivery_rank, country, rider_id LIMIT 20"),
    "r8_vehicle_series": q(
        "SELECT year, month, vehicle_type, printf('%d-%02d', year, month) AS period, total_deliveries FROM v", _VEHICLES
    ),
    "r9_vehicle_share": q(
        f"""SELECT vehicle_type, CAST(n AS BIGINT) AS total_deliveries, {half_up('CAST(n AS HUGEINT) * 10000', 't')} AS percent,
        CAST(t AS BIGINT) AS grand_total
        FROM (SELECT vehicle_type, sum(total_deliveries) AS n, sum(sum(total_deliveries)) OVER () AS t
              FROM v GROUP BY vehicle_type)""",
        _VEHICLES,
    ),
    "r10_country_options": q(
        "SELECT DISTINCT country FROM drill WHERE gid = 3 UNION SELECT 'Philippines' AS country", _ALL_1998
    ),
    "r11_rider_kpis": q(
        """SELECT (SELECT rider_id FROM k ORDER BY total_sales DESC, rider_id LIMIT 1) AS top_rider,
        (SELECT max(total_sales) FROM k) AS top_sales,
        (SELECT rider_id FROM k WHERE sales_growth_pct IS NOT NULL ORDER BY sales_growth_pct DESC, total_sales DESC,
         rider_id LIMIT 1) AS best_growth_rider, (SELECT max(sales_growth_pct) FROM k) AS best_growth_pct""",
        ("k", q7(1998, 2, 50)),
    ),
    "r12_rider_table": q(q7(1998, 2, 50)),
    "r13_revenue_series": q(q1(19980101, 19981231, _MONTH)),
    "r14_drilldown_total": q(f"SELECT {_ROLLUP_COLS}, gid FROM drill", _ASIA),
    "r14_drilldown_average": q(f"SELECT {_DRILL_COLS}, gid FROM drill", _ASIA_FILTERED),
    "r15_fallback": q(f"SELECT {_ROLLUP_COLS}, gid FROM drill", _ASIA),
    "r16_options": q(
        """SELECT DISTINCT 'country' AS kind, country AS value FROM drill WHERE gid = 0 UNION ALL
        SELECT DISTINCT 'category', category FROM drill WHERE gid = 0""",
        _ALL_1998,
    ),
    "r16_options_city": q(
        """SELECT 'country' AS kind, 'ASIA' AS value UNION ALL
        SELECT DISTINCT 'city', city FROM drill WHERE gid = 1 UNION ALL
        SELECT DISTINCT 'category', category FROM drill WHERE gid = 0 AND city = 'NATION_2'""",
        _ASIA,
    ),
    "r17_countries": q(countries()),
    "r17_countries_category": q(
        f"SELECT * FROM ({countries(chr(39).join(['p.category = ', 'ring', '']), 'ring')}) ORDER BY average_order_value DESC, country LIMIT 3"
    ),
    "r18_cities": q(
        f"SELECT city, city_rank, {_ROLLUP_COLS.replace(' city,', '')} FROM drill JOIN best USING (city) WHERE gid = 0",
        _ASIA,
        _TOP_3,
    ),
    "r18_cities_average": q(
        f"SELECT city, city_rank, {_DRILL_COLS.replace(' city,', '')} FROM drill JOIN best USING (city) WHERE gid = 0",
        ("drill", revenue(1998, "country = 'ASIA' AND category = 'ring'")),
        ("best", f"SELECT * FROM ({_RANKED.format('average_order_value', 0)}) WHERE city_rank <= 3"),
    ),
    "r19_categories": q(
        f"SELECT {_ROLLUP_COLS} FROM drill WHERE gid = 0 ORDER BY total_revenue DESC, category LIMIT 10", _IN_CITY
    ),
    "r20_matrix": q(
        f"SELECT city_rank, city, {_MATRIX} FROM drill JOIN best USING (city) WHERE gid = 0 GROUP BY city_rank, city",
        _ASIA,
        _TOP_3,
    ),
    "r21_country_extremes": q(extremes("x", "country"), ("x", countries())),
    "r21_city_extremes": q(extremes("x", "city"), _ASIA, ("x", "SELECT * FROM drill WHERE gid = 1")),
    "r21_city_category_extremes": q(
        extremes("x", "category", ("city",)), _ASIA, ("x", "SELECT * FROM drill WHERE gid = 0 AND country = 'ASIA' AND city IS NOT NULL")
    ),
    "r21_category_extremes": q(extremes("x", "category"), _IN_CITY, ("x", "SELECT * FROM drill WHERE gid = 0")),
    "r22_table": q(f"SELECT city, category, {_TEXT} FROM drill WHERE gid = 0", _ASIA),
    "r22_country_table": q(f"SELECT country, category, {_TEXT} FROM ({countries()})"),
}

_SALES = "CAST(sum(total_price) AS DOUBLE) AS sales"
_CITY_SALES = ("s", f"SELECT u.country, u.city, sum(total_price) AS sales FROM fact f {_JOIN_USER} GROUP BY u.country, u.city")
_MONTH_SALES = ("s", f"SELECT d.year, d.month, sum(total_price) AS sales FROM fact f {_JOIN_DATE} GROUP BY d.year, d.month")
_QUARTERS = (
    "s",
    f"""SELECT *, lag(sales) OVER (PARTITION BY rider_id ORDER BY year, quarter) AS prev FROM (
    SELECT f.rider_id, d.year, d.quarter, sum(total_price) AS sales FROM fact f {_JOIN_DATE} GROUP BY ALL)""",
)
_USERS_1998 = f'(SELECT "userId" FROM {RAW["orders"]} WHERE "updatedAt" >= {WM})'
_NUMBER = """try_cast(substr("deliveryDate", 1, 4) AS DOUBLE)"""

BLOCKS = {
    "p1_optional_filter": q("SELECT user_id, country FROM dim_user WHERE country = 'ASIA'"),
    "p2_date_range": q("SELECT order_id, delivery_date_id FROM fact WHERE delivery_date_id BETWEEN 19980101 AND 19980331"),
    "p3_two_quarters": q(
        "SELECT date_id, year, quarter FROM dim_date WHERE (year = 1998 AND quarter = 1) OR (year = 1997 AND quarter = 4)"
    ),
    "p4_equality": q(f"SELECT order_id, delivery_date_id FROM fact f {_JOIN_DATE} WHERE d.year = 1998 AND d.month = 10"),
    "p5_having": q(
        f"SELECT country, city, {_SALES} FROM fact f {_JOIN_USER} GROUP BY country, city HAVING country = 'ASIA'"
    ),
    "p6_window_filter": q(
        """SELECT rider_id, deliveries, rank FROM (SELECT *, rank() OVER (ORDER BY deliveries DESC) AS rank
        FROM (SELECT rider_id, count(*) AS deliveries FROM fact GROUP BY rider_id)) WHERE rank <= 10"""
    ),
    "p7_relabel": q(
        f"""SELECT CASE WHEN grouping(u.country) = 1 THEN 'Grand Total' ELSE u.country END AS country,
        CASE WHEN grouping(u.city) = 1 THEN 'All Cities' ELSE u.city END AS city, {_SALES},
        CAST(grouping(u.country, u.city) AS INT) AS gid FROM fact f {_JOIN_USER} GROUP BY ROLLUP (u.country, u.city)"""
    ),
    "j1_fact_product": q(f"SELECT order_id, f.product_id, p.name, p.category FROM fact f {_JOIN_PRODUCT}"),
    "j2_fact_date": q(f"SELECT order_id, delivery_date_id, d.year, d.month, d.day FROM fact f {_JOIN_DATE}"),
    "j3_fact_user": q(f"SELECT order_id, f.user_id, u.country, u.city FROM fact f {_JOIN_USER}"),
    "j4_fact_rider": q(f"SELECT order_id, f.rider_id, r.vehicle_type, r.courier_name FROM fact f {_JOIN_RIDER}"),
    "j5_left_join": q(f"SELECT order_id, f.rider_id, r.courier_name FROM fact f LEFT {_JOIN_RIDER}"),
    "j3_key_filter": q(f"SELECT order_id, f.user_id FROM fact f {_JOIN_USER} WHERE u.country = 'ASIA'"),
    "j6_anti_join": q(f"SELECT user_id FROM dim_user WHERE user_id NOT IN {_USERS_1998}"),
    "j7_semi_join": q(f"SELECT user_id FROM dim_user WHERE user_id IN {_USERS_1998}"),
    "g1_sum": q(f"SELECT product_id, {_SALES}, CAST(sum(quantity) AS BIGINT) AS units FROM fact GROUP BY product_id"),
    "g2_count": q(f"SELECT r.vehicle_type, count(*) AS deliveries FROM fact f {_JOIN_RIDER} GROUP BY r.vehicle_type"),
    "g3_count_distinct": q(
        f"SELECT u.country, count(DISTINCT f.rider_id) AS riders FROM fact f {_JOIN_USER} GROUP BY u.country"
    ),
    "g4_average": q(
        f"SELECT u.city, {half_up(cents('sum(total_price)'), 'count(*)')} AS average FROM fact f {_JOIN_USER} GROUP BY u.city"
    ),
    "g5_group_by": q(
        f"SELECT u.country, p.category, {_SALES} FROM fact f {_JOIN_USER} {_JOIN_PRODUCT} GROUP BY u.country, p.category"
    ),
    "g6_rollup_two": q(
        f"""SELECT u.country, u.city, {_SALES}, CAST(grouping(u.country, u.city) AS INT) AS gid
        FROM fact f {_JOIN_USER} GROUP BY ROLLUP (u.country, u.city)"""
    ),
    "g6_rollup_three": q(
        f"""SELECT u.country, u.city, p.category, {_SALES}, CAST(grouping(u.country, u.city, p.category) AS INT) AS gid
        FROM fact f {_JOIN_USER} {_JOIN_PRODUCT} GROUP BY ROLLUP (u.country, u.city, p.category)"""
    ),
    "g6_rollup_distinct": q(
        f"""SELECT u.country, u.city, {_SALES}, count(DISTINCT f.rider_id) AS riders,
        CAST(grouping(u.country, u.city) AS INT) AS gid FROM fact f {_JOIN_USER} GROUP BY ROLLUP (u.country, u.city)"""
    ),
    "g7_period_group": q(f"SELECT {_MONTH} AS period, {_SALES} FROM fact f {_JOIN_DATE} GROUP BY 1"),
    "g8_extremes": q(
        """SELECT (SELECT city FROM s ORDER BY sales DESC, city LIMIT 1) AS highest,
        CAST((SELECT max(sales) FROM s) AS DOUBLE) AS highest_value,
        (SELECT city FROM s ORDER BY sales, city LIMIT 1) AS lowest,
        CAST((SELECT min(sales) FROM s) AS DOUBLE) AS lowest_value""",
        _CITY_SALES,
    ),
    "g9_share": q(
        f"""SELECT courier_name, n AS deliveries, {half_up('CAST(n AS HUGEINT) * 10000', 't')} AS percent,
        CAST(t AS BIGINT) AS grand_total FROM (SELECT r.courier_name, count(*) AS n, sum(count(*)) OVER () AS t
        FROM fact f {_JOIN_RIDER} GROUP BY r.courier_name)"""
    ),
    "g10_distinct": q("SELECT DISTINCT category FROM dim_product"),
    "w1_moving_average": q(
        """SELECT year, month, CAST(sum(sales) OVER (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
        AS DOUBLE) AS last_three FROM s""",
        _MONTH_SALES,
    ),
    "w2_rank": q("SELECT product_id, rank() OVER (ORDER BY current_price DESC) AS rank FROM dim_product"),
    "w3_lag": q(
        "SELECT rider_id, year, quarter, CAST(sales AS DOUBLE) AS sales, CAST(prev AS DOUBLE) AS prev_sales FROM s", _QUARTERS
    ),
    "w4_growth": q(
        f"""SELECT rider_id, year, quarter, {half_up(f'(({cents("sales")} - {cents("prev")}) * 10000)',
        f'NULLIF({cents("prev")}, 0)')} AS growth FROM s""",
        _QUARTERS,
    ),
    "w5_percent_rank": q(
        f"""SELECT product_id, {half_up('CAST(pos - 1 AS HUGEINT) * 10000', 'greatest(n - 1, 1)')} AS percentile
        FROM (SELECT product_id, rank() OVER (ORDER BY current_price DESC) AS pos, count(*) OVER () AS n FROM dim_product)"""
    ),
    "w6_row_number": q(
        "SELECT country, city, row_number() OVER (PARTITION BY country ORDER BY sales DESC, city) AS pos FROM s", _CITY_SALES
    ),
    "o1_sort": q("SELECT user_id, gender FROM dim_user ORDER BY gender NULLS LAST, user_id"),
    "o2_top_n": q(f"SELECT product_id, {_SALES} FROM fact GROUP BY 1 ORDER BY sum(total_price) DESC, product_id LIMIT 25"),
    "o3_latest": f"SELECT {ts('max(o_orderdate)')} AS latest FROM orders",
    "o4_head": q(f"SELECT user_id, {_SALES} FROM fact GROUP BY 1 ORDER BY sum(total_price) DESC, user_id LIMIT 20"),
    "f1_period_text": q(
        f"SELECT d.date_id, {_YEAR} AS per_year, {_MONTH} AS per_month, {_DAY} AS per_day FROM dim_date d"
    ),
    "f2_case": q("SELECT date_id, CASE WHEN is_weekend THEN 'weekend' ELSE 'week' END AS kind FROM dim_date"),
    "f3_null_handling": q("SELECT user_id, coalesce(gender, '?') AS known, NULLIF(gender, 'M') AS not_m FROM dim_user"),
    "f4_round": q(f"SELECT product_id, {half_up(cents('current_price'), '3')} AS third FROM dim_product"),
    "f5_quarter_label": q("SELECT date_id, concat(year, '-Q', quarter) AS label FROM dim_date"),
    "f6_cast": "SELECT o_orderkey AS id, o_orderkey AS number FROM orders",
    "f7_text": source(
        "products",
        "id, upper(trim(category)) AS upper, regexp_matches(name, '^s.*g$') AS matches, name LIKE '%ring' AS ring, "
        "left(name, 3) AS start",
    ),
    "f8_date_parts": q("SELECT date_id, year, quarter, month, day FROM dim_date"),
    "f9_date_text_to_id": q("SELECT date_id FROM dim_date WHERE date_id >= 20000101"),
    "f10_prev_quarter": q("SELECT date_id FROM dim_date WHERE year = 1998 AND quarter = 4"),
    "f11_period_label": q(
        """SELECT printf('%d-%02d', year, month) AS period, CAST(sales AS DOUBLE) AS sales FROM s UNION ALL
        SELECT CAST(year AS VARCHAR), CAST(sum(sales) AS DOUBLE) FROM s GROUP BY year""",
        _MONTH_SALES,
    ),
    "f12_month_start": q(
        "SELECT CAST(make_date(year, month, 1) AS VARCHAR) AS start, CAST(sales AS DOUBLE) AS sales FROM s", _MONTH_SALES
    ),
    "f13_to_number": source("orders", f"id, {_NUMBER} AS number, coalesce({_NUMBER}, 0) AS number_or_0"),
    "f14_money_text": q(
        "SELECT product_id, format('{:,.2f}', CAST(sum(total_price) AS DOUBLE)) AS amount FROM fact GROUP BY product_id"
    ),
}

ALL = {**SCANS, **TRANSFORMS, **LOADS, **ANALYTICS, **REPORTS, **BLOCKS}
