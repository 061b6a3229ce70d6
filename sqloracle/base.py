"""Shared DuckDB CTEs: the driver-table adapters, features and the star schema.

Written independently of the Spark code, in plain SQL, from the same definitions.
"""

from __future__ import annotations

# revenue / quantity rounded half-up to 4 places, in integer arithmetic (exact)
_PRICE = ("CAST(CAST((CAST(round(l.l_extendedprice * 100) AS BIGINT) * 200 + CAST(l.l_quantity AS BIGINT))"
          " // (2 * CAST(l.l_quantity AS BIGINT)) AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(10,4))")

_LINES = """
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey"""

SALES = f"""
sales AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS Invoice,
         lpad(CAST(l.l_partkey AS VARCHAR), 5, '0') AS StockCode,
         p.p_name AS Description,
         CAST(l.l_quantity AS INTEGER) AS Quantity,
         o.o_orderdate AS InvoiceDate,
         {_PRICE} AS Price,
         o.o_custkey AS CustomerID,
         n.n_name AS Country
  {_LINES}
)"""

_DIRTY_ROWS = f"""
  SELECT
    CASE WHEN l.l_linenumber = 2 THEN inv || ' ' ELSE inv END AS Invoice,
    CASE WHEN l.l_partkey % 50 = 0 THEN 'POST'
         WHEN l.l_partkey % 61 = 0 THEN CAST(l.l_partkey % 1000 AS VARCHAR)
         WHEN l.l_partkey % 7 = 0 THEN chr(9) || lpad(CAST(l.l_partkey AS VARCHAR), 5, '0') || 'b '
         ELSE lpad(CAST(l.l_partkey AS VARCHAR), 5, '0') END AS StockCode,
    CASE WHEN l.l_linenumber = 7 THEN NULL
         WHEN l.l_linenumber = 4 AND l.l_partkey % 11 = 0 THEN 'nan'
         WHEN l.l_linenumber = 3 THEN '  ' || upper(p.p_name) || ' '
         WHEN l.l_linenumber = 5 THEN p.p_brand
         ELSE p.p_name END AS Description,
    CASE WHEN l.l_linenumber = 6 AND l.l_returnflag = 'A' THEN -CAST(l.l_quantity AS INTEGER)
         ELSE CAST(l.l_quantity AS INTEGER) END AS Quantity,
    o.o_orderdate + to_hours(CAST(l.l_orderkey % 12 + 8 AS BIGINT)) AS InvoiceDate,
    CASE WHEN l.l_linenumber = 5 AND l.l_returnflag = 'N' AND l.l_partkey % 3 = 0 THEN CAST(0 AS DECIMAL(10,4))
         ELSE {_PRICE} END AS Price,
    CASE WHEN o.o_custkey % 5 = 0 THEN NULL ELSE o.o_custkey END AS CustomerID,
    CASE WHEN l.l_linenumber = 2 THEN n.n_name || ' ' ELSE n.n_name END AS Country,
    l.l_linenumber AS ln
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'C' || CAST(l_orderkey AS VARCHAR)
                       ELSE CAST(l_orderkey AS VARCHAR) END AS inv FROM lineitem) l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey"""

DIRTY = f"""
dirty_rows AS ({_DIRTY_ROWS}
),
dirty_sales AS (
  SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country FROM dirty_rows
  UNION ALL
  SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country FROM dirty_rows WHERE ln = 1
)"""

EVENT_SALES = """
event_sales AS (
  SELECT CAST(event_id AS VARCHAR) AS Invoice, upper(event_type) AS StockCode,
         upper(event_type[1]) || lower(event_type[2:]) AS Description,
         1 AS Quantity, ts AS InvoiceDate, CAST(value AS DECIMAL(10,4)) AS Price,
         user_id AS CustomerID, coalesce(n.n_name, 'Unspecified') AS Country
  FROM events e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def title(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '(\\p{{L}}+|\\P{{L}}+)', 1),"
            f" lambda x: upper(x[1]) || lower(x[2:])), '')")


NORMALIZED = f"""
normalized AS (
  SELECT {strip('Invoice')} AS Invoice,
         upper({strip('StockCode')}) AS StockCode,
         CASE WHEN Description IS NULL OR {title(strip('Description'))} IN ('', 'Nan') THEN NULL
              ELSE {title(strip('Description'))} END AS Description,
         Quantity, InvoiceDate, Price, CustomerID,
         {strip('Country')} AS Country
  FROM dirty_sales
)"""

# cleaning chain on the dirty lines (dedupe, cancellations, invalid, fill, noise)
CLEAN_CHAIN = NORMALIZED + """,
deduped AS (SELECT DISTINCT * FROM normalized),
valid AS (SELECT * FROM deduped WHERE NOT starts_with(Invoice, 'C') AND Quantity > 0 AND Price > 0),
desc_counts AS (SELECT StockCode, Description, count(*) AS c FROM valid WHERE Description IS NOT NULL GROUP BY 1, 2),
desc_mode AS (
  SELECT StockCode, Description AS mode_desc FROM (
    SELECT *, row_number() OVER (PARTITION BY StockCode ORDER BY c DESC, Description) AS rn FROM desc_counts)
  WHERE rn = 1),
filled AS (
  SELECT v.Invoice, v.StockCode, coalesce(v.Description, m.mode_desc, 'Unknown') AS Description,
         v.Quantity, v.InvoiceDate, v.Price, v.CustomerID, v.Country
  FROM valid v LEFT JOIN desc_mode m USING (StockCode)),
cleaned_lines AS (
  SELECT * FROM filled
  WHERE StockCode NOT IN ('POST', 'D', 'DOT', 'M', 'BANK CHARGES', 'PADS', 'AMAZONFEE', 'C2', 'CRUK')
    AND length(StockCode) >= 4)"""


def features(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country,
         starts_with(Invoice, 'C') AS IsCancelled,
         CustomerID IS NOT NULL AS HasCustomerID,
         CAST(round(Quantity * Price, 2) AS DECIMAL(12,2)) AS TotalRevenue,
         CAST(year(InvoiceDate) AS INTEGER) AS Year,
         CAST(month(InvoiceDate) AS INTEGER) AS Month,
         strftime(InvoiceDate, '%Y-%m') AS YearMonth,
         CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS DayOfWeek,
         dayname(InvoiceDate) AS DayOfWeekName,
         CAST(hour(InvoiceDate) AS INTEGER) AS Hour,
         CAST(quarter(InvoiceDate) AS INTEGER) AS Quarter,
         CAST(weekofyear(InvoiceDate) AS INTEGER) AS WeekOfYear
  FROM {src}
)"""


def warehouse(src: str, regions: bool = True) -> str:
    """Star schema CTEs from cleaned lines ``src``: dim_date, dim_product, dim_country, fact, fd."""
    region_join = ("LEFT JOIN (SELECT n_name AS country_name, r_name AS region FROM nation "
                   "JOIN region ON n_regionkey = r_regionkey) r USING (country_name)") if regions else \
        "LEFT JOIN (SELECT NULL::VARCHAR AS country_name, NULL::VARCHAR AS region) r USING (country_name)"
    return f"""
dim_date AS (
  SELECT DISTINCT
    CAST(strftime(InvoiceDate, '%Y%m%d%H') AS INTEGER) AS date_key,
    CAST(InvoiceDate AS DATE) AS full_date,
    CAST(year(InvoiceDate) AS INTEGER) AS year,
    CAST(quarter(InvoiceDate) AS INTEGER) AS quarter,
    CAST(month(InvoiceDate) AS INTEGER) AS month,
    monthname(InvoiceDate) AS month_name,
    CAST(weekofyear(InvoiceDate) AS INTEGER) AS week_of_year,
    CAST(day(InvoiceDate) AS INTEGER) AS day_of_month,
    CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS day_of_week,
    dayname(InvoiceDate) AS day_name,
    CAST(hour(InvoiceDate) AS INTEGER) AS hour,
    strftime(InvoiceDate, '%Y-%m') AS year_month,
    isodow(InvoiceDate) IN (6, 7) AS is_weekend
  FROM {src}
),
prod_counts AS (SELECT StockCode, Description, count(*) AS c FROM {src} WHERE Description IS NOT NULL GROUP BY 1, 2),
prod_mode AS (
  SELECT StockCode, Description FROM (
    SELECT *, row_number() OVER (PARTITION BY StockCode ORDER BY c DESC, Description) AS rn FROM prod_counts)
  WHERE rn = 1),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY s.StockCode) AS BIGINT) AS product_key,
         s.StockCode AS stock_code, coalesce(m.Description, 'Unknown') AS description
  FROM (SELECT DISTINCT StockCode FROM {src}) s LEFT JOIN prod_mode m USING (StockCode)
),
dim_customer AS (
  SELECT DISTINCT CAST(CustomerID AS BIGINT) AS customer_key, CAST(CustomerID AS BIGINT) AS customer_id,
         TRUE AS has_account
  FROM {src} WHERE CustomerID IS NOT NULL
  UNION ALL SELECT -1, -1, FALSE
),
dim_country AS (
  SELECT CAST(row_number() OVER (ORDER BY c.country_name) AS BIGINT) AS country_key, c.country_name,
         coalesce(r.region, 'Other') AS region
  FROM (SELECT DISTINCT Country AS country_name FROM {src}) c {region_join}
),
fact AS (
  SELECT s.Invoice AS invoice_no,
         CAST(strftime(s.InvoiceDate, '%Y%m%d%H') AS INTEGER) AS date_key,
         p.product_key,
         CAST(coalesce(s.CustomerID, -1) AS BIGINT) AS customer_key,
         c.country_key,
         s.Quantity AS quantity, s.Price AS unit_price, s.TotalRevenue AS total_revenue
  FROM {src} s
  JOIN dim_product p ON p.stock_code = s.StockCode
  JOIN dim_country c ON c.country_name = s.Country
),
fd AS (SELECT * FROM fact JOIN dim_date USING (date_key))"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


# Standard prefixes
SALES_WH = with_ctes(SALES, features("sales", "cleaned"), warehouse("cleaned"))
EVENTS_WH = with_ctes(EVENT_SALES, features("event_sales", "cleaned"), warehouse("cleaned"))
SALES_CLEANED = with_ctes(SALES, features("sales", "cleaned"))
EVENTS_CLEANED = with_ctes(EVENT_SALES, features("event_sales", "cleaned"))
DIRTY_CLEANED = with_ctes(DIRTY, CLEAN_CHAIN, features("cleaned_lines", "cleaned"))


def round_avg_cents(col: str, scale: int) -> str:
    """ROUND(AVG(col), 2) exactly (half away from zero) for a non-negative DECIMAL of ``scale``."""
    unit = 10 ** scale
    step = 10 ** (scale - 2)
    return (f"((2 * CAST(sum({col} * {unit}) AS HUGEINT) + {step} * count({col})) // (2 * {step} * count({col})))"
            f" / 100.0")


def sround(expr: str, digits: int) -> str:
    """Spark's ROUND of a DOUBLE: half-up on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"
