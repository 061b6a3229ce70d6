"""DuckDB oracles of the warehouse grown by two loads: what one database with sequences would hold."""

from __future__ import annotations

from sqloracle.base import SALES, SALES_WH, features, with_ctes

_ORDER = "InvoiceDate, Invoice, StockCode, CustomerID, Country, Quantity, Price, TotalRevenue, Description"

# load 1 numbers the lines before the bound, load 2 numbers the others on
_LOADS = with_ctes(SALES, features("sales", "cleaned"), f"""
loads AS (SELECT *, CASE WHEN InvoiceDate < TIMESTAMP '1995-07-01' THEN 1 ELSE 2 END AS load FROM cleaned),
codes AS (SELECT StockCode, min(load) AS load FROM loads GROUP BY StockCode),
products AS (SELECT StockCode AS stock_code, row_number() OVER (ORDER BY load, StockCode) AS product_key FROM codes),
places AS (SELECT Country AS country_name, row_number() OVER (ORDER BY min(load), Country) AS country_key FROM loads GROUP BY Country),
names AS (
  SELECT StockCode AS stock_code, Description AS description FROM loads GROUP BY StockCode, Description
  QUALIFY row_number() OVER (PARTITION BY StockCode ORDER BY Description IS NULL, count(*) DESC, Description) = 1)""")

SQL: dict[str, str] = {
    "incremental_load": _LOADS + f"""
SELECT row_number() OVER (ORDER BY load, {_ORDER}) AS sale_id, Invoice AS invoice_no,
       CAST(strftime(InvoiceDate, '%Y%m%d%H') AS INTEGER) AS date_key, product_key, stock_code,
       coalesce(CustomerID, -1) AS customer_key, country_key, country_name, Quantity AS quantity,
       CAST(Price AS DOUBLE) AS unit_price, CAST(TotalRevenue AS DOUBLE) AS total_revenue
FROM loads JOIN products ON stock_code = StockCode JOIN places ON country_name = Country
""",
    "incremental_products": _LOADS + """
SELECT product_key, stock_code, coalesce(description, 'Unknown') AS description FROM products JOIN names USING (stock_code)
""",
    "incremental_customers": SALES_WH + "SELECT * FROM dim_customer",
    "customer_history": SALES_WH + """,
lines AS (SELECT invoice_no, date_key, stock_code, description, customer_key, quantity, CAST(total_revenue AS DOUBLE) AS total_revenue
          FROM fact JOIN dim_product USING (product_key))
SELECT 'customer' AS asked, * FROM lines WHERE customer_key = (SELECT max(customer_id) FROM dim_customer)
UNION ALL SELECT 'product', * FROM lines WHERE stock_code = (SELECT min(stock_code) FROM dim_product)
UNION ALL SELECT 'invoice', * FROM lines WHERE invoice_no = (SELECT max(invoice_no) FROM fact)
""",
    "fact_by_lookup": SALES_WH + """
SELECT invoice_no, date_key, product_key, CASE WHEN customer_key % 4 = 0 THEN -1 ELSE customer_key END AS customer_key, country_key,
       quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM fact
""",
    "distinct_by_bitmap": SALES_WH + """
SELECT coalesce(year_month, 'all') AS period, count(DISTINCT invoice_no) AS num_invoices, count(DISTINCT customer_key) AS num_customers,
       count(DISTINCT product_key) AS num_products
FROM fd GROUP BY ROLLUP (year_month)
UNION ALL
SELECT 'last_30_days', count(DISTINCT invoice_no), count(DISTINCT customer_key), count(DISTINCT product_key)
FROM fd WHERE full_date >= (SELECT max(full_date) FROM fd) - 30
""",
}
