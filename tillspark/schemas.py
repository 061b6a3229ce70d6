"""Table schemas and the fixed values the reports depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# ---------------------------------------------------------------------------

# Stock codes that are postage, fees or manual adjustments, not products.
NOISE_CODES = ["POST", "D", "DOT", "M", "BANK CHARGES", "PADS", "AMAZONFEE", "C2", "CRUK"]

# Minimum length of a product stock code.
MIN_CODE_LENGTH = 4

# Country -> region lookup; countries absent from it fall into DEFAULT_REGION.
COUNTRY_REGIONS = [
    ("United Kingdom", "Europe"),
    ("EIRE", "Europe"),
    ("Germany", "Europe"),
    ("France", "Europe"),
    ("Netherlands", "Europe"),
    ("Spain", "Europe"),
    ("Belgium", "Europe"),
    ("Switzerland", "Europe"),
    ("Portugal", "Europe"),
    ("Norway", "Europe"),
    ("Finland", "Europe"),
    ("Sweden", "Europe"),
    ("Denmark", "Europe"),
    ("Italy", "Europe"),
    ("Austria", "Europe"),
    ("Poland", "Europe"),
    ("Cyprus", "Europe"),
    ("Greece", "Europe"),
    ("Iceland", "Europe"),
    ("Malta", "Europe"),
    ("Lithuania", "Europe"),
    ("Australia", "Asia-Pacific"),
    ("Japan", "Asia-Pacific"),
    ("Singapore", "Asia-Pacific"),
    ("Hong Kong", "Asia-Pacific"),
    ("Bahrain", "Asia-Pacific"),
    ("Saudi Arabia", "Asia-Pacific"),
    ("Lebanon", "Asia-Pacific"),
    ("United Arab Emirates", "Asia-Pacific"),
    ("USA", "Americas"),
    ("Canada", "Americas"),
    ("Brazil", "Americas"),
    ("Unspecified", "Other"),
    ("RSA", "Other"),
]
DEFAULT_REGION = "Other"
DEFAULT_DESCRIPTION = "Unknown"

# Guest customer row of the customer dimension.
GUEST_KEY = -1

# Inventory risk thresholds on the average monthly quantity.
RISK_HIGH = 1000
RISK_MEDIUM = 300
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH"]
# Demand trend: recent 3-month average against the long-run average.
TREND_RISING = 1.2
TREND_FALLING = 0.8

# RFM: number of tiles and segment rules (score sums).
RFM_TILES = 5
RFM_CHAMPIONS = 12
RFM_LOYAL = 9
RFM_RECENT = 4
RFM_FREQUENT = 4
RFM_AT_RISK = 5

# Forecasting.
HORIZON = 6
TRAIN_RATIO = 0.8
SEASON = 12
Z80 = 1.28

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
               "CustomerID", "Country"]

RAW_SALES = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DecimalType(10, 4)),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

CLEANED_EXTRA = T.StructType([
    T.StructField("IsCancelled", T.BooleanType()),
    T.StructField("HasCustomerID", T.BooleanType()),
    T.StructField("TotalRevenue", T.DecimalType(12, 2)),
    T.StructField("Year", T.IntegerType()),
    T.StructField("Month", T.IntegerType()),
    T.StructField("YearMonth", T.StringType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfWeekName", T.StringType()),
    T.StructField("Hour", T.IntegerType()),
    T.StructField("Quarter", T.IntegerType()),
    T.StructField("WeekOfYear", T.IntegerType()),
])

CLEANED_SALES = T.StructType(RAW_SALES.fields + CLEANED_EXTRA.fields)

FORECAST_RESULTS = T.StructType([
    T.StructField("year_month", T.StringType()),
    T.StructField("forecast_revenue", T.DecimalType(14, 2)),
    T.StructField("lower_80ci", T.DecimalType(14, 2)),
    T.StructField("upper_80ci", T.DecimalType(14, 2)),
    T.StructField("model_used", T.StringType()),
])

REVENUE_FORECAST_CSV = T.StructType([
    T.StructField("YearMonth", T.StringType()),
    T.StructField("ForecastRevenue", T.DoubleType()),
    T.StructField("Lower_80CI", T.DoubleType()),
    T.StructField("Upper_80CI", T.DoubleType()),
    T.StructField("ModelUsed", T.StringType()),
])

# Columns of the forecast file and their names in forecast_results.
FORECAST_COLUMN_NAMES = {
    "YearMonth": "year_month",
    "ForecastRevenue": "forecast_revenue",
    "Lower_80CI": "lower_80ci",
    "Upper_80CI": "upper_80ci",
    "ModelUsed": "model_used",
}
