"""Fixed values.

These must equal the original analysis for results to match it: column lists,
labels, report strings, the token pattern and the default parameters of each
step. They are stated here once, in the original's order, and imported by the
operators.
"""

# --- fixed values (must match the original analysis) -------------------------------------

# KPI columns added by cleaning, and the text columns that get "0" for NULL
KPI_COLUMNS = ["GrossProfit", "ProfitMargin", "StockTurnover", "UnsoldCapital"]
STRING_FILL = ["VendorName", "Description"]

# columns of the exploratory key-stats summary
KPI_SUMMARY_COLUMNS = ["ProfitMargin", "TotalSalesDollars", "GrossProfit", "StockTurnover",
                       "UnsoldCapital"]

# correlation matrix columns
CORR_COLUMNS = ["TotalSalesDollars", "GrossProfit", "ProfitMargin", "StockTurnover",
                "UnsoldCapital"]

# clustering features, tier labels and the report's description of the method
FEATURES = ["LogSales", "LogGrossProfit", "ProfitMargin", "StockTurnoverCapped"]
LOW, MID, HIGH = "Low Performer", "Mid Performer", "High Performer"
CLUSTER_ALGORITHM = "KMeans (k={k}, standardized, log-scaled dollar features)"
PROFILE_COLUMNS = ["TotalSalesDollars", "GrossProfit", "ProfitMargin", "StockTurnover"]

# regression drivers and target, and the report's name for the target
DRIVERS = ["FreightCost", "StockTurnover", "BrandCount", "AvgPurchasePrice", "AvgActualPrice"]
TARGET = "ProfitMargin"
TARGET_LABEL = "ProfitMargin (%)"

# word tokens: lower-cased runs of two or more letters, digits or underscores
TOKEN_PATTERN = r"([\p{L}\p{N}_]{2,})"

# default parameters
VENDOR_K, TEXT_K, N_INIT, SEED = 3, 8, 10, 42
TURNOVER_CAP_QUANTILE, CROP_QUANTILE = 0.95, 0.98
MAX_FEATURES, NGRAM_MAX, TOP_TERMS = 300, 2, 6
HIST_BINS, KDE_GRIDSIZE, BOX_WHIS = 40, 200, 1.5
TOP_N, VALUE_COUNTS_N = 10, 5
