"""Column contracts, code lists, time bands and thresholds.

Everything in this module is data that results must agree with, stated as text.
Nothing here has logic; the operators take these as defaults and accept others.
"""

# Column contracts, one per table, in column order.

RAW_TRIPS = """
    VendorID BIGINT,
    tpep_pickup_datetime TIMESTAMP,
    tpep_dropoff_datetime TIMESTAMP,
    passenger_count BIGINT,
    trip_distance DOUBLE,
    PULocationID BIGINT,
    DOLocationID BIGINT,
    RatecodeID BIGINT,
    store_and_fwd_flag STRING,
    payment_type BIGINT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    improvement_surcharge DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    Airport_fee DOUBLE
"""

ZONES = """
    LocationID INT NOT NULL,
    Borough STRING,
    Zone STRING,
    service_zone STRING
"""

BRONZE_TRIPS = """
    VendorID INT,
    tpep_pickup_datetime TIMESTAMP,
    tpep_dropoff_datetime TIMESTAMP,
    passenger_count INT,
    trip_distance DOUBLE,
    PULocationID INT,
    DOLocationID INT,
    RatecodeID INT,
    store_and_fwd_flag STRING,
    payment_type INT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    improvement_surcharge DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    Airport_fee DOUBLE,
    _source_file STRING NOT NULL,
    _source_month STRING NOT NULL,
    _ingestion_ts TIMESTAMP NOT NULL,
    _year INT NOT NULL,
    _month INT NOT NULL
"""

DIM_DATE = """
    date_key INT NOT NULL,
    full_date DATE NOT NULL,
    year SMALLINT NOT NULL,
    month SMALLINT NOT NULL,
    day SMALLINT NOT NULL,
    day_of_week SMALLINT NOT NULL,
    day_name STRING NOT NULL,
    week_of_year SMALLINT NOT NULL,
    is_weekend BOOLEAN NOT NULL,
    is_holiday BOOLEAN NOT NULL,
    quarter SMALLINT NOT NULL
"""

DIM_TIME = """
    time_key INT NOT NULL,
    hour SMALLINT NOT NULL,
    minute SMALLINT NOT NULL,
    time_of_day STRING NOT NULL,
    is_rush_hour BOOLEAN NOT NULL,
    is_night BOOLEAN NOT NULL
"""

DIM_LOCATION = """
    location_key INT NOT NULL,
    location_id INT NOT NULL,
    borough STRING,
    zone_name STRING,
    service_zone STRING
"""

DIM_VENDOR = """
    vendor_key INT NOT NULL,
    vendor_id INT NOT NULL,
    vendor_name STRING NOT NULL
"""

DIM_RATECODE = """
    ratecode_key INT NOT NULL,
    ratecode_id INT NOT NULL,
    ratecode_name STRING NOT NULL,
    ratecode_description STRING
"""

DIM_PAYMENT_TYPE = """
    payment_type_key INT NOT NULL,
    payment_type_id INT NOT NULL,
    payment_type_name STRING NOT NULL
"""

FACT_TRIPS = """
    trip_key BIGINT NOT NULL,
    date_key INT NOT NULL,
    pickup_time_key INT NOT NULL,
    dropoff_time_key INT NOT NULL,
    pickup_location_key INT NOT NULL,
    dropoff_location_key INT NOT NULL,
    vendor_key INT NOT NULL,
    ratecode_key INT NOT NULL,
    payment_type_key INT NOT NULL,
    passenger_count SMALLINT,
    trip_distance_miles DECIMAL(10,2),
    trip_duration_minutes DECIMAL(10,2),
    fare_amount DECIMAL(10,2),
    extra_amount DECIMAL(10,2),
    mta_tax DECIMAL(10,2),
    tip_amount DECIMAL(10,2),
    tolls_amount DECIMAL(10,2),
    improvement_surcharge DECIMAL(10,2),
    congestion_surcharge DECIMAL(10,2),
    airport_fee DECIMAL(10,2),
    total_amount DECIMAL(10,2),
    _source_file STRING NOT NULL,
    _ingestion_ts TIMESTAMP NOT NULL
"""

# Code lists (key, name, description).

VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc."),
]

RATE_CODES = [
    (1, "Standard rate", "Standard metered fare"),
    (2, "JFK", "JFK Airport flat fare"),
    (3, "Newark", "Newark Airport negotiated fare"),
    (4, "Nassau/Westchester", "Nassau or Westchester fare"),
    (5, "Negotiated fare", "Negotiated flat fare"),
    (6, "Group ride", "Group ride fare"),
    (99, "Unknown", "Unknown or invalid rate code"),
]

PAYMENT_TYPES = [
    (0, "Unknown/Missing"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

UNKNOWN_LOCATIONS = [
    (264, 264, "Unknown", "Unknown", "Unknown"),
    (265, 265, "Unknown", "Unknown", "Unknown"),
]

# Defaults for codes that are missing in the source.

DEFAULT_VENDOR = 1
DEFAULT_RATE_CODE = 1
DEFAULT_PAYMENT_TYPE = 5

# Hour bands, first hour included and last hour excluded.

TIME_OF_DAY = [
    (0, 6, "Night"),
    (6, 12, "Morning"),
    (12, 17, "Afternoon"),
    (17, 21, "Evening"),
    (21, 24, "Night"),
]
RUSH_HOURS = [(7, 10), (16, 19)]
NIGHT_HOURS = [(0, 6), (21, 24)]
WEEKEND_DAYS = [1, 7]  # 1 = Sunday

# Subsets used by reports.

HIGH_VALUE_TOTAL = 50
AIRPORT_LOCATIONS = [1, 132, 138]

# Limits and thresholds.

MAX_TRIP_SECONDS = 86400
REJECTION_WARNING = 0.05
REJECTION_CRITICAL = 0.20
QUALITY_GOOD = 99
QUALITY_WARN = 95
JDBC_BATCH_ROWS = 10000
ALERT_LEVELS = ["info", "warning", "critical"]
METRIC_TYPES = ["counter", "gauge", "timer", "histogram"]
