"""Column layouts of the raw files and of the tables the engine passes around."""

from __future__ import annotations

from pyspark.sql import types as T

BIKE, YELLOW, GREEN = "bike", "yellow", "green"
MODES = (BIKE, YELLOW, GREEN)

# Zip of a location that no lookup knows, and hour of a time text without one.
UNKNOWN_ZIP = "00000"
UNKNOWN_HOUR = "-1"

# --- Fixed values: column names of the raw files -----------------------------------------

BIKE_COLUMNS = [
    "tripduration", "starttime", "stoptime",
    "start station id", "start station name", "start station latitude", "start station longitude",
    "end station id", "end station name", "end station latitude", "end station longitude",
    "bikeid", "usertype", "birth year", "gender",
]
# Bike columns that carry a type other than text; a row that breaks one is malformed.
BIKE_TYPED = {"tripduration": "double", "birth year": "int"}

YELLOW_ZONE_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
]
YELLOW_POINT_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "pickup_longitude", "pickup_latitude", "RatecodeID",
    "store_and_fwd_flag", "dropoff_longitude", "dropoff_latitude",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount",
]
GREEN_ZONE_COLUMNS = [
    "VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "store_and_fwd_flag",
    "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "trip_distance",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type",
    "congestion_surcharge",
]

GREEN_POINT_COLUMNS = [
    "VendorID", "lpep_pickup_datetime", "Lpep_dropoff_datetime", "Store_and_fwd_flag",
    "RateCodeID", "Pickup_longitude", "Pickup_latitude", "Dropoff_longitude", "Dropoff_latitude",
    "Passenger_count", "Trip_distance", "Fare_amount", "Extra", "MTA_tax", "Tip_amount",
    "Tolls_amount", "Ehail_fee", "improvement_surcharge", "Total_amount", "Payment_type",
    "Trip_type",
]

TAXI_LAYOUTS = {
    "yellow_zones": YELLOW_ZONE_COLUMNS,
    "yellow_points": YELLOW_POINT_COLUMNS,
    "green_zones": GREEN_ZONE_COLUMNS,
    "green_points": GREEN_POINT_COLUMNS,
}

# --- Engine tables -----------------------------------------------------------------------

# One row per trip, whatever its mode.  Text columns stay as read; see functions/ for cleaning.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("mode", T.StringType()),
        T.StructField("pickup", T.StringType()),
        T.StructField("start_id", T.StringType()),
        T.StructField("end_id", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("distance", T.StringType()),
        T.StructField("usertype", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("trip_type", T.StringType()),
    ]
)
TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()

CELL_KEYS = ["date", "hour", "start_zip", "end_zip"]

LOOKUP_FILE_COLUMNS = {"station": "stationId", "zone": "zoneId"}

STATION_FEED_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "stations",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("station_id", T.StringType()),
                                    T.StructField("name", T.StringType()),
                                    T.StructField("lat", T.DoubleType()),
                                    T.StructField("lon", T.DoubleType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

GOLDEN_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("count", T.LongType())]
)


def all_text(columns: list[str]) -> T.StructType:
    """A schema with every column as text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in columns])
