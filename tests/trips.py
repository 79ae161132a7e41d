"""Literal trip messages and the end each of them has to come to."""

import json

BASE = {
    "VendorID": 2,
    "tpep_pickup_datetime": "2016-01-01 00:00:00",
    "tpep_dropoff_datetime": "2016-01-01 00:20:00",
    "passenger_count": 1,
    "trip_distance": 3.2,
    "pickup_longitude": -73.98,
    "pickup_latitude": 40.75,
    "RateCodeID": 1,
    "store_and_fwd_flag": "N",
    "dropoff_longitude": -73.95,
    "dropoff_latitude": 40.78,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 3.75,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 17.05,
    "retry_count": 0,
}


def trip(**changes):
    """The base message with changes; None removes a field."""
    record = BASE | changes
    return json.dumps({k: v for k, v in record.items() if v is not None})


# name: (message, end by default, retry count, end when three-valued and typed)
FATES = {
    "base": (trip(), "processed", 0, "processed"),
    "vendor_missing": (trip(VendorID=None), "repaired", 1, "repaired"),
    "vendor_text": (trip(VendorID="invalid_value"), "repaired", 1, "repaired"),
    "vendor_negative": (trip(VendorID=-2), "processed", 0, "processed"),
    "fare_negative": (trip(fare_amount=-12.0), "repaired", 1, "repaired"),
    "count_negative": (trip(passenger_count=-1), "failed", 3, "failed"),
    "count_large": (trip(passenger_count=12), "failed", 3, "failed"),
    "total_negative": (trip(total_amount=-17.05), "failed", 3, "failed"),
    "rate_99": (trip(RateCodeID=99), "failed", 3, "failed"),
    "pickup_missing": (trip(tpep_pickup_datetime=None), "failed", 3, "failed"),
    "count_missing": (trip(passenger_count=None), "repaired", 1, "lost"),
    "count_text": (trip(passenger_count="invalid_value"), "repaired", 1, "lost"),
    "rate_missing": (trip(RateCodeID=None), "repaired", 1, "lost"),
    "fare_missing": (trip(fare_amount=None), "failed", 3, "lost"),
    "fare_text": (trip(fare_amount="invalid_value"), "failed", 3, "lost"),
    "total_missing": (trip(total_amount=None), "failed", 3, "lost"),
    "flag_missing": (trip(store_and_fwd_flag=None), "failed", 3, "lost"),
    "fare_dollars": (trip(fare_amount="$12.50"), "repaired", 1, "lost"),
    "fare_large_bad_count": (trip(fare_amount=1e7, passenger_count=-1), "failed", 3, "failed"),
    "fare_small_bad_count": (trip(fare_amount=5e-4, passenger_count=-1), "failed", 3, "failed"),
    "not_json": ("{not json", "failed", 3, "lost"),
    "null_value": (None, "failed", 3, "lost"),
    "empty_object": ("{}", "failed", 3, "lost"),
    "distance_missing": (trip(trip_distance=None), "processed", 0, "processed"),
    "distance_text": (trip(trip_distance="invalid_value"), "processed", 0, "processed"),
    "payment_negative": (trip(payment_type=-1), "processed", 0, "processed"),
    "retry_count_missing": (trip(retry_count=None), "processed", 0, "processed"),
    "vendor_missing_no_count": (trip(VendorID=None, retry_count=None), "repaired", 1, "lost"),
    "fare_nan": (trip().replace("12.0", "NaN"), "failed", 3, None),
}


def envelope(spark):
    """The messages as rows of a topic, each at an offset of its own."""
    from lazaret.contracts import ENVELOPE

    start = "2024-01-01 00:00:00"
    rows = [
        (None, message, "trips", 0, i, None) for i, (message, *_) in enumerate(FATES.values())
    ]
    df = spark.createDataFrame(rows, ENVELOPE)
    from pyspark.sql import functions as F

    return df.withColumn("timestamp", F.lit(start).cast("timestamp"))


NAMES = dict(enumerate(FATES))
