"""Declared schemas and other fixed values of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _I, _S, _TS = T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# The trip warehouse table.
TRIP_WAREHOUSE = _struct(
    vendorid=_I, pickup_datetime=_TS, dropoff_datetime=_TS, passenger_count=_D, trip_distance=_D, ratecodeid=_D,
    store_and_fwd_flag=_S, pulocationid=_I, dolocationid=_I, payment_type=_I, fare_amount=_D, extra=_D, mta_tax=_D,
    tip_amount=_D, tolls_amount=_D, improvement_surcharge=_D, total_amount=_D, congestion_surcharge=_D,
)

# Trip column names per colour; any colour but green uses the second map.
GREEN_NAMES = {
    "lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime", "ehail_fee": "fee",
}
OTHER_NAMES = {
    "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", "airport_fee": "fee",
}
SAMPLE_ROWS = 10_000

# The sales tables.
TRANSACTIONS = _struct(
    transaction_id=T.LongType(), customer_id=_I, product_id=_I, amount=T.DecimalType(19, 2), qty=_I, channel_id=_I,
    bought_date=T.DateType(),
)
RESELLERS = _struct(reseller_id=_I, reseller_name=_S, commission_pct=T.DecimalType(10, 4))
CHANNELS = _struct(channel_id=_I, channel_name=_S)
CUSTOMERS = _struct(customer_id=_I, first_name=_S, last_name=_S, email=_S)
PRODUCTS = _struct(product_id=_I, name=_S, city=_S, price=T.DecimalType(19, 2))
CHANNEL_ROWS = [(1, "in-store"), (2, "web"), (3, "mobile app")]
RESELLER_ROWS = [
    (1001, "Imaginary Street Press Company", "0.15"),
    (1002, "European Example Press Corporation", "0.17"),
    (1003, "Scandinavian Legendary Printing Company", "0.14"),
    (1004, "Mediterranean Postcard Press Association", "0.16"),
]
PRODUCT_FORMATS = ["4x6", "4.25x6", "5x7", "5.5x8.5", "6x9", "6x11"]
PRODUCT_TEXTS = [
    "Greetings from", "All the love from", "Just settled in", "Come visit me in", "Merry Christmas from",
]
CALENDAR_START, CALENDAR_END = "2019-01-01", "2020-12-31"

# Daily reseller files, as CSV with spaced headers or JSON with a nested customer.
RESELLER_CSV = T.StructType([
    T.StructField("Transaction ID", T.LongType()), T.StructField("Product name", _S), T.StructField("Quantity", _I),
    T.StructField("Total amount", _D), T.StructField("Sales Channel", _S), T.StructField("Customer First Name", _S),
    T.StructField("Customer Last Name", _S), T.StructField("Customer Email", _S), T.StructField("Series City", _S),
    T.StructField("Created Date", _S), T.StructField("Reseller ID", _S),
])
RESELLER_JSON = T.StructType([
    T.StructField("date", _S), T.StructField("reseller-id", _S), T.StructField("productName", _S),
    T.StructField("qty", _I), T.StructField("totalAmount", _D), T.StructField("salesChannel", _S),
    T.StructField("customer", _struct(firstname=_S, lastname=_S, email=_S)), T.StructField("dateCreated", _S),
    T.StructField("seriesCity", _S), T.StructField("Created Date", _S), T.StructField("transactionId", T.LongType()),
])

# The web log record of the stream.
WEB_LOG = T.StructType([
    T.StructField("id", _I), T.StructField("first-name", _S), T.StructField("page-name", _S),
    T.StructField("page-url", _S), T.StructField("timestamp", _S), T.StructField("item-list", _S),
])


def _values(tag: str = "VALUE") -> T.StructType:
    return T.StructType([T.StructField(tag, T.ArrayType(_S))])


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


# Elements of the sanctions list. VALUE repeats below each list element.
INDIVIDUAL = T.StructType([
    *_texts("DATAID", "VERSIONNUM", "FIRST_NAME", "SECOND_NAME", "THIRD_NAME", "UN_LIST_TYPE", "REFERENCE_NUMBER",
            "LISTED_ON", "NAME_ORIGINAL_SCRIPT"),
    *[T.StructField(n, T.ArrayType(_values()))
      for n in ("TITLE", "DESIGNATION", "NATIONALITY", "LIST_TYPE", "LAST_DAY_UPDATED")],
])
ENTITY = T.StructType([
    *_texts("DATAID", "VERSIONNUM", "FIRST_NAME", "UN_LIST_TYPE", "REFERENCE_NUMBER", "LISTED_ON"),
    *[T.StructField(n, T.ArrayType(_values())) for n in ("LIST_TYPE", "LAST_DAY_UPDATED")],
    T.StructField("ENTITY_ALIAS", T.ArrayType(T.StructType(_texts("QUALITY", "ALIAS_NAME")))),
    T.StructField("ENTITY_ADDRESS", T.ArrayType(T.StructType(_texts("STREET", "CITY", "COUNTRY")))),
])

# Columns of a job posting.
JOB_COLUMNS = [
    "Job Title", "Company Name", "Job URL", "Job Description", "Candidate Requirements", "Benefits", "Location",
    "Work Location", "Salary", "Experience", "Application Deadline", "Domain", "Company Size",
]
