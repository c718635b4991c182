"""Seed records and seeding of empty raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.envelope import to_envelope
from stratalake.sources.warehouse import Warehouse

# The demonstration records.
SEED_USERS = [
    (1, "Alice Johnson", "alice.johnson@example.com", "Female", "Ms.", "Software Engineer", "American", "English", "Master", 32, "A+", ("San Francisco", "California", "US", "94102", "Market St", "123"), "2024-01-15T10:00:00Z", "2024-06-01T08:30:00Z"),
    (2, "Bob Smith", "bob.smith@example.com", "Male", "Mr.", "Data Analyst", "Canadian", "English", "Bachelor", 28, "O+", ("Toronto", "Ontario", "CA", "M5V 3A8", "King St", "456"), "2024-02-20T14:30:00Z", "2024-05-15T12:00:00Z"),
    (3, "Charlie Brown", "charlie.brown@example.com", "Male", "Dr.", "Product Manager", "British", "English", "PhD", 45, "B-", ("London", "England", "GB", "EC1A 1BB", "Oxford St", "789"), "2024-03-10T09:15:00Z", "2024-04-20T16:45:00Z"),
    (4, "Diana Müller", "diana.mueller@example.com", "Female", "Dr.", "Data Scientist", "German", "German", "PhD", 38, "AB+", ("Berlin", "Berlin", "DE", "10115", "Friedrichstraße", "42"), "2024-01-05T08:00:00Z", "2024-06-10T14:00:00Z"),
    (5, "Ethan Park", "ethan.park@example.com", "Male", "Mr.", "Marketing Director", "American", "English", "MBA", 41, "O-", ("New York", "New York", "US", "10001", "5th Ave", "800"), "2024-02-01T12:00:00Z", "2024-05-20T09:00:00Z"),
    (6, "Fatima Al-Rashid", "fatima.rashid@example.com", "Female", "Ms.", "UX Designer", "Emirati", "Arabic", "Master", 29, "A-", ("Dubai", "Dubai", "AE", "00000", "Sheikh Zayed Rd", "1"), "2024-03-15T06:00:00Z", "2024-06-05T11:30:00Z"),
    (7, "George Tanaka", "george.tanaka@example.com", "Male", "Mr.", "DevOps Engineer", "Japanese", "Japanese", "Bachelor", 35, "B+", ("Tokyo", "Tokyo", "JP", "100-0001", "Chiyoda", "1-1"), "2024-01-20T03:00:00Z", "2024-05-30T07:00:00Z"),
    (8, "Hannah Cohen", "hannah.cohen@example.com", "Female", "Ms.", "Financial Analyst", "American", "English", "Master", 31, "O+", ("Chicago", "Illinois", "US", "60601", "Michigan Ave", "200"), "2024-02-10T15:00:00Z", "2024-06-15T10:00:00Z"),
    (9, "Ivan Petrov", "ivan.petrov@example.com", "Male", "Mr.", "Backend Developer", "Canadian", "English", "Bachelor", 27, "A+", ("Vancouver", "British Columbia", "CA", "V6B 1A1", "Granville St", "300"), "2024-03-01T09:00:00Z", "2024-05-25T13:00:00Z"),
    (10, "Julia Santos", "julia.santos@example.com", "Female", "Ms.", "Product Designer", "Brazilian", "Portuguese", "Bachelor", 26, "AB-", ("São Paulo", "São Paulo", "BR", "01310-100", "Av Paulista", "1578"), "2024-01-25T11:00:00Z", "2024-06-08T16:00:00Z"),
    (11, "Kevin O'Brien", "kevin.obrien@example.com", "Male", "Mr.", "Solutions Architect", "British", "English", "Master", 39, "B-", ("London", "England", "GB", "SW1A 1AA", "Whitehall", "10"), "2024-02-15T07:30:00Z", "2024-06-12T09:00:00Z"),
    (12, "Lena Fischer", "lena.fischer@example.com", "Female", "Ms.", "Machine Learning Engineer", "German", "German", "PhD", 33, "O+", ("Munich", "Bavaria", "DE", "80331", "Marienplatz", "8"), "2024-03-20T10:00:00Z", "2024-06-18T12:00:00Z"),
]
SEED_PRODUCTS = [
    (101, "Tesla", "Model 3", 2024, "42990.00", "2024-01-01T00:00:00Z"),
    (102, "Toyota", "Camry", 2023, "28500.00", "2024-01-01T00:00:00Z"),
    (103, "Honda", "Civic", 2024, "25800.00", "2024-01-01T00:00:00Z"),
    (104, "BMW", "X5", 2023, "65900.00", "2024-01-01T00:00:00Z"),
    (105, "Mercedes-Benz", "C-Class", 2024, "46250.00", "2024-01-01T00:00:00Z"),
    (106, "Ford", "Mustang", 2024, "32515.00", "2024-01-01T00:00:00Z"),
    (107, "Porsche", "Cayenne", 2023, "82900.00", "2024-01-01T00:00:00Z"),
    (108, "Hyundai", "Tucson", 2024, "30550.00", "2024-01-01T00:00:00Z"),
]
SEED_PURCHASES = [
    (1001, 1, 101, "2024-04-01T14:30:00Z", "2024-03-28T10:00:00Z", None),
    (1002, 1, 105, "2024-05-15T09:45:00Z", "2024-05-14T16:20:00Z", None),
    (1003, 1, 103, "2024-06-20T11:00:00Z", "2024-06-19T08:00:00Z", None),
    (1004, 1, 107, "2024-07-10T16:00:00Z", "2024-07-08T12:00:00Z", None),
    (1005, 2, 102, "2024-05-01T11:00:00Z", "2024-04-30T18:30:00Z", None),
    (1006, 2, 106, "2024-06-05T14:00:00Z", "2024-06-04T10:00:00Z", None),
    (1007, 2, 108, "2024-07-15T09:00:00Z", "2024-07-14T15:00:00Z", None),
    (1008, 3, 104, "2024-05-10T15:20:00Z", "2024-05-08T12:00:00Z", "2024-05-20T10:00:00Z"),
    (1009, 3, 102, "2024-06-25T10:00:00Z", "2024-06-24T08:00:00Z", None),
    (1010, 4, 107, "2024-03-15T08:00:00Z", "2024-03-14T20:00:00Z", None),
    (1011, 4, 101, "2024-04-20T12:00:00Z", "2024-04-19T14:00:00Z", None),
    (1012, 4, 105, "2024-05-25T09:30:00Z", "2024-05-24T11:00:00Z", None),
    (1013, 4, 104, "2024-06-30T15:00:00Z", "2024-06-29T10:00:00Z", "2024-07-10T08:00:00Z"),
    (1014, 4, 106, "2024-07-20T11:00:00Z", "2024-07-19T09:00:00Z", None),
    (1015, 5, 104, "2024-04-05T10:00:00Z", "2024-04-03T14:00:00Z", None),
    (1016, 5, 107, "2024-05-10T13:00:00Z", "2024-05-09T09:00:00Z", None),
    (1017, 5, 105, "2024-06-15T16:00:00Z", "2024-06-14T11:00:00Z", None),
    (1018, 5, 101, "2024-07-25T08:00:00Z", "2024-07-24T15:00:00Z", None),
    (1019, 6, 103, "2024-04-10T07:00:00Z", "2024-04-09T12:00:00Z", "2024-04-20T06:00:00Z"),
    (1020, 6, 108, "2024-05-20T09:00:00Z", "2024-05-19T14:00:00Z", "2024-06-01T08:00:00Z"),
    (1021, 6, 106, "2024-06-28T11:00:00Z", "2024-06-27T16:00:00Z", None),
    (1022, 7, 102, "2024-03-20T04:00:00Z", "2024-03-19T22:00:00Z", None),
    (1023, 7, 108, "2024-05-05T06:00:00Z", "2024-05-04T20:00:00Z", None),
    (1024, 7, 103, "2024-06-10T03:00:00Z", "2024-06-09T18:00:00Z", None),
    (1025, 8, 103, "2024-04-15T16:00:00Z", "2024-04-14T10:00:00Z", None),
    (1026, 8, 102, "2024-06-01T12:00:00Z", "2024-05-31T08:00:00Z", None),
    (1027, 9, 106, "2024-04-25T10:00:00Z", "2024-04-24T14:00:00Z", None),
    (1028, 9, 101, "2024-05-30T08:00:00Z", "2024-05-29T12:00:00Z", "2024-06-10T09:00:00Z"),
    (1029, 9, 108, "2024-07-05T15:00:00Z", "2024-07-04T11:00:00Z", None),
    (1030, 10, 105, "2024-05-12T13:00:00Z", "2024-05-11T09:00:00Z", None),
    (1031, 10, 106, "2024-07-01T10:00:00Z", "2024-06-30T15:00:00Z", None),
    (1032, 11, 107, "2024-04-08T08:00:00Z", "2024-04-07T12:00:00Z", None),
    (1033, 11, 104, "2024-05-18T14:00:00Z", "2024-05-17T10:00:00Z", "2024-05-28T09:00:00Z"),
    (1034, 11, 101, "2024-07-12T11:00:00Z", "2024-07-11T08:00:00Z", None),
    (1035, 12, 101, "2024-07-28T09:00:00Z", "2024-07-27T14:00:00Z", None),
]

USER_RECORD = (
    "id bigint, name string, email string, gender string, title string, occupation string, "
    "nationality string, language string, academic_degree string, age int, blood_type string, "
    "address struct<city string, state string, country_code string, postal_code string, "
    "street_name string, street_number string>, created_at string, updated_at string"
)
PRODUCT_RECORD = "id bigint, make string, model string, year int, price string, created_at string"
PURCHASE_RECORD = (
    "id bigint, user_id bigint, product_id bigint, purchased_at string, "
    "added_to_cart_at string, returned_at string"
)


def seed_records(spark: SparkSession) -> dict[str, DataFrame]:
    """The demonstration records as raw envelope rows, one DataFrame per stream."""
    products = spark.createDataFrame(SEED_PRODUCTS, PRODUCT_RECORD)
    return {
        "raw_users": to_envelope(spark.createDataFrame(SEED_USERS, USER_RECORD)),
        "raw_products": to_envelope(products.withColumn("price", F.col("price").cast("decimal(10,2)"))),
        "raw_purchases": to_envelope(spark.createDataFrame(SEED_PURCHASES, PURCHASE_RECORD)),
    }


def seed_if_empty(warehouse: Warehouse, rows: DataFrame, layer: str, name: str) -> bool:
    """Append rows to a table that has none; returns whether anything was written."""
    if warehouse.exists(layer, name) and not warehouse.ref(layer, name).isEmpty():
        return False
    warehouse.append(rows, layer, name)
    return True
