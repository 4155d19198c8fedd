"""Small frames and files for the tests: a feed of parcels, as a depot might deliver it."""

from pyspark.sql.types import StringType, StructField, StructType

PARCELS = {
    "column_map": {"parcel": "source_parcel_id", "sender": "source_sender_id", "unit": "unit"},
    "date_fields": {"sent_on": {"target": "sent_ts", "format": "dd.MM.yyyy HH:mm"}},
    "int_fields": {"grams": "grams"},
    "decimal_fields": {"fee": "fee"},
    "boolean_fields": {"returned": {"target": "returned", "true_values": ["ja", "j"], "false_values": ["nein"]}},
    "required_fields": ["source_parcel_id", "source_sender_id", "fee"],
}
PARCEL = {
    "parcel": "P-77",
    "sender": "S-3",
    "fee": "18.40",
    "unit": "box",
    "grams": "450",
    "sent_on": "05.03.2023 14:30",
    "returned": "nein",
    "_corrupt_record": None,
    "_client_id": "depot_9",
}


def strings(spark, columns, rows):
    return spark.createDataFrame(rows, StructType([StructField(c, StringType()) for c in columns]))


def parcels(spark, *changes):
    """One good raw parcel per dict of changed cells."""
    rows = [tuple(change.get(name, cell) for name, cell in PARCEL.items()) for change in changes]
    return strings(spark, list(PARCEL), rows)


def land(folder, client_id, name, content):
    """Put a feed file where the scan looks for it; returns the input folder."""
    (folder / client_id).mkdir(parents=True, exist_ok=True)
    with open(folder / client_id / name, "w", encoding="utf-8", newline="") as file:
        file.write(content)
    return str(folder)


def column(df, name):
    return [row[name] for row in df.collect()]
