"""Station feeds: JSON payloads, single messages, validation and dead letters.

Everything is a column expression, so the same functions serve batch files and streams.
Fields are first read as text and then cast, which tells "absent" from "unusable".
"""

from __future__ import annotations

import datetime as dt


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.functions import safe_divide
from velomart.operators.quality import QualityGateError
from velomart.params import Params
from velomart.schemas import STATION_INFORMATION, STATION_STATUS, STATION_STATUS_DLQ, conform

# Dead-letter reasons, and the word in one of them.
INVALID_JSON = "invalid_json"
MISSING_STATION_ID = "missing_station_id"
PRODUCER_DLQ = "producer_dlq"
PROBLEMS_WORD = "masalah"

COUNTS_REQUIRED = ("num_bikes_available", "num_docks_available")
COUNTS_OPTIONAL = (
    "num_ebikes_available",
    "num_scooters_available",
    "num_bikes_disabled",
    "num_docks_disabled",
)
FLAGS = ("is_installed", "is_renting", "is_returning", "is_disabled")

_STATUS_TEXT = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "station_id", *COUNTS_REQUIRED, *COUNTS_OPTIONAL, *FLAGS,
            "last_reported", "last_reported_iso", "snapshot_timestamp",
        )
    ]
)
_INFORMATION_TEXT = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "station_id", "name", "short_name", "lat", "lon", "capacity", "region_id",
            "eightd_has_key_dispenser",
        )
    ]
    + [T.StructField("rental_methods", T.ArrayType(T.StringType()))]
)
_ENVELOPE = T.StructType(
    [
        T.StructField("last_updated", T.StringType()),
        T.StructField("ttl", T.StringType()),
        T.StructField(
            "data", T.StructType([T.StructField("stations", T.ArrayType(T.StringType()))])
        ),
    ]
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per payload file, the whole text in ``value``."""
    return spark.read.option("wholetext", True).text(path)


def archive_payloads(payloads: DataFrame, path: str) -> None:
    """Keep the untouched payload texts for a replay, line feeds included: one JSON line each."""
    payloads.select("value").write.mode("append").json(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived payloads as ``read_payloads`` gave them."""
    return spark.read.schema("value string").json(path)


def _whole(text: Column) -> Column:
    """Text of a whole number as a long; 12 and 12.0 are whole, 12.5 is not."""
    whole = F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(text, ".", 1))
    return whole.try_cast("long")


def _flag(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin("1", "true"), True).when(low.isin("0", "false"), False)


def _unusable(text: Column, value: Column) -> Column:
    return text.isNotNull() & value.isNull()


def _first_reason(rules: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(reason)) for reason, bad in rules.items()])


def _worked_out(rows: DataFrame) -> DataFrame:
    """The same rows, behind a generator that no filter is pushed through.

    A condition on a column that was parsed from a text would else be moved below the parsing,
    with the whole expression in it wherever the column is named: one JSON text read many times.
    """
    return rows.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))))


# --- envelopes ------------------------------------------------------------------------


def parse_envelope(payloads: DataFrame) -> DataFrame:
    """Add ``envelope`` and ``problems``, the number of structural errors in the payload."""
    e = F.col("envelope")
    stations = e["data"]["stations"]
    not_objects = F.size(F.filter(stations, lambda x: ~F.coalesce(x.startswith("{"), F.lit(False))))
    problems = (
        _unusable(e["last_updated"], _whole(e["last_updated"])).cast("int")
        + _unusable(e["ttl"], _whole(e["ttl"])).cast("int")
        + F.when(stations.isNull(), 1).otherwise(not_objects)
    )
    parsed = payloads.withColumn("envelope", F.from_json("value", _ENVELOPE))
    return _worked_out(parsed.withColumn("problems", F.when(e.isNull(), 1).otherwise(problems)))


def stations_of(envelopes: DataFrame) -> DataFrame:
    """One row per station of the valid payloads, as JSON text with its position."""
    return envelopes.where("problems = 0").select(
        F.timestamp_seconds(_whole(F.col("envelope.last_updated"))).alias("last_updated"),
        F.posexplode("envelope.data.stations").alias("position", "value"),
    )


def envelope_dead_letters(envelopes: DataFrame, failed_at: Column) -> DataFrame:
    """Whole payloads whose structure cannot be trusted."""
    reason = F.concat(F.lit("invalid_envelope: "), F.col("problems").cast("string"), F.lit(f" {PROBLEMS_WORD}"))
    bad = envelopes.where("problems > 0")
    return _dead_letters(bad, reason, failed_at)


def _dead_letters(rows: DataFrame, reason: Column, failed_at: Column) -> DataFrame:
    letters = rows.withColumns(
        {
            "raw_payload": F.col("value"),
            "error_reason": reason,
            "failed_at": failed_at,
        }
    )
    return conform(letters, STATION_STATUS_DLQ)


# --- station status -------------------------------------------------------------------


def parse_status(rows: DataFrame, text: Column | None = None) -> DataFrame:
    """Add the typed fields of a status record and ``invalid``, its first broken rule."""
    r = F.col("_record")
    counts = {c: _whole(r[c]) for c in (*COUNTS_REQUIRED, *COUNTS_OPTIONAL)}
    flags = {c: _flag(r[c]) for c in FLAGS}
    rules = {"station_id is empty": F.coalesce(r["station_id"], F.lit("")) == ""}
    for name in COUNTS_REQUIRED:
        rules[f"{name} is required"] = r[name].isNull()
    for name, value in counts.items():
        rules[f"{name} is not an integer"] = _unusable(r[name], value)
        rules[f"{name} is negative"] = value < 0
    for name, value in flags.items():
        rules[f"{name} is not a flag"] = _unusable(r[name], value)
    rules["last_reported is not an epoch"] = _unusable(
        r["last_reported"], _whole(r["last_reported"])
    )
    return _worked_out(
        rows.withColumn("_record", F.from_json("value" if text is None else text, _STATUS_TEXT))
        .withColumn("invalid", _first_reason(rules))
        .withColumns({"station_id": r["station_id"], **counts, **flags})
    )


def status_from_payload(
    stations: DataFrame, snapshot_at: Column, ingested_at: Column
) -> tuple[DataFrame, DataFrame]:
    """(status rows, dead letters) of exploded payload stations; times are epoch seconds."""
    parsed = parse_status(stations).withColumns(
        {
            "last_reported": F.timestamp_seconds(_whole(F.col("_record.last_reported"))),
            "snapshot_timestamp": snapshot_at,
            "_ingested_at": ingested_at,
            "_snapshot_date": F.to_date(snapshot_at),
        }
    )
    reason = F.concat(F.lit("invalid_station: "), F.col("invalid"))
    return (
        conform(parsed.where("invalid IS NULL"), STATION_STATUS),
        _dead_letters(parsed.where("invalid IS NOT NULL"), reason, ingested_at),
    )


def status_payloads(payloads: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(status rows, dead letters) of whole payloads; broken envelopes are dead letters whole.

    The snapshot time is the payload's own, or ``now`` where it names none.
    """
    envelopes = parse_envelope(payloads)
    snapshot = F.coalesce("last_updated", now)
    rows, letters = status_from_payload(stations_of(envelopes), snapshot, now)
    return rows, letters.unionByName(envelope_dead_letters(envelopes, now))


def to_messages(status: DataFrame) -> DataFrame:
    """Status rows as (key, value) messages keyed by station, for any streaming sink."""
    body = status.select(
        "station_id",
        F.to_json(
            F.struct(
                "station_id", *COUNTS_REQUIRED, *COUNTS_OPTIONAL, *FLAGS,
                F.unix_seconds("last_reported").alias("last_reported"),
                _iso("last_reported").alias("last_reported_iso"),
                _iso("snapshot_timestamp").alias("snapshot_timestamp"),
            )
        ).alias("value"),
    )
    return body.select(F.col("station_id").alias("key"), "value")


def _iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def decode_messages(
    messages: DataFrame, now: Column, dlq_topic: str = "station_status_dlq"
) -> DataFrame:
    """Messages as status rows, with ``error_reason`` set on those that are dead letters.

    ``messages`` has ``value`` and, when known, ``kafka_topic``, ``kafka_partition`` and
    ``kafka_offset``. An ISO time keeps its clock reading and drops its offset; a message
    without a usable snapshot time is stamped with ``now``.
    """
    names = set(messages.columns)
    missing = {
        c: F.lit(None).cast(t)
        for c, t in (("kafka_topic", "string"), ("kafka_partition", "long"), ("kafka_offset", "long"))
        if c not in names
    }
    r = F.col("_record")
    snapshot = F.coalesce(
        r["snapshot_timestamp"].try_cast("timestamp_ntz").cast("timestamp"), now
    )
    has_id = F.array_contains(F.json_object_keys("value"), "station_id")
    reason = (
        F.when(F.col("kafka_topic") == dlq_topic, PRODUCER_DLQ)
        .when(~F.col("_is_json"), INVALID_JSON)
        .when(~F.coalesce(has_id, F.lit(False)), MISSING_STATION_ID)
        .when(F.col("invalid").isNotNull(), F.concat(F.lit("invalid_station: "), "invalid"))
    )
    judged = messages.withColumns({**missing, "_is_json": F.try_parse_json("value").isNotNull()})
    # a text that is no JSON is read to its end once, not again for its fields
    return (
        parse_status(judged, F.when(F.col("_is_json"), F.col("value")))
        .withColumn("error_reason", reason)
        .withColumns(
            {
                "last_reported": r["last_reported_iso"]
                .try_cast("timestamp_ntz")
                .cast("timestamp"),
                "snapshot_timestamp": snapshot,
                "_ingested_at": now,
                "_snapshot_date": F.to_date(snapshot),
                "raw_payload": F.col("value"),
                "failed_at": now,
            }
        )
        .drop("_record", "invalid", "_is_json")
    )


def status_rows(decoded: DataFrame) -> DataFrame:
    return conform(decoded.where("error_reason IS NULL"), STATION_STATUS)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return conform(decoded.where("error_reason IS NOT NULL"), STATION_STATUS_DLQ)


# --- station information --------------------------------------------------------------


def parse_information(stations: DataFrame, ingested_at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(information rows, rejected records with their first broken rule)."""
    r = F.col("_record")
    numbers = {c: r[c].try_cast("double") for c in ("lat", "lon")}
    capacity = _whole(r["capacity"])
    dispenser = _flag(r["eightd_has_key_dispenser"])
    rules = {"station_id is empty": F.coalesce(r["station_id"], F.lit("")) == ""}
    for name, value in numbers.items():
        rules[f"{name} is not a number"] = _unusable(r[name], value)
    rules["capacity is not an integer"] = _unusable(r["capacity"], capacity)
    rules["eightd_has_key_dispenser is not a flag"] = _unusable(
        r["eightd_has_key_dispenser"], dispenser
    )
    parsed = (
        stations.withColumn("_record", F.from_json("value", _INFORMATION_TEXT))
        .withColumn("error", _first_reason(rules))
        .withColumns(
            {
                **{c: r[c] for c in ("station_id", "name", "short_name", "region_id")},
                **numbers,
                "capacity": capacity,
                "rental_methods": r["rental_methods"],
                "eightd_has_key_dispenser": dispenser,
                "_ingested_at": F.lit(ingested_at).cast("timestamp"),
            }
        )
    )
    return (
        conform(parsed.where("error IS NULL"), STATION_INFORMATION),
        parsed.where("error IS NOT NULL").select("station_id", "error", "value"),
    )


def enforce_payload_quality(rows: DataFrame, rejected: DataFrame, p: Params) -> None:
    """Stop when too large a share of the payload was rejected."""
    sides = rows.select(F.lit(0).alias("bad")).unionByName(rejected.select(F.lit(1).alias("bad")))
    share = F.round(safe_divide(F.sum("bad"), F.nullif(F.count(F.lit(1)), F.lit(0))) * 100, 4)
    pct = sides.agg(share.alias("pct")).first().pct or 0.0
    if pct > p.quarantine_alert_pct:
        raise QualityGateError(f"{pct}% of the station records failed validation")


def read_information(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited station information."""
    return spark.read.schema(STATION_INFORMATION).json(path)


def verify_information(table: DataFrame, expected_rows: int) -> DataFrame:
    """One row: row count as loaded, and at least one capacity."""
    return table.agg(
        F.lit(expected_rows).cast("long").alias("staged_rows"),
        F.count(F.lit(1)).alias("rows_in_table"),
        F.count("capacity").alias("rows_with_capacity"),
    ).withColumn(
        "is_ok",
        (F.col("staged_rows") == F.col("rows_in_table")) & (F.col("rows_with_capacity") > 0),
    )
