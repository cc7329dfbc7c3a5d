"""Customer risk: customers decoded from a nested envelope, joined to risk scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import base64_text, first_of, leading_part, text_of
from ..operators.joins import salted_join
from ..operators.keyed import last_per_key
from ..operators.messages import json_fields
from ..session import stage

#: Parts into which a customer's scores, and its records, are split as state.
SALTS, RECORD_SALTS = 8, 2

OUTPUT = ["customer", "score", "email", "birthYear"]


def envelopes_from(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return json_fields(messages, text_of(F.col("value")), schemas.SORTED_SET, keep)


def customers_from(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Customers with an email and a birthday, from the first entry of each sorted set.

    bytes → JSON → first entry → base64 → JSON. Other messages have no entry
    that decodes to a customer and fall to the not-null filter.
    """
    entry = base64_text(first_of(F.col("zSetEntries"), "element"))
    parsed = json_fields(envelopes_from(messages, keep), entry, schemas.CUSTOMER, keep)
    present = parsed.filter(F.col("email").isNotNull() & F.col("birthDay").isNotNull())
    return present.withColumn("birthYear", leading_part(F.col("birthDay")))


def risks_from(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return json_fields(messages, text_of(F.col("value")), schemas.RISK, keep)


def customer_risk(customers: DataFrame, risks: DataFrame, salts: int | None = None,
                  record_salts: int | None = None) -> DataFrame:
    """Every score with every record of its customer, whenever either arrives.

    As a stream-stream join without a time bound this keeps all rows of both
    sides as state. A customer's scores are split over ``salts`` state partitions and its
    records over ``record_salts``, each side repeated for every part of the other. By default
    streams are split and tables are not, since Spark splits hot keys of tables at run time.
    Keep the numbers for the life of a checkpoint.
    """
    streaming = customers.isStreaming or risks.isStreaming
    salts = salts or (SALTS if streaming else 1)
    record_salts = record_salts or (RECORD_SALTS if streaming else 1)
    people = customers.select("email", "birthYear")
    scores = risks.select("customer", "score")
    return salted_join(scores, people, "customer", "email", salts, record_salts).select(*OUTPUT)


def customer_risk_bounded(customers: DataFrame, risks: DataFrame, within: str,
                          lateness: str = "60 minutes", time: str = "timestamp") -> DataFrame:
    """The same join for scores within an interval of the customer's record.

    Both inputs carry the message ``time``; with a watermark on each, rows that
    can no longer match leave the state.
    """
    people = customers.select("email", "birthYear", F.col(time).alias("customer_time")) \
        .withWatermark("customer_time", lateness)
    scores = risks.select("customer", "score", F.col(time).alias("risk_time")) \
        .withWatermark("risk_time", lateness)
    return scores.join(people, F.expr(
        f"customer = email AND risk_time >= customer_time - INTERVAL {within} "
        f"AND risk_time <= customer_time + INTERVAL {within}"), "inner").select(*OUTPUT)


def customer_risk_latest(customers: DataFrame, risks: DataFrame, order: list[str]) -> DataFrame:
    """Scores with the last record of their customer: at most one row per score.

    ``customers`` is a batch table here; ``risks`` may be a stream, which then
    needs no state at all. The last records are written once for a stream, whose micro-batches
    would otherwise each compute them again; they are those at its start.
    """
    people = last_per_key(customers, ["email"], order).select("email", "birthYear")
    if risks.isStreaming:
        people = stage(people, "latest-customers")
    return risks.select("customer", "score").join(
        people, F.col("customer") == F.col("email"), "inner").select(*OUTPUT)
