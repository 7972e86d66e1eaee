"""The JSON envelope in which a job reports its outcome."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the two keys of the envelope.
ENVELOPE = "status string, message string"


def build(status: Column, message: Column) -> Column:
    """Envelope text; a NULL message stays in it as null."""
    body = F.struct(status.alias("status"), message.alias("message"))
    return F.to_json(body, {"ignoreNullFields": "false"})


def parse(envelope: Column) -> Column:
    """Struct (status, message) of an envelope text."""
    return F.from_json(envelope, ENVELOPE)
