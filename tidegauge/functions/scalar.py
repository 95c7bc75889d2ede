"""Small column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def travel_minutes(start, end) -> Column:
    """Minutes between two timestamps, with millisecond resolution."""
    def ms(t: Column) -> Column:
        return F.unix_millis(t.cast("timestamp"))
    return (ms(_c(end)) - ms(_c(start))) / F.lit(60000.0)


def standardize(value, mean: float, std: float) -> Column:
    return ((_c(value) - F.lit(float(mean))) / F.lit(float(std))).cast("float")


def argmax(scores) -> Column:
    """Zero-based position of the first largest element of an array."""
    return (F.array_position(_c(scores), F.array_max(_c(scores))) - 1).cast("int")


def class_to_tag(cls) -> Column:
    return F.when(_c(cls) == 0, F.lit("normal")).otherwise(F.lit("anomaly"))


def tag_to_class(tag) -> Column:
    return F.when(F.lower(_c(tag)) == "normal", F.lit(0)).otherwise(F.lit(1))


def default_key(key, default: str = "cpu") -> Column:
    return F.when(_c(key) == "", F.lit(default)).otherwise(_c(key))


def model_key(name) -> Column:
    """Model name as used in keys: spaces become underscores."""
    return F.replace(_c(name), F.lit(" "), F.lit("_"))


def model_text(name, description, data_type, model_type) -> Column:
    """One-line text of a model descriptor."""
    return F.concat_ws(" | ", model_key(name), _c(description), _c(data_type), _c(model_type))


def request_id() -> Column:
    """A new random request key. It is not repeatable, so add it once, at ingestion, and
    store it with the record."""
    return F.uuid()
