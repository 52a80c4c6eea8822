"""Fields of one raw JSON event."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MINIMAL_EVENT, TYPED_EVENT

# RFC 3339 as commonly parsed: one-digit hours, a comma before the fraction and
# offsets up to 24:60 pass. \z, since $ would let a line break through.
RFC3339 = (
    r"^\d{4}-\d{2}-\d{2}T(?:[01]?\d|2[0-3]):[0-5]\d:[0-5]\d(?:[.,]\d+)?"
    r"(?:Z|[+-](?:[01]\d|2[0-4]):(?:[0-5]\d|60))\z"
)

TEXT_FIELDS = ["eventTime", "eventID", "awsRegion", "recipientAccountId", "userIdentity.accountId"]

# How a JSON value that is no text looks once it was read as text.
NOT_TEXT = r"^(?:[-+]?\d[\d.eE+-]*|[{\[].*|true|false|NaN|[-+]?(?:INF|Inf|Infinity))\z"

# The end of both account keys; a pattern that starts with plain letters is found fast.
UNQUOTED_ACCOUNT = r'ccountId"(?!:")'


def _looks_untyped(c: Column) -> Column:
    return F.rlike(c, F.lit("(?s)" + NOT_TEXT))


def _escaped_letters(raw: Column) -> Column:
    """A key may be written with escapes such as \\u0041."""
    def has(text: str) -> Column:
        return F.contains(raw, F.lit(text))

    return has("\\u00") & reduce(lambda a, b: a | b, [has(f"\\u00{d}") for d in "4567"])


def _wrong_type(raw: Column, e: Column) -> Column:
    """A read field holds something other than text or null.

    Few records can: those are parsed once more, with types. Account ids are digits
    in any case, so there it counts whether each such key is directly followed by `:"`.
    """
    suspect = (
        _looks_untyped(F.coalesce(e.getField("eventID"), F.lit("")))
        | _looks_untyped(F.coalesce(e.getField("awsRegion"), F.lit("")))
        | _looks_untyped(F.coalesce(e.getField("eventTime"), F.lit("")))
        | F.rlike(raw, F.lit(UNQUOTED_ACCOUNT)) | _escaped_letters(raw))

    def wrong(typed: Column) -> Column:
        fields = [reduce(lambda c, name: c.getField(name), f.split("."), typed) for f in TEXT_FIELDS]
        kinds = [F.coalesce(F.schema_of_variant(f), F.lit("VOID")) for f in fields]
        return reduce(lambda a, b: a | b, [~k.isin("STRING", "VOID") for k in kinds])

    # As a lambda, the check stays out of the generated code of the common case.
    return F.when(suspect, F.exists(F.array(F.from_json(raw, TYPED_EVENT)), wrong)).otherwise(False)


def project_minimal(records: DataFrame, strict: bool = True) -> DataFrame:
    """Parse `raw` once into the five read fields, plus `malformed`.

    Missing ids and regions become ''. With `strict`, a field of another JSON type
    than text makes the record malformed; without, it is taken as its text.
    """
    raw, e = F.col("raw"), F.col("_e")
    event = F.from_json(raw, MINIMAL_EVENT, {"columnNameOfCorruptRecord": "_bad"})
    # Out of a one-element array: a later filter on the fields cannot move below it,
    # which would parse every record twice.
    parsed = records.select("*", F.explode(F.array(event)).alias("_e"))
    malformed = e.isNull() | F.col("_e._bad").isNotNull()
    if strict:
        malformed = malformed | _wrong_type(raw, e)
    return parsed.withColumns({
        "malformed": malformed,
        "event_time": F.coalesce(F.col("_e.eventTime"), F.lit("")),
        "event_id": F.coalesce(F.col("_e.eventID"), F.lit("")),
        "region": F.coalesce(F.col("_e.awsRegion"), F.lit("")),
        "identity_account_id": F.coalesce(F.col("_e.userIdentity.accountId"), F.lit("")),
        "recipient_account_id": F.coalesce(F.col("_e.recipientAccountId"), F.lit("")),
    }).drop("_e")


def resolve_account(df: DataFrame) -> DataFrame:
    """`account_id`: the recipient, else the caller's account, else null."""
    return df.withColumn("account_id", F.coalesce(
        F.nullif("recipient_account_id", F.lit("")), F.nullif("identity_account_id", F.lit(""))))


def parse_event_time(df: DataFrame) -> DataFrame:
    """Add `time_ok`, `event_micros` (the instant) and the route's date and hour.

    Date and hour are the wall clock of the event's own offset, so they come from
    the text. No session time zone is involved.
    """
    t = F.col("event_time")
    ok = F.rlike(t, F.lit(RFC3339)) & F.substring(t, 1, 10).try_cast("date").isNotNull()
    # Two-digit hour, so that the positions below hold.
    even = F.when(F.substring(t, 13, 1) == ":", F.concat(F.substring(t, 1, 11), F.lit("0"), F.substring(t, 12, 100)))
    df = df.withColumn("time_ok", ok).withColumn("_t", F.when(F.col("time_ok"), even.otherwise(t)))
    n = F.col("_t")

    def part(start: int, size: int) -> Column:
        return F.substring(n, start, size)

    def number(c: Column) -> Column:
        return c.try_cast("bigint")

    zone = F.when(F.endswith(n, F.lit("Z")), F.lit("Z")).otherwise(F.right(n, F.lit(6)))
    offset = F.when(zone == "Z", F.lit(0)).otherwise(
        F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
        * (number(F.substring(zone, 2, 2)) * 3600 + number(F.substring(zone, 5, 2)) * 60))
    digits = F.substring(n, F.lit(21), F.length(n) - 20 - F.length(zone))
    fraction = F.when(F.substring(n, 20, 1).isin(".", ","),
                      number(F.rpad(F.substring(digits, 1, 6), 6, "0"))).otherwise(F.lit(0))
    seconds = (F.unix_date(part(1, 10).try_cast("date")).cast("bigint") * 86400
               + number(part(12, 2)) * 3600 + number(part(15, 2)) * 60 + number(part(18, 2)) - offset)
    return df.withColumns({
        "event_micros": F.when(F.col("time_ok"), seconds * 1_000_000 + fraction),
        "year": part(1, 4), "month": part(6, 2), "day": part(9, 2), "hour": part(12, 2),
    }).drop("_t")
