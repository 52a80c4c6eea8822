"""Which accounts and regions hold data."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import ACCOUNT_PATTERN, extract_below, is_account_id, parse_object_key
from ..schemas import LOG_SUFFIX


def _known_account(strict_accounts: bool) -> Column:
    """Standalone accounts must be 12 digits; below an organization any folder counts."""
    ok = is_account_id("account_id")
    return ok if strict_accounts else ok | ((F.col("org_id") != "") & (F.col("account_id") != ""))


def discover_accounts(objects: DataFrame, strict_accounts: bool = False) -> DataFrame:
    """Distinct `(bucket, org_id, account_id)`, with or without trail logs in them."""
    return (objects
            .select("bucket",
                    extract_below("key", "prefix", ACCOUNT_PATTERN, 1).alias("org_id"),
                    extract_below("key", "prefix", ACCOUNT_PATTERN, 2).alias("account_id"))
            .filter(_known_account(strict_accounts))
            .distinct())


def discover_account_regions(objects: DataFrame, strict_accounts: bool = False) -> DataFrame:
    """Distinct `(bucket, org_id, account_id, region)` that hold trail logs."""
    return (parse_object_key(objects)
            .filter(_known_account(strict_accounts) & (F.col("region") != ""))
            .select("bucket", "org_id", "account_id", "region")
            .distinct())


def log_objects(objects: DataFrame, strict_accounts: bool = False) -> DataFrame:
    """The objects an ingest reads, with `org_id`, `account_id` and `region`."""
    return (parse_object_key(objects.filter(F.endswith("key", F.lit(LOG_SUFFIX))))
            .filter(_known_account(strict_accounts) & (F.col("region") != "")))
