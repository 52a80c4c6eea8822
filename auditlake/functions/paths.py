"""Object paths: `[prefix/]AWSLogs/[org/]account/CloudTrail/region/...`."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the folder layout.
LOGS_FOLDER = "AWSLogs/"
TRAIL_FOLDER = "CloudTrail"
ORG_PATTERN = r"o-[^/]*"

# Below the base prefix. The organization level is taken whenever it is there
# (possessive `?+`).
ACCOUNT_PATTERN = rf"(?:({ORG_PATTERN})/)?+([^/]+)/"
PAIR_PATTERN = rf"{ACCOUNT_PATTERN}{TRAIL_FOLDER}/([^/]+)/"


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def base_prefix(prefix) -> Column:
    p = _text(prefix)
    return F.concat(F.when(p != "", F.concat(p, F.lit("/"))).otherwise(""), F.lit(LOGS_FOLDER))


def search_prefix(base, org, account, region=None) -> Column:
    o = _text(org)
    parts = [
        _text(base),
        F.when(o != "", F.concat(o, F.lit("/"))).otherwise(""),
        _text(account),
        F.lit(f"/{TRAIL_FOLDER}/"),
    ]
    if region is not None:
        parts += [_text(region), F.lit("/")]
    return F.concat(*parts)


def extract_below(key, prefix, pattern: str, group: int) -> Column:
    """A group of `pattern` right below the base prefix of a key, '' where it does not match."""
    anchored = F.concat(F.lit(r"^\Q"), base_prefix(prefix), F.lit(r"\E" + pattern))
    return F.call_function("regexp_extract", F.col(key) if isinstance(key, str) else key, anchored, F.lit(group))


def parse_object_key(objects: DataFrame) -> DataFrame:
    """Add `org_id`, `account_id`, `region`; '' where the key has no such folder."""
    return objects.withColumns({
        name: extract_below("key", "prefix", PAIR_PATTERN, i)
        for i, name in enumerate(("org_id", "account_id", "region"), start=1)
    })


def is_account_id(c) -> Column:
    return F.rlike(_text(c), F.lit(r"^[0-9]{12}\z"))


def _bare(path: Column) -> Column:
    """Drop scheme and leading slashes: `file:/a`, `file:///a` and `/a` are one place."""
    return F.regexp_replace(path, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/+", "")


def decoded(uri) -> Column:
    """Undo the %-escapes of `_metadata.file_path` ('+' stands for itself there)."""
    return F.url_decode(F.replace(F.col(uri) if isinstance(uri, str) else uri, F.lit("+"), F.lit("%2B")))


def bare_path(path) -> Column:
    return _bare(F.col(path) if isinstance(path, str) else path)


def object_key(path, root: str) -> Column:
    """Key of an object below the bucket root it was listed from."""
    bare = bare_path(path)
    stem = F.concat(_bare(F.lit(root.rstrip("/"))), F.lit("/"))
    return F.substring(bare, F.instr(bare, stem) + F.length(stem), F.length(bare))


def glob_escaped(path: str) -> str:
    """`glob_literal` of a known path."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def glob_literal(path) -> Column:
    """A path as a load pattern that stands for that very path."""
    return F.regexp_replace(path, r"([{}\[\]*?\\])", r"\\$1")
