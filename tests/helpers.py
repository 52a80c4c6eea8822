import gzip
import json
import os

from auditlake import IngestOptions, Trail

TRAIL = Trail("t", "b", "")


def event(event_id, time="2024-01-01T05:06:07Z", account="000000000001", region="us-east-1", **more):
    return json.dumps({"eventTime": time, "eventID": event_id, "awsRegion": region,
                       "recipientAccountId": account, **more}, separators=(",", ":"))


def log(*records):
    return '{"Records":[' + ",".join(records) + "]}"


def put(root, key, body, compress=True, cut=0):
    """Write one object of bucket `b`."""
    path = os.path.join(str(root), "b", key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = body if isinstance(body, bytes) else body.encode()
    if compress:
        data = gzip.compress(data)
    with open(path, "wb") as f:
        f.write(data[:len(data) - cut])
    return path


def key(name, account="000000000001", region="us-east-1", prefix="", org=""):
    parts = [prefix, "AWSLogs", org, account, "CloudTrail", region, name]
    return "/".join(p for p in parts if p)


def options(root, **changes):
    return IngestOptions(bucket_uri=str(root) + "/{bucket}", **changes)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())
