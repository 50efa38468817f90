"""Object-store settings (s3a) built from the environment.

Returned as a plain dict of ``spark.hadoop.fs.s3a.*`` keys so a caller can pass
it to ``SparkSession.builder.config(map=...)`` or ``spark-submit --conf``.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from urllib.parse import urlparse

# What the connector needs for an S3-compatible store. Timeouts, retries and
# block sizes keep the connector's own defaults; the connection pool is sized
# for executors with many concurrent column-chunk reads.
S3A_DEFAULTS = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "spark.hadoop.fs.s3a.path.style.access": "true",
    "spark.hadoop.fs.s3a.connection.maximum": "1000",
}


def s3a_conf(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """s3a settings from ``AWS_ENDPOINT``, ``AWS_ACCESS_KEY_ID``,
    ``AWS_SECRET_ACCESS_KEY``; missing credentials fall back to the default
    provider chain (instance roles)."""
    env = os.environ if env is None else env
    conf = dict(S3A_DEFAULTS)
    endpoint = env.get("AWS_ENDPOINT")
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    key, secret = env.get("AWS_ACCESS_KEY_ID"), env.get("AWS_SECRET_ACCESS_KEY")
    if key and secret:
        conf["spark.hadoop.fs.s3a.access.key"] = key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return conf


def require_uri(path: str) -> str:
    """Paths must carry a scheme (``s3a://``, ``file:/``, ``hdfs://``...), so a
    bucket name is never silently read as a local folder."""
    if not urlparse(path).scheme:
        raise ValueError(f"path needs a scheme (e.g. s3a://bucket/raw/): {path!r}")
    return path
