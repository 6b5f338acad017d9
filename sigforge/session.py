"""Spark sessions, and this package on the executors' path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def s3_credentials(env: dict[str, str]) -> dict[str, str]:
    """Hadoop settings for S3 from environment-like values: keys, keys with a session token, or the default chain.

    One half of a key pair without the other is an error.
    """
    key, secret, token = (env.get(k) or "" for k in ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY", "AWS_SESSION_TOKEN"))
    if bool(key) != bool(secret):
        raise ValueError("AWS_ACCESS_KEY_ID and AWS_SECRET_ACCESS_KEY must be set together")
    if token and not key:
        raise ValueError("AWS_SESSION_TOKEN needs a key pair")
    prefix = "spark.hadoop.fs.s3a"
    if not key:
        return {f"{prefix}.aws.credentials.provider": "com.amazonaws.auth.DefaultAWSCredentialsProviderChain"}
    conf = {f"{prefix}.access.key": key, f"{prefix}.secret.key": secret}
    if token:
        conf |= {f"{prefix}.session.token": token, f"{prefix}.aws.credentials.provider": "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"}
    return conf


def build_session(app: str = "sigforge", master: str | None = None, conf: dict[str, str] | None = None, env: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution and UTC; credentials only if `env` is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (base | (s3_credentials(env) if env is not None else {}) | (conf or {})).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Put this package on the path of the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="sigforge-"), "sigforge.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(to)
    _shipped.add(app)
