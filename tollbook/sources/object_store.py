"""Session settings for reading and writing through an S3-compatible store."""

from __future__ import annotations


def s3a_conf(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    """Settings for ``s3a://`` paths; give them to the session builder before start."""
    # Spark's names of these settings.
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
