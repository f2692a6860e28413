"""Object-store access. Layers are addressed by URI (``s3a://bucket/prefix/...``); this
module only builds the connector options for the session builder. Credentials are passed in
by the caller (or left to the connector's default provider chain) and never read here."""

from __future__ import annotations


def s3a_options(access_key: str | None = None, secret_key: str | None = None,
                endpoint: str | None = None, path_style: bool = False,
                credentials_provider: str | None = None) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for ``get_session(extra_conf=...)``."""
    conf = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    if credentials_provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = credentials_provider
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if path_style:
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return conf
