"""User and password for the database."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sluice.plans.specs import Endpoint

# Fixed value: Hadoop's setting for the credential provider path.
PROVIDER_PATH = "hadoop.security.credential.provider.path"


def check_credentials(source: Endpoint) -> None:
    """All or none: what is there must lead to a user and a password."""
    if source.get("credentialProviderPath") and not _alias(source):
        source.require("passwordAlias")
    if _alias(source) or source.get("password") is not None:
        source.require("user")


def connection_properties(spark: SparkSession, source: Endpoint) -> dict[str, str]:
    """Reader properties; none if the connection URL carries the credentials itself.

    The password is either the option ``password`` or looked up by its alias
    (``passwordAlias``, or ``alias``) in a Hadoop credential store.
    """
    check_credentials(source)
    password = source.get("password")
    if password is None and _alias(source):
        password = _look_up(spark, _alias(source), source)
    pairs = {"user": source.get("user"), "password": password}
    return {name: value for name, value in pairs.items() if value is not None}


def _alias(source: Endpoint) -> str | None:
    return source.get("passwordAlias") or source.get("alias")


def _look_up(spark: SparkSession, alias: str, source: Endpoint) -> str:
    # A copy, so that the session's own configuration stays as it is.
    conf = spark._jvm.org.apache.hadoop.conf.Configuration(spark._jsc.hadoopConfiguration())
    provider = source.get("credentialProviderPath")
    if provider:
        conf.set(PROVIDER_PATH, provider)
    found = conf.getPassword(alias)
    if found is None:
        raise ValueError(
            f"endpoint '{source.name}': no password under the alias '{alias}'"
            f" in {conf.get(PROVIDER_PATH) or 'the configured credential providers'}"
        )
    return "".join(found)
