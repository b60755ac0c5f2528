"""Connection options for Kafka and for Kafka on AWS (IAM or SCRAM login)."""

from __future__ import annotations

from collections.abc import Mapping

# Login modules and mechanisms the brokers expect.
SECURITY_PROTOCOL = "SASL_SSL"
IAM_MECHANISM = "AWS_MSK_IAM"
IAM_LOGIN_MODULE = "software.amazon.msk.auth.iam.IAMLoginModule"
IAM_CALLBACK_HANDLER = "software.amazon.msk.auth.iam.IAMClientCallbackHandler"
SCRAM_MECHANISM = "SCRAM-SHA-512"
SCRAM_LOGIN_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"


def _prefixed(client: Mapping[str, str]) -> dict[str, str]:
    return {f"kafka.{name}": str(value) for name, value in client.items()}


def _no_quotes(**values: str) -> None:
    for name, value in values.items():
        if value is None:
            raise ValueError(f"{name} must not be null")
        if '"' in value:
            raise ValueError(f"{name} must not contain a double-quote character")


def merged(fixed: Mapping[str, str], extras: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of any other connector: extras pass through, the named settings win."""
    return {**(extras or {}), **fixed}


def kafka(
    servers: str, group: str | None = None, extras: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Plain client options; the named settings win over extras."""
    fixed = {"bootstrap.servers": servers}
    if group is not None:
        fixed["group.id"] = group
    return _prefixed(merged(fixed, extras))


def iam_login(
    servers: str, region: str, group: str | None = None, extras: Mapping[str, str] | None = None
) -> dict[str, str]:
    """IAM login; extras win over the security settings, not over servers and group."""
    _no_quotes(region=region)
    security = {
        "security.protocol": SECURITY_PROTOCOL,
        "sasl.mechanism": IAM_MECHANISM,
        "sasl.jaas.config": f'{IAM_LOGIN_MODULE} required awsRegion="{region}";',
        "sasl.client.callback.handler.class": IAM_CALLBACK_HANDLER,
    }
    return kafka(servers, group, {**security, **(extras or {})})


def scram_login(
    servers: str,
    user: str,
    password: str,
    group: str | None = None,
    extras: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """SCRAM-SHA-512 login; extras win over the security settings."""
    _no_quotes(username=user, password=password)
    security = {
        "security.protocol": SECURITY_PROTOCOL,
        "sasl.mechanism": SCRAM_MECHANISM,
        "sasl.jaas.config": f'{SCRAM_LOGIN_MODULE} required username="{user}" password="{password}";',
    }
    return kafka(servers, group, {**security, **(extras or {})})
