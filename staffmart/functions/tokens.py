"""Keyed tokens for personal identifiers: HMAC-SHA256 by column, with the key's version.

``token(v) = "<key id>." || HMAC-SHA256(secret, "<field>:" || str(v))`` — two
nested built-in ``sha2``, evaluated in the JVM. Equal values of one field have
equal tokens in every job, so the vault and the public table always join; equal
values of different fields (a tax number that is also an identity number) have
different ones. The key id tells which secret made a token, so that tables can
be re-keyed one by one (``operators.privacy.rotate``). The secret is required:
identifiers such as an 11-digit tax number can be enumerated, so an unkeyed
hash would be reversible.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SECRET_CONF = "spark.staffmart.pseudonym.secret"
KEY_ID_CONF = "spark.staffmart.pseudonym.key.id"
REDACTION_CONF = "spark.sql.redaction.string.regex"
FIRST_KEY = "1"

# Fixed values of HMAC-SHA256: block size, and the bytes that both pads repeat.
_BLOCK, _INNER, _OUTER = 64, 0x36, 0x5C


@dataclass(frozen=True)
class TokenKey:
    """A secret and its version, which every token names."""

    secret: str
    key_id: str = FIRST_KEY

    def pads(self) -> tuple[bytes, bytes]:
        """The inner and the outer padded key."""
        key = self.secret.encode()
        key = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
        return bytes(b ^ _INNER for b in key), bytes(b ^ _OUTER for b in key)

    def __repr__(self) -> str:
        return f"TokenKey(key_id={self.key_id!r})"


def as_key(key: TokenKey | str) -> TokenKey:
    return TokenKey(key) if isinstance(key, str) else key


def key_from_conf(spark: SparkSession) -> TokenKey:
    value = spark.conf.get(SECRET_CONF, None)
    if not value:
        raise ValueError(f"set {SECRET_CONF} (a per-deployment secret) before pseudonymising")
    key = TokenKey(value, spark.conf.get(KEY_ID_CONF, None) or FIRST_KEY)
    hide_key(spark, key)
    return key


def hide_key(spark: SparkSession, key: TokenKey | str) -> None:
    """Keep the secret, and the padded keys made of it, out of printed plans in this session."""
    key = as_key(key)
    own = "|".join([re.escape(key.secret), *(f"(?i:{pad.hex()})" for pad in key.pads())])
    before = spark.conf.get(REDACTION_CONF, None)
    if not before:
        spark.conf.set(REDACTION_CONF, own)
    elif own not in before:
        spark.conf.set(REDACTION_CONF, f"{before}|{own}")


def hmac_sha256(message: Column, key: TokenKey) -> Column:
    """Lowercase hex HMAC-SHA256 of a string or binary column."""
    inner, outer = (F.lit(pad) for pad in key.pads())
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def token(c: Column | str, key: TokenKey | str, field: str) -> Column:
    """NULL stays NULL; anything else becomes ``<key id>.<64 lowercase hex digits>``.

    ``field`` names what the value is (``cpf``), the same in all tables.
    """
    key = as_key(key)
    value = F.col(c) if isinstance(c, str) else c
    message = F.concat(F.lit(f"{field}:"), value.cast("string"))
    return F.concat(F.lit(f"{key.key_id}."), hmac_sha256(message, key))


def key_id_of(c: Column | str) -> Column:
    """The version of the key that made a token."""
    return F.substring_index(F.col(c) if isinstance(c, str) else c, ".", 1)
