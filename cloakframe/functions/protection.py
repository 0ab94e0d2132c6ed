"""Protection methods as column expressions, and the registry that names them.

Every method leaves null and empty text as it is.  Keys and salts are columns
(see ``plans.secrets``), so their values stay out of plans and column names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of protected text and the redaction mark.
ENC_PREFIX = "ENC:"
HASH_PREFIX = "HASH:"
REDACTED = "[REDACTED]"
TOKEN_LENGTH = 16


@dataclass(frozen=True)
class Options:
    """Rule options; also the defaults of a rule without any."""

    mask_char: str = "*"
    visible_chars: int = 4
    direction: str = "right"
    token_prefix: str = "TOK_"

    def column(self) -> Column:
        return F.struct(
            F.lit(self.mask_char).alias("mask_char"),
            F.lit(self.visible_chars).alias("visible_chars"),
            F.lit(self.direction).alias("direction"),
            F.lit(self.token_prefix).alias("token_prefix"),
        )


@dataclass(frozen=True)
class SecretColumns:
    """Where the methods find key material: binary key, salt, token key."""

    key: Column
    salt: Column
    token_key: Column


Builder = Callable[[Column, Column, SecretColumns], Column]


def mask(text: Column, options: Column) -> Column:
    """Keep ``visible_chars`` at one end or in the centre; length never changes.

    Text not longer than the visible part is masked whole.
    """
    length = F.length(text)
    n = options.visible_chars
    hidden = length - n
    front = F.floor(hidden / F.lit(2)).cast("int")
    return (
        F.when((n <= 0) | (length <= n), F.repeat(options.mask_char, length))
        .when(options.direction == "left", F.concat(F.left(text, n), F.repeat(options.mask_char, hidden)))
        .when(
            options.direction == "center",
            F.concat(
                F.repeat(options.mask_char, front),
                F.substring(text, front + 1, n),
                F.repeat(options.mask_char, hidden - front),
            ),
        )
        .otherwise(F.concat(F.repeat(options.mask_char, hidden), F.right(text, n)))
    )


def sha256_hash(text: Column, salt: Column) -> Column:
    return F.concat(F.lit(HASH_PREFIX), F.sha2(F.concat(salt, text), 256))


def sha256_verify(text: Column, hashed: Column, salt: Column) -> Column:
    """Whether ``hashed`` is the hash of ``text``; false for anything not a hash."""
    return F.startswith(hashed, F.lit(HASH_PREFIX)) & (sha256_hash(text, salt) == hashed)


def aes256_encrypt(text: Column, key: Column) -> Column:
    """AES-256-CBC with PKCS7 padding: ``ENC:`` + base64(iv + ciphertext).

    The IV hashes the key with a random UUID: unique per value, not guessable
    without the key, and non-deterministic to the optimizer, which otherwise
    would fold equal inputs into one ciphertext.
    """
    iv = F.unhex(F.substring(F.sha2(F.concat(F.hex(key), F.uuid()), 256), 1, 32))
    sealed = F.aes_encrypt(text, key, F.lit("CBC"), F.lit("PKCS"), iv)
    right_size = F.when(F.length(key) == 32, sealed).otherwise(
        F.raise_error(F.lit("AES-256 needs a 32-byte key")).cast("binary")
    )
    # base64() breaks lines every 76 characters by default.
    return F.concat(F.lit(ENC_PREFIX), F.translate(F.base64(right_size), "\r\n", ""))


def aes256_decrypt(text: Column, key: Column) -> Column:
    """``struct(value, error)``: one of the two is null; empty text passes."""
    payload = F.try_to_binary(F.substring(text, F.lit(len(ENC_PREFIX) + 1), F.length(text)), F.lit("base64"))
    plain = F.try_aes_decrypt(payload, key, F.lit("CBC"), F.lit("PKCS")).cast("string")
    error = (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(~F.startswith(text, F.lit(ENC_PREFIX)), "value is not encrypted")
        .when(payload.isNull(), "payload is not base64")
        .when(F.length(payload) < 32, "payload is too short")
        .when(plain.isNull(), "wrong key or damaged payload")
    )
    return F.struct(
        F.when(text == "", text).when(error.isNull(), plain).alias("value"), error.alias("error")
    )


def keyed_token(text: Column, prefix: Column, token_key: Column) -> Column:
    """Prefix + 16 characters of ``[0-9A-Z]`` derived from a keyed hash.

    Equal values get equal tokens on every executor and every retry without a
    lookup; two 40-bit blocks make a collision improbable, and registering the
    tokens in a vault checks for one.
    """
    digest = F.sha2(F.concat_ws("\u0000", token_key, prefix, text), 256)

    def block(first: int) -> Column:
        return F.lpad(F.conv(F.substring(digest, first, 10), 16, 36), TOKEN_LENGTH // 2, "0")

    return F.concat(prefix, block(1), block(11))


@dataclass(frozen=True)
class Method:
    name: str
    build: Builder
    reversible: bool = False


METHODS: dict[str, Method] = {}


def register_protection(name: str, build: Builder, reversible: bool = False) -> None:
    """Add a method under ``name``: ``build(text, options, secrets) -> Column``.

    A null result means the method failed for that text.
    """
    METHODS[name] = Method(name, build, reversible)


register_protection("aes256_encrypt", lambda t, o, s: aes256_encrypt(t, s.key), reversible=True)
register_protection("sha256_hash", lambda t, o, s: sha256_hash(t, s.salt))
register_protection("masking", lambda t, o, s: mask(t, o))
register_protection(
    "tokenization", lambda t, o, s: keyed_token(t, o.token_prefix, s.token_key), reversible=True
)
register_protection("redact", lambda t, o, s: F.lit(REDACTED))


def method_named(name: str) -> Method:
    if name not in METHODS:
        raise KeyError(f"Unknown protection method: {name}")
    return METHODS[name]


def protect_by_name(
    text: Column, method: Column, options: Column, secrets: SecretColumns, names: list[str]
) -> Column:
    """One expression for a per-row method; only ``names`` are compiled in."""
    case = None
    for name in names:
        value = method_named(name).build(text, options, secrets)
        test = method == F.lit(name)
        case = F.when(test, value) if case is None else case.when(test, value)
    return F.when(text.isNull() | (text == ""), text).otherwise(case)


def protect_col(
    text: Column, method: str, options: Options = Options(), secrets: SecretColumns | None = None
) -> Column:
    """A whole column under one method."""
    found = method_named(method)
    none = SecretColumns(F.lit(None).cast("binary"), F.lit(""), F.lit(""))
    value = found.build(text, options.column(), secrets or none)
    return F.when(text.isNull() | (text == ""), text).otherwise(value)


def unprotect_col(text: Column, method: str, secrets: SecretColumns) -> Column:
    """``struct(value, error)`` for AES; one-way methods refuse at plan time."""
    found = method_named(method)
    if not found.reversible:
        raise NotImplementedError(f"{method} is not reversible")
    if method == "tokenization":
        raise ValueError("tokens are resolved against a vault table: use operators.vault.detokenize")
    return aes256_decrypt(text, secrets.key)

