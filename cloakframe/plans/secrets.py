"""Key material for a job, kept out of query plans.

A literal key would show in ``explain()``, in the UI and in generated column
names.  Here the values live in a one-row DataFrame and enter a query as
scalar subqueries, which plans show by name only.
"""

from __future__ import annotations

import base64
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions.protection import SecretColumns

# Environment names of the base64 key and of the salt.
KEY_ENV = "ENCRYPTION_KEY"
SALT_ENV = "HASH_SALT"
TOKEN_KEY_ENV = "TOKEN_KEY"
KEY_BYTES = 32

KEY_COLUMN, SALT_COLUMN, TOKEN_KEY_COLUMN = "__cf_key", "__cf_salt", "__cf_token_key"


@dataclass(frozen=True, repr=False)
class Secrets:
    """AES key (exactly 32 bytes), hash salt and token key.

    There is no random default: a key nobody stored is data nobody can read.
    """

    key: bytes | None = None
    salt: str = ""
    token_key: str | None = None

    def __post_init__(self) -> None:
        if self.key is not None and len(self.key) != KEY_BYTES:
            raise ValueError(f"AES-256 needs a key of {KEY_BYTES} bytes, got {len(self.key)}")

    @staticmethod
    def from_env() -> Secrets:
        encoded = os.environ.get(KEY_ENV)
        return Secrets(
            base64.b64decode(encoded) if encoded else None,
            os.environ.get(SALT_ENV, ""),
            os.environ.get(TOKEN_KEY_ENV),
        )

    def check(self, methods: list[str]) -> None:
        if "aes256_encrypt" in methods and self.key is None:
            raise ValueError("the policy encrypts: an AES key is required")
        if "tokenization" in methods and not self.token_key:
            raise ValueError("the policy tokenizes: a token key is required")

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the three secret columns, as scalar subqueries."""
        spark: SparkSession = df.sparkSession
        row = [(bytearray(self.key) if self.key else None, self.salt, self.token_key or "")]
        frame = spark.createDataFrame(row, "k binary, s string, t string")
        return df.withColumns(
            {
                KEY_COLUMN: frame.select("k").scalar(),
                SALT_COLUMN: frame.select("s").scalar(),
                TOKEN_KEY_COLUMN: frame.select("t").scalar(),
            }
        )


def secret_columns() -> SecretColumns:
    return SecretColumns(F.col(KEY_COLUMN), F.col(SALT_COLUMN), F.col(TOKEN_KEY_COLUMN))
