"""HMAC-SHA256 signatures as Catalyst expressions.

HMAC(K, m) = H((K' ^ opad) || H((K' ^ ipad) || m)), with K' the key padded
to the 64-byte block (hashed first when longer).  The two padded keys depend
only on the key, so they are computed once on the driver and enter the plan
as binary literals; the per-row work is two built-in ``sha2`` calls.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.jsoncodec import encode_json

BLOCK = 64
# Fixed value: the header that carries the signature of a body.
SIG_HEADER = "HashSHA256"


def _pads(key: str) -> tuple[bytes, bytes]:
    k = key.encode("utf-8")
    if len(k) > BLOCK:
        k = hashlib.sha256(k).digest()
    k = k.ljust(BLOCK, b"\x00")
    return bytes(b ^ 0x36 for b in k), bytes(b ^ 0x5C for b in k)


def hmac_sha256_hex(body: Column | str, key: str) -> Column:
    """Lower-case hex HMAC-SHA256 of the UTF-8 bytes of ``body``."""
    b = F.col(body) if isinstance(body, str) else body
    ipad, opad = _pads(key)
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), b.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(opad), inner), 256)


def verify_signature(body: Column | str, signature: Column | str, key: str | None) -> Column:
    """Status of the signature check: 200 when the key or the signature is
    empty (nothing to check) or when they match, else 400."""
    sig = F.col(signature) if isinstance(signature, str) else signature
    if not key:
        return F.lit(200)
    return (
        F.when(sig.isNull() | (sig == ""), F.lit(200))
        .when(sig == hmac_sha256_hex(body, key), F.lit(200))
        .otherwise(F.lit(400))
    )


def sign_rows(df: DataFrame, key: str | None, cols=("id", "type", "delta", "value"), newline: bool = True) -> DataFrame:
    """Add ``body`` (the JSON of the row) and ``signature``.

    The single-update sender signs the encoder output including its trailing
    newline; ``newline=False`` signs the bare JSON.  No key, no signature."""
    body = encode_json(cols)
    if newline:
        body = F.concat(body, F.lit("\n"))
    out = df.withColumn("body", body)
    sig = hmac_sha256_hex(F.col("body"), key) if key else F.lit(None).cast("string")
    return out.withColumn("signature", sig)
