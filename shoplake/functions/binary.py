"""Decimals carried as the big-endian two's-complement bytes of their unscaled value."""

from pyspark.sql import Column, functions as F


def decode_decimal(raw: Column, precision: int = 10, scale: int = 2) -> Column:
    """Signed bytes to ``decimal(precision, scale)``.

    Null for empty input, for more than eight bytes and for values that do not
    fit the target type.
    """
    digits = F.hex(raw)
    fill = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    signed = F.conv(F.lpad(digits, 16, fill), 16, -10).cast("bigint")
    unscaled = F.when(F.length(raw).between(1, 8), signed).cast("decimal(19,0)")
    step = F.expr(f"CAST({10 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale}))")
    return (unscaled * step).try_cast(f"decimal({precision},{scale})")


def encode_decimal(amount: Column, scale: int = 2) -> Column:
    """Inverse of :func:`decode_decimal`."""
    unscaled = F.round(amount * F.lit(10 ** scale)).cast("bigint")
    digits = F.hex(unscaled)
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    needs_sign_byte = (unscaled >= 0) & (F.substring(even, 1, 1) >= "8")
    return F.unhex(F.when(needs_sign_byte, F.concat(F.lit("00"), even)).otherwise(even))
