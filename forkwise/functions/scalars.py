"""Scalar functions of the chain domain, all of them column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stored enums use.
CHANGE_KINDS = ("created", "modified", "destroyed", "touched")
STATUSES = ("active", "reorged")
REVERT_TABLES = ("account_diffs", "storage_diffs", "receipt_artifacts", "canonical_blocks")

ZERO_HASH = "0x" + "0" * 64
BLOOM_BYTES = 256


def change_kind(old: Column, new: Column) -> Column:
    """Kind of a change between two account structs; null where the account is on neither side.

    Existence is that of the struct: a present account with null fields is not absent.
    """
    differs = ~(old["balance"].eqNullSafe(new["balance"]) & old["nonce"].eqNullSafe(new["nonce"]) & old["code_hash"].eqNullSafe(new["code_hash"]))
    return (
        F.when(old.isNull() & new.isNull(), F.lit(None).cast("string"))
        .when(old.isNull(), F.lit("created"))
        .when(new.isNull(), F.lit("destroyed"))
        .when(differs, F.lit("modified"))
        .otherwise(F.lit("touched"))
    )


def strict_enum(value: Column, allowed: tuple[str, ...]) -> Column:
    """``value``, or an error where it is none of ``allowed``."""
    return F.when(value.isin(*allowed), value).otherwise(F.raise_error(F.concat(F.lit("unknown value: "), F.coalesce(value, F.lit("null")))))


def lenient_status(value: Column) -> Column:
    """Status as an explicit decoder of old data reads it: whatever isn't known is active."""
    return F.when(value.isin(*STATUSES), value).otherwise(F.lit("active"))


def lenient_change_kind(value: Column) -> Column:
    return F.when(value.isin(*CHANGE_KINDS), value).otherwise(F.lit("touched"))


def lenient_table(value: Column) -> Column:
    return F.when(value.isin(*REVERT_TABLES), value).otherwise(F.lit("account_diffs"))


def u256(text: Column) -> Column:
    """Canonical decimal text of a 256-bit number, null if it is none.

    Only digits count; leading zeros go. 78 digits are the most that 2**256 - 1 has.
    """
    limit = str(2**256 - 1)
    digits = F.regexp_replace(F.when(text.rlike(r"^[0-9]+$"), text), r"^0+(?=.)", "")
    n = F.length(digits)
    return F.when((n < len(limit)) | ((n == len(limit)) & (digits <= limit)), digits)


def u256_or_zero(text: Column) -> Column:
    return F.coalesce(u256(text), F.lit("0"))


def to_hex(data: Column) -> Column:
    return F.lower(F.concat(F.lit("0x"), F.hex(data)))


def from_hex(text: Column) -> Column:
    """Bytes of ``0x`` text; null if it isn't hex."""
    return F.unhex(F.substring(F.when(text.rlike(r"^0x([0-9a-fA-F]{2})*$"), text), 3, 1 << 30))


def hash_text(text: Column) -> Column:
    """A 32-byte hash in its canonical text; null if it isn't one."""
    return F.lower(F.when(text.rlike(r"^0x[0-9a-fA-F]{64}$"), text))


def address_text(text: Column) -> Column:
    return F.lower(F.when(text.rlike(r"^0x[0-9a-fA-F]{40}$"), text))


def number_address(n: Column) -> Column:
    """The address whose last bytes are ``n``."""
    return F.concat(F.lit("0x"), F.lower(F.lpad(F.hex(n), 40, "0")))


def number_hash(n: Column) -> Column:
    """The hash whose last bytes are ``n``."""
    return F.concat(F.lit("0x"), F.lower(F.lpad(F.hex(n), 64, "0")))


def fork_hash(number: Column, fork: Column) -> Column:
    """Deterministic block hash: the number in eight bytes, the fork in one, then zeros."""
    return F.concat(F.lit("0x"), F.lower(F.lpad(F.hex(number.cast("bigint")), 16, "0")), F.lower(F.lpad(F.hex(fork.cast("bigint")), 2, "0")), F.lit("0" * 46))


def block_key(block_hash: Column) -> Column:
    return F.to_json(F.struct(block_hash.alias("block_hash")))


def account_key(block_hash: Column, address: Column) -> Column:
    return F.to_json(F.struct(block_hash.alias("block_hash"), address.alias("address")))


def storage_key(block_hash: Column, address: Column, slot: Column) -> Column:
    return F.to_json(F.struct(block_hash.alias("block_hash"), address.alias("address"), slot.alias("slot")))


def receipt_key(block_hash: Column, tx_index: Column) -> Column:
    return F.to_json(F.struct(block_hash.alias("block_hash"), tx_index.alias("tx_index")))


def parsed_key(key: Column) -> Column:
    """Struct of a key's parts; those that its table doesn't have are null. Text that is no JSON object is an error."""
    kind = "block_hash string, address string, slot string, tx_index int"
    return F.from_json(key, kind, {"mode": "FAILFAST"})


def bloom(data: Column) -> Column:
    """``data`` padded with zeros or cut to 256 bytes."""
    zeros = F.unhex(F.lit("00" * BLOOM_BYTES))
    return F.substring(F.concat(F.coalesce(data, F.unhex(F.lit(""))), zeros), 1, BLOOM_BYTES)


def before(number: Column) -> Column:
    """The height below ``number``, no lower than zero; null is zero."""
    return F.greatest(F.coalesce(number, F.lit(0)) - 1, F.lit(0)).cast("bigint")


# --- recursive length prefix, on hex text -------------------------------------


def _even_hex(n: Column) -> Column:
    h = F.lower(F.hex(n))
    return F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)


def rlp_number(n: Column) -> Column:
    """Hex of the encoding of a number from 0 up to 2**63 - 1."""
    h = _even_hex(n)
    prefix = F.lower(F.hex((F.lit(0x80) + F.length(h) / 2).cast("bigint")))
    return F.when(n == 0, F.lit("80")).when(n < 128, h).otherwise(F.concat(prefix, h))


def rlp_list(payload: Column) -> Column:
    """Hex of the list whose encoded items are the hex text ``payload``."""
    n = (F.length(payload) / 2).cast("bigint")
    size = _even_hex(n)
    long = F.concat(F.lower(F.hex((F.lit(0xF7) + F.length(size) / 2).cast("bigint"))), size)
    return F.concat(F.when(n < 56, F.lower(F.hex(F.lit(0xC0) + n))).otherwise(long), payload)


def receipt_rlp(status: Column, cumulative_gas: Column, log_bloom: Column | None = None, logs_hex: Column | None = None, tx_type: Column | None = None) -> Column:
    """Bytes of an encoded receipt: the list of status, gas, bloom and logs; a typed one has its type byte before that."""
    filter_hex = F.lit("00" * BLOOM_BYTES) if log_bloom is None else F.lower(F.hex(bloom(log_bloom)))
    body = F.concat(F.when(status, F.lit("01")).otherwise(F.lit("80")), rlp_number(cumulative_gas), F.lit("b90100"), filter_hex, F.lit("c0") if logs_hex is None else logs_hex)
    encoded = rlp_list(body)
    if tx_type is not None:
        encoded = F.concat(F.when(F.coalesce(tx_type, F.lit(0)) > 0, F.lower(F.lpad(F.hex(tx_type), 2, "0"))).otherwise(F.lit("")), encoded)
    return F.unhex(encoded)
