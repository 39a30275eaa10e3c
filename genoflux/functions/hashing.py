"""Row fingerprints: MD5 over the canonical JSON of a record.

The canonical form writes every field (nulls included) in ascending field
order, with map keys sorted, exactly as the record sink writes it.  With
``framing='java'`` the digest is taken over the bytes a Java object stream
produces for a byte array holding that JSON (stream header + array class
descriptor + 4-byte big-endian length + payload), so digests equal those of
a writer that hashed its serialised byte array that way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import sorted_map

# Fixed value: Java object-stream framing of a byte[] (magic, version,
# TC_ARRAY, class descriptor of "[B" with its serialVersionUID, no fields,
# end of block data, no superclass).
JAVA_BYTE_ARRAY_PREFIX_HEX = "ACED0005757200025B42ACF317F8060854E00200007870"


def canonical_struct(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Struct of ``cols`` in ascending name order; maps get sorted keys."""
    cols = sorted(cols if cols is not None else df.columns)
    types = dict(df.dtypes)
    fields = []
    for c in cols:
        col = F.col(f"`{c}`")
        if types.get(c, "").startswith("map<"):
            col = sorted_map(col)
        fields.append(col.alias(c))
    return F.struct(*fields)


def canonical_json(struct_col: Column) -> Column:
    return F.to_json(struct_col, {"ignoreNullFields": "false"})


def md5_of_json(json_col: Column, framing: str = "plain") -> Column:
    if framing == "plain":
        return F.md5(json_col)
    if framing == "java":
        payload = F.encode(json_col, "UTF-8")
        length = F.unhex(F.lpad(F.hex(F.octet_length(payload)), 8, "0"))
        return F.md5(F.concat(F.unhex(F.lit(JAVA_BYTE_ARRAY_PREFIX_HEX)), length, payload))
    raise ValueError(f"unknown framing {framing!r}")


def row_md5(df: DataFrame, cols: Sequence[str] | None = None, framing: str = "plain") -> Column:
    """MD5 hex fingerprint of the record formed by ``cols``."""
    return md5_of_json(canonical_json(canonical_struct(df, cols)), framing)
