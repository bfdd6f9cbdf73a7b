"""Avro values of flat records, with a registry's header, in column expressions: no connector package and no Python workers.

A message is a zero byte, the writer's schema id (four bytes, high first) and the record's datum. Records hold fields of
``int``, ``long`` (also ``timestamp-millis``), ``boolean``, ``string``, ``bytes`` and enums, each also nullable by a union with null.
A field that the reader's schema has and the writer's lacks takes its default; one that only the writer has is skipped.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: the first byte, the bytes before the datum, the most bytes of a number.
MAGIC = "00"
HEADER_BYTES = 5
VARINT_BYTES = 10

_SPARK_TYPES = {"int": "INT", "long": "BIGINT", "boolean": "BOOLEAN", "string": "STRING", "bytes": "BINARY", "enum": "STRING"}


class Field:
    """One field of a record: its type without the union, the place of null in the union, an enum's symbols."""

    def __init__(self, field: dict) -> None:
        self.name, kind = field["name"], field["type"]
        self.has_default, self.default = "default" in field, field.get("default")
        self.null_branch = None
        if isinstance(kind, list):
            if len(kind) != 2 or "null" not in kind:
                raise ValueError(f"{self.name}: only unions of null and one type")
            self.null_branch = kind.index("null")
            kind = kind[1 - self.null_branch]
        described = kind if isinstance(kind, dict) else {"type": kind}
        self.kind, self.logical = described["type"], described.get("logicalType")
        if self.kind not in _SPARK_TYPES or self.logical not in (None, "timestamp-millis"):
            raise ValueError(f"{self.name}: no such type here: {kind}")
        self.symbols = described.get("symbols", [])

    @property
    def spark_type(self) -> str:
        return "TIMESTAMP" if self.logical else _SPARK_TYPES[self.kind]


def fields(schema: str) -> list[Field]:
    record = json.loads(schema)
    if record.get("type") != "record":
        raise ValueError("only records")
    return [Field(f) for f in record["fields"]]


def spark_schema(schema: str) -> str:
    return ", ".join(f"`{f.name}` {f.spark_type}" for f in fields(schema))


# --- Writing ---------------------------------------------------------------------------------------------------------
# A datum is put together as hexadecimal text and made bytes at the end.


def _byte(value: Column) -> Column:
    return F.lpad(F.hex(value), 2, "0")


def varint(value: Column) -> Column:
    """A whole number as Avro writes it, in hexadecimal: zig-zag, then seven bits a byte, low ones first."""
    value = value.cast("bigint")
    zigzag = F.shiftleft(value, 1).bitwiseXOR(F.shiftright(value, 63))
    groups = []
    for i in range(VARINT_BYTES):
        rest = F.shiftrightunsigned(zigzag, 7 * i)
        low = rest.bitwiseAND(F.lit(127).cast("bigint"))
        last = F.lit(True) if i == VARINT_BYTES - 1 else F.shiftrightunsigned(zigzag, 7 * (i + 1)) == 0
        byte = _byte(F.when(last, low).otherwise(low.bitwiseOR(F.lit(128).cast("bigint"))))
        groups.append(byte if i == 0 else F.when(rest != 0, byte).otherwise(F.lit("")))
    return F.concat(*groups)


def _datum(field: Field, value: Column) -> Column:
    if field.logical:
        return varint(F.unix_millis(value.cast("timestamp")))
    if field.kind in ("int", "long"):
        return varint(value)
    if field.kind == "boolean":
        return F.when(value, F.lit("01")).otherwise(F.lit("00"))
    if field.kind == "enum":
        place = reduce(lambda found, s: found.when(value == s[1], F.lit(s[0])), enumerate(field.symbols), F.when(F.lit(False), F.lit(0)))
        return varint(F.coalesce(place, F.raise_error(F.concat(F.lit(f"{field.name}: no such symbol: "), value)).cast("int")))
    content = value.cast("binary")
    return F.concat(varint(F.octet_length(content)), F.hex(content))


def _field(field: Field, value: Column) -> Column:
    if field.null_branch is None:
        missing = F.raise_error(F.lit(f"{field.name}: null where the schema wants a value")).cast("string")
        return F.when(value.isNull(), missing).otherwise(_datum(field, value))
    present = F.concat(varint(F.lit(1 - field.null_branch)), _datum(field, value))
    return F.when(value.isNull(), varint(F.lit(field.null_branch))).otherwise(present)


def encode(records: DataFrame, schema: str, schema_id: int) -> Column:
    """The message of each row of ``records``, whose columns have the names of the schema's fields.

    Null where the schema has no union with null, and a symbol that an enum lacks, fail the job.
    """
    known = {c.lower() for c in records.columns}
    wanted = fields(schema)
    if lacking := [f.name for f in wanted if f.name.lower() not in known]:
        raise ValueError(f"no columns for the fields {lacking}")
    header = F.lit(f"{MAGIC}{schema_id:08X}")
    return F.unhex(F.concat(header, *(_field(f, F.col(f"`{f.name}`")) for f in wanted)))


# --- Reading ---------------------------------------------------------------------------------------------------------


def _number(value: Column, start: Column, count: int) -> Column:
    """``count`` bytes from ``start`` (from 1) as a number, high byte first; bytes beyond the end count as zero."""
    return F.conv(F.rpad(F.hex(F.substring(value, start, F.lit(count))), 2 * count, "0"), 16, 10).cast("bigint")


def _read_varint(rows: DataFrame, value: str, at: str, number: str) -> DataFrame:
    """Add ``number``, read from place ``at``, and move ``at`` past it. A number cut short fails the job."""
    # Seven bytes fit into a positive long; the other three are read apart.
    rows = rows.withColumns({"_high": _number(F.col(value), F.col(at), 7), "_low": _number(F.col(value), F.col(at) + 7, 3)})
    one = [F.shiftrightunsigned("_high", 8 * (6 - i)) if i < 7 else F.shiftrightunsigned("_low", 8 * (9 - i)) for i in range(VARINT_BYTES)]
    byte = [b.bitwiseAND(F.lit(255).cast("bigint")) for b in one]
    length = reduce(lambda found, i: found.when(byte[i] < 128, F.lit(i + 1)), range(1, VARINT_BYTES), F.when(byte[0] < 128, F.lit(1)))
    rows = rows.withColumn("_length", length)
    bits = [
        F.when(F.col("_length") > i, F.shiftleft(byte[i].bitwiseAND(F.lit(127).cast("bigint")), 7 * i)).otherwise(F.lit(0).cast("bigint"))
        for i in range(VARINT_BYTES)
    ]
    rows = rows.withColumn("_zigzag", reduce(lambda a, b: a.bitwiseOR(b), bits))
    whole = F.shiftrightunsigned("_zigzag", 1).bitwiseXOR(-F.col("_zigzag").bitwiseAND(F.lit(1).cast("bigint")))
    inside = F.col("_length").isNotNull() & (F.col(at) + F.col("_length") - 1 <= F.octet_length(value))
    cut = F.raise_error(F.lit("the message ends within a number")).cast("bigint")
    rows = rows.withColumn(number, F.when(F.col(value).isNull(), None).when(inside, whole).otherwise(cut))
    return rows.withColumn(at, F.col(at) + F.col("_length")).drop("_high", "_low", "_length", "_zigzag")


def _read_field(rows: DataFrame, field: Field, value: str, at: str, name: str) -> DataFrame:
    if field.null_branch is not None:
        # Where the branch is null nothing follows: what would be read is not used, and the place stays.
        rows = _read_varint(rows, value, at, "_branch")
        rows = rows.withColumns({"_kept": F.col(at), "_source": F.col(value)})
        rows = rows.withColumn(value, F.when(F.col("_branch") != field.null_branch, F.col(value)))
        rows = _read_field(rows, _plain(field), value, at, name)
        rows = rows.withColumn(at, F.when(F.col("_branch") == field.null_branch, F.col("_kept")).otherwise(F.col(at)))
        return rows.withColumn(value, F.col("_source")).drop("_branch", "_kept", "_source")
    if field.kind == "boolean":
        found = F.substring(F.col(value), F.col(at), F.lit(1))
        cut = F.raise_error(F.lit("the message ends before a field")).cast("boolean")
        read = F.when(F.col(value).isNull(), None).when(F.octet_length(found) == 1, F.hex(found) == "01").otherwise(cut)
        return rows.withColumn(name, read).withColumn(at, F.col(at) + 1)
    rows = _read_varint(rows, value, at, "_read")
    read = F.col("_read")
    if field.logical:
        rows = rows.withColumn(name, F.timestamp_millis(read))
    elif field.kind in ("int", "long"):
        rows = rows.withColumn(name, read.cast(field.spark_type))
    elif field.kind == "enum":
        symbols = F.create_map(*chain(*((F.lit(i).cast("bigint"), F.lit(s)) for i, s in enumerate(field.symbols))))
        unknown = F.raise_error(F.lit(f"{field.name}: no such place in the enum")).cast("string")
        rows = rows.withColumn(name, F.when(read.isNull(), None).otherwise(F.coalesce(F.try_element_at(symbols, read), unknown)))
    else:
        content = F.substring(F.col(value), F.col(at), read.cast("int"))
        cut = F.raise_error(F.lit("the message ends within a field")).cast("binary")
        whole = F.when(read.isNull(), None).when(F.octet_length(content) == read, content).otherwise(cut)
        rows = rows.withColumn(name, whole.cast(field.spark_type)).withColumn(at, F.col(at) + read.cast("int"))
    return rows.drop("_read")


def _plain(field: Field) -> Field:
    plain = object.__new__(Field)
    plain.__dict__ = {**field.__dict__, "null_branch": None}
    return plain


def decode(
    messages: DataFrame, schema: str, schema_id: int | None = None, reader: str | None = None, column: str = "value"
) -> DataFrame:
    """The records of messages, batch or stream: a column per field of ``reader`` (if not given, of the writer's ``schema``).

    Other columns of ``messages`` stay, before them. A message that is null gives a row of nulls. A wrong first byte, another
    ``schema_id`` than the one named, and a message that is too short or too long fail the job.
    """
    written = fields(schema)
    kept = [c for c in messages.columns if c != column]
    if reserved := [c for c in kept if c.startswith("_")]:
        raise ValueError(f"columns {reserved} begin like the decoder's own")
    head = F.hex(F.substring(F.col("_value"), F.lit(1), F.lit(HEADER_BYTES)))
    right = head.startswith(MAGIC) if schema_id is None else head == f"{MAGIC}{schema_id:08X}"
    wrong = F.raise_error(F.concat(F.lit("not a message of this schema, it begins with "), head)).cast("binary")
    value = F.col(column).cast("binary")
    rows = messages.select(*(F.col(f"`{c}`") for c in kept), value.alias("_value"))
    rows = rows.withColumn("_value", F.when(F.col("_value").isNull() | right, F.col("_value")).otherwise(wrong))
    rows = rows.withColumn("_at", F.lit(HEADER_BYTES + 1))
    for i, field in enumerate(written):
        rows = _read_field(rows, field, "_value", "_at", f"_field{i}")
    places = {f.name: i for i, f in enumerate(written)}
    ends = F.col("_value").isNull() | (F.col("_at") == F.octet_length("_value") + 1)
    columns = []
    for field in fields(reader or schema):
        if field.name in places:
            found = F.col(f"_field{places[field.name]}").cast(field.spark_type)
        elif field.has_default:
            found = F.when(F.col("_value").isNotNull(), F.lit(field.default)).cast(field.spark_type)
        else:
            raise ValueError(f"{field.name} was not written and has no default")
        trailing = F.raise_error(F.lit("the message goes on after its record")).cast(field.spark_type)
        columns.append(F.when(ends, found).otherwise(trailing).alias(field.name))
    # A filter on a field would be moved down field by field, and with it a copy of all that was read before each. A generator
    # stops it, so that a message is read once.
    return rows.select(*(F.col(f"`{c}`") for c in kept), F.inline(F.array(F.struct(*columns))))
