"""Decoding of SNMP table indexes (I9, H8, H9) and the rule formats (H7)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bit layout of the vendor's 32-bit port id (TIMETRA-TC-MIB, TmnxPortID).
INVALID_PORT = 0x1E000000
TYPE_SHIFT = 29
SLOT_SHIFT, SLOT_BITS = 25, 4
MDA_SHIFT, MDA_BITS = 21, 4
PORT_SHIFT, PORT_BITS = 15, 6
CHANNEL_BITS = 15
VIRTUAL_BITS = 9
LAG_BITS = 8
LAG_FLAG_SHIFT = 28
BREAKOUT_FIELDS = ((18, 5), (14, 4), (6, 6), (0, 6))  # slot, mda, connector, port


def _bits(value: Column, shift: int, width: int) -> Column:
    return F.shiftright(value, shift).bitwiseAND((1 << width) - 1).cast("string")


def port_name(raw: Column) -> Column:
    """32-bit port id -> ``slot/mda/port[.channel]``, ``virtual-n``, ``lag-n`` or ``s/m/cX/Y``."""
    value = raw.try_cast("bigint")
    kind = F.shiftright(value, TYPE_SHIFT).bitwiseAND(7)
    physical = F.concat_ws(
        "/", _bits(value, SLOT_SHIFT, SLOT_BITS), _bits(value, MDA_SHIFT, MDA_BITS), _bits(value, PORT_SHIFT, PORT_BITS))
    slot, mda, connector, port = (_bits(value, *f) for f in BREAKOUT_FIELDS)
    named = (
        F.when(kind == 0, physical)
        .when(kind == 1, F.concat(physical, F.lit("."), _bits(value, 0, CHANNEL_BITS)))
        .when(kind == 2, F.when(_bits(value, LAG_FLAG_SHIFT, 1) == "0",
                                F.concat(F.lit("virtual-"), _bits(value, 0, VIRTUAL_BITS)))
              .otherwise(F.concat(F.lit("lag-"), _bits(value, 0, LAG_BITS))))
        .when(kind == 3, F.concat_ws("/", slot, mda, F.concat(F.lit("c"), connector), port))
    )
    return F.when(value != INVALID_PORT, named)


def _sap_parts(raw: Column) -> Column:
    return F.split(raw, r"\.", -1)


def sap_name(raw: Column) -> Column:
    """``svc.port.encap[.queue]`` -> ``svc-portname-encap``; null if it has another shape."""
    parts = _sap_parts(raw)
    name = port_name(F.get(parts, 1))
    return F.when(
        F.size(parts).between(3, 4) & name.isNotNull(),
        F.concat_ws("-", F.get(parts, 0), name, F.get(parts, 2)),
    )


def sap_queue(raw: Column) -> Column:
    """Queue number of a four-part access point id, else null."""
    parts = _sap_parts(raw)
    return F.when((F.size(parts) == 4) & port_name(F.get(parts, 1)).isNotNull(), F.get(parts, 3))


def _hex_octet(value: Column) -> Column:
    text = F.lower(F.hex(value))
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def address_text(raw: Column) -> Column:
    """``type.octets.dotted`` -> IPv4 text or long-form IPv6; anything else null."""
    parts = F.split(F.trim(raw), r"\.", -1)
    kind = F.get(parts, 0).try_cast("bigint")
    octets = F.slice(parts, 3, 16)
    values = F.transform(octets, lambda o: o.try_cast("bigint"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.concat(_hex_octet(F.get(values, 2 * i)), _hex_octet(F.get(values, 2 * i + 1))),
    )
    v4 = F.when(F.size(parts) == 6, F.array_join(octets, "."))
    v6 = F.when((F.size(parts) == 18) & F.forall(values, lambda v: v.isNotNull()), F.array_join(pairs, ":"))
    return F.when(F.size(parts) >= 6, F.when(kind == 1, v4).when(kind == 2, v6))


def positional_pattern(pattern: str) -> tuple[str, dict[str, int]]:
    """Named groups -> positions, since Java group names may not hold ``_``; the match is anchored."""
    positions = dict(re.compile(pattern).groupindex)
    return "^(?:" + re.sub(r"\(\?P<\w+>", "(", pattern) + ")", positions
