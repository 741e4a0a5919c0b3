"""Addresses and prefixes as fixed-width integers.

An address is ``(family, hi, lo)``: IPv4 uses ``lo`` only, IPv6 two 64-bit halves.  Prefix keys are
the same triple with the host bits cleared, so every address join is an equi join on longs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = f"^({_OCTET}[.]){{3}}{_OCTET}$"
_GROUPS = "([0-9a-f]{1,4}:)*[0-9a-f]{1,4}"


def _shl(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits.cast("int"))


def is_ipv4(c: Column) -> Column:
    return c.rlike(IPV4_PATTERN)


def ipv4_value(c: Column) -> Column:
    """Dotted text -> 0..2^32-1, null if not an address."""
    octets = F.split(c, r"\.")
    value = sum((F.get(octets, i).try_cast("bigint") * (256 ** (3 - i)) for i in range(1, 4)),
                F.get(octets, 0).try_cast("bigint") * 256 ** 3)
    return F.when(is_ipv4(c), value)


def ipv4_text(value: Column) -> Column:
    """0..2^32-1 -> dotted text."""
    return F.concat_ws(".", *[(F.shiftright(value, s).bitwiseAND(255)).cast("string") for s in (24, 16, 8, 0)])


def ip_version(c: Column) -> Column:
    return F.when(c.contains(":"), 6).otherwise(4)


# One SQL text rather than nested Python calls: ``transform(array(x), v -> ..)[0]`` binds a value once.
_ADDRESS = """
CASE
WHEN <ip> RLIKE '<v4 pattern>' THEN named_struct('family', 4, 'hi', 0L, 'lo', <v4>)
WHEN contains(<ip>, ':') THEN
  transform(array(lower(<ip>)), ip ->
  -- a dotted IPv4 tail becomes two hex groups
  transform(array(CASE WHEN NOT contains(ip, '.') THEN ip
    WHEN substring_index(ip, ':', -1) RLIKE '<v4 pattern>' THEN
      concat(left(ip, length(ip) - length(substring_index(ip, ':', -1))),
        concat_ws(':', lower(hex(shiftright(<tail>, 16))), lower(hex(<tail> & 65535)))) END), plain ->
  -- hex groups left and right of '::', null where malformed
  transform(array(transform(split(plain, '::', -1), side ->
    CASE WHEN side = '' THEN array() WHEN side RLIKE '^<groups>$' THEN split(side, ':') END)), sides ->
  transform(array(CASE
    WHEN size(sides) = 1 AND size(get(sides, 0)) = 8 THEN get(sides, 0)
    WHEN size(sides) = 2 AND size(get(sides, 0)) + size(get(sides, 1)) <= 7 THEN
      concat(get(sides, 0), array_repeat('0', 8 - size(get(sides, 0)) - size(get(sides, 1))), get(sides, 1)) END), groups ->
  transform(array(array_join(transform(groups, g -> lpad(g, 4, '0')), '')), digits ->
  transform(array(named_struct('hi', bigint(conv(left(digits, 16), 16, -10)), 'lo', bigint(conv(right(digits, 16), 16, -10)))), n ->
    CASE WHEN n.hi = 0 AND shiftrightunsigned(n.lo, 32) = 65535 THEN named_struct('family', 4, 'hi', 0L, 'lo', n.lo & 4294967295L)
         WHEN n.hi IS NOT NULL THEN named_struct('family', 6, 'hi', n.hi, 'lo', n.lo) END)[0])[0])[0])[0])[0])[0]
END""".replace("<v4 pattern>", IPV4_PATTERN).replace("<groups>", _GROUPS)


def _ipv4_sql(text: str) -> str:
    octet = lambda i: f"try_cast(get(split({text}, '[.]'), {i}) AS BIGINT)"
    return f"({octet(0)} * 16777216 + {octet(1)} * 65536 + {octet(2)} * 256 + {octet(3)})"


def address(column: str) -> Column:
    """``(family, hi, lo)`` of a text address column, null if it is none; mapped IPv6 becomes IPv4."""
    ip = f"trim(string(`{column}`))"
    tail = _ipv4_sql("substring_index(ip, ':', -1)")
    return F.expr(_ADDRESS.replace("<ip>", ip).replace("<v4>", _ipv4_sql(ip)).replace("<tail>", tail))


def with_address(df: DataFrame, ip: str, family: str = "family", hi: str = "hi", lo: str = "lo") -> DataFrame:
    """Add the integer form of a text address; all three are null when the text is no address.

    The text is split once, and four numbers that give the same text again are an IPv4 address; only texts with a colon
    reach the expression for IPv6.  Both steps are a generator's output, so they run once per row and later predicates
    are not pushed below them as copies.
    """
    text = F.trim(F.col(f"`{ip}`").cast("string"))
    split = df.select("*", F.explode(F.array(F.struct(text.alias("t"), F.split(text, r"\.", 5).alias("p")))).alias("_text"))
    part = [F.get("_text.p", F.lit(i)).try_cast("int") for i in range(4)]
    small = (part[0].bitwiseOR(part[1]).bitwiseOR(part[2]).bitwiseOR(part[3])).between(0, 255)
    is_v4 = (F.size("_text.p") == 4) & small & (F.concat_ws(".", *[p.cast("string") for p in part]) == F.col("_text.t"))
    value = ((part[0].cast("bigint") * 256 + part[1]) * 256 + part[2]) * 256 + part[3]
    v4 = F.struct(F.lit(4).alias("family"), F.lit(0).cast("bigint").alias("hi"), value.alias("lo"))
    parsed = split.select(
        *df.columns, F.explode(F.array(F.when(F.coalesce(is_v4, F.lit(False)), v4).when(F.col("_text.t").contains(":"), address(ip)))).alias("_addr"))
    return parsed.select(
        *[F.col(f"`{n}`") for n in df.columns],
        F.col("_addr.family").alias(family), F.col("_addr.hi").alias(hi), F.col("_addr.lo").alias(lo))


def network_hi(family: Column, hi: Column, length: Column) -> Column:
    """Upper half with the bits below the prefix length cleared."""
    ones = F.lit(-1).cast("bigint")
    return (
        F.when((family == 4) | (length == 0), F.lit(0).cast("bigint"))
        .when(length >= 64, hi)
        .otherwise(hi.bitwiseAND(_shl(ones, F.lit(64) - length)))
    )


def network_lo(family: Column, lo: Column, length: Column) -> Column:
    """Lower half with the bits below the prefix length cleared."""
    ones = F.lit(-1).cast("bigint")
    return (
        F.when(length == 0, F.lit(0).cast("bigint"))
        .when(family == 4, lo.bitwiseAND(_shl(ones, F.lit(32) - length)))
        .when(length <= 64, F.lit(0).cast("bigint"))
        .otherwise(lo.bitwiseAND(_shl(ones, F.lit(128) - length)))
    )


def length_is_valid(family: Column, length: Column) -> Column:
    return F.coalesce(length.between(0, F.when(family == 4, 32).otherwise(128)), F.lit(False))


def cidr_struct(text: Column) -> Column:
    """``"10.0.0.0/8"`` -> ``(ip, len)``; anything but two parts with a whole-number length -> null."""
    parts = F.split(text, "/", -1)
    length = F.get(parts, F.lit(1)).try_cast("int")
    return F.when(
        (F.size(parts) == 2) & length.isNotNull(),
        F.struct(F.get(parts, F.lit(0)).alias("ip"), length.alias("len")),
    )


def _looks_like_v6(c: Column) -> Column:
    low = F.lower(c)
    shape = low.rlike(r"^[0-9a-f:]+(\d+(\.\d+){3})?$") & (~low.contains(":::"))
    compressed = low.rlike(rf"^({_GROUPS})?::({_GROUPS}(\.\d+){{0,3}})?$")
    full = low.rlike(r"^([0-9a-f]{1,4}:){7}[0-9a-f]{1,4}$") | low.rlike(r"^([0-9a-f]{1,4}:){6}\d+(\.\d+){3}$")
    groups = F.size(F.filter(F.split(low, ":"), lambda g: g != ""))
    return shape & ((compressed & (groups <= 7)) | full)


def address_or_cidr(text: Column) -> Column:
    """Address list items: a CIDR as is, a bare address with /32 or /128, anything else null."""
    bare = F.when(is_ipv4(text), F.struct(text.alias("ip"), F.lit(32).alias("len"))).when(
        _looks_like_v6(text), F.struct(text.alias("ip"), F.lit(128).alias("len")))
    head, tail = F.substring_index(text, "/", 1), F.regexp_extract(text, r"^[^/]*/(.*)$", 1)
    length = tail.try_cast("int")
    cidr = F.when(length.isNotNull(), F.struct(head.alias("ip"), length.alias("len")))
    return F.when(text.contains("/"), cidr).otherwise(bare)
