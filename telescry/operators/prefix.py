"""Longest-prefix joins (C7, D3, D5, D12) as equi joins, by binary search on prefix lengths.

The lengths that occur in an index are a sorted list per family.  A probe compares its network of the middle length with the
index; a hit sends it to the longer half, a miss to the shorter one.  So that a hit tells of longer prefixes, every prefix leaves
markers: its own network cut to each shorter length at which a search for it turns to longer ones.  A marker's best match, the longest
prefix that covers it, is worked out beforehand, so a search that a marker has led astray need not turn back.  That takes
at most 6 equi joins on ``(family, length, network)`` for IPv4 and 8 for IPv6, with one row per distinct address.  An index with no
more lengths than that is read in one join, with a row per address and length.

The index is never collected and may be far larger than memory.  Its lengths and their counts (at most 162 rows) are, and where
these prove that prefixes and markers are few, they are broadcast.  Index and markers are stored once (``searchable``, or
exported with the index), so that the steps of a search read small tables and share one broadcast or one exchange each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.functions.net import length_is_valid, network_hi, network_lo, with_address
from telescry.session import stored_table

_KEY = ["family", "plen", "hi", "lo"]


def prefix_keys(df: DataFrame, ip: str, length: str) -> DataFrame:
    """Replace text address and length by the integer prefix key; invalid prefixes are dropped."""
    keyed = with_address(df, ip).withColumn("plen", F.col(length).cast("int"))
    keyed = keyed.filter(F.col("family").isNotNull() & length_is_valid(F.col("family"), F.col("plen")))
    family, plen = F.col("family"), F.col("plen")
    return keyed.withColumn("hi", network_hi(family, F.col("hi"), plen)).withColumn(
        "lo", network_lo(family, F.col("lo"), plen))


def subnet_index(rows: DataFrame, payload: Sequence[str], subnets: str = "ip_subnet", order: str = "id") -> DataFrame:
    """One row per prefix with ``payload``; a prefix listed twice keeps the row with the largest id."""
    usable = rows.filter(F.col(order).isNotNull())
    if "ref" in payload:
        usable = usable.filter(F.col("ref").isNotNull())
    items = usable.select(order, *[c for c in payload if c != order], F.explode(subnets).alias("_net"))
    items = items.select("*", F.col("_net.ip").alias("_net_ip"), F.col("_net.len").alias("_net_len"))
    keyed = prefix_keys(items, "_net_ip", "_net_len")
    best = keyed.groupBy(*_KEY).agg(F.max_by(F.struct(*payload), order).alias("payload"))
    return best.select(*_KEY, *[F.col(f"payload.{c}").alias(c) for c in payload])


#: Prefixes and markers up to this number (of some 40 bytes each) are broadcast.
BROADCAST_ROWS = 400_000
#: Lengths per family up to which each is looked up: as many as the steps of a search over all lengths.
FEW_LENGTHS = {4: 6, 6: 8}


def search_path(at: int, n: int) -> list[int]:
    """Places in a sorted list of ``n`` lengths where a search that ends at place ``at`` turns to longer ones."""
    low, high, out = 0, n - 1, []
    while low <= high:
        middle = (low + high) // 2
        if middle == at:
            break
        if middle < at:
            out.append(middle)
            low = middle + 1
        else:
            high = middle - 1
    return out


def _network(hi: str = "_hi", lo: str = "_lo", length: str = "plen") -> list[Column]:
    return [network_hi(F.col("family"), F.col(hi), F.col(length)).alias("hi"), network_lo(F.col("family"), F.col(lo), F.col(length)).alias("lo")]


def _by_family(values: Mapping[int, Column], otherwise: Column) -> Column:
    out = otherwise
    for family, value in values.items():
        out = F.when(F.col("family") == family, value).otherwise(out)
    return out


@dataclass(frozen=True)
class PrefixIndex:
    """A subnet index ready for searches: ``counts`` of its prefixes by (family, length), and as ``entries`` its prefixes and markers with
    ``best``, the length of the longest prefix that covers them (None where lengths are so few that no search is needed)."""

    rows: DataFrame
    entries: DataFrame | None
    counts: Mapping[tuple[int, int], int]

    @property
    def lengths(self) -> dict[int, list[int]]:
        return {f: sorted(n for g, n in self.counts if g == f) for f in {f for f, _ in self.counts}}

    @property
    def few(self) -> bool:
        """Whether the counts prove that prefixes and markers are no more than ``BROADCAST_ROWS``."""
        lengths = self.lengths
        return sum(c * (1 + len(search_path(lengths[f].index(n), len(lengths[f])))) for (f, n), c in self.counts.items()) <= BROADCAST_ROWS


def length_counts(index: DataFrame) -> DataFrame:
    """family, plen, count: at most 162 rows."""
    return index.groupBy("family", "plen").count()


def counts_of(rows: DataFrame) -> dict[tuple[int, int], int]:
    return {(r["family"], r["plen"]): r["count"] for r in rows.collect()}


def searchable(index: DataFrame) -> PrefixIndex:
    """Store an index and its search entries in the shared folder."""
    rows = stored_table(index, "prefixes")
    counts = counts_of(length_counts(rows))
    return PrefixIndex(rows, stored_table(search_entries(rows, counts), "prefix-search") if needs_search(counts) else None, counts)


def needs_search(counts: Mapping[tuple[int, int], int]) -> bool:
    """Whether a family has more lengths than a search has steps at most."""
    return any(sum(f == g for g, _ in counts) > most for f, most in FEW_LENGTHS.items())


def search_entries(index: DataFrame, counts: Mapping[tuple[int, int], int]) -> DataFrame:
    """family, plen, hi, lo, best of prefixes and markers."""
    keys = index.select(*_KEY)
    lengths = {f: sorted(n for g, n in counts if g == f) for f in {f for f, _ in counts}}
    paths = {f: [[own[k] for k in search_path(at, len(own))] for at in range(len(own))] for f, own in lengths.items()}
    none = F.array().cast("array<int>")
    turns = _by_family({
        f: F.create_map(*[x for n, path in zip(lengths[f], own) for x in (F.lit(n), F.array(*map(F.lit, path)).cast("array<int>"))])[F.col("plen")] for f, own in paths.items()}, none)
    cut = keys.select("family", F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.explode(turns).alias("plen"))
    markers = cut.select("family", "plen", *_network()).distinct().join(keys, _KEY, "left_anti")
    # shorter prefixes that cover a marker; only markers are expanded, never probes
    shorter = _by_family({f: F.array(*map(F.lit, own)).cast("array<int>") for f, own in lengths.items()}, none)
    wide = markers.select("family", F.col("plen").alias("_len"), F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.explode_outer(F.filter(shorter, lambda n: n < F.col("plen"))).alias("plen"))
    covers = wide.select("*", *_network()).join(keys.select(*_KEY, F.col("plen").alias("_best")), _KEY, "left")
    found = covers.groupBy("family", F.col("_len").alias("plen"), F.col("_hi").alias("hi"), F.col("_lo").alias("lo")).agg(F.max("_best").alias("best"))
    return keys.withColumn("best", F.col("plen")).unionByName(found)


def _best_match(probes: DataFrame, index: DataFrame | PrefixIndex, payload: Sequence[str], key: str) -> DataFrame:
    """Most specific payload per probe; probes have ``key, family, hi, lo`` and optionally ``_max_len``, the longest length that counts."""
    search = index if isinstance(index, PrefixIndex) else searchable(index)
    limit = ["_max_len"] if "_max_len" in probes.columns else []  # a longer length is a miss, as if the probe had no bits there
    found = (_one_by_one if search.entries is None else _halving)(probes, search, key, limit)
    best = found.filter(F.col("_best").isNotNull()).withColumn("plen", F.col("_best")).select(key, "family", "plen", *_network())
    return best.join(search.rows, _KEY).select(key, F.col("plen").alias("_plen"), *payload)


def _entries(search: PrefixIndex, df: DataFrame, best: str) -> DataFrame:
    side = df.select(*_KEY, F.col(best).alias("_found"), F.lit(True).alias("_hit"))
    return F.broadcast(side) if search.few else side


def _one_by_one(probes: DataFrame, search: PrefixIndex, key: str, limit: Sequence[str]) -> DataFrame:
    """One candidate per length, where lengths are as few as the steps of a search: the longest that hits."""
    own = [key, "family", F.col("hi").alias("_hi"), F.col("lo").alias("_lo")]
    lists = _by_family({f: F.array(*map(F.lit, n)).cast("array<int>") for f, n in search.lengths.items()}, F.array().cast("array<int>"))
    if limit:
        lists = F.filter(lists, lambda n: n <= F.col("_max_len"))
    wide = probes.select(*own, F.explode(lists).alias("plen")).select("*", *_network())
    hits = wide.join(_entries(search, search.rows, "plen"), _KEY, "left_semi")
    return hits.groupBy(key, "family", "_hi", "_lo").agg(F.max("plen").alias("_best"))


def _halving(probes: DataFrame, search: PrefixIndex, key: str, limit: Sequence[str]) -> DataFrame:
    """Binary search: each step halves the lengths that are left."""
    entries = _entries(search, search.entries, "best")
    lists = {f: F.array(*map(F.lit, own)).cast("array<int>") for f, own in search.lengths.items()}
    last = _by_family({f: F.lit(len(own) - 1) for f, own in search.lengths.items()}, F.lit(-1))
    state = probes.select(key, *limit, "family", F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.lit(0).alias("_first"), last.alias("_last"), F.lit(None).cast("int").alias("_best"))
    for _ in range(max((len(own) for own in search.lengths.values()), default=0).bit_length()):
        middle = F.floor((F.col("_first") + F.col("_last")) / 2).cast("int")
        reached = F.col("_first") <= F.col("_last")
        length = F.when(reached, _by_family({f: F.get(own, F.col("_middle")) for f, own in lists.items()}, F.lit(None)))
        at = state.withColumn("_middle", middle).withColumn("plen", length)
        hit = F.coalesce(F.col("_hit"), F.lit(False))
        if limit:
            hit = hit & (F.col("plen") <= F.col("_max_len"))
        state = at.select("*", *_network()).join(entries, _KEY, "left").select(
            key, *limit, "family", "_hi", "_lo", F.when(hit, F.col("_middle") + 1).otherwise(F.col("_first")).alias("_first"),
            F.when(hit, F.col("_last")).otherwise(F.col("_middle") - 1).alias("_last"), F.when(hit, F.col("_found")).otherwise(F.col("_best")).alias("_best"))
    return state


def lpm_resolve(df: DataFrame, ip_columns: Sequence[str], index: DataFrame | PrefixIndex, payload: Sequence[str]) -> DataFrame:
    """Payload per distinct address of one or several columns: ``ip, _plen, payload...``."""
    listed = df.select(F.explode(F.array(*[F.col(c) for c in ip_columns])).alias("ip")) if len(ip_columns) > 1 \
        else df.select(F.col(ip_columns[0]).alias("ip"))
    distinct = listed.filter(F.col("ip").isNotNull() & (F.col("ip") != "")).distinct()
    probes = with_address(distinct, "ip").filter(F.col("family").isNotNull())
    return _best_match(probes, index, payload, "ip")


def lpm_attach(df: DataFrame, ip: str, resolved: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Left join of a resolved table (``fields``: payload name -> new name)."""
    side = resolved.select(F.col("ip").alias(ip), *[F.col(f).alias(n) for f, n in fields.items()])
    return df.join(side, ip, "left")


def lpm_join(df: DataFrame, ip: str, index: DataFrame | PrefixIndex, fields: Mapping[str, str]) -> DataFrame:
    """D3: add the payload of the most specific prefix that holds the address; null if there is none."""
    return lpm_attach(df, ip, lpm_resolve(df, [ip], index, list(fields)), fields)


def enrich_ip_ext(df: DataFrame, indexes: Mapping[str, DataFrame | PrefixIndex], ip: str, direction: str) -> DataFrame:
    """One ``{direction}_ip_{name}_ref`` per extra prefix table."""
    for name, index in indexes.items():
        df = lpm_join(df, ip, index, {"ref": f"{direction}_ip_{name}_ref"})
    return df


def cidr_join(df: DataFrame, network: str, index: DataFrame | PrefixIndex, fields: Mapping[str, str]) -> DataFrame:
    """Payload of the most specific prefix that covers a whole network (``a.b.c.d/len`` text)."""
    payload = list(fields)
    distinct = df.select(F.col(network).alias("_net")).filter(F.col("_net").isNotNull()).distinct()
    parts = F.split("_net", "/", -1)
    split = distinct.filter(F.size(parts) == 2).select("_net", F.get(parts, 0).alias("_a"), F.get(parts, 1).try_cast("int").alias("_l"))
    probes = prefix_keys(split, "_a", "_l").select("_net", "family", "hi", "lo", F.col("plen").alias("_max_len"))
    best = _best_match(probes, index, payload, "_net")
    side = best.select(F.col("_net").alias(network), *[F.col(f).alias(n) for f, n in fields.items()])
    return df.join(side, network, "left")
