"""One function per job.

All tables live below one ``base`` folder.  Jobs are plain functions: a scheduler of your choice calls
the batch jobs, and the stream jobs return a running query.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from telescry.config import FlowConfig, MetricConfig, RollupPolicy
from telescry.entities import addresses, services, specs, status
from telescry.operators import flows, keyed, metrics, ranges, registry, rollup, versioned
from telescry.operators.predicates import route_contains, route_url
from telescry.operators.prefix import subnet_index
from telescry.operators.lookup import DEVICE_LOOKUP, INTERFACE_LOOKUP
from telescry.operators.snapshot import LookupSpec, live, lookup_rows
from telescry.operators.versioned import EntitySpec
from telescry.session import cut_lineage
from telescry.sinks import tables as sinks
from telescry.sinks.current import HASH_VIEW, KV_VIEW, KeptView, last_view, latest_version_view, lookup_view, read_kept, refresh, version_view
from telescry.sinks.statistics import LoadLog
from telescry.sources import files, messages
from telescry.streaming.run import BatchFn, read_once, rollup_sink, run_stream
from telescry.streaming.state import replayed_lookup

KV, HASHES = "kv", "kv_hash"


# --- metadata --------------------------------------------------------------------------------------

#: Views that the flow jobs read of a metadata table, besides its current versions.
DEVICE_VIEW, INTERFACE_VIEW = lookup_view(DEVICE_LOOKUP), lookup_view(INTERFACE_LOOKUP)
APPLICATION_VIEW = last_view(specs.APPLICATION)


def views_of(spec: EntitySpec) -> list[KeptView]:
    own = [version_view(spec)] if spec.versioned else []
    return own + [v for v in (DEVICE_VIEW, INTERFACE_VIEW, APPLICATION_VIEW) if v.table == spec.table]


def refresh_views(spark: SparkSession, base: str, kept: Sequence[KeptView]) -> None:
    """Merge the last appends into the views, where that pays."""
    for view in kept:
        refresh(spark, base, view)


def refs(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """``id, ref`` of the current versions of a metadata table, None while it is empty."""
    kept = read_kept(spark, base, latest_version_view(name, ("hash",)))
    return None if kept is None else kept.select("id", "ref")


def snapshots(spark: SparkSession, base: str, spec: EntitySpec) -> dict[str, DataFrame]:
    names = {table for _, table in (*spec.refs, *spec.list_refs)}
    found = {name: refs(spark, base, name) for name in names}
    return {name: df for name, df in found.items() if df is not None}


def upsert_entity(spark: SparkSession, base: str, spec: EntitySpec, staged: DataFrame, as_of: Column, force: bool = False) -> None:
    """Append the new versions of a staged batch; running it twice appends nothing the second time."""
    now = read_kept(spark, base, version_view(spec)) if spec.versioned else None
    rows = versioned.apply_to_current(staged, now, spec, snapshots(spark, base, spec), as_of, force, cut_lineage)
    sinks.append_table(rows, sinks.metadata_table(spec), base)
    refresh_views(spark, base, views_of(spec))


def metadata_files(spark: SparkSession, paths: str | Sequence[str], base: str, as_of: Column, force: bool = False) -> None:
    """Table files -> metadata tables, in the order in which references resolve."""
    rows = files.read_table_files(spark, paths)
    for name, spec in specs.FILE_ENTITIES.items():
        staged = versioned.stage(rows.filter(F.col("table") == name), spec)
        upsert_entity(spark, base, spec, staged, as_of, force)


def _as_rows(df: DataFrame) -> DataFrame:
    """Typed columns -> the record JSON that staging reads."""
    return df.select(F.monotonically_increasing_id().alias("pos"), F.to_json(F.struct(*df.columns)).alias("row_json"))


def registry_job(spark: SparkSession, as_registry: str, net_registry: str, base: str, as_of: Column, iso: DataFrame | None = None,
                 subdivisions: DataFrame | None = None) -> None:
    """AS and organisation registries -> meta_organization, then meta_as."""
    net_orgs, nets = files.read_net_registry(spark, net_registry)
    ases, orgs = registry.merge_registries(files.read_as_registry(spark, as_registry), net_orgs, nets, iso, subdivisions)
    for spec, rows in ((specs.ORGANIZATION, orgs), (specs.AUTONOMOUS_SYSTEM, ases)):
        upsert_entity(spark, base, spec, versioned.stage(_as_rows(rows), spec), as_of)


def ip_geo_job(spark: SparkSession, block_files: Sequence[str], asn_files: Sequence[str], location_files: Sequence[str], base: str,
               as_of: Column, custom: DataFrame | None = None, present: str | None = None) -> None:
    """Geo blocks with AS and place names -> meta_ip."""
    asn = registry.asn_index(files.read_csv(spark, asn_files, files.ASN_BLOCKS))
    places = registry.locations(files.read_csv(spark, location_files, files.LOCATIONS))
    rows = registry.geo_blocks(files.read_csv(spark, block_files, files.GEO_BLOCKS), asn, places, custom, present)
    staged = rows.select(
        F.col("id").alias("_pos"), "id", F.lit("{}").alias("ext"), F.array().cast("array<string>").alias("tag"),
        *[F.col(c) for c in specs.IP_BLOCK.fields])
    upsert_entity(spark, base, specs.IP_BLOCK, staged, as_of)


def grid_site_job(spark: SparkSession, payloads: str, base: str, as_of: Column, url_part: str) -> None:
    rows = messages.read_payloads(spark, payloads, addresses.GRID_SCHEMA).filter(route_contains(url_part))
    upsert_entity(spark, base, specs.GRID_SITE_IP, addresses.stage_grid_sites(rows.withColumnRenamed("data", "sites")), as_of)


def service_prefix_job(spark: SparkSession, payloads: str, base: str, as_of: Column, url_part: str) -> None:
    rows = messages.read_payloads(spark, payloads, f"struct<{_inner(addresses.SERVICE_SCHEMA)}>").filter(route_contains(url_part))
    upsert_entity(spark, base, specs.SERVICE_PREFIX_IP, addresses.stage_service_prefixes(rows), as_of)


def service_edge_job(spark: SparkSession, payloads: str, base: str, as_of: Column, url_part: str) -> None:
    rows = messages.read_payloads(spark, payloads, f"struct<{_inner(services.EDGE_SCHEMA)}>")
    rows = rows.filter(route_contains(url_part, present="data.data.serviceEdgeList"))
    upsert_entity(spark, base, specs.SERVICE_EDGE, services.stage_service_edges(rows), as_of)


def _inner(schema: str) -> str:
    """``name type`` -> ``name:type`` for use inside a struct."""
    return schema.replace(" ", ":", 1)


def event_venue_job(spark: SparkSession, paths: str | Sequence[str], base: str, as_of: Column) -> None:
    rows = files.read_json_docs(spark, paths, addresses.VENUE_SCHEMA)
    upsert_entity(spark, base, specs.EVENT_VENUE_IP, addresses.stage_event_venue(rows), as_of)


def science_registry_job(spark: SparkSession, paths: str | Sequence[str], base: str, as_of: Column) -> None:
    rows = files.read_json_docs(spark, paths, addresses.SCIENCE_SCHEMA)
    upsert_entity(spark, base, specs.SCIENCE_REGISTRY_IP, addresses.stage_science_registry(rows), as_of)


def status_job(spark: SparkSession, payloads: str, base: str, as_of: Column, cfg: MetricConfig = MetricConfig()) -> None:
    """Facility, site, resource, incident and event payloads -> tables, index lookups and status metrics."""
    rows = messages.read_payloads(spark, payloads, f"array<struct<{_fields(status.RECORD_SCHEMA)}>>")
    records = {name: messages.payload_records(rows, route_url(pattern)) for name, pattern in status.URL.items()}
    lookups = keyed.invert_refs(records["facility"].filter(F.col("self_uri").isNotNull()), "site_uris", status.FACILITY_TABLE).unionByName(
        keyed.invert_refs(records["site"].filter(F.col("self_uri").isNotNull()), "resource_uris", status.SITE_TABLE))
    sinks.write_kv(keyed.kv_rows(lookups, as_of), base, KV)
    refresh(spark, base, KV_VIEW)
    view = kv(spark, base, as_of)
    to_facility, to_site = (keyed.kv_table(view, t) for t in (status.FACILITY_TABLE, status.SITE_TABLE))
    upsert_entity(spark, base, specs.FACILITY, status.stage_facilities(records["facility"]), as_of)
    upsert_entity(spark, base, specs.SITE, status.stage_sites(records["site"], to_facility), as_of)
    upsert_entity(spark, base, specs.RESOURCE, status.stage_resources(records["resource"], to_site, to_facility), as_of)
    resource_refs = refs(spark, base, specs.RESOURCE.table)
    upsert_entity(spark, base, specs.INCIDENT, status.stage_incidents(records["incident"], resource_refs), as_of)
    upsert_entity(spark, base, specs.EVENT, status.stage_events(records["event"]), as_of)
    sinks.write_demux(metrics.status_metrics(records["resource"], resource_refs, as_of, cfg=cfg), base, "counter")


def _fields(schema: str) -> str:
    return ", ".join(part.replace(" ", ":", 1) for part in schema.split(", "))


def compute_job_job(spark: SparkSession, payloads: str, base: str, as_of: Column, cfg: MetricConfig = MetricConfig()) -> None:
    """Queued and running jobs -> meta_alcf_job and job metrics."""
    record = f"array<struct<{_job_fields()}>>"
    rows = messages.job_rows(messages.read_payloads(spark, payloads, f"struct<queued:{record}, running:{record}>"))
    upsert_entity(spark, base, specs.COMPUTE_JOB, status.stage_jobs(rows), as_of)
    job_refs = refs(spark, base, specs.COMPUTE_JOB.table)
    sinks.write_demux(metrics.job_metrics(rows, job_refs, as_of, cfg=cfg), base, "gauge")


def _job_fields() -> str:
    head, tail = status.JOB_SCHEMA.split("schedselect ")
    kind, rest = tail.split(">>, ", 1)
    return f"{_fields(head.rstrip(', '))}, schedselect:{kind}>>, {_fields(rest)}"


# --- key-value tables and indexes ------------------------------------------------------------------

def kv(spark: SparkSession, base: str, as_of: Column | None = None) -> DataFrame | None:
    """Live key-value entries, None before the first write."""
    return _live(read_kept(spark, base, KV_VIEW), as_of)


def _live(kept: DataFrame | None, as_of: Column | None) -> DataFrame | None:
    return kept if kept is None or as_of is None else live(kept, as_of)


def kv_job(spark: SparkSession, base: str, lookup_specs: Sequence[str], as_of: Column) -> None:
    """Metadata references as key-value entries, per lookup spec."""
    for text in lookup_specs:
        spec = LookupSpec.parse(text)
        table = sinks.read_table(spark, base, spec.table)
        if table is None:
            continue
        pairs = keyed.kv_refs(table, spec, text)
        strip = F.expr("substring(key, instr(key, ':') + 1)")
        entries = keyed.kv_rows(pairs.withColumn("key", strip), as_of, None, keyed.time_order(F.col("max_insert_time")))
        sinks.write_kv(keyed.kv_view(entries), base, KV)  # of records with one key the newest
    refresh(spark, base, KV_VIEW)


def ip_index_job(spark: SparkSession, base: str, spec_text: str = "meta_ip:as_id", simple_name: bool = True,
                 require_fields: bool = True) -> str:
    """Subnet index of an IP metadata table, exported for the flow jobs."""
    spec = LookupSpec.parse(spec_text, require_fields)
    table = sinks.read_table(spark, base, spec.table)
    if table is None:
        raise ValueError(f"{spec.table} has not been written")
    rows = lookup_rows(table, replace(spec, fields=(*spec.fields, "ip_subnet")))
    index = subnet_index(rows, ["ref", *spec.fields])
    return sinks.export_index(index, base, spec_text, simple_name)


def compact_kv_job(spark: SparkSession, base: str, as_of: Column, generation: int) -> None:
    """Newest live entries in place of the whole history of the key-value tables."""
    for name, view in ((KV, keyed.kv_view), (HASHES, keyed.hash_view)):
        table = sinks.read_table(spark, base, name)
        if table is not None:
            sinks.compact_kv(spark, view(table, as_of), base, name, generation)


def retention_job(spark: SparkSession, base: str, as_of: datetime, rollups: Mapping[str, Sequence[str]] | None = None) -> None:
    """Drop days that are out of keeping from flows, traffic, metrics and rollups."""
    kept = [sinks.FLOW_TABLE, sinks.TRAFFIC_TABLE, *[sinks.metric_table(k) for k in sinks.METRIC_TYPES]]
    kept += [sinks.rollup_table(rollup.KINDS[name], w) for name, windows in (rollups or {}).items() for w in windows]
    for table in kept:
        sinks.apply_retention(spark, table, base, as_of)


def interface_cache_job(spark: SparkSession, polls: DataFrame, base: str, as_of: Column) -> None:
    """Device polls -> interface records as keyed hashes."""
    order = [keyed.message_order().alias("seq")] if {"message_time", "partition", "offset"} <= set(polls.columns) else []
    recs = keyed.interface_records(keyed.name_from_id(polls), order)
    sinks.write_kv(keyed.hash_rows(recs, "meta_interface_cache", "id", as_of), base, HASHES)
    refresh(spark, base, HASH_VIEW)


def interface_export_job(spark: SparkSession, base: str, as_of: Column) -> None:
    """Cached interface records -> meta_interface."""
    view = _live(read_kept(spark, base, HASH_VIEW), as_of)
    if view is None:
        return
    wide = keyed.hash_records(view, "meta_interface_cache", ["id", "ext", *specs.INTERFACE.fields])
    upsert_entity(spark, base, specs.INTERFACE, versioned.stage(_as_rows(wide.drop("key")), specs.INTERFACE), as_of)


# --- flows -----------------------------------------------------------------------------------------

def flow_lookups(spark: SparkSession, base: str, cfg: FlowConfig = FlowConfig()) -> flows.FlowLookups:
    """Lookups from the kept views and exported indexes as they are now."""
    apps = read_kept(spark, base, APPLICATION_VIEW)
    index = lambda name: sinks.read_index(spark, base, name)
    ext = {name: index(f"meta_ip_{name}") for name in cfg.ip_ref_extensions}
    return flows.FlowLookups(
        ip=index("meta_ip"), ip_ext={n: df for n, df in ext.items() if df is not None},
        as_refs=refs(spark, base, specs.AUTONOMOUS_SYSTEM.table), devices=read_kept(spark, base, DEVICE_VIEW),
        interfaces=read_kept(spark, base, INTERFACE_VIEW), applications=None if apps is None else ranges.cache_ranges(apps))


def flow_batch(spark: SparkSession, base: str, cfg: FlowConfig = FlowConfig(), rollups: Mapping[str, Sequence[str]] | None = None,
               policy: RollupPolicy = RollupPolicy()) -> BatchFn:
    """Batch function: raw messages -> data_flow, rejected messages, rollup partials, and load statistics.

    Messages are parsed and judged once, and kept for both sinks.  Lookups are read again for every batch.  The
    enriched rows are written first and the rollups read them back from there, so nothing is computed twice and a
    lost executor costs one stage.
    """
    wanted = {name: tuple(w) for name, w in (rollups or {}).items()}

    def handle(rows: DataFrame, batch: sinks.Batch) -> None:
        session = rows.sparkSession
        rejected = rows.filter("error IS NOT NULL").select("topic", "partition", "offset", "error")
        log = LoadLog()
        sinks.append_table(log.watch(rejected, REJECTED.name), REJECTED, base, batch)
        stamped = flows.ingest(rows.filter("error IS NULL").drop("error"), flow_lookups(session, base, cfg), cfg)
        sinks.append_table(log.watch(stamped, sinks.FLOW_TABLE.name), sinks.FLOW_TABLE, base, batch)
        log.flush(session, base, batch)
        stored = sinks.read_batch(session, sinks.FLOW_TABLE, base, batch)
        if stored is None:
            return
        apps = read_kept(session, base, APPLICATION_VIEW)
        for name, windows in wanted.items():
            kind = rollup.KINDS[name]
            for window in windows:
                index = None if apps is None else ranges.dictionary_ranges(apps)
                rollup_sink(kind, window, base, policy, lambda index=index: index)(stored, batch)

    once = read_once(handle)
    return lambda rows, batch: once(flows.judged_flows(rows), batch)


REJECTED = sinks.TableSpec("rejected_message", ("topic", "partition", "offset", "error"))


def flow_stream(spark: SparkSession, source: DataFrame, base: str, checkpoint: str, cfg: FlowConfig = FlowConfig(),
                rollups: Mapping[str, Sequence[str]] | None = None, interval: str | None = "30 seconds") -> StreamingQuery:
    """Message stream -> flow table and rollups (K1, K3, K5)."""
    return run_stream(source, flow_batch(spark, base, cfg, rollups), checkpoint, interval)


def enriched_flow_batch(base: str, cfg: FlowConfig = FlowConfig(), service_refs: Callable[[SparkSession], DataFrame | None] = lambda _: None) -> BatchFn:
    """Batch function of the flow source that is enriched already: messages -> data_flow.

    Messages are long.  Where no prefix or group lookup reads them again they are not kept: the pass that writes the flows
    counts dead letters, and only if there are some are they looked for.
    """

    def handle(rows: DataFrame, batch: sinks.Batch) -> None:
        session = rows.sparkSession
        lookups = flow_lookups(session, base, cfg)
        known = lambda spec: refs(session, base, spec.table)
        registry, groups = sinks.read_index(session, base, specs.SCIENCE_REGISTRY_IP.table), service_refs(session)
        enrich = lambda good: flows.project_enriched_flows(
            good, cfg, lookups.ip, lookups.as_refs, known(specs.DEVICE), known(specs.INTERFACE), groups, registry)

        def kept(rows: DataFrame, batch: sinks.Batch) -> None:
            good, dead = messages.parse_messages(rows, flows.ENRICHED_SCHEMA)
            sinks.append_table(dead, REJECTED, base, batch)
            sinks.append_table(enrich(good), sinks.FLOW_TABLE, base, batch)

        def passing(rows: DataFrame, batch: sinks.Batch) -> None:
            seen = Observation()
            judged = messages.judged_messages(rows, flows.ENRICHED_SCHEMA).observe(seen, F.count("error").alias("dead"))
            sinks.append_table(enrich(judged.filter("error IS NULL").drop("error")), sinks.FLOW_TABLE, base, batch)
            if seen.get.get("dead", 1):
                sinks.append_table(messages.parse_messages(rows, flows.ENRICHED_SCHEMA)[1], REJECTED, base, batch)

        once = all(x is None for x in (lookups.ip, registry, groups))
        (passing if once else read_once(kept))(rows, batch)

    return handle


def enriched_flow_stream(source: DataFrame, base: str, checkpoint: str, cfg: FlowConfig = FlowConfig(), interval: str | None = "30 seconds") -> StreamingQuery:
    return run_stream(source, enriched_flow_batch(base, cfg), checkpoint, interval)


# --- SNMP ------------------------------------------------------------------------------------------

def ordered_lookups(polls: DataFrame, rules: metrics.Rules, reads: Column, ttl_s: int | None = None) -> DataFrame:
    """K6 in message order: what each poll would look up, as the polls before it in the stream have left it.

    ``polls`` is a stream of parsed messages with ``partition`` and ``offset``; ``reads`` is the array of ``table, key``
    structs that a poll asks for.  The batch-wide variant, in which a batch sees all it writes itself, is ``snmp_batch``.
    """
    polls = metrics.tokens(polls)
    place = ("partition", "offset")
    writes = keyed.index_lookup(polls, rules.by_name, place).select("table", "key", "value", F.lit(1).alias("writes"), *place)
    asks = polls.select(*place, F.explode(reads).alias("r")).select("r.table", "r.key", F.lit(None).cast("string").alias("value"), F.lit(0).alias("writes"), *place)
    return replayed_lookup(writes.unionByName(asks).filter(F.col("key").isNotNull()), ttl_s)


def snmp_batch(base: str, rules: metrics.Rules, as_of: Callable[[], Column] = F.current_timestamp,
               cfg: MetricConfig = MetricConfig()) -> BatchFn:
    """Batch function: polls -> index lookups, then interface traffic and generic metrics.

    The lookups of the batch are written first and read by the same batch (K6).
    """

    def handle(rows: DataFrame, batch: sinks.Batch) -> None:
        spark = rows.sparkSession
        good, dead = messages.parse_messages(rows, metrics.WIRE_SCHEMA)
        sinks.append_table(dead, REJECTED, base, batch)
        entries = keyed.index_lookup(metrics.tokens(good), rules.by_name, ("message_time", "partition", "offset"))
        newest = keyed.kv_view(keyed.kv_rows(entries, as_of(), order=keyed.message_order()))
        known = kv(spark, base, as_of())
        sinks.write_kv(newest if known is None else keyed.to_write(newest, known, as_of()), base, KV, batch)
        refresh(spark, base, KV_VIEW)
        view = kv(spark, base, as_of())
        traffic = metrics.interface_traffic(good, keyed.kv_table(view, cfg.ifname_table), keyed.kv_table(view, cfg.interface_ref_table), cfg)
        sinks.append_table(traffic, sinks.TRAFFIC_TABLE, base, batch)
        for kind, melted in metrics.metric_tables(metrics.melt_metrics(good, rules, view, cfg)).items():
            sinks.write_demux(melted, base, kind, batch=batch)

    return read_once(handle)


def snmp_stream(source: DataFrame, base: str, checkpoint: str, rules: metrics.Rules, interval: str | None = "30 seconds") -> StreamingQuery:
    return run_stream(source, snmp_batch(base, rules), checkpoint, interval)


def named_traffic_batch(base: str, cfg: MetricConfig = MetricConfig()) -> BatchFn:
    """Batch function of the interface source that names its interfaces itself: messages -> data_interface_traffic."""

    def handle(rows: DataFrame, batch: sinks.Batch) -> None:
        good, dead = messages.parse_messages(rows, metrics.NAMED_SCHEMA)
        sinks.append_table(dead, REJECTED, base, batch)
        view = kv(rows.sparkSession, base)
        known = None if view is None else keyed.kv_table(view, cfg.interface_ref_table)
        sinks.append_table(metrics.project_interface_traffic(good, known, cfg), sinks.TRAFFIC_TABLE, base, batch)

    return read_once(handle)


def named_traffic_stream(source: DataFrame, base: str, checkpoint: str, interval: str | None = "30 seconds") -> StreamingQuery:
    return run_stream(source, named_traffic_batch(base), checkpoint, interval)


def message_archive_stream(source: DataFrame, base: str, checkpoint: str, interval: str | None = "30 seconds") -> StreamingQuery:
    """Raw messages -> data_kafka_message."""

    def handle(rows: DataFrame, batch: sinks.Batch) -> None:
        sinks.append_table(messages.raw_archive(rows), sinks.MESSAGE_TABLE, base, batch)
        sinks.append_table(messages.not_json(rows), REJECTED, base, batch)

    return run_stream(source, handle, checkpoint, interval)


