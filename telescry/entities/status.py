"""Facilities, sites, resources, incidents, events and compute jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.functions.text import epoch_or_null, ext_or_default, iso_timestamp, last_segment, string_array, to_long
from telescry.operators.lookup import lookup_array, lookup_join
from telescry.operators.predicates import all_present

# URL patterns of the status API.
URL = {
    "facility": "/facility$",
    "site": "/facility/sites$",
    "event": "/status/(incidents/.+/)?events$",
    "incident": "/status/incidents$",
    "resource": "/status/resources$",
}
FACILITY_TABLE, SITE_TABLE = "iri_site_to_facility", "iri_resource_to_site"

RECORD_SCHEMA = (
    "id string, self_uri string, name string, description string, last_modified string, short_name string, "
    "organization_name string, support_uri string, operating_organization string, country_name string, "
    "state_or_province_name string, street_address string, site_uris array<string>, resource_uris array<string>, "
    "status string, type string, occurred_at string, resource_uri string, incident_uri string, start string, "
    "`end` string, resolution string, resource_type string, `group` string, capability_uris array<string>, "
    "current_status string, ext string, tag string"
)


def _base() -> list:
    return [
        "_pos", "id", ext_or_default(F.col("ext")).alias("ext"), string_array(F.col("tag")).alias("tag"),
        F.col("self_uri").alias("uri"), "name", "description",
    ]


def _time(name: str, alias: str) -> Column:
    return iso_timestamp(F.col(f"`{name}`")).alias(alias)


def stage_facilities(rows: DataFrame) -> DataFrame:
    good = rows.filter(all_present(["id", "self_uri", "last_modified"]))
    return good.select(*_base(), _time("last_modified", "last_modified"), "short_name", "organization_name", "support_uri")


def stage_sites(rows: DataFrame, site_to_facility: DataFrame | None) -> DataFrame:
    """``site_to_facility`` is the ``key, value`` table of the inverted references."""
    good = rows.filter(all_present(["id", "self_uri", "last_modified"]))
    good = lookup_join(good, site_to_facility, {"id": "key"}, {"value": "facility_id"})
    return good.select(
        *_base(), _time("last_modified", "last_modified"), "facility_id", "short_name", "operating_organization",
        "country_name", F.col("state_or_province_name").alias("country_sub_name"), "street_address")


def stage_resources(rows: DataFrame, resource_to_site: DataFrame | None, site_to_facility: DataFrame | None) -> DataFrame:
    """Resource -> site -> facility."""
    good = rows.filter(all_present(["id", "resource_type", "self_uri"]))
    good = lookup_join(good, resource_to_site, {"id": "key"}, {"value": "site_id"})
    good = lookup_join(good, site_to_facility, {"site_id": "key"}, {"value": "facility_id"})
    return good.select(
        *_base(), F.col("resource_type").alias("type"), "group",
        F.coalesce("capability_uris", F.array().cast("array<string>")).alias("capability_id"), "site_id", "facility_id")


def stage_incidents(rows: DataFrame, resource_refs: DataFrame | None) -> DataFrame:
    """Resource ids are kept for every URI, references only where one is known."""
    good = rows.filter(all_present(["id", "self_uri", "last_modified", "status", "type", "start", "resolution"]))
    ids = F.array_compact(F.transform(F.coalesce("resource_uris", F.array().cast("array<string>")), last_segment))
    staged = good.select(
        *_base(), _time("last_modified", "last_modified"), "status", "type", _time("start", "start_time"),
        _time("end", "end_time"), "resolution", ids.alias("resource_id"),
        F.struct("id", "_pos").alias("_row"))
    return lookup_array(staged, "_row", "resource_id", resource_refs, "resource_ref", keep_misses=False).drop("_row")


def stage_events(rows: DataFrame) -> DataFrame:
    good = rows.filter(all_present(["id", "self_uri", "last_modified", "status", "occurred_at", "resource_uri", "incident_uri"]))
    return good.select(
        *_base(), _time("last_modified", "last_modified"), "status", _time("occurred_at", "occurred_at_time"),
        last_segment(F.col("resource_uri")).alias("resource_id"), last_segment(F.col("incident_uri")).alias("incident_id"))


SELECT_FIELDS = (
    "at_queue:string, broken:boolean, debug:boolean, host:string, mem:string, mpiprocs:bigint, nchunks:bigint, "
    "ncpus:bigint, ngpus:bigint, system:string, validation:boolean"
)
JOB_SCHEMA = (
    "jobid string, mode string, nodes string, project string, queue string, state string, submittime string, "
    "starttime string, substate string, walltime string, location string, "
    f"schedselect array<struct<{SELECT_FIELDS}>>, runtimef string, queuedtimef string, score double, ext string, tag string"
)
JOB_REQUIRED = ("jobid", "mode", "nodes", "project", "queue", "state", "submittime", "substate", "walltime")


def stage_jobs(rows: DataFrame) -> DataFrame:
    """minutes to seconds, epochs to timestamps; no usable submit time rejects the record."""
    good = rows.filter(all_present(JOB_REQUIRED))
    start = epoch_or_null(F.col("starttime"))
    wall = to_long(F.col("walltime")) * 60
    out = good.select(
        "_pos", F.col("jobid").alias("id"), ext_or_default(F.col("ext")).alias("ext"), string_array(F.col("tag")).alias("tag"),
        "compute_resource_id", string_array(F.col("location")).alias("location"), "mode",
        to_long(F.col("nodes")).alias("node_count"), "project", "queue",
        F.coalesce(F.filter("schedselect", lambda s: s.isNotNull()), F.array().cast(f"array<struct<{SELECT_FIELDS}>>")).alias("schedule_select"),
        start.alias("start_time"), F.timestamp_seconds(F.unix_timestamp(start) + wall).alias("end_time"), "state",
        epoch_or_null(F.col("submittime")).alias("submit_time"), to_long(F.col("substate")).alias("substate"),
        wall.alias("wall_time_secs"))
    return out.filter(F.col("submit_time").isNotNull() & F.col("node_count").isNotNull() & F.col("wall_time_secs").isNotNull())
