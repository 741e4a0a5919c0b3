"""Table specs of all metadata entities.

The field lists are the tables' fixed column names.
"""

from __future__ import annotations

from telescry.operators.versioned import EntitySpec

_PLACE = {
    "city_name": "text", "continent_name": "text", "country_name": "text", "country_code": "text",
    "country_sub_name": "text", "country_sub_code": "text", "latitude": "double", "longitude": "double",
}

INTERFACE = EntitySpec(
    "meta_interface",
    {
        "type": "text", "description": "text", "device_id": "text", "edge": "flag", "flow_index": "long",
        "ipv4": "text", "ipv6": "text", "name": "text", "speed": "long", "circuit_id": "texts",
        "peer_as_id": "long", "peer_interface_ipv4": "text", "peer_interface_ipv6": "text",
        "lag_member_interface_id": "texts", "port_interface_id": "text", "remote_interface_id": "text",
        "remote_organization_id": "text",
    },
    required=("id", "device_id", "name", "type"),
    refs=(
        ("device", "meta_device"), ("peer_as", "meta_as"), ("port_interface", "meta_interface"),
        ("remote_interface", "meta_interface"), ("remote_organization", "meta_organization"),
    ),
    list_refs=(("circuit", "meta_circuit"), ("lag_member_interface", "meta_interface")),
    self_refs=("port_interface", "remote_interface"),
    self_list_refs=("lag_member_interface",),
)

DEVICE = EntitySpec(
    "meta_device",
    {
        "type": "text", "loopback_ip": "texts", "management_ip": "texts", "hostname": "text",
        "location_name": "text", "location_type": "texts", **_PLACE, "manufacturer": "text", "model": "text",
        "network": "text", "os": "text", "role": "text", "state": "text",
    },
    required=("id", "type"),
)

CIRCUIT = EntitySpec(
    "meta_circuit",
    {
        "type": "text", "description": "text", "state": "text", "endpoint_type": "texts", "endpoint_id": "texts",
        "parent_circuit_id": "text",
    },
    required=("id", "endpoint_id", "endpoint_type"),
    refs=(("parent_circuit", "meta_circuit"),),
    self_refs=("parent_circuit",),
    pairs=("endpoint_type", "endpoint_id"),
)

ORGANIZATION = EntitySpec("meta_organization", {"name": "text", "type": "texts", **_PLACE}, required=("id", "name"))

AUTONOMOUS_SYSTEM = EntitySpec(
    "meta_as",
    {"name": "text", "organization_id": "text"},
    required=("id", "name", "organization_id"),
    refs=(("organization", "meta_organization"),),
    id_type="bigint",
)

IP_BLOCK = EntitySpec(
    "meta_ip",
    {"ip_subnet": "cidrs", **_PLACE, "as_id": "long"},
    required=("id", "ip_subnet"),
    refs=(("as", "meta_as"),),
)

APPLICATION = EntitySpec(
    "meta_application",
    {"protocol": "text", "port_range_min": "long", "port_range_max": "long"},
    required=("id", "protocol", "port_range_min", "port_range_max"),
    versioned=False,
    sort_key=("protocol", "id", "port_range_min", "port_range_max"),
)

EVENT_VENUE_IP = EntitySpec(
    "meta_ip_scinet",
    {"ip_subnet": "cidrs", "organization_name": "text", "coordinate_x": "double", "coordinate_y": "double"},
)

SCIENCE_REGISTRY_IP = EntitySpec(
    "meta_ip_scireg",
    {
        "scireg_update_time": "date", "ip_subnet": "cidrs", "organization_name": "text", "organization_id": "text",
        "discipline": "text", "latitude": "double", "longitude": "double", "resource_name": "text",
        "project_name": "text", "contact_email": "text",
    },
    refs=(("organization", "meta_organization"),),
)

GRID_SITE_IP = EntitySpec(
    "meta_ip_cric",
    {
        "ip_subnet": "cidrs", "rcsite_name": "text", "latitude": "double", "longitude": "double",
        "country_name": "text", "netsite_name": "text", "tier": "long",
    },
)

SERVICE_PREFIX_IP = EntitySpec(
    "meta_ip_service",
    {
        "ip_subnet": "cidrs", "service_prefix_group_name": "texts", "service_label": "texts", "service_type": "texts",
        "org_short_name": "text", "org_full_name": "text", "org_types": "texts", "org_funding_agency": "text",
        "org_hide": "flag", "as_id": "long",
    },
)

SERVICE_EDGE = EntitySpec(
    "meta_interface_service",
    {
        "connection_name": "text", "service_edge_id": "text", "org_short_name": "text", "org_full_name": "text",
        "org_hide": "flag", "org_tag": "texts", "org_type": "texts", "org_funding_agency": "text",
        "peer_as_id": "long", "peer_ipv4": "text", "peer_ipv6": "text",
    },
)

_STATUS = {"uri": "text", "name": "text", "description": "text"}
FACILITY = EntitySpec(
    "meta_iri_facility",
    {**_STATUS, "last_modified": "timestamp", "short_name": "text", "organization_name": "text", "support_uri": "text"},
)
SITE = EntitySpec(
    "meta_iri_site",
    {
        **_STATUS, "last_modified": "timestamp", "facility_id": "text", "short_name": "text",
        "operating_organization": "text", "country_name": "text", "country_sub_name": "text", "street_address": "text",
    },
    refs=(("facility", "meta_iri_facility"),),
)
EVENT = EntitySpec(
    "meta_iri_event",
    {
        **_STATUS, "last_modified": "timestamp", "status": "text", "occurred_at_time": "timestamp", "resource_id": "text",
        "incident_id": "text",
    },
    refs=(("resource", "meta_iri_resource"), ("incident", "meta_iri_incident")),
)
INCIDENT = EntitySpec(
    "meta_iri_incident",
    {
        **_STATUS, "last_modified": "timestamp", "status": "text", "type": "text", "start_time": "timestamp",
        "end_time": "timestamp", "resolution": "text", "resource_id": "texts", "resource_ref": "texts",
    },
)
RESOURCE = EntitySpec(
    "meta_iri_resource",
    {
        **_STATUS, "type": "text", "group": "text", "capability_id": "texts", "site_id": "text", "facility_id": "text",
    },
    refs=(("site", "meta_iri_site"), ("facility", "meta_iri_facility")),
)
COMPUTE_JOB = EntitySpec(
    "meta_alcf_job",
    {
        "compute_resource_id": "text", "location": "texts", "mode": "text", "node_count": "long", "project": "text",
        "queue": "text", "schedule_select": "structs", "start_time": "timestamp", "end_time": "timestamp",
        "state": "text", "submit_time": "timestamp", "substate": "long", "wall_time_secs": "long",
    },
)

FILE_ENTITIES = {s.table: s for s in (ORGANIZATION, AUTONOMOUS_SYSTEM, DEVICE, CIRCUIT, INTERFACE, IP_BLOCK, APPLICATION)}
"""Entities that arrive as table files, in the order in which references resolve."""

ALL = {
    s.table: s for s in (
        *FILE_ENTITIES.values(), EVENT_VENUE_IP, SCIENCE_REGISTRY_IP, GRID_SITE_IP, SERVICE_PREFIX_IP, SERVICE_EDGE,
        FACILITY, SITE, EVENT, INCIDENT, RESOURCE, COMPUTE_JOB,
    )
}
