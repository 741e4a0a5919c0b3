"""User-facing settings, one frozen dataclass per concern."""

from __future__ import annotations

from dataclasses import dataclass, field


def parse_pairs(text: str | None) -> dict[str, str]:
    """``"100:blue, 200:red"`` -> ``{"100": "blue", "200": "red"}``; items without a colon are ignored."""
    pairs = (item.partition(":") for item in (text or "").split(","))
    return {key.strip(): value.strip() for key, colon, value in pairs if colon}


def parse_list(text: str | None) -> tuple[str, ...]:
    """Comma list, blanks removed."""
    return tuple(item.strip() for item in (text or "").split(",") if item.strip())


@dataclass(frozen=True)
class Policy:
    """Constants stamped on every fact row."""

    originator: str = "unknown"
    level: str = "tlp:amber"
    scope: tuple[str, ...] = ()


@dataclass(frozen=True)
class FlowConfig:
    policy: Policy = field(default_factory=Policy)
    flow_type: str = "unknown"
    auto_scopes: bool = True
    community_scopes: dict[str, str] = field(default_factory=dict)
    ip_ref_extensions: tuple[str, ...] = ()
    as_path_mode: str = "reference"  # or "true_run_length"
    extensions: tuple[str, ...] = ("bgp", "ipv4", "ipv6", "mpls", "vlan")


@dataclass(frozen=True)
class RollupPolicy:
    """Policy columns of a rollup; ``override=False`` keeps those of the flow rows."""

    override: bool = True
    level: str = "tlp:green"
    scope: tuple[str, ...] = ("comm:re",)


@dataclass(frozen=True)
class MetricConfig:
    policy: Policy = field(default_factory=Policy)
    collector_id: str = "telescry"
    interface_metric_name: str = "snmp_if"
    ifname_table: str = "ifindex_to_ifname"
    interface_ref_table: str = "meta_interface"
    short_device: bool = True
    traffic_interval_s: int = 30
