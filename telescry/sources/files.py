"""Table files, documents, CSV blocks, registry dumps (A3-A7) and metadata snapshots."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.operators.keyed import hash_view
from telescry.operators.snapshot import LookupSpec, lookup_rows


def _place() -> Column:
    """Order of rows by file name, then by place in the file; the row number alone follows the files' sizes."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))


def read_json_docs(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """A3: one JSON document (or array of records) per file; files that vanish are skipped."""
    reader = spark.read.schema(schema).option("multiLine", True).option("ignoreMissingFiles", True)
    return reader.json(list(paths) if not isinstance(paths, str) else paths).withColumn("_pos", _place())


def _table_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    for batch in batches:
        out = []
        for path, text in zip(batch["path"], batch["value"]):
            doc = yaml.safe_load(text)
            if not isinstance(doc, dict) or doc.get("table") is None:
                continue
            data = doc.get("data") or []
            data = data if isinstance(data, list) else [data]
            out += [(path, doc["table"], i, json.dumps(r, default=str)) for i, r in enumerate(data)]
        yield pd.DataFrame(out, columns=["path", "table", "row", "row_json"])


def read_table_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A4: YAML files ``{table, data: [...]}`` -> ``table, pos, row_json``; files without ``table`` are skipped.

    YAML has no native reader; each file is parsed by one task, files in parallel.
    """
    texts = spark.read.option("ignoreMissingFiles", True).text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    texts = texts.select(F.col("_metadata.file_path").alias("path"), "value")
    rows = texts.mapInPandas(_table_rows, "path string, table string, row bigint, row_json string")
    return rows.select("table", F.struct("path", "row").alias("pos"), "row_json")


ASN_BLOCKS = "network string, autonomous_system_number string, autonomous_system_organization string"
LOCATIONS = (
    "geoname_id string, locale_code string, continent_code string, continent_name string, country_iso_code string, "
    "country_name string, subdivision_1_iso_code string, subdivision_1_name string, subdivision_2_iso_code string, "
    "subdivision_2_name string, city_name string, metro_code string, time_zone string, is_in_european_union string"
)
GEO_BLOCKS = "network string, geoname_id string, latitude string, longitude string"


def read_csv(spark: SparkSession, paths: Sequence[str], columns: str) -> DataFrame:
    """A5: CSV files with a header, columns taken by name, in the order of the path list.

    A column a file does not have is null.  ``pos`` orders rows by file, then by line.
    """
    names = [c.split()[0] for c in columns.split(", ")]
    out = None
    for i, path in enumerate(paths):
        raw = spark.read.option("header", True).option("ignoreMissingFiles", True).csv(path)
        have = set(raw.columns)
        part = raw.select(
            F.struct(F.lit(i).alias("file"), _place().alias("line")).alias("pos"),
            *[(F.col(n) if n in have else F.lit(None).cast("string")).alias(n) for n in names])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("read_csv needs at least one path")
    return out


AS_REGISTRY = "type string, asn string, organizationId string, name string, country string"


def read_as_registry(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, also gzip; blank lines are skipped."""
    return spark.read.schema(AS_REGISTRY).json(path).withColumn("pos", _place())


_NET_ORG = "id:bigint, name:string, country:string, city:string, state:string, latitude:string, longitude:string"
_NET = (
    "asn:string, org_id:bigint, name:string, info_ipv6:boolean, info_prefixes4:bigint, info_prefixes6:bigint, "
    "info_ratio:string, info_scope:string, info_traffic:string, info_types:array<string>"
)
NET_REGISTRY = f"org struct<data:array<struct<{_NET_ORG}>>>, net struct<data:array<struct<{_NET}>>>"


def read_net_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """One nested dump -> organisations and networks, each with its list position."""
    doc = spark.read.schema(NET_REGISTRY).option("multiLine", True).json(path)
    listed = lambda name: doc.select(F.posexplode(f"{name}.data").alias("pos", "r")).select("pos", "r.*")
    return listed("org"), listed("net")


def snapshot(table: DataFrame, spec: LookupSpec, versioned: bool = True) -> DataFrame:
    """Latest rows of a metadata table as a lookup spec asks for them."""
    return lookup_rows(table, spec, versioned)


def read_keyed(rows: DataFrame, table: str) -> DataFrame:
    """A10: keyed hashes of one table as ``table, key, data``; empty ones do not appear."""
    view = hash_view(rows.filter(F.col("table") == table))
    return view.groupBy("table", "key").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("data"))
