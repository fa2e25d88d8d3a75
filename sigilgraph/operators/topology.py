"""The asset graph: node merges by natural key and all its edge kinds through one linking job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import merge_nodes

# Key columns of node labels, labels whose key must be there, and edge kinds (source, type, target).
NODE_KEYS = {
    "IP": ["address"], "Host": ["hostname"], "Device": ["device_id"], "Subnet": ["range"], "NetworkService": ["port", "protocol"],
    "SoftwareVersion": ["version"], "Application": ["name"], "Role": ["permission"], "Component": ["name"], "Mission": ["name"],
    "OrganizationUnit": ["name"], "MissionDependency": ["id"], "User": ["username", "domain"], "Vulnerability": ["cve_id"],
    "CVE": ["cve_id"], "Node": ["name"],
}
EDGES = [
    ("SoftwareVersion", "ON", "Host"), ("Role", "TO", "Device"), ("Role", "ASSIGNED_TO", "User"), ("User", "ASSIGNED_TO", "Role"),
    ("Device", "TO", "Role"), ("Device", "HAS_IDENTITY", "Host"), ("SoftwareVersion", "IN", "Vulnerability"), ("IP", "HAS_ASSIGNED", "Node"),
    ("Node", "IS_A", "Host"), ("Node", "HAS_ASSIGNED", "IP"), ("Host", "IS_A", "Node"), ("Host", "HAS_IDENTITY", "Device"),
    ("Host", "ON", "SoftwareVersion"), ("IP", "PART_OF", "Subnet"), ("Subnet", "PART_OF", "IP"), ("Mission", "FOR", "OrganizationUnit"),
    ("Mission", "SUPPORTS", "Component"), ("Component", "FROM", "MissionDependency"), ("Component", "PROVIDED_BY", "Host"),
    ("Component", "SUPPORTS", "Mission"), ("Component", "TO", "MissionDependency"), ("OrganizationUnit", "FOR", "Mission"),
    ("OrganizationUnit", "PART_OF", "OrganizationUnit"), ("Subnet", "PART_OF", "Subnet"), ("Subnet", "PART_OF", "OrganizationUnit"),
    ("MissionDependency", "TO", "Component"), ("MissionDependency", "FROM", "Component"), ("OrganizationUnit", "PART_OF", "Subnet"),
    ("Node", "IS_CONNECTED_TO", "Node"), ("NetworkService", "ON", "Host"), ("Host", "PROVIDED_BY", "Component"), ("Host", "ON", "NetworkService"),
    ("Application", "HAS_IDENTITY", "Component"), ("Component", "HAS_IDENTITY", "Application"), ("Vulnerability", "REFERS_TO", "CVE"),
    ("Vulnerability", "IN", "SoftwareVersion"), ("CVE", "REFERS_TO", "Vulnerability"),
]


def merge_assets(label: str, claims: DataFrame, order: str, last: list[str]) -> DataFrame:
    """Nodes of a label by natural key, other columns last non-NULL; blank keys are refused, a user's blank domain is ``default``."""
    if label == "User":
        claims = claims.withColumn("domain", F.coalesce(F.nullif(F.trim("domain"), F.lit("")), F.lit("default")))
    return merge_nodes(claims, NODE_KEYS[label], order, last=last)


def link_all(claims: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (src_label, type, trg_label, src, trg) of allowed kinds whose ends both exist in nodes (label, key): one pair of semi-joins for all
    kinds together, each edge once."""
    allowed = reduce(lambda a, b: a | b, [(F.col("src_label") == s) & (F.col("type") == k) & (F.col("trg_label") == t) for s, k, t in EDGES])
    end = lambda p: nodes.select(F.col("label").alias(f"{p}_label"), F.col("key").alias(p)).distinct()
    rows = claims.where(allowed).select("src_label", "type", "trg_label", "src", "trg").dropna().distinct()
    return rows.join(end("src"), ["src_label", "src"], "left_semi").join(end("trg"), ["trg_label", "trg"], "left_semi")
