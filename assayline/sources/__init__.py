from assayline.sources.drift import field_profile, schema_drift
from assayline.sources.landed import (
    collection_completeness,
    department_codes,
    landing_ledger,
    page_chains,
    page_completeness,
    page_gaps,
    page_rejects,
    read_envelope,
    read_geojson,
    read_json_array,
    read_json_records,
    rejects,
)
from assayline.sources.layers import (
    Layout,
    delete_partition,
    ensure_namespace,
    fq_table,
    read_table,
    register_external,
    register_views,
    write_table,
)
from assayline.sources.staging import Staging, staged, staging_root

__all__ = [
    "Layout",
    "Staging",
    "collection_completeness",
    "delete_partition",
    "department_codes",
    "ensure_namespace",
    "field_profile",
    "fq_table",
    "landing_ledger",
    "page_chains",
    "page_completeness",
    "page_gaps",
    "page_rejects",
    "read_envelope",
    "read_geojson",
    "read_json_array",
    "read_json_records",
    "read_table",
    "register_external",
    "register_views",
    "rejects",
    "schema_drift",
    "staged",
    "staging_root",
    "write_table",
]
