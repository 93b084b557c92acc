"""tidewater: landing-zone ingest, run auditing, golden regression and
health probes as set-based Spark jobs."""

from .schema import FileClass, string_schema
from .session import build_session, configure, shared_root, work_dir
from .plans.ingest import ImbalanceError, IngestResult, ingest, list_landing
from .plans.audit import audited_run, create_audit_table
from .plans.golden import revert_specs, revert_table, run_golden, run_test_dir
from .plans.probes import run_probes
from .streaming.landing import continuous_ingest, pickup_to_bronze, release_ready
from .streaming.watermark import incremental_rows, reset_watermarks

__all__ = [
    "FileClass", "string_schema", "build_session", "configure", "shared_root", "work_dir",
    "ImbalanceError", "IngestResult", "ingest", "list_landing",
    "audited_run", "create_audit_table",
    "revert_specs", "revert_table", "run_golden", "run_test_dir",
    "run_probes",
    "continuous_ingest", "pickup_to_bronze", "release_ready",
    "incremental_rows", "reset_watermarks",
]
