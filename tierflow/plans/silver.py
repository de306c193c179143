"""Bronze to Silver: the newest batch of each new or re-landed file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierflow.operators import newer_than, to_silver
from tierflow.session import measured
from tierflow.sources.tables import LOAD_ID, TableStore, in_loads, newest_loads
from tierflow.specs import FILE_NAME, LOAD_TS, SourceSpec


def pending_batches(manifest: DataFrame, silver: DataFrame) -> DataFrame:
    """(file_name, update_timestamp): newest batch per file that Silver lacks.

    The manifest has a row per load and file; of Silver one column (plus the partition
    value) is read.
    """
    return newer_than(newest_loads(manifest), silver.select(FILE_NAME, LOAD_TS))


def incoming_rows(store: TableStore, spec: SourceSpec, loads: list[str] | None = None) -> DataFrame:
    """Silver-shaped rows of the pending batches.

    The pending batches come from Bronze's manifest and are worked out first; Bronze is
    then read in their partitions only.  With ``loads``, the ids of the loads just written,
    no other is looked at: no other file can have become pending.
    """
    manifest = store.manifest(spec.name)
    if loads is not None:
        manifest = manifest.filter(F.col(LOAD_ID).isin(loads))
    pending = measured(pending_batches(manifest, store.silver(spec)))
    return to_silver(in_loads(store.bronze(spec), pending), spec)


def refresh_silver(
    store: TableStore, spec: SourceSpec, loads: list[str] | None = None
) -> DataFrame:
    """Replace the pending files in Silver in one write.  Returns Silver.

    ``loads`` names the loads just written; without it everything pending is found, also
    what a failure left between a load and its entry in the manifest.  Running it again
    changes nothing; after a failure half-way it completes what is missing, since a file
    absent from Silver counts as pending.
    """
    if loads is None:
        store.complete_manifest(spec.name)
    store.replace_by_file(incoming_rows(store, spec, loads), spec.name)
    return store.silver(spec)
