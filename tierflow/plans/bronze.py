"""Landing to Bronze."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from tierflow.sources.csv_landing import scan_csv
from tierflow.sources.lineage import stage_bronze
from tierflow.sources.tables import TableStore
from tierflow.specs import SourceSpec


def load_bronze(
    store: TableStore,
    spec: SourceSpec,
    landing: str | list[str],
    load_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """Append every row now in landing, with file name and load timestamp.

    Nothing is skipped or compared: a file still in landing is loaded again, and
    Silver later keeps its newest batch.  Headers of files seen before are not read
    again.  Returns the Bronze table.
    """
    headers = store.path("headers", spec.name)
    rows = stage_bronze(scan_csv(store.spark, landing, spec, with_path=True, header_index=headers), load_ts)
    store.append_bronze(rows, spec.name)
    return store.bronze(spec)
