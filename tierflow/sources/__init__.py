from tierflow.sources.csv_landing import batch_stamp, headers_by_file, scan_csv, write_landing
from tierflow.sources.lineage import stage_bronze, with_file_name, with_load_ts
from tierflow.sources.responses import (
    flatten_gallery_detail,
    flatten_gallery_index,
    flatten_international,
    flatten_player_rankings,
    flatten_players,
    flatten_results,
    flatten_team_rankings,
    gallery_details,
    gallery_photos,
    ragged_table,
    read_documents,
    union_ragged,
)
from tierflow.sources.tables import TableStore

__all__ = [
    "TableStore",
    "batch_stamp",
    "flatten_gallery_detail",
    "flatten_gallery_index",
    "flatten_international",
    "flatten_player_rankings",
    "flatten_players",
    "flatten_results",
    "flatten_team_rankings",
    "gallery_details",
    "gallery_photos",
    "headers_by_file",
    "ragged_table",
    "read_documents",
    "scan_csv",
    "stage_bronze",
    "union_ragged",
    "with_file_name",
    "with_load_ts",
    "write_landing",
]
