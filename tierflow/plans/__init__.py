from tierflow.plans.archive import archive, archive_check, archive_tally, archived_lines, arrival_audit
from tierflow.plans.bronze import load_bronze
from tierflow.plans.extract import land_gallery, land_responses
from tierflow.plans.gold import build_gold, enrich_international, json_gold, nested_gold, team_report
from tierflow.plans.silver import incoming_rows, pending_batches, refresh_silver
from tierflow.plans.sources import each_source

__all__ = [
    "archive",
    "archive_check",
    "archive_tally",
    "archived_lines",
    "arrival_audit",
    "build_gold",
    "each_source",
    "enrich_international",
    "incoming_rows",
    "json_gold",
    "land_gallery",
    "land_responses",
    "load_bronze",
    "nested_gold",
    "pending_batches",
    "refresh_silver",
    "team_report",
]
