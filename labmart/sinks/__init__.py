from labmart.sinks.guards import insert_missing, seed_if_empty, vocabulary_needed
from labmart.sinks.publish import PublishError, staged_publish
from labmart.sinks.quarantine import accepted, append_with_quarantine, quarantined, reject_reason
from labmart.sinks.tables import arrange, run_name, with_bucket_column, write_table
from labmart.sinks.versions import current_version, publish_version, published

__all__ = [name for name in dir() if not name.startswith("_")]
