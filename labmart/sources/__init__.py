from labmart.sources.discovery import (
    discover_files,
    require_files,
    validate_structure,
    volume_report,
)
from labmart.sources.lab import (
    filter_by_path,
    scan_glob,
    scan_lab,
    union_batches,
    with_source_file,
)
from labmart.sources.vocab import detect_separator, scan_vocab, vocab_file_check

__all__ = [name for name in dir() if not name.startswith("_")]
