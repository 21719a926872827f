from tickloom.streaming.bars import (
    apply_corrections,
    corrected_checks,
    follow_corrections,
    follow_rewritten_files,
    land_incremental,
)

__all__ = ["apply_corrections", "corrected_checks", "follow_corrections", "follow_rewritten_files", "land_incremental"]
