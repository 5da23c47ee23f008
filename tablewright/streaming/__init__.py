from tablewright.streaming.capture import (  # noqa: F401
    capture_changes, capture_snapshot_changes, checkpoint_location, committed_batches,
    mark_committed, purge_committed, replace_checkpoint, uncommitted_batches, read_staged,
)
