from tablewright.sinks.writers import (  # noqa: F401
    append_dead_letters, drop_staging, run_statements, write_files, write_table,
)
