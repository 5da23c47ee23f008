from tablewright.sources.scan import scan, select_source, replay  # noqa: F401
from tablewright.sources.views import build_view, with_delta, register_tables  # noqa: F401
from tablewright.sources.changes import change_feed, backfill  # noqa: F401
