from .events import parse_event_time, project_minimal, resolve_account
from .naming import add_rates, file_name, route_key, state_key
from .paths import base_prefix, is_account_id, object_key, parse_object_key, search_prefix

__all__ = [
    "add_rates", "base_prefix", "file_name", "is_account_id", "object_key",
    "parse_event_time", "parse_object_key", "project_minimal", "resolve_account",
    "route_key", "search_prefix", "state_key",
]
