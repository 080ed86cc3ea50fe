from .lines import (
    REJECTED,
    adjacency_edges,
    count_rejects,
    parse_labeled,
    parse_movies,
    parse_profiles,
    parse_ratings,
    parse_users,
    read_lines,
    rejected_lines,
    spread_splits,
)
from .delimited import MOVIES, RATINGS, USERS, read_delimited, read_table
from .sinks import as_lines, write_text

__all__ = [
    "MOVIES",
    "RATINGS",
    "REJECTED",
    "USERS",
    "adjacency_edges",
    "as_lines",
    "count_rejects",
    "parse_labeled",
    "parse_movies",
    "parse_profiles",
    "parse_ratings",
    "parse_users",
    "read_delimited",
    "read_lines",
    "read_table",
    "rejected_lines",
    "spread_splits",
    "write_text",
]
