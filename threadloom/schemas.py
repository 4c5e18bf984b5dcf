"""Column layouts of the archive entities and of the exported tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Archive kinds, their directories, file prefixes and decoded fields.
DIRECTORIES = {"submissions": "submissions", "comments": "comments", "authors": "authors"}
PREFIXES = {"submissions": "RS_", "comments": "RC_", "authors": "RA_"}
TEXT_FIELDS = {
    "submissions": ("subreddit", "id", "author", "title"),
    "comments": ("subreddit", "id", "author", "body"),
    "authors": ("subreddit", "author"),
    "user_in_subreddit": ("subreddit", "author"),
}
NUMBER_FIELDS = {"authors": ("created_utc",)}
CSV_COLUMNS = {
    "submissions": ("subreddit", "id", "author", "title"),
    "comments": ("subreddit", "id", "author", "body"),
    "authors": ("author", "created_utc"),
    "user_in_subreddit": ("subreddit", "author"),
}
DELETED_AUTHOR = "[deleted]"
MISSING_SUBREDDIT = "No-Subreddit-defined"
EXPERIMENTS = ("UserContributionsInSubreddits", "UsersInSubreddits")

# Exported column name for each internal column.
EDGE_CSV = {
    "i": "i",
    "j": "j",
    "u_ij": "U_ij",
    "degree_i": "degree_i",
    "degree_j": "degree_j",
    "weighted_degree_i": "weighted-degree_i",
    "weighted_degree_j": "weighted-degree_j",
    "avg_weighted_edge_weight_i": "avg-weighted-edge-weight_i",
    "avg_weighted_edge_weight_j": "avg-weighted-edge-weight_j",
    "w_ij": "W_ij",
}
VERTEX_CSV = {
    "i": "i",
    "ui": "Ui",
    "degree": "degree",
    "weighted_degree": "weighted-degree",
    "degree_degree": "degree-degree",
    "weighted_degree_degree": "weighted-degree-degree",
    "local_clustering_coefficient": "local-clustering-coefficient",
}


def _csv_schema(names: dict[str, str], strings: set[str], longs: set[str]) -> T.StructType:
    def kind(column: str) -> T.DataType:
        if column in strings:
            return T.StringType()
        return T.LongType() if column in longs else T.DoubleType()

    return T.StructType([T.StructField(out, kind(col)) for col, out in names.items()])


EDGE_SCHEMA = _csv_schema(EDGE_CSV, {"i", "j"}, {"u_ij", "degree_i", "degree_j"})
VERTEX_SCHEMA = _csv_schema(VERTEX_CSV, {"i"}, {"ui", "degree", "degree_degree"})
COUNT_SCHEMA = T.StructType([T.StructField("subreddit", T.StringType()), T.StructField("count", T.LongType())])
MEMBERSHIP_SCHEMA = T.StructType(
    [T.StructField("subreddit", T.StringType()), T.StructField("author", T.StringType())]
)
