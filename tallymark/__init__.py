"""Table reconciliation on Spark: does a target table hold the same data as its source, and where not?"""

from tallymark.operators.buckets import bag_diff_by_buckets, differing_buckets, digest_tree
from tallymark.operators.checks import (
    check_compare,
    check_summary,
    compare_profiles,
    row_count_check,
    table_verdict,
)
from tallymark.operators.discovery import candidate_keys, renamed_columns
from tallymark.operators.hash_profile import hash_profile, hash_profile_compare, hash_profile_long
from tallymark.operators.incremental import profile_incremental
from tallymark.operators.multiset import bag_diff, fingerprint, is_equal, table_equality
from tallymark.operators.profile import check_queries, profile, single_check
from tallymark.operators.reconcile import keyed_diff_small
from tallymark.operators.rows import duplicate_keys, keyed_diff, positional_diff, row_status_counts
from tallymark.operators.schema_diff import metadata_diff, missing_columns, schema_diff
from tallymark.operators.sinks import preview, write_result
from tallymark.plans.compare import Comparison, compare
from tallymark.plans.job import JobResult, default_reader, run
from tallymark.sources.catalog import decode_catalog, describe_columns, resolve_base_table
from tallymark.sources.manifest import read_manifest
from tallymark.sources.readers import filtered, read_files, read_jdbc, read_jdbc_columns, read_query

__all__ = [
    "Comparison",
    "JobResult",
    "bag_diff",
    "bag_diff_by_buckets",
    "candidate_keys",
    "check_compare",
    "check_queries",
    "check_summary",
    "compare",
    "compare_profiles",
    "decode_catalog",
    "default_reader",
    "describe_columns",
    "differing_buckets",
    "digest_tree",
    "duplicate_keys",
    "filtered",
    "fingerprint",
    "hash_profile",
    "hash_profile_compare",
    "hash_profile_long",
    "is_equal",
    "keyed_diff",
    "keyed_diff_small",
    "metadata_diff",
    "missing_columns",
    "positional_diff",
    "preview",
    "profile",
    "profile_incremental",
    "read_files",
    "read_jdbc",
    "read_jdbc_columns",
    "read_manifest",
    "read_query",
    "renamed_columns",
    "resolve_base_table",
    "row_count_check",
    "row_status_counts",
    "run",
    "schema_diff",
    "single_check",
    "table_equality",
    "table_verdict",
    "write_result",
]
