"""tessera: a PySpark-native toolkit for everyday ETL and geo enrichment.

Public functions take and return DataFrames (or Columns) and leave planning
to Catalyst. Some run a job when called: where types or vocabularies must be
known at plan time, where a hot-key list or a lookup table is written once,
and for row numbers. File listings and CSV header lines are held by the
driver, in proportion to the number of files; other results are bounded.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from tessera.session import checkpoint_dir, get_session

# Python functions of this package that run in tasks (mapInPandas bodies,
# service callables) travel with the task by value, so executors do not need
# the package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from tessera.functions.geohash import geo_decode, geo_encode, geohash, to_coord  # noqa: E402
from tessera.functions.nested import json_field, parse_doc, to_json_text  # noqa: E402
from tessera.functions.paths import (file_format, join_path, location_text, object_stem,  # noqa: E402
                                     parse_object_path, path_levels)
from tessera.operators.enrich import enrich  # noqa: E402
from tessera.operators.geojoin import places_nearby, reverse_geocode, within_distance  # noqa: E402
from tessera.operators.inventory import check_objects, crawl_prefix, crawl_size  # noqa: E402
from tessera.operators.reshape import (array_vocabulary, explode_ranked, multi_hot,  # noqa: E402
                                       union_all_by_name, with_row_index, zip_rows)
from tessera.operators.responses import flatten_geocode, flatten_places  # noqa: E402
from tessera.sources.files import (list_files, read_csv, read_json_docs, read_lines,  # noqa: E402
                                   read_many, read_parquet)
from tessera.sources.one_object import write_one_csv, write_one_json_docs  # noqa: E402
from tessera.sources.sheets import full_refresh, prepare_full_refresh, sheet_to_table  # noqa: E402
from tessera.sources.sinks import write_csv, write_json_docs, write_parquet  # noqa: E402
from tessera.sources.tables import (delete_where, drop_table, keep_unless, read_query,  # noqa: E402
                                    run_statement, sql_query, truncate_table, write_table)

__all__ = [
    "get_session", "checkpoint_dir",
    "geo_encode", "geo_decode", "geohash", "to_coord",
    "json_field", "parse_doc", "to_json_text",
    "file_format", "join_path", "location_text", "object_stem", "parse_object_path", "path_levels",
    "enrich", "places_nearby", "reverse_geocode", "within_distance", "check_objects", "crawl_prefix", "crawl_size",
    "array_vocabulary", "explode_ranked", "multi_hot", "union_all_by_name", "with_row_index", "zip_rows",
    "flatten_geocode", "flatten_places",
    "list_files", "read_csv", "read_json_docs", "read_lines", "read_many", "read_parquet",
    "full_refresh", "prepare_full_refresh", "sheet_to_table",
    "write_csv", "write_json_docs", "write_one_csv", "write_one_json_docs", "write_parquet",
    "delete_where", "drop_table", "keep_unless", "read_query", "run_statement", "sql_query",
    "truncate_table", "write_table",
]
__version__ = "0.1.0"
