"""The same results as plain SQL over the test tables."""

from __future__ import annotations

from granulake.checks.fixtures import (
    EVENT_NAME_SQL,
    EVENT_TABLES,
    FAULTY_COLUMNS,
    MESSAGES_SQL,
    SHARED_NAME_SQL,
    STORED_FILES_SQL,
    TRACKING_SQL,
)
from granulake.schemas import PRODUCT_COLUMNS

_URL = "gs://gcp-public-data-goes-16/"
_WELL_FORMED = "msg_seq % 50 <> 0"
_ID = "concat('b/', name, '/', CAST(msg_seq AS VARCHAR))"
_TABLE_CASE = (
    "CASE msg_seq % 6 "
    + " ".join(f"WHEN {value} THEN '{table}'" for value, table in EVENT_TABLES.items())
    + " END"
)
_MESSAGES = f"({MESSAGES_SQL}) m"
_EVENTS = f"(SELECT event_id AS k, ts, {EVENT_NAME_SQL} AS name FROM events) e"


def _in_table(table: str, key: str) -> str:
    kinds = [str(value) for value, target in EVENT_TABLES.items() if target == table]
    return f"{key} % 6 IN ({', '.join(kinds)})"


def _value(column: str, kind: str, position: int) -> str:
    if column == "total_size":
        return "k * 37 + 1000"
    if column == "base_url":
        return f"concat('{_URL}', name)"
    if kind == "INTEGER":
        return f"(k * 31 + {position * 7}) % 100000"
    if kind == "FLOAT":
        return f"CAST(((k * 17 + {position * 13}) % 10000) / 8.0 AS DOUBLE)"
    if kind == "TIMESTAMP":
        return "ts"
    return f"concat('{column[:3]}_', CAST(k % 9 AS VARCHAR))"


def _text(column: str, kind: str, position: int) -> str:
    if kind == "TIMESTAMP":
        return "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
    return f"CAST({_value(column, kind, position)} AS VARCHAR)"


def _product(table: str) -> str:
    columns = ", ".join(
        f'{_value(c, kind, i)} AS "{c}"' for i, (c, kind) in enumerate(PRODUCT_COLUMNS[table])
    )
    return f"SELECT {columns} FROM {_EVENTS} WHERE {_in_table(table, 'k')} AND k % 50 <> 0"


def _rejected(table: str, column: str) -> str:
    position = [name for name, _ in PRODUCT_COLUMNS[table]].index(column)
    value = _value(column, "INTEGER", position)
    return (
        f"SELECT concat('{_URL}', name) AS base_url, "
        f"CASE WHEN k % 83 <> 0 AND k % 73 <> 0 AND k % 89 <> 0 AND k % 97 <> 0 THEN {value} END "
        "AS value, CASE WHEN k % 83 = 0 OR k % 73 = 0 THEN 'missing_field' "
        "WHEN k % 97 = 0 AND k % 89 <> 0 THEN 'bad_value' ELSE 'loaded' END AS verdict "
        f"FROM {_EVENTS} WHERE {_in_table(table, 'k')}"
    )


_REJECTED = " UNION ALL ".join(_rejected(table, column) for table, column in FAULTY_COLUMNS.items())

_DEST = "concat('goes/', replace(split_part(name, '/', 5), '.nc', '.csv'))"


def _csv(table: str, events: str = _EVENTS, more: str = "") -> str:
    columns = PRODUCT_COLUMNS[table]
    names = ",".join(c for c, _ in columns)
    values = ", ".join(_text(c, kind, i) for i, (c, kind) in enumerate(columns))
    line_end = "chr(13), chr(10)"
    return (
        f"SELECT {more} name, concat('gs://products/', {_DEST}) AS dest_uri, "
        f"concat('{names}', {line_end}, concat_ws(',', {values}), {line_end}) AS csv_text "
        f"FROM {events} WHERE {_in_table(table, 'k')} AND k % 50 <> 0"
    )


_INGESTED = " UNION ALL BY NAME ".join(
    f"SELECT '{table}' AS table_name, * FROM ({_product(table)}) p" for table in PRODUCT_COLUMNS
)
_SHARED = f"(SELECT event_id AS k, ts, {SHARED_NAME_SQL} AS name FROM events) e"
_OBJECTS = " UNION ALL ".join(
    _csv(table, more=f"'{table}' AS table_name,") for table in PRODUCT_COLUMNS
)
_SHARED_OBJECTS = " UNION ALL ".join(
    _csv(table, _SHARED, f"'{table}' AS table_name, k, ts,") for table in PRODUCT_COLUMNS
)
_CURRENT_OBJECTS = (
    "SELECT dest_uri, name, table_name, csv_text, CAST(1 AS BIGINT) AS rows_of_name "
    f"FROM ({_SHARED_OBJECTS}) o QUALIFY row_number() OVER (PARTITION BY dest_uri "
    "ORDER BY date_trunc('second', ts) DESC, concat('b/', name, '/', CAST(k AS VARCHAR)) DESC) = 1"
)
_LOADED_FILES = " UNION ALL BY NAME ".join(
    f"SELECT '{table}' AS table_name, * FROM ({_product(table)} AND (k // 500) % 3 <> 1) p "
    f"UNION ALL BY NAME SELECT DISTINCT '{table}' AS table_name, k // 500 AS refused_part FROM {_EVENTS} "
    f"WHERE {_in_table(table, 'k')} AND k % 50 <> 0 AND (k // 500) % 3 = 1 AND k % 100 BETWEEN 1 AND 12"
    for table in PRODUCT_COLUMNS
)
_WAITED = (
    f"SELECT concat('{_URL}', name) AS base_url, CASE k % 5 WHEN 4 THEN 'object_not_found' ELSE 'loaded' END "
    f"AS verdict, CAST(1 AS BIGINT) AS n FROM {_EVENTS} WHERE k % 50 <> 0 AND k % 6 <> 4 "
    f"UNION ALL SELECT NULL, 'malformed', count(*) FROM {_EVENTS} WHERE k % 50 = 0 HAVING count(*) > 0"
)
_DELIVERED = " UNION ALL ".join(
    f"SELECT '{option}' AS option, CASE WHEN {_WELL_FORMED} THEN {_ID} END AS id, value, "
    f"CAST({n} AS BIGINT) AS n FROM {_MESSAGES}"
    for option, n in (("as delivered", "CASE WHEN msg_seq % 3 = 0 THEN 2 ELSE 1 END"), ("distinct", "1"))
)

_TABLE_REPORT = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST({len(columns)} AS BIGINT) AS columns, "
    f"TRUE AS created_once, count(*) AS loaded FROM events "
    f"WHERE {_in_table(table, 'event_id')} AND event_id % 50 <> 0"
    for table, columns in PRODUCT_COLUMNS.items()
)

_FILES = f"({STORED_FILES_SQL}) c"
_TRACKING = f"({TRACKING_SQL}) t"
_UNSEEN = (
    f"SELECT path, mtime, file_type, filename FROM {_FILES} "
    f"WHERE NOT EXISTS (SELECT 1 FROM {_TRACKING} WHERE t.project = 'Test' AND t.path = c.path)"
)
_QUEUED = f"SELECT filename, path, mtime, file_type FROM {_TRACKING} WHERE inqueue = 1 AND project = 'Test'"


def _claimed(rows: int) -> str:
    return f"{_QUEUED} ORDER BY mtime, path LIMIT {rows}"


_URL_OF_PATH = "regexp_replace(path, '/store', 'gs:/', 'g')"
_DATASET = "concat('dat_', CAST(k % 9 AS VARCHAR))"
_SCENE = "concat('sce_', CAST(k % 9 AS VARCHAR))"
_PIXELS = "CAST((k * 31 + 98) % 100000 AS VARCHAR)"
_WEST = "CAST(CAST(((k * 17 + 117) % 10000) / 8.0 AS DOUBLE) AS VARCHAR)"
_LINE = (
    f"CASE file_type WHEN 'rad' THEN concat(',', {_URL_OF_PATH}, ',', {_DATASET}, ',', {_SCENE}, "
    f"',', {_PIXELS}, ',', {_WEST}) ELSE concat({_URL_OF_PATH}, ',', {_DATASET}) END"
)
_LINES = f"SELECT path, file_type, {_LINE} AS csv_line FROM {_FILES}"

_EXPORT = (
    f"SELECT data, mtime, path FROM {_TRACKING} "
    "WHERE file_type = 'rad' AND data > '' AND project = 'Test'"
)


def oracle_sql() -> dict[str, str]:
    return {
        "notification_source": f"SELECT value FROM {_MESSAGES}",
        "parse_notifications": (
            f"SELECT msg_seq, name, {_ID} AS id, size FROM {_MESSAGES} WHERE {_WELL_FORMED}"
        ),
        "relevant_notifications": (
            "SELECT msg_seq, json_extract_string(value, '$.name') AS name, "
            "json_extract_string(value, '$.id') AS id, "
            f"json_extract_string(value, '$.size') AS size FROM (SELECT * FROM {_MESSAGES} "
            "WHERE json_valid(value)) v WHERE "
            + " OR ".join(
                f"contains(json_extract_string(value, '$.name'), '{text}')"
                for text in ("ABI-L1b", "ABI-L2-CMIP", "ABI-L2-MCMIP", "GLM-L2-LCFA")
            )
        ),
        "malformed_notifications": (
            f"SELECT msg_seq, value FROM {_MESSAGES} WHERE NOT json_valid(value)"
        ),
        "skipped_notifications": (
            f"SELECT msg_seq, name FROM {_MESSAGES} WHERE {_WELL_FORMED} AND msg_seq % 6 = 4"
        ),
        "route_products": (
            f"SELECT msg_seq, name, {_TABLE_CASE} AS table_name FROM {_MESSAGES} "
            f"WHERE {_WELL_FORMED}"
        ),
        "granule_header": (
            "SELECT name, "
            "CAST(CASE k % 6 WHEN 3 THEN 6 ELSE 8 END AS INTEGER) AS attributes, "
            "CAST(CASE k % 6 WHEN 1 THEN 8 WHEN 2 THEN 84 WHEN 3 THEN 7 ELSE 12 END AS INTEGER) "
            "AS variables, "
            f"CASE WHEN k % 6 <> 3 THEN {_SCENE} END AS scene_id, "
            "CASE WHEN k % 6 IN (0, 1, 5) THEN concat('ban_', CAST(k % 9 AS VARCHAR)) END "
            "AS band_units, "
            "CASE k % 6 WHEN 0 THEN CAST((k * 31 + 98) % 100000 AS VARCHAR) "
            "WHEN 5 THEN CAST((k * 31 + 98) % 100000 AS VARCHAR) "
            "WHEN 1 THEN CAST((k * 31 + 105) % 100000 AS VARCHAR) END AS valid_pixels "
            f"FROM {_EVENTS} WHERE k % 6 <> 4"
        ),
        "message_granule_join": (
            f"SELECT msg_seq, name, {_ID} AS id, size, {_TABLE_CASE} AS table_name, "
            "concat('dat_', CAST(msg_seq % 9 AS VARCHAR)) AS dataset_name "
            f"FROM {_MESSAGES} WHERE {_WELL_FORMED} AND msg_seq % 6 <> 4"
        ),
        "product_l1b": _product("abi_l1b_radiance"),
        "product_cmip": _product("abi_l2_cmip"),
        "product_mcmip": _product("abi_l2_mcmip"),
        "product_glm": _product("glm_l2_lcfa"),
        "load_rejects": _REJECTED,
        "granule_csv": " UNION ALL ".join(_csv(table) for table in PRODUCT_COLUMNS),
        "destination_uri": (
            f"SELECT name, concat('gs://products/', {_DEST}) AS dest_uri, {_DEST} AS local_name "
            f"FROM {_MESSAGES} WHERE {_WELL_FORMED} AND msg_seq % 6 <> 4"
        ),
        "csv_roundtrip": _product("abi_l2_cmip"),
        "csv_load": _LOADED_FILES,
        "csv_objects": _OBJECTS,
        "object_view": _CURRENT_OBJECTS,
        "late_headers": _WAITED,
        "distinct_messages": _DELIVERED,
        "ensure_tables": _TABLE_REPORT,
        "ingest_stream": (
            f"{_INGESTED} UNION ALL BY NAME SELECT 'rejects' AS table_name, "
            f"concat('malformed ', value) AS item FROM {_MESSAGES} WHERE NOT json_valid(value)"
        ),
        "catalog_glob": (
            f"SELECT path, mtime, filename FROM {_FILES} WHERE regexp_matches(path, "
            r"'^/store/pub/ABI-L2-MCMIPM/1997/[^/]*/[^/]*/[^/]*\.nc$')"
        ),
        "catalog_typed": (
            "SELECT path, mtime, location_type AS file_type FROM (SELECT path, mtime, "
            "CASE WHEN file_type = 'mcm' AND year(mtime) BETWEEN 1990 AND 1999 THEN 'mcm' "
            "WHEN year(mtime) = 1997 THEN 'y97' "
            "WHEN file_type = 'rad' AND year(mtime) BETWEEN 1992 AND 1995 THEN 'rad' END "
            f"AS location_type FROM {_FILES}) x WHERE location_type IS NOT NULL"
        ),
        "existing_paths": (
            f"SELECT path, filename FROM {_TRACKING} WHERE project = 'Test' "
            f"AND EXISTS (SELECT 1 FROM {_FILES} WHERE c.path = t.path)"
        ),
        "unseen_files": f"SELECT path, mtime, file_type FROM ({_UNSEEN}) u",
        "enqueue_new_files": (
            "SELECT project, filename, path, data, mtime, file_type, "
            f"CAST(inqueue AS INTEGER) AS inqueue FROM {_TRACKING} WHERE project = 'Test' "
            "UNION ALL SELECT 'Test', filename, path, '', mtime, file_type, 1 "
            f"FROM ({_UNSEEN}) u"
        ),
        "path_functions": (
            "SELECT name, split_part(name, '/', 5) AS base, '' AS base_of_folder, "
            "concat('goes/', replace(concat(split_part(name, '/', 5), '.nc'), '.nc', '.csv')) "
            "AS csv_of_double_suffix, concat('/store/pub/', name) AS joined, "
            "concat('/store/pub/', name) AS joined_at_slash, concat('/', name) AS joined_absolute, "
            f"name AS joined_to_nothing FROM {_EVENTS}"
        ),
        "base_url_prefix": (
            f"SELECT path, {_URL_OF_PATH} AS base_url, "
            f"concat({_URL_OF_PATH}, {_URL_OF_PATH}) AS all_replaced FROM {_FILES}"
        ),
        "tracking_scan": f"SELECT * FROM {_TRACKING} WHERE project = 'Test'",
        "queue_counts": (
            f"SELECT project, inqueue, count(*) AS files FROM {_TRACKING} GROUP BY project, inqueue"
        ),
        "claim_batch": _claimed(50),
        "claim_capped": _claimed(150),
        "claim_state": (
            f"WITH claimed AS ({_claimed(50)}) SELECT project, filename, path, "
            "CASE WHEN hit THEN '' ELSE data END AS data, mtime, file_type, "
            "CASE WHEN hit THEN 2 ELSE inqueue END AS inqueue FROM (SELECT *, project = 'Test' "
            f"AND filename IN (SELECT filename FROM claimed) AS hit FROM {_TRACKING}) s"
        ),
        "complete_batch": (
            f"WITH claimed AS ({_claimed(50)}), lines AS ({_LINES}) "
            "SELECT t.project, t.filename, t.path, "
            "CASE WHEN n.filename IS NULL THEN t.data ELSE l.csv_line END AS data, "
            "t.mtime, t.file_type, "
            "CASE WHEN n.filename IS NULL THEN t.inqueue ELSE 0 END AS inqueue "
            f"FROM {_TRACKING} LEFT JOIN claimed n ON t.project = 'Test' "
            "AND t.filename = n.filename LEFT JOIN lines l ON l.path = n.path"
        ),
        "drain_queue": (
            f"WITH lines AS ({_LINES}) SELECT t.project, t.filename, t.path, "
            "CASE WHEN t.inqueue = 1 THEN l.csv_line ELSE t.data END AS data, "
            "t.mtime, t.file_type, CAST(CASE WHEN t.inqueue = 1 THEN 0 ELSE t.inqueue END "
            f"AS INTEGER) AS inqueue FROM {_TRACKING} JOIN lines l ON l.path = t.path "
            "WHERE t.project = 'Test'"
        ),
        "config_metadata": (
            "SELECT path, file_type, CAST(NULL AS VARCHAR) AS absent_col, "
            f"{_URL_OF_PATH} AS base_url, {_DATASET} AS dataset, "
            f"CASE WHEN file_type = 'rad' THEN {_SCENE} END AS scene, "
            f"CASE WHEN file_type = 'rad' THEN {_PIXELS} END AS valid_px, "
            f"CASE WHEN file_type = 'rad' THEN {_WEST} END AS west FROM {_FILES}"
        ),
        "metadata_csv_line": _LINES,
        "export_metadata": (
            "SELECT row_number() OVER (ORDER BY mtime, path) AS position, data AS line "
            f"FROM ({_EXPORT}) x UNION ALL "
            "SELECT 0, 'absent_col,base_url,dataset,scene,valid_px,west'"
        ),
        "export_page": (
            f"SELECT data AS line FROM ({_EXPORT}) x ORDER BY mtime, path LIMIT 100 OFFSET 200"
        ),
    }
