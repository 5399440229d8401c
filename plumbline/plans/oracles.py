"""ANSI SQL for each registered query, computed straight from the base tables."""

from __future__ import annotations

from plumbline.functions.constants import CHECKS, RUNNING, STILL_RUNNING, UNKNOWN_PIPELINE
from plumbline.plans.fixtures import CONNECTION
from plumbline.plans.queries import CUSTOMER_TEXT, RUN_DATE, TABLE_KEYS

# The template corpus as relations: pl pipelines, act activities, ls linked services, ds data sets, tr triggers,
# df data flows, ir integration runtimes; res all resources, dep all dependency targets.
CORPUS = """
cut AS (SELECT *, l_linenumber // 1000 AS block FROM lineitem),
ord AS (SELECT *, o_custkey // 10 AS f,
               lag(o_orderkey) OVER (PARTITION BY o_custkey // 10 ORDER BY o_orderkey) AS previous FROM orders),
blocks AS (SELECT o_orderkey, 0 AS block FROM orders UNION SELECT l_orderkey, block FROM cut WHERE block > 0),
pl AS (SELECT ord.*, block, 'pl_' || o_orderkey || CASE WHEN block = 0 THEN '' ELSE '_' || block END AS pname,
              CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN ''
                   ELSE 'Order ' || o_orderkey END AS description,
              CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS folder,
              o_orderkey % 5 > 1 AS annotated
       FROM ord JOIN blocks USING (o_orderkey)),
act AS (SELECT cut.*, o_custkey // 10 AS f,
               'pl_' || l_orderkey || CASE WHEN block = 0 THEN '' ELSE '_' || block END AS pname,
               row_number() OVER (PARTITION BY l_orderkey, block
                                  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn,
               CASE WHEN l_linestatus = 'O' AND l_quantity <= 25 THEN 'ForEach' WHEN l_linestatus = 'O' THEN 'Copy'
                    ELSE 'Lookup' END AS type,
               CASE WHEN l_discount <> 0 THEN 'part ' || l_partkey END AS description,
               CASE l_returnflag WHEN 'R' THEN '7.00:00:00' WHEN 'A' THEN '0.12:00:00' END AS timeout,
               CASE WHEN l_tax = 0 THEN true END AS sequential,
               CASE WHEN l_quantity % 2 = 0 THEN CAST(l_quantity * 4 AS INTEGER) END AS batch
        FROM cut JOIN orders ON o_orderkey = l_orderkey),
edge AS (SELECT f, pname, rn, rn - 1 AS up, CASE WHEN l_returnflag = 'R' THEN 'Failed' ELSE 'Succeeded' END AS cond,
                rn > 2 AND l_linestatus = 'O' AS several FROM act WHERE rn > 1
         UNION ALL SELECT f, pname, rn, rn - 2, 'Failed', true FROM act WHERE rn > 2 AND l_linestatus = 'O'),
ls AS (SELECT *, c_custkey // 10 AS f, 'ls_' || c_custkey AS lname,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'AzureKeyVault' WHEN 'AUTOMOBILE' THEN 'AzureSqlDatabase'
                                ELSE 'AzureBlobFS' END AS type FROM customer),
ds AS (SELECT *, p_partkey // 14 AS f, 'ds_' || p_partkey AS dname,
              'ls_' || (10 * (p_partkey // 14) + p_partkey % 10) AS service FROM part),
tr AS (SELECT e.*, o_custkey // 10 AS f, 'tr_' || event_id AS tname FROM events e JOIN orders ON o_orderkey = event_id
       WHERE event_type = 'signup'),
df AS (SELECT *, s_suppkey AS f, 'df_' || s_suppkey AS fname FROM supplier),
ir AS (SELECT *, CAST(n_nationkey % 15 AS BIGINT) AS f, 'ir_' || n_nationkey AS iname FROM nation),
res AS (SELECT f, 'pipelines' AS kind, pname AS name FROM pl UNION ALL SELECT f, 'linkedServices', lname FROM ls
        UNION ALL SELECT f, 'datasets', dname FROM ds UNION ALL SELECT f, 'triggers', tname FROM tr
        UNION ALL SELECT f, 'dataflows', fname FROM df UNION ALL SELECT f, 'integrationRuntimes', iname FROM ir),
plset AS (SELECT DISTINCT f, pname, 'datasets' AS kind, 'ds_' || (14 * f + l_partkey % 14) AS name
          FROM act WHERE l_quantity = 50),
dep AS (SELECT f, 'pipelines' AS from_kind, pname AS from_name, kind, name FROM plset
        UNION ALL SELECT f, 'pipelines', pname, 'pipelines', 'pl_' || previous FROM pl
                  WHERE o_totalprice > 400000 AND previous IS NOT NULL
        UNION ALL SELECT f, 'datasets', dname, 'linkedServices', service FROM ds
        UNION ALL SELECT f, 'triggers', tname, 'pipelines', 'pl_' || event_id FROM tr WHERE value <= 100),
used AS (SELECT f, kind, name FROM dep UNION SELECT f, 'triggers', tname FROM tr WHERE value <= 100),
unused AS (SELECT DISTINCT f, kind, name FROM res ANTI JOIN used USING (f, kind, name)),
factory AS (SELECT DISTINCT f FROM res)
"""

# Name and pipeline of the findings of each check.
_FINDINGS = {
    1: "SELECT f, name, NULL AS pipeline FROM unused WHERE kind = 'pipelines'",
    2: """SELECT DISTINCT s.f, s.pname AS name, NULL AS pipeline FROM edge s
          JOIN edge w ON w.several AND w.cond = 'Failed' AND w.f = s.f AND w.pname = s.pname AND w.up = s.rn
          JOIN edge b ON b.several AND b.cond = 'Failed' AND b.f = s.f AND b.pname = s.pname AND b.up = s.up
          WHERE s.cond = 'Succeeded'""",
    3: "SELECT f, pname AS name, NULL AS pipeline FROM pl WHERE coalesce(description, '') = ''",
    4: "SELECT f, pname AS name, NULL AS pipeline FROM pl WHERE folder IS NULL",
    5: "SELECT f, pname AS name, NULL AS pipeline FROM pl WHERE NOT annotated",
    6: "SELECT f, fname AS name, NULL AS pipeline FROM df WHERE s_nationkey % 2 = 0",
    7: "SELECT f, 'a' || rn AS name, pname AS pipeline FROM act WHERE timeout = '7.00:00:00'",
    8: "SELECT f, 'a' || rn AS name, pname AS pipeline FROM act WHERE description IS NULL",
    9: "SELECT f, 'a' || rn AS name, pname AS pipeline FROM act WHERE type = 'ForEach' AND sequential IS NULL AND batch IS NULL",
    10: "SELECT f, 'a' || rn AS name, pname AS pipeline FROM act WHERE type = 'ForEach' AND sequential IS NULL AND coalesce(batch, 0) < 50",
    11: """SELECT f, lname AS name, NULL AS pipeline FROM ls
           WHERE type <> 'AzureKeyVault' AND NOT (c_custkey % 3 = 0 AND c_custkey % 2 <> 0)""",
    12: "SELECT f, name, NULL AS pipeline FROM unused WHERE kind = 'linkedServices'",
    13: "SELECT f, lname AS name, NULL AS pipeline FROM ls WHERE c_acctbal < 0",
    14: "SELECT f, lname AS name, NULL AS pipeline FROM ls WHERE c_custkey % 4 = 0",
    15: "SELECT f, name, NULL AS pipeline FROM unused WHERE kind = 'datasets'",
    16: "SELECT f, dname AS name, NULL AS pipeline FROM ds WHERE p_size % 2 = 0",
    17: "SELECT f, dname AS name, NULL AS pipeline FROM ds WHERE p_size < 10",
    18: "SELECT f, dname AS name, NULL AS pipeline FROM ds WHERE p_size % 3 = 0",
    19: "SELECT f, name, NULL AS pipeline FROM unused WHERE kind = 'triggers'",
    20: "SELECT f, tname AS name, NULL AS pipeline FROM tr WHERE user_id % 3 = 0",
    21: "SELECT f, tname AS name, NULL AS pipeline FROM tr WHERE user_id % 5 = 0",
}


def _details(*numbers: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT f AS template_id, {no} AS "CheckNo", '{component}' AS "Component", name AS "Name",
            '{detail}' AS "CheckDetail", '{severity}' AS "Severity", CAST(pipeline AS VARCHAR) AS "BelongsToPipeline"
            FROM ({_FINDINGS[no]})"""
        for no, component, severity, _, detail in CHECKS
        if no in numbers
    )


def _summary(as_written: bool = False) -> str:
    counted = " UNION ALL ".join(
        f"SELECT f, {no} AS no FROM ({_FINDINGS[5 if as_written and no == 14 else no]})" for no in _FINDINGS
    )
    values = ", ".join(f"({no}, '{summary}', '{severity}')" for no, _, severity, summary, _ in CHECKS)
    return f"""SELECT factory.f AS template_id, v.no AS "CheckNo", count(found.no) AS "IssueCount",
        v.summary AS "CheckDetail", v.severity AS "Severity"
        FROM factory CROSS JOIN (VALUES {values}) v(no, summary, severity)
        LEFT JOIN ({counted}) found ON found.f = factory.f AND found.no = v.no GROUP BY ALL"""


def _corpus(sql: str, more: str = "") -> str:
    return f"WITH {CORPUS}{more} {sql}"


def _typed(kind: str) -> str:
    return f"'Microsoft.DataFactory/factories/{kind}'"


_STATUS = (
    "CASE event_type WHEN 'click' THEN 'InProgress' WHEN 'view' THEN 'Queued' WHEN 'purchase' THEN 'Succeeded'"
    " WHEN 'signup' THEN 'Succeeded' WHEN 'error' THEN 'Failed' END"
)
_RUNNING = ", ".join(f"'{s}'" for s in RUNNING)
LOG = f"""
runs AS (SELECT CAST(event_id AS VARCHAR) AS run_id, 'pl_' || user_id AS pipeline_name, {_STATUS} AS status,
                ts AS last_updated FROM events),
latest AS (SELECT pipeline_name, arg_max(run_id, last_updated) AS run_id, arg_max(status, last_updated) AS status
           FROM runs GROUP BY pipeline_name),
named AS (SELECT 'pl_' || c_custkey AS pipeline_name FROM customer),
user_run AS (SELECT CAST(user_id AS VARCHAR) AS run_id, 'pl_' || user_id AS pipeline_name,
                    arg_max({_STATUS}, ts) AS status, max(ts) AS last_updated FROM events GROUP BY user_id),
acts AS (SELECT CAST(user_id AS VARCHAR) AS run_id, 'act_' || event_id AS activity_name, event_type AS activity_type, ts,
                'event ' || event_id AS message,
                CASE WHEN event_type = 'error' THEN CAST(regexp_extract(props, ': *(-?[0-9]+)', 1) AS INTEGER) END AS k
         FROM events),
errs AS (SELECT *, CASE WHEN k > 0 THEN CAST(k AS VARCHAR) ELSE '' END AS code FROM acts WHERE k IS NOT NULL)
"""


def _log(sql: str) -> str:
    return f"WITH {LOG} {sql}"


_LINES = "SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS value FROM documents"
_WORDS = "SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word"
_ORDER_LINES = f"""SELECT 'SO' || o_orderkey AS "SalesOrderNumber", count(*) AS "DetailLineCount" FROM orders
    JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderdate = TIMESTAMP '{RUN_DATE}' GROUP BY o_orderkey"""
_QUOTED = " || ',' || ".join(f"""'"' || {c} || '"'""" for c in CUSTOMER_TEXT)
_CUSTOMER = f"SELECT {', '.join(CUSTOMER_TEXT)} FROM customer"
_HOUR_FOLDER = "'Year=' || strftime({t}, '%Y') || '/Month=' || strftime({t}, '%m') || '/Day=' || strftime({t}, '%d') || '/Hour=' || strftime({t}, '{h}')"
_TREE = """
located AS (SELECT n_nationkey, '/' || r_name || '/' || n_name AS parent FROM nation JOIN region ON r_regionkey = n_regionkey),
tree AS (SELECT parent || '/' || c_name AS path,
                CASE WHEN c_custkey % 10 <> 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'SCALA' WHEN 1 THEN 'PYTHON'
                     WHEN 2 THEN 'SQL' ELSE 'R' END END AS language,
                CASE WHEN c_custkey % 10 = 0 THEN 'LIBRARY' ELSE 'NOTEBOOK' END AS type
         FROM customer JOIN located ON n_nationkey = c_nationkey)
"""
_FACTORIES = """SELECT DISTINCT c_custkey // 10 AS "DataFactoryId", {name} AS "DataFactoryName" FROM customer"""
_STAGE_ROWS = """SELECT o_orderkey, CAST(o_orderkey % 7 + 1 AS INTEGER) AS "StageId", {enabled} AS "Enabled" FROM orders"""
_NUMBERS = "(SELECT row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)"
_OBJECT_NAME = "CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'FK_' || c_name || '_x' END"


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    # Templates
    o["read_template_lines"] = o["read_templates"] = _corpus(
        "SELECT f AS template_id, 'factory_' || f AS factory_name, count(*) AS resources FROM res GROUP BY f"
    )
    o["shred_resources"] = _corpus(
        """SELECT r.f AS template_id, '[concat(parameters(''factoryName''), ''/' || r.name || ''')]' AS name,
           'Microsoft.DataFactory/factories/' || r.kind AS type, '2018-06-01' AS "apiVersion", coalesce(d.list, '') AS "dependsOn"
           FROM res r LEFT JOIN (
               SELECT f, from_kind, from_name, string_agg(t, ';' ORDER BY t) AS list FROM (
                   SELECT f, from_kind, from_name, '[concat(variables(''factoryId''), ''/' || kind || '/' || name || ''')]' AS t FROM dep)
               GROUP BY ALL) d ON d.f = r.f AND d.from_name = r.name AND d.from_kind = r.kind"""
    )
    o["shred_activities"] = _corpus(
        """SELECT a.f AS template_id, a.pname AS "PipelineName", CAST(a.rn - 1 AS INTEGER) AS position, 'a' || a.rn AS name,
           a.type, a.description, coalesce(e.list, '') AS "dependsOn", a.timeout, a.sequential AS "isSequential", a.batch AS "batchCount"
           FROM act a LEFT JOIN (SELECT f, pname, rn, string_agg('a' || up || ':' || cond, ';' ORDER BY 'a' || up || ':' || cond) AS list
                                 FROM edge GROUP BY ALL) e ON e.f = a.f AND e.pname = a.pname AND e.rn = a.rn"""
    )
    o["resources_of_type"] = _corpus(
        """SELECT f AS template_id, 'Microsoft.DataFactory/factories/' || kind AS type, name FROM res
           WHERE kind IN ('triggers', 'dataflows')"""
    )
    o["t_factory_name"] = _corpus("""SELECT f AS template_id, 'factory_' || f AS "DataFactoryName" FROM factory""")
    o["t_component_summary"] = _corpus(
        """SELECT f AS template_id, upper(kind[1]) || kind[2:] AS "ComponentType", count(*) AS "Count" FROM res GROUP BY ALL
           UNION SELECT factory.f, 'Activities', count(act.rn) FROM factory LEFT JOIN act USING (f) GROUP BY factory.f"""
    )
    o["t_pipeline_info"] = _corpus(
        """SELECT pl.f AS template_id, pl.pname AS "PipelineName", pl.description AS "Description", folder AS "FolderName",
           count(*) AS "ActivityCount" FROM pl JOIN act ON act.f = pl.f AND act.pname = pl.pname
           WHERE folder IS NOT NULL GROUP BY ALL"""
    )
    o["t_activity_info"] = _corpus(
        """SELECT f AS template_id, 'a' || rn AS "ActivityName", type AS "Type", description AS "Description",
           pname AS "BelongsToPipeline" FROM act"""
    )
    o["t_linked_service_info"] = _corpus(
        """SELECT f AS template_id, lname AS "LinkedServiceName", type AS "Type",
           CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS "UsingKeyVault" FROM ls"""
    )
    o["t_dataset_info"] = _corpus(
        """SELECT f AS template_id, dname AS "DatasetName", p_type AS "Type", p_brand AS "FolderName",
           service AS "ConnectedToLinkedService" FROM ds WHERE p_size >= 10"""
    )
    o["t_integration_runtime_info"] = _corpus(
        """SELECT f AS template_id, iname AS "IntegrationRuntimeName",
           CASE WHEN n_regionkey < 2 THEN 'Managed' ELSE 'SelfHosted' END AS "Type" FROM ir"""
    )
    o["t_dataflow_info"] = _corpus("""SELECT f AS template_id, fname AS "DataFlowName", 'MappingDataFlow' AS "Type" FROM df""")
    o["t_trigger_info"] = _corpus(
        """SELECT f AS template_id, tname AS "TriggerName",
           CASE WHEN value < 50 THEN 'ScheduleTrigger' ELSE 'TumblingWindowTrigger' END AS "Type",
           CASE WHEN user_id % 2 = 0 THEN 'Started' ELSE 'Stopped' END AS "Status" FROM tr"""
    )

    # Graph and checks
    o["g_resources"] = _corpus("SELECT DISTINCT f AS template_id, kind || '|' || name AS key FROM res")
    o["g_dependants"] = _corpus("SELECT f AS template_id, kind || '|' || name AS key FROM used")
    o["redundant_resources"] = _corpus("SELECT f AS template_id, kind || '|' || name AS key FROM unused")
    for number in _FINDINGS:
        o[f"c{number:02d}"] = _corpus(_details(number))
    o["c01_indirect"] = f"""WITH RECURSIVE {CORPUS},
        started(f, name) AS (SELECT f, name FROM dep WHERE from_kind = 'triggers'
                             UNION SELECT d.f, d.name FROM dep d JOIN started s ON d.f = s.f AND d.from_name = s.name
                                   WHERE d.from_kind = 'pipelines' AND d.kind = 'pipelines')
        {_details(1).replace(_FINDINGS[1], "SELECT DISTINCT f, pname AS name, NULL AS pipeline FROM pl ANTI JOIN started ON started.f = pl.f AND started.name = pname")}"""
    o["c_details"] = _corpus(_details(*_FINDINGS))
    o["c_summary"] = o["c_summary_from_documents"] = _corpus(_summary())
    o["c_summary_as_written"] = _corpus(_summary(as_written=True))
    o["c_totals"] = _corpus(
        f"""SELECT template_id, count(*) AS checks_run, count(*) FILTER (WHERE "IssueCount" <> 0) AS checks_with_issues,
            CAST(sum("IssueCount") AS BIGINT) AS total_issues FROM ({_summary()}) GROUP BY template_id"""
    )
    o["c_severity_totals"] = _corpus(
        f"""SELECT "Severity", CAST(sum("IssueCount") AS BIGINT) AS "IssueCount",
            CASE "Severity" WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS "Rank"
            FROM ({_summary()}) GROUP BY "Severity" ORDER BY 3"""
    )
    o["workspace_tree"] = f"WITH {_TREE} SELECT path, language, type FROM tree"
    o["export_manifest"] = f"""WITH {_TREE}
        SELECT path, '/export' || path || CASE language WHEN 'SCALA' THEN '.scala' WHEN 'PYTHON' THEN '.ipynb'
               WHEN 'SQL' THEN '.sql' WHEN 'R' THEN '.r' END AS target,
               CASE WHEN language = 'PYTHON' THEN 'JUPYTER' WHEN language IS NOT NULL THEN 'SOURCE' END AS format,
               CASE WHEN type = 'LIBRARY' THEN 'skipped' ELSE 'export' END AS action FROM tree"""

    # Run log
    o["r_latest_run"] = _log(
        """SELECT pipeline_name AS "PipelineName", coalesce(run_id, '') AS "RunIdUsed", coalesce(status, '') AS "Status"
           FROM named LEFT JOIN latest USING (pipeline_name)"""
    )
    o["r_status_by_run_id"] = _log(
        """SELECT 'order_' || o_orderkey AS "PipelineName", CAST(o_orderkey AS VARCHAR) AS "RunIdUsed", status AS "Status"
           FROM orders LEFT JOIN runs ON run_id = CAST(o_orderkey AS VARCHAR)"""
    )
    o["r_terminal_runs"] = _log(
        f"""SELECT pipeline_name AS "PipelineName", u.run_id AS "RunIdUsed", status AS "Status",
            CASE WHEN status <> 'Succeeded' THEN
              '{{"errorCode":"' || e.code || '","failureType":"UserError","message":"' || e.message || '"}}' END AS "ErrorDetails"
            FROM user_run u LEFT JOIN (SELECT run_id, arg_min(code, ts) AS code, arg_min(message, ts) AS message
                                       FROM errs GROUP BY run_id) e USING (run_id)
            WHERE status NOT IN ({_RUNNING})"""
    )
    o["r_activity_error_rows"] = _log(
        """SELECT run_id AS "RunId", activity_name AS "ActivityName", activity_type AS "ActivityType", code AS "ErrorCode",
           'UserError' AS "ErrorType", message AS "ErrorMessage" FROM errs WHERE code <> ''"""
    )
    o["r_activity_errors"] = _log(
        """SELECT pipeline_name AS "PipelineName", status AS "PipelineStatus", u.run_id AS "RunId",
           activity_name AS "ActivityName", activity_type AS "ActivityType", code AS "ErrorCode",
           CASE WHEN code IS NOT NULL THEN 'UserError' END AS "ErrorType", message AS "ErrorMessage"
           FROM user_run u LEFT JOIN (SELECT * FROM errs WHERE code <> '') e USING (run_id)"""
    )
    o["r_activity_error_counts"] = _log(
        """SELECT pipeline_name AS "PipelineName", status AS "PipelineStatus", u.run_id AS "RunId", count(*) AS "ResponseCount",
           count(*) FILTER (WHERE k > 0) AS "ResponseErrorCount"
           FROM user_run u JOIN acts USING (run_id) GROUP BY ALL"""
    )
    o["r_running_gate"] = _log(
        f"""SELECT l.pipeline_name, l.run_id AS this_run_id, l.known, coalesce(r.n, 0) AS "RunningCount",
            coalesce(r.n, 0) >= 1 OR NOT l.known AS blocked,
            CASE WHEN NOT l.known THEN replace('{UNKNOWN_PIPELINE}', '#', l.pipeline_name)
                 WHEN r.n >= 1 THEN replace('{STILL_RUNNING}', '#', l.pipeline_name) END AS message
            FROM (SELECT named.pipeline_name, coalesce(latest.run_id, '') AS run_id, latest.run_id IS NOT NULL AS known
                  FROM named LEFT JOIN latest USING (pipeline_name)) l
            LEFT JOIN (SELECT runs.pipeline_name, count(*) AS n FROM runs JOIN latest USING (pipeline_name)
                       WHERE runs.status IN ({_RUNNING}) AND runs.run_id <> latest.run_id GROUP BY runs.pipeline_name) r
            USING (pipeline_name)"""
    )
    log_columns = f"""event_id AS "LogId", CAST(user_id % 3 + 1 AS INTEGER) AS "StageId", user_id AS "PipelineId",
        'pl_' || user_id AS "PipelineName", ts AS "StartDateTime", {_STATUS} AS "PipelineStatus",
        CASE WHEN {_STATUS} NOT IN ({_RUNNING}) THEN ts + INTERVAL 5 MINUTE END AS "EndDateTime\""""
    o["r_last_execution"] = f"""SELECT {log_columns} FROM events
        WHERE event_id // 100 = (SELECT max(event_id) // 100 FROM events) ORDER BY 2, 3"""
    o["select_star"] = f"""SELECT {log_columns}, event_id // 100 AS "LocalExecutionId" FROM events"""
    o["r_property_lookup"] = """SELECT 'supplier_' || p_partkey AS "PropertyName", s_name AS "PropertyValue"
        FROM part LEFT JOIN supplier ON s_suppkey = p_partkey"""
    o["r_current_execution_counts"] = f"""SELECT CAST(user_id % 3 + 1 AS INTEGER) AS "StageId", {_STATUS} AS "PipelineStatus",
        count(*) AS "RecordCount" FROM events GROUP BY ALL"""

    # Notebook queries
    o["n_order_line_count"] = _ORDER_LINES
    o["n_order_line_count_bucketed"] = _ORDER_LINES
    o["n_order_line_count_sql"] = _ORDER_LINES + " ORDER BY 1"
    o["n_word_count"] = o["write_parquet_roundtrip"] = _WORDS + " ORDER BY 2 DESC, 1"
    o["n_word_count_repeated"] = f"SELECT * FROM ({_WORDS}) WHERE count > 1"

    # Sources and sinks
    o["read_text_lines"] = _LINES
    o["read_csv_inferred"] = f"SELECT {', '.join(CUSTOMER_TEXT)}, c_acctbal FROM customer"
    o["read_csv_multiline"] = "SELECT doc_id, text, lang FROM documents"
    o["i_clean_csv"] = "SELECT doc_id, regexp_replace(text, '[\\r\\n]+', '', 'g') AS text, lang FROM documents"
    o["publish_table"] = "SELECT * FROM orders"
    o["write_csv_quoted"] = o["i_txt_to_csv"] = f"SELECT {_QUOTED} AS value FROM customer"
    o["list_files"] = "SELECT page_id % 4 AS folder, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY 1"
    o["binary_ingest"] = """SELECT page_id % 4 AS folder, 2020 AS "Year", 10 AS "Month", 20 AS "Day", 3 AS "Hour",
        CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY 1"""
    o["land_partitioned"] = """SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS "Year", CAST(month(ts) AS INTEGER) AS "Month",
        CAST(day(ts) AS INTEGER) AS "Day", CAST(strftime(ts, '%I') AS INTEGER) AS "Hour" FROM events"""
    o["temp_view_sql"] = (
        "SELECT lang, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE n_chars >= 500 GROUP BY lang"
    )
    o["table_list"] = """SELECT n_name || '.' || c_name AS "TableName" FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE c_custkey % 2 = 0 AND n_name = 'NATION_2'"""

    o["append_log_entries"] = """SELECT strftime(ts, '%d/%m/%Y %H:%M:%S') || '|' || CASE WHEN event_type = 'error' THEN 'start ' ELSE 'end ' END
        || event_id AS value FROM events"""

    # Ingestion
    o["i_landing_path"] = f"""SELECT event_id, ts, {_HOUR_FOLDER.format(t="ts", h="%I")} AS "ProcessDateFolder" FROM events"""
    o["i_route_files"] = """SELECT name, substr(name, instr(name, '.') + 1) AS extension,
        CASE ending WHEN '.xlsx' THEN 'xlsx' WHEN '.txt' THEN 'txt' ELSE 'default' END AS route,
        CASE ending WHEN '.xlsx' THEN replace(name, 'xlsx', 'csv') WHEN '.txt' THEN replace(name, 'txt', 'csv') ELSE name END AS target_name,
        'Landing/Year=2020/Month=10/Day=20/Hour=03' AS target_folder
        FROM (SELECT 'f_' || page_id || ending AS name, ending FROM (
            SELECT page_id, CASE page_id % 4 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.txt' WHEN 2 THEN '.csv' ELSE '.a.b' END AS ending FROM pages))"""
    o["i_csv_to_table"] = o["st_landing_ingest"] = _CUSTOMER
    o["i_copy_table"] = "SELECT * FROM lineitem"
    o["i_copy_all_tables"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS "TableName", count(*) AS "Rows", 'Succeeded' AS "Status", CAST(sum({k}) AS BIGINT) AS "KeySum" FROM {t}"""
        for t, k in TABLE_KEYS.items()
    )
    filled = (
        CONNECTION.replace("@{linkedService().ServerInstance}", "' || 'srv' || c_nationkey || '")
        .replace("@{linkedService().DatabaseName}", "' || c_mktsegment || '")
        .replace("@{linkedService().SQLPassword}", "<redacted>")
        .replace("@dataset().DSTableName ", "' || c_name || ' ")
        .replace("@{linkedService().Note}", "@dataset().DSTable of ' || c_mktsegment || '")
    )
    o["i_render_connection"] = f"SELECT c_custkey, '{filled}' AS rendered FROM customer"
    o["i_pick_linked_service"] = _corpus(
        """SELECT f AS template_id, 'ls_' || key AS "LinkedServiceName", CASE WHEN key % 2 = 0 THEN 'u' END AS url,
           CASE WHEN key % 3 = 0 THEN '{"type":"AzureKeyVaultSecret","secretName":"s"}' ELSE 'x' END AS "connectionString"
           FROM (SELECT f, max(c_custkey) AS key FROM ls WHERE type = 'AzureBlobFS' GROUP BY f)"""
    )
    o["i_log_lines"] = """SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') || '|' || props AS line,
        date_trunc('second', ts) AS logged_at, props AS message FROM events"""

    # Metadata tables
    o["rename_factory"] = _FACTORIES.format(name="'factory_renamed'")
    o["replace_stages"] = _STAGE_ROWS.format(enabled="o_orderkey % 7 + 1 <= 3")
    o["disable_stages"] = _STAGE_ROWS.format(enabled="o_orderkey % 7 + 1 <= 3")
    o["generate_workers"] = f"""SELECT n AS "PipelineId", CAST(7 AS BIGINT) AS "DataFactoryId",
        CASE WHEN n <= 100 THEN 1 WHEN n <= 200 THEN 2 WHEN n <= 300 THEN 3 END AS "StageId", 'Wait ' || n AS "PipelineName",
        CAST(NULL AS INTEGER) AS "LogicalPredecessorId", true AS "Enabled" FROM {_NUMBERS}"""
    o["drop_fk_statements"] = f"""SELECT 'ALTER TABLE SalesLT.' || c_name || ' DROP CONSTRAINT FK_' || c_name || '_x' AS "Statement"
        FROM customer WHERE c_custkey % 2 = 1"""

    # Streaming
    target = "round(least(25.0, CASE WHEN count(value) * 300 * 100 / 3600.0 < 70 THEN 1.0 ELSE avg(value) END), 6)"
    o["st_autoscale_target"] = f"""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
        count(value) AS samples, {target} AS target FROM events GROUP BY 1"""
    o["st_autoscale_target_batch"] = f"""SELECT start AS window_start, start + INTERVAL 1 HOUR AS window_end, count(value) AS samples,
        {target} AS target FROM (
            SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start, value
            FROM events) GROUP BY start"""
    o["st_run_status"] = o["st_run_status_batch"] = _log(
        f"""SELECT run_id, status, last_updated, CASE WHEN status <> 'Succeeded' THEN
              '{{"errorCode":"' || e.code || '","failureType":"UserError","message":"' || e.message || '"}}' END AS "ErrorDetails"
            FROM user_run LEFT JOIN (SELECT run_id, arg_min(code, ts) AS code, arg_min(message, ts) AS message
                                     FROM errs GROUP BY run_id) e USING (run_id) WHERE status NOT IN ({_RUNNING})"""
    )

    # Scalar functions
    hour = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))"
    o["scalar_functions"] = f"""SELECT o_orderkey,
        upper(lower(o_orderpriority)[1]) || lower(o_orderpriority)[2:] AS f01_first_upper,
        replace(o_orderpriority, 'LO', '$1') AS f02_replace,
        replace(substr(repeat(CAST(o_orderkey AS VARCHAR), 11) || ''')]', 1, 50), ''')]', '') AS f03_cut_name,
        repeat(CAST(o_orderkey AS VARCHAR), 11) AS f04_clean_name,
        o_orderpriority || ' x.y.' || o_orderstatus AS f05_clean_type,
        CAST(o_orderkey AS VARCHAR) AS f06_key_name,
        CAST(len(string_split(o_orderpriority || '  x ', ' ')) AS INTEGER) AS f07_words,
        'a.' || o_orderstatus AS f08_extension,
        replace(o_orderpriority || ' x.y', ' ', '') AS f09_dataset_name,
        o_orderstatus || '@{{' || o_orderkey || '}}' AS f10_interpolate,
        CAST(length(o_orderpriority) + 1 AS INTEGER) AS f11_length,
        {_HOUR_FOLDER.format(t=f"({hour})", h="%I")} AS f12_landing,
        {_HOUR_FOLDER.format(t=f"({hour})", h="%H")} AS f12_landing_24,
        o_orderdate - INTERVAL 7 DAY AS f13_add_days,
        CASE WHEN o_orderkey % 3 <> 0 THEN date_trunc('day', o_orderdate) END AS f14_run_date,
        strftime(o_orderdate, '%Y-%m-%d') AS f15_cast,
        CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS f16_fallback,
        strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') || '|' || o_orderstatus AS f17_log_line,
        CAST(2 AS INTEGER) AS f18_digits,
        '{{"PipelineName":"' || o_orderkey || '","Status":"' || o_orderpriority || '\\""}}' AS f19_json,
        CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS f20_fk_table,
        o_orderkey || '/' || o_orderpriority || '/@{{linkedService().No}}' AS f21_fill,
        CASE o_orderstatus WHEN 'F' THEN '.ipynb' WHEN 'O' THEN '.sql' END AS f22_extension,
        CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS f23_error_code,
        CASE WHEN o_orderkey % 2 = 0 THEN 'm' END AS f23_message,
        CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 ELSE 0 END AS f24_rank
        FROM orders"""
    o["sql_functions"] = f"""SELECT o_orderkey, 'pipelines/pl_' || o_orderkey AS name, o_orderpriority AS type,
        CASE WHEN strftime(o_orderdate, '%Y-%m-%d') <> '{RUN_DATE}' THEN date_trunc('day', o_orderdate) END AS run_date FROM orders"""
    return o


ORACLES = _oracles()
