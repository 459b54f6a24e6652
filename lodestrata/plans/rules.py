"""Queries of the classification rules over cases made of the tables' rows: each order picks one value of every input. The
inputs are shared by the Spark query and its SQL; the rules are written out in SQL on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators.audit import signal_counts
from .registry import query
from .views import table


MIX = "({} * 48271 % 2147483647)"  # a step of the minimal standard generator


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, list):
        return "[" + ", ".join(map(_literal, v)) + "]"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _column(v):
    return F.array(*map(F.lit, v)).cast("array<int>") if isinstance(v, list) else F.lit(v)


def cases(inputs: dict[str, list], source: str = "orders", key: str = "o_orderkey"):
    """(DataFrame of (spark, sf_dir), SQL) of the rows' key k and, for each input, one of its values, picked by the digits of the
    scrambled key in a mixed base."""
    bases, sql_columns, base = {}, [], 1
    for name, values in inputs.items():
        n, bases[name] = len(values), base
        kind = "::INT[][]" if isinstance(values[0], list) else ""
        sql_columns.append(f"({_literal(values)}{kind})[{MIX.format(f'{key}::BIGINT')} // {base} % {n} + 1] AS {name}")
        base *= n

    def build(spark, sf_dir):
        pick = lambda name, values: F.expr(f"cast({MIX.format(f'cast({key} as bigint)')} div {bases[name]} % {len(values)} + 1 as int)")
        columns = [F.element_at(F.array(*map(_column, values)), pick(name, values)).alias(name) for name, values in inputs.items()]
        return table(spark, sf_dir, source).select(F.col(key).alias("k"), *columns)

    return build, f"SELECT {key} AS k, {', '.join(sql_columns)} FROM {source}"


def _c(*names: str):
    return [F.col(n) for n in names]


CODES = [[], [200], [403], [404], [401, 200], [500], [302, 200], [403, 404], [429, 503]]
ROBOTS = [[], [200], [403], [404], [301, 302], [503]]
LOGS = [
    "", "all is well", "getaddrinfo failed for host", "Connection refused by peer", "ConnectTimeout after 5 s", "read timeout", "certificate verify failed", "TLS handshake", "Too many redirects", "SSL error: bad",
    "Temporary failure in name resolution", "server disconnected without a response", "ProxyError: no route", "Max retries exceeded", "connecterror", "dns lookup", "HTTP 403 Forbidden", "request timeout", None,
]
EXECUTION = ["SUCCESS", "FAILED", "error", None]


def _holds(column: str, *tokens: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({column}, '')), {_literal(t)})" for t in tokens) + ")"


def _in(codes: str, *wanted: int) -> str:
    return f"list_has_any({codes}, {list(wanted)})"


def _some(codes: str, cond: str) -> str:
    return f"(len(list_filter({codes}, lambda c: {cond})) > 0)"


_DNS = ("name or service not known", "nodename nor servname", "getaddrinfo failed")
_FAILED = "(coalesce(upper(execution), '') IN ('FAILED', 'ERROR'))"
_OK = _some("site", "c >= 200 AND c < 400")

_probe, _probe_sql = cases({"timed_out": [False, False, False, True], "robots": ROBOTS, "site": CODES, "resources": [0, 0, 3], "execution": EXECUTION, "returncode": [0, 1], "log": LOGS})


@query(f"""SELECT k, s.status, s.action FROM (SELECT k, CASE WHEN timed_out THEN {{'status': 'TIMEOUT', 'action': 'review_reachability_or_runtime'}}
WHEN len(site) = 0 AND {_in('robots', 401, 403)} THEN {{'status': 'ROBOTS_BLOCKED', 'action': 'review_robots_policy'}}
WHEN resources > 0 THEN {{'status': 'GREEN_RESOURCES', 'action': 'candidate_for_b6_http_html'}}
WHEN {_FAILED} THEN CASE WHEN len(site) > 0 AND NOT {_OK} AND {_in('site', 403)} THEN {{'status': 'HTTP_403', 'action': 'review_access_or_waf'}}
  WHEN len(site) > 0 AND NOT {_OK} AND {_in('site', 404)} THEN {{'status': 'HTTP_404', 'action': 'review_entrypoint'}}
  WHEN {_holds('log', *_DNS, 'connection refused', 'connecterror', 'dns', 'ssl error')} THEN {{'status': 'UNAVAILABLE', 'action': 'review_domain_or_network'}} ELSE {{'status': 'EXECUTION_ERROR', 'action': 'inspect_persisted_output'}} END
WHEN returncode <> 0 THEN CASE WHEN len(site) > 0 AND NOT {_OK} AND {_in('site', 403)} THEN {{'status': 'HTTP_403', 'action': 'review_access_or_waf'}}
  WHEN len(site) > 0 AND NOT {_OK} AND {_in('site', 404)} THEN {{'status': 'HTTP_404', 'action': 'review_entrypoint'}} ELSE {{'status': 'EXECUTION_ERROR', 'action': 'inspect_persisted_output'}} END
WHEN {_OK} THEN {{'status': 'REACHABLE_NO_RESOURCES', 'action': 'review_seed_or_workflow'}} WHEN {_in('site', 403)} THEN {{'status': 'HTTP_403', 'action': 'review_access_or_waf'}}
WHEN {_in('site', 404)} THEN {{'status': 'HTTP_404', 'action': 'review_entrypoint'}} WHEN len(site) = 0 AND {_in('robots', 404, 405)} THEN {{'status': 'REACHABLE_NO_RESOURCES', 'action': 'review_seed_or_workflow'}}
ELSE {{'status': 'EXECUTION_ERROR', 'action': 'inspect_persisted_output'}} END AS s FROM ({_probe_sql}))""")
def probe_decisions(spark, sf_dir):
    """C01."""
    return _probe(spark, sf_dir).select("k", R.probe_status(*_c("timed_out", "robots", "site", "resources", "execution", "returncode", "log")).alias("s")).select("k", "s.*")


_REASON = f"""CASE WHEN {_in('site', 403)} THEN 'SITE_HTTP_403' WHEN {_in('site', 401)} THEN 'SITE_HTTP_401' WHEN {_some('site', 'c >= 500')} THEN 'SITE_HTTP_5XX'
WHEN {_holds('log', *_DNS, 'name resolution')} THEN 'DNS_OR_NAME_RESOLUTION' WHEN {_holds('log', 'connection refused')} THEN 'CONNECTION_REFUSED' WHEN {_holds('log', 'connecttimeout', 'connect timeout')} THEN 'CONNECT_TIMEOUT'
WHEN {_holds('log', 'readtimeout', 'read timeout')} THEN 'READ_TIMEOUT' WHEN {_holds('log', 'ssl', 'certificate verify failed', 'tls')} THEN 'SSL_ERROR' WHEN {_holds('log', 'too many redirects', 'redirect loop')} THEN 'REDIRECT_PROBLEM' END"""


@query(f"""WITH r AS (SELECT *, {_REASON} AS reason0, returncode <> 0 OR {_FAILED} AS bad FROM ({_probe_sql})),
s AS (SELECT *, CASE WHEN resources > 0 THEN 'SUCCESS_RESOURCES' WHEN timed_out THEN 'TIMEOUT' WHEN bad AND {_in('site', 403)} THEN 'ACCESS_RESTRICTED' WHEN bad AND {_in('site', 401)} THEN 'ACCESS_RESTRICTED'
WHEN len(site) = 0 AND {_in('robots', 401, 403)} THEN 'ROBOTS_REVIEW' WHEN reason0 IN ('DNS_OR_NAME_RESOLUTION', 'CONNECTION_REFUSED', 'CONNECT_TIMEOUT', 'SSL_ERROR') THEN 'UNAVAILABLE'
WHEN {_OK} THEN CASE WHEN bad THEN 'EXECUTION_ERROR' ELSE 'REACHABLE_NO_RESOURCES' END WHEN {_in('site', 403, 401)} THEN 'ACCESS_RESTRICTED' WHEN bad THEN 'EXECUTION_ERROR' ELSE 'NO_EVIDENCE' END AS status FROM r)
SELECT k, status, CASE status WHEN 'TIMEOUT' THEN 'SUBPROCESS_TIMEOUT' WHEN 'ROBOTS_REVIEW' THEN 'ROBOTS_ACCESS_RESTRICTED' WHEN 'ACCESS_RESTRICTED' THEN CASE WHEN {_in('site', 403)} THEN 'SITE_HTTP_403' ELSE 'SITE_HTTP_401' END ELSE reason0 END AS reason, reason0 AS log_reason FROM s""")
def stage_statuses(spark, sf_dir):
    """C02, C03."""
    c = _probe(spark, sf_dir).select("k", R.stage_status(*_c("returncode", "execution", "resources", "robots", "site", "log", "timed_out")).alias("s"), R.stage_reason(*_c("log", "site")).alias("log_reason"))
    return c.select("k", "s.*", "log_reason")


CHARACTERISED = ["ACCESS_RESTRICTED", "REACHABLE_NEEDS_DEEPER_REVIEW", "ROBOTS_REVIEW", "UNAVAILABLE", "EXECUTION_ERROR", "EXECUTION_ERROR", None]
_diag, _diag_sql = cases({"state": CHARACTERISED, "site": CODES, "robots": ROBOTS, "log": LOGS})


def _pairs(rows: list[tuple[str, str, str]], default: tuple[str, str]) -> str:
    """Two CASE expressions, reason and route."""
    return ", ".join("CASE " + " ".join(f"WHEN {r[0]} THEN '{r[k]}'" for r in rows) + f" ELSE '{default[k - 1]}' END AS {name}" for k, name in ((1, "reason"), (2, "route")))


_DIAGNOSE = [
    ("state = 'ACCESS_RESTRICTED'", "HTTP_ACCESS_RESTRICTED", "ACCESS_REVIEW"), ("state = 'REACHABLE_NEEDS_DEEPER_REVIEW'", "NO_RESOURCES_AFTER_HTML_API", "B7_OR_CUSTOM_REVIEW"),
    ("state = 'ROBOTS_REVIEW'", "ROBOTS_POLICY_REVIEW", "ROBOTS_REVIEW"), ("state = 'UNAVAILABLE'", "SOURCE_UNAVAILABLE", "SOURCE_URL_REVIEW"),
    (_holds("log", *_DNS, "name resolution"), "DNS_OR_NAME_RESOLUTION", "SOURCE_URL_REVIEW"), (_holds("log", "certificate", "sslerror", "ssl error", "tls"), "SSL_TLS_ERROR", "SOURCE_URL_OR_TLS_REVIEW"),
    (_holds("log", "connection refused"), "CONNECTION_REFUSED", "SOURCE_AVAILABILITY_REVIEW"), (_holds("log", "connecttimeout", "connect timeout"), "CONNECT_TIMEOUT", "NETWORK_RETRY_OR_SOURCE_REVIEW"),
    (_holds("log", "readtimeout", "read timeout"), "READ_TIMEOUT", "NETWORK_RETRY_OR_SOURCE_REVIEW"), (_holds("log", "too many redirects", "redirect loop"), "REDIRECT_LOOP_OR_LIMIT", "ENTRYPOINT_REDIRECT_REVIEW"),
    (_in("site", 403), "HTTP_403", "ACCESS_REVIEW"), (_in("site", 401), "HTTP_401", "ACCESS_REVIEW"), (_some("site", "c >= 500"), "HTTP_5XX", "SOURCE_AVAILABILITY_REVIEW"),
    (_holds("log", "max retries exceeded", "connection error", "connecterror"), "NETWORK_OR_CONNECTION_ERROR", "SOURCE_AVAILABILITY_REVIEW"),
]


@query(f"SELECT k, {_pairs(_DIAGNOSE, ('UNKNOWN_EXECUTION_ERROR', 'MANUAL_DIAGNOSTIC_REVIEW'))} FROM ({_diag_sql})")
def diagnoses(spark, sf_dir):
    """C04."""
    return _diag(spark, sf_dir).select("k", R.diagnose(*_c("state", "site", "log")).alias("s")).select("k", "s.*")


_FORENSIC = [
    *_DIAGNOSE[:2], (_holds("log", *_DNS, "temporary failure in name resolution", "name resolution error"), "DNS_OR_NAME_RESOLUTION", "SOURCE_URL_REVIEW"),
    (_holds("log", "certificate verify failed", "sslerror", "ssl error", "tls error", "certificate error"), "SSL_TLS_ERROR", "TLS_OR_SOURCE_REVIEW"), (_holds("log", "connection refused"), "CONNECTION_REFUSED", "SOURCE_AVAILABILITY_REVIEW"),
    (_holds("log", "connecttimeout", "connect timeout"), "CONNECT_TIMEOUT", "NETWORK_OR_SOURCE_RETRY"), (_holds("log", "readtimeout", "read timeout"), "READ_TIMEOUT", "NETWORK_OR_SOURCE_RETRY"),
    (_holds("log", "too many redirects", "redirect loop"), "REDIRECT_LOOP_OR_LIMIT", "ENTRYPOINT_REDIRECT_REVIEW"), (_holds("log", "remoteprotocolerror", "server disconnected", "remote protocol"), "REMOTE_PROTOCOL_ERROR", "NETWORK_OR_SERVER_REVIEW"),
    (_holds("log", "proxyerror", "proxy error"), "PROXY_ERROR", "NETWORK_ENVIRONMENT_REVIEW"), (_in("site", 403), "HTTP_403", "ACCESS_REVIEW"), (_in("site", 401), "HTTP_401", "ACCESS_REVIEW"),
    (_some("site", "c >= 500"), "SITE_HTTP_5XX", "SOURCE_AVAILABILITY_REVIEW"), ("len(site) = 0 AND " + _some("robots", "c >= 500"), "ROBOTS_HTTP_5XX_BLOCKING", "ROBOTS_OR_SOURCE_REVIEW"),
    ("len(site) = 0 AND len(robots) > 0 AND len(list_filter(robots, lambda c: c IN (301, 302, 307, 308))) = len(robots)", "ROBOTS_REDIRECT_WITHOUT_SITE_CRAWL", "ENTRYPOINT_OR_ROBOTS_REVIEW"),
    ("len(site) = 0 AND len(robots) = 0", "NO_HTTP_TRACE_EXECUTION_FAILURE", "SOURCE_URL_OR_NETWORK_REVIEW"),
]


@query(f"SELECT k, {_pairs(_FORENSIC, ('UNCLASSIFIED_EXECUTION_FAILURE', 'MANUAL_DIAGNOSTIC_REVIEW'))} FROM ({_diag_sql})")
def failure_forensics(spark, sf_dir):
    """C05."""
    return _diag(spark, sf_dir).select("k", R.failure(*_c("state", "site", "robots", "log")).alias("s")).select("k", "s.*")


_ready, _ready_sql = cases({"kind": ["HTTP_HTML_CANDIDATE", "API_CANDIDATE", "API_CANDIDATE", "OTHER", None], "quality": ["DATA_API_EVIDENCE", "CMS_OR_METADATA_ONLY", "GENERIC_API_REVIEW", "NONE", None], "hint": ["api", "html", None]})


@query(f"""SELECT k, CASE WHEN kind = 'HTTP_HTML_CANDIDATE' THEN 'READY_HTTP_HTML' WHEN kind = 'API_CANDIDATE' THEN CASE quality WHEN 'DATA_API_EVIDENCE' THEN 'READY_DATA_API' WHEN 'GENERIC_API_REVIEW' THEN 'API_SEMANTIC_REVIEW' ELSE 'READY_HTML_WITH_API_DISCOVERY' END ELSE 'READY_REVIEW' END AS b6_status,
CASE WHEN b6_status IN ('API_SEMANTIC_REVIEW', 'READY_REVIEW') THEN 'REVIEW_BEFORE_PROMOTION' ELSE 'PROMOTE_OPERATIONAL_CONFIG' END AS b6_route,
CASE b6_status WHEN 'READY_DATA_API' THEN 'api' WHEN 'API_SEMANTIC_REVIEW' THEN NULL WHEN 'READY_REVIEW' THEN hint ELSE 'html' END AS workflow_strategy,
CASE b6_status WHEN 'READY_HTTP_HTML' THEN false WHEN 'READY_REVIEW' THEN coalesce(hint = 'api', false) ELSE true END AS discover_apis, false AS browser_review, b6_status IN ('API_SEMANTIC_REVIEW', 'READY_REVIEW') AS custom_review FROM ({_ready_sql})""")
def ready_decisions(spark, sf_dir):
    """C06."""
    return _ready(spark, sf_dir).select("k", R.ready_decision(*_c("kind", "quality", "hint")).alias("s")).select("k", "s.*")


_recon, _recon_sql = cases({"action": ["RETRY_CRAWL", "RETRY_CRAWL", "DEFER_B7_B8", "HOLD_ACCESS_REVIEW", "HOLD_TLS_REVIEW", "RETIRED_NO_SUBSTITUTION", "ARCHIVE_NO_LIVE_PROMOTION", "NEEDS_IDENTITY_REVIEW", "X", None], "run": ["RECOVERED_RESOURCES", "REACHABLE_NO_RESOURCES", "TIMEOUT", None]})


@query(f"""SELECT k, CASE action WHEN 'RETRY_CRAWL' THEN CASE run WHEN 'RECOVERED_RESOURCES' THEN 'READY_RECONCILED_HTTP_API' WHEN 'REACHABLE_NO_RESOURCES' THEN 'B7_B8_CANDIDATE' ELSE 'RECONCILIATION_TECHNICAL_HOLD' END WHEN 'DEFER_B7_B8' THEN 'B7_B8_CANDIDATE' WHEN 'HOLD_ACCESS_REVIEW' THEN 'ACCESS_RESTRICTED'
WHEN 'HOLD_TLS_REVIEW' THEN 'TLS_TECHNICAL_HOLD' WHEN 'RETIRED_NO_SUBSTITUTION' THEN 'RETIRED_HISTORICAL_SOURCE' WHEN 'ARCHIVE_NO_LIVE_PROMOTION' THEN 'ARCHIVE_ONLY' WHEN 'NEEDS_IDENTITY_REVIEW' THEN 'IDENTITY_REVIEW_REQUIRED' ELSE 'UNRESOLVED_RECONCILIATION' END AS b6_status,
CASE b6_status WHEN 'READY_RECONCILED_HTTP_API' THEN 'PROMOTE_OPERATIONAL_CONFIG' WHEN 'B7_B8_CANDIDATE' THEN 'B7_BROWSER_CHARACTERIZATION' WHEN 'RECONCILIATION_TECHNICAL_HOLD' THEN 'TECHNICAL_REVIEW' WHEN 'ACCESS_RESTRICTED' THEN 'ACCESS_POLICY_REVIEW' WHEN 'TLS_TECHNICAL_HOLD' THEN 'TLS_CLIENT_REVIEW'
WHEN 'RETIRED_HISTORICAL_SOURCE' THEN 'B10_HISTORICAL_STATUS' WHEN 'ARCHIVE_ONLY' THEN 'B10_ARCHIVE_STATUS' WHEN 'IDENTITY_REVIEW_REQUIRED' THEN 'B8_IDENTITY_CUSTOM_REVIEW' ELSE 'MANUAL_REVIEW' END AS b6_route,
CASE WHEN b6_status IN ('READY_RECONCILED_HTTP_API', 'ARCHIVE_ONLY') THEN 'html' END AS workflow_strategy, b6_status IN ('READY_RECONCILED_HTTP_API', 'B7_B8_CANDIDATE', 'RECONCILIATION_TECHNICAL_HOLD') AS discover_apis,
b6_status = 'B7_B8_CANDIDATE' AS browser_review, b6_status NOT IN ('READY_RECONCILED_HTTP_API', 'ACCESS_RESTRICTED', 'RETIRED_HISTORICAL_SOURCE') AS custom_review FROM ({_recon_sql})""")
def reconciliation_decisions(spark, sf_dir):
    """C07."""
    return _recon(spark, sf_dir).select("k", R.reconciliation_decision(*_c("action", "run")).alias("s")).select("k", "s.*")


_plan, _plan_sql = cases({"b6": ["READY_HTTP_HTML", "READY_DATA_API", "READY_HTML_WITH_API_DISCOVERY", "API_SEMANTIC_REVIEW", "IDENTITY_REVIEW_REQUIRED", "ACCESS_RESTRICTED", "TLS_TECHNICAL_HOLD", "RETIRED_HISTORICAL_SOURCE", "ARCHIVE_ONLY", "B7_B8_CANDIDATE", None], "route": ["PROMOTE_OPERATIONAL_CONFIG", "B7_BROWSER_CHARACTERIZATION", None], "workflow": ["html", None, "", "sitemap"], "browser": ["PROMOTE_JAVASCRIPT_WORKFLOW", "B8_CUSTOM_REVIEW", None]})


@query(f"""SELECT k, CASE WHEN b6 IN ('READY_HTTP_HTML', 'READY_DATA_API', 'READY_HTML_WITH_API_DISCOVERY') THEN 'R' WHEN route = 'B7_BROWSER_CHARACTERIZATION' THEN CASE WHEN browser = 'PROMOTE_JAVASCRIPT_WORKFLOW' THEN 'J' ELSE 'B' END WHEN b6 = 'API_SEMANTIC_REVIEW' THEN 'A'
WHEN b6 IN ('ACCESS_RESTRICTED', 'TLS_TECHNICAL_HOLD', 'RETIRED_HISTORICAL_SOURCE', 'ARCHIVE_ONLY') THEN 'S' ELSE 'B' END AS c,
CASE c WHEN 'R' THEN CASE b6 WHEN 'READY_HTTP_HTML' THEN 'OPERATIONAL_HTTP_HTML' WHEN 'READY_DATA_API' THEN 'OPERATIONAL_DATA_API' ELSE 'OPERATIONAL_HTML_API_DISCOVERY' END WHEN 'J' THEN 'OPERATIONAL_JAVASCRIPT' WHEN 'S' THEN b6 ELSE 'B8_CUSTOM_CANDIDATE' END AS operational_status,
CASE WHEN c = 'R' THEN CASE WHEN workflow <> '' THEN workflow WHEN b6 = 'READY_DATA_API' THEN 'api' ELSE 'html' END WHEN c = 'J' THEN 'javascript' WHEN c = 'S' AND b6 = 'ARCHIVE_ONLY' THEN workflow END AS workflow_strategy,
c IN ('J', 'A') OR (c = 'R' AND b6 <> 'READY_HTTP_HTML') AS discover_apis, c = 'J' AS browser_required, c IN ('A', 'B') AS custom_required, CASE WHEN c IN ('R', 'J') THEN 'OPERATIONAL_CONFIG' WHEN c = 'S' THEN 'B10_STATUS' ELSE 'B8_CUSTOM' END AS next_phase,
CASE WHEN c IN ('J', 'B') AND route = 'B7_BROWSER_CHARACTERIZATION' AND browser IS NULL THEN 'MISSING_BROWSER_RESOLUTION' END AS error FROM ({_plan_sql})""".replace("SELECT k, CASE", "SELECT * EXCLUDE (c, b6, route, workflow, browser) FROM (SELECT *, CASE", 1) + ")")
def plan_merges(spark, sf_dir):
    """C08, C09."""
    p = _plan(spark, sf_dir).select("k", R.plan_merge(*_c("b6", "route", "workflow", "browser"), F.col("browser").isNotNull()).alias("s"))
    return p.select("k", "s.*")


_browse, _browse_sql = cases({"ok": [True, False, None], "downloads": [0, 0, 2], "data_events": [0, 1, 0], "xhr": [0, 0, 5], "b6": ["IDENTITY_REVIEW_REQUIRED", "API_SEMANTIC_REVIEW", "OTHER", "OTHER", None], "b7": ["JAVASCRIPT_NETWORK_REVIEW", "B8_CUSTOM_CANDIDATE", "OTHER", None], "controls": [0, 0, 4], "links": [0, 3]})


@query(f"""SELECT k, CASE WHEN downloads > 0 THEN 'BROWSER_FILE_DISCOVERY' WHEN data_events > 0 THEN 'BROWSER_DATA_NETWORK_EVIDENCE' WHEN xhr > 0 THEN 'BROWSER_GENERIC_NETWORK_EVIDENCE' WHEN ok THEN 'BROWSER_NO_DATA_EVIDENCE' ELSE 'BROWSER_EXECUTION_ERROR' END AS status,
CASE WHEN downloads > 0 THEN 'B7_OPERATIONAL_BROWSER' WHEN data_events > 0 OR xhr > 0 THEN 'B7_NETWORK_REVIEW' ELSE 'B8_CUSTOM_REVIEW' END AS route,
CASE WHEN b6 = 'IDENTITY_REVIEW_REQUIRED' THEN 'IDENTITY_RESEARCH_REQUIRED' WHEN b6 = 'API_SEMANTIC_REVIEW' THEN 'API_SEMANTIC_REVIEW' WHEN b7 = 'JAVASCRIPT_NETWORK_REVIEW' THEN 'BROWSER_NETWORK_SEMANTIC_REVIEW' WHEN b7 = 'B8_CUSTOM_CANDIDATE' THEN 'BROWSER_INTERACTION_REVIEW' ELSE 'CUSTOM_GENERAL_REVIEW' END AS candidate_class,
CASE candidate_class WHEN 'IDENTITY_RESEARCH_REQUIRED' THEN 'IDENTITY_RESEARCH' WHEN 'API_SEMANTIC_REVIEW' THEN 'API_SEMANTIC_PROBE' WHEN 'BROWSER_NETWORK_SEMANTIC_REVIEW' THEN 'NETWORK_ENDPOINT_PROBE' WHEN 'BROWSER_INTERACTION_REVIEW' THEN CASE WHEN controls > 0 THEN 'SAFE_BROWSER_INTERACTION' WHEN links > 0 THEN 'DATA_LINK_TRAVERSAL' ELSE 'CUSTOM_SITE_REVIEW' END ELSE 'CUSTOM_SITE_REVIEW' END AS strategy FROM ({_browse_sql})""")
def browser_candidates(spark, sf_dir):
    """C10, C11."""
    b = _browse(spark, sf_dir).select("k", R.browser_result(*_c("ok", "downloads", "data_events", "xhr")).alias("r"), R.candidate_strategy(*_c("b6", "b7", "controls", "links")).alias("s"))
    return b.select("k", "r.*", "s.*")


_custom, _custom_sql = cases({"identity": ["UNRESOLVED_NO_SAFE_SUCCESSOR", "RESOLVED_SAME_INSTITUTION", None, None], "json": [True, False, None], "kind": ["STRUCTURED_FILE", "OTHER_FILE", None], "skipped": [True, False, None], "listed": [True, False], "structured": [0, 0, 1], "files": [0, 0, 1], "events": [0, 0, 1], "blocked": [0, 0, 1], "browsed": [True, False]})


@query(f"""SELECT k, CASE WHEN identity = 'UNRESOLVED_NO_SAFE_SUCCESSOR' THEN 'CUSTOM_IDENTITY_UNRESOLVED' WHEN listed AND skipped IS DISTINCT FROM true AND (json IS NOT DISTINCT FROM true OR kind IS NOT DISTINCT FROM 'STRUCTURED_FILE') THEN 'CUSTOM_DATA_ENDPOINT_CONFIRMED' WHEN structured > 0 THEN 'CUSTOM_STRUCTURED_FILES_CONFIRMED'
WHEN files > 0 THEN 'CUSTOM_FILES_CONFIRMED' WHEN events > 0 THEN 'CUSTOM_DATA_NETWORK_CONFIRMED' WHEN blocked > 0 THEN 'CUSTOM_REQUIRES_FORM_POLICY' WHEN listed OR browsed THEN 'CUSTOM_NO_DATA_EVIDENCE' ELSE 'CUSTOM_EXECUTION_ERROR' END AS status,
CASE WHEN status LIKE '%CONFIRMED' THEN 'PROMOTE_CUSTOM_WORKFLOW' WHEN status = 'CUSTOM_REQUIRES_FORM_POLICY' THEN 'B8_POLICY_REVIEW' ELSE 'B10_STATUS' END AS route FROM ({_custom_sql})""")
def custom_probes(spark, sf_dir):
    """C12."""
    http = F.when(F.col("listed"), F.array(F.struct(F.col("json").alias("json_data"), F.col("kind").alias("resource_kind"), "skipped")))
    return _custom(spark, sf_dir).select("k", R.custom_probe(F.col("identity"), http, *_c("structured", "files", "events", "blocked", "browsed")).alias("s")).select("k", "s.*")


_resolve, _resolve_sql = cases({"status": ["CUSTOM_DATA_ENDPOINT_CONFIRMED", "CUSTOM_NO_DATA_EVIDENCE", "CUSTOM_IDENTITY_UNRESOLVED", "CUSTOM_REQUIRES_FORM_POLICY", "CUSTOM_REQUIRES_FORM_POLICY", "X", None], "policy": ["RESOLVED_NO_PUBLIC_DATA_SCOPE", "RESOLVED_CURATED_HTTP_SEEDS", "READ_ONLY_POST_QUERY_CANDIDATES", "Y", None], "endpoints": [0, 2], "seeds": [0, 1], "confirmed": [True, False, None], "identity": ["RESOLVED_SAME_INSTITUTION", "OTHER", None], "candidate": ["https://a.org", "", None]})


@query(f"""SELECT k, CASE WHEN status = 'CUSTOM_DATA_ENDPOINT_CONFIRMED' THEN CASE WHEN endpoints = 0 THEN 'NO_CONFIRMED_ENDPOINT' END WHEN status IN ('CUSTOM_NO_DATA_EVIDENCE', 'CUSTOM_IDENTITY_UNRESOLVED') THEN NULL WHEN status IS DISTINCT FROM 'CUSTOM_REQUIRES_FORM_POLICY' THEN 'UNSUPPORTED_PROBE_STATUS' WHEN policy IS NULL THEN 'MISSING_POLICY'
WHEN policy = 'RESOLVED_NO_PUBLIC_DATA_SCOPE' THEN NULL WHEN policy = 'RESOLVED_CURATED_HTTP_SEEDS' THEN CASE WHEN seeds = 0 THEN 'NO_SUCCESSFUL_SEED' END WHEN policy = 'READ_ONLY_POST_QUERY_CANDIDATES' THEN CASE WHEN confirmed IS DISTINCT FROM true THEN 'FORM_NOT_CONFIRMED' END ELSE 'UNSUPPORTED_POLICY_STATUS' END AS error,
CASE WHEN error IS NULL THEN CASE status WHEN 'CUSTOM_DATA_ENDPOINT_CONFIRMED' THEN 'OPERATIONAL_CUSTOM_DATA_API' WHEN 'CUSTOM_NO_DATA_EVIDENCE' THEN 'NO_PUBLIC_DATA_EVIDENCE' WHEN 'CUSTOM_IDENTITY_UNRESOLVED' THEN 'IDENTITY_UNRESOLVED' ELSE CASE policy WHEN 'RESOLVED_NO_PUBLIC_DATA_SCOPE' THEN 'NO_PUBLIC_DATA_SCOPE' WHEN 'RESOLVED_CURATED_HTTP_SEEDS' THEN 'OPERATIONAL_HTTP_HTML_CURATED' ELSE 'OPERATIONAL_CUSTOM_FORM_RESOURCE' END END END AS resolution_status,
CASE resolution_status WHEN 'OPERATIONAL_HTTP_HTML_CURATED' THEN 'html' WHEN 'OPERATIONAL_CUSTOM_DATA_API' THEN 'custom' WHEN 'OPERATIONAL_CUSTOM_FORM_RESOURCE' THEN 'custom' END AS workflow_strategy, CASE WHEN workflow_strategy IS NOT NULL THEN 'OPERATIONAL_CONFIG' WHEN resolution_status IS NOT NULL THEN 'B10_STATUS' END AS next_phase,
CASE WHEN status = 'CUSTOM_NO_DATA_EVIDENCE' AND identity = 'RESOLVED_SAME_INSTITUTION' AND candidate <> '' THEN candidate END AS entrypoint_override FROM ({_resolve_sql})""")
def custom_resolutions(spark, sf_dir):
    """C13."""
    return _resolve(spark, sf_dir).select("k", R.custom_resolution(*_c("status", "policy", "endpoints", "seeds", "confirmed", "identity", "candidate")).alias("s")).select("k", "s.*")


LINES = ["all fine", "Traceback (most recent call last): x", "FALLO NO CONTROLADO EN WORKFLOW y", "bs4 ParserRejectedMarkup", "UnicodeEncodeError: z", "--- Logging error ---", "[ERROR] a [CRITICAL]", "[critical] traceback (most recent call last): b", "error without brackets"]
_SIGNALS = [("TRACEBACK", r"Traceback \(most recent call last\):"), ("UNCONTROLLED_WORKFLOW_ERROR", "Fallo no controlado en workflow"), ("PARSER_REJECTED_MARKUP", "ParserRejectedMarkup"), ("UNICODE_ENCODE_ERROR", "UnicodeEncodeError"), ("LOGGING_ERROR", "--- Logging error ---"), ("EXPLICIT_ERROR_LOG", r"\[(ERROR|CRITICAL)\]")]
_signals_sql = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(line, '(?i){rx}') THEN '{n}' END" for n, rx in _SIGNALS) + "], lambda x: x IS NOT NULL)"
_lines, _lines_sql = cases({"line": LINES, "expected": ["html", "api", None, ""], "actual": ["html", "api", None], "state": ["SUCCEEDED", "SUCCEEDED", "SUCCEEDED", "FAILED", None], "resources": [0, 5, None]})


@query(f"""SELECT k, array_to_string(s, ',') AS signals, CASE WHEN state IS DISTINCT FROM 'SUCCEEDED' THEN 'CHECKPOINT_NOT_SUCCEEDED' WHEN len(s) > 0 THEN 'PROCESS_OK_WITH_INTERNAL_ERROR' WHEN expected <> '' AND actual <> '' AND expected <> actual THEN 'WORKFLOW_MISMATCH' WHEN resources = 0 THEN 'ZERO_RESOURCES_REVIEW'
WHEN expected <> '' AND actual IS NULL THEN 'WORKFLOW_NOT_OBSERVED_WARNING' WHEN resources IS NULL THEN 'RESOURCE_COUNT_NOT_OBSERVED_WARNING' ELSE 'CLEAN_SUCCESS' END AS classification,
classification NOT IN ('WORKFLOW_NOT_OBSERVED_WARNING', 'RESOURCE_COUNT_NOT_OBSERVED_WARNING', 'CLEAN_SUCCESS') AS blocks, CASE WHEN classification = 'CLEAN_SUCCESS' THEN 'OK' WHEN classification = 'ZERO_RESOURCES_REVIEW' THEN 'REVIEW' WHEN blocks THEN 'ERROR' ELSE 'WARNING' END AS severity FROM (SELECT *, {_signals_sql} AS s FROM ({_lines_sql}))""")
def log_classes(spark, sf_dir):
    """C14, C15."""
    c = _lines(spark, sf_dir).withColumn("signals", R.error_signals(F.col("line")))
    return c.select("k", F.array_join("signals", ",").alias("signals"), R.log_class(*_c("expected", "actual", "state"), F.size("signals"), F.col("resources")).alias("s")).select("k", "signals", "s.*")


@query(f"SELECT signal, count(*) AS n FROM (SELECT unnest({_signals_sql}) AS signal FROM ({_lines_sql})) GROUP BY 1")
def error_signals(spark, sf_dir):
    """A22."""
    return signal_counts(_lines(spark, sf_dir).select(R.error_signals(F.col("line")).alias("signals")), "signals")


_out, _out_sql = cases({"blocker": [False, False, True], "report": [True, True, False, None], "execution": ["SUCCESS", "SUCCESS", "FAILED", None], "acquisition": [False, False, True], "resources": [0, 7, None], "records": [0, 3], "failure": ["ROBOTS_UNREACHABLE", "TIMEOUT", None], "physical": ["p", "", None], "projection": ["DATAX_READY", "PROJECTION_EMPTY"]})


@query(f"""SELECT k, CASE WHEN blocker AND execution = 'FAILED' THEN 'EXTERNAL_BLOCKER' WHEN report IS DISTINCT FROM true THEN 'EVIDENCE_MISSING' WHEN execution IS DISTINCT FROM 'SUCCESS' THEN 'EXECUTION_NOT_SUCCESS' WHEN acquisition THEN 'ACQUISITION_JOB_READY' WHEN coalesce(resources, 0) = 0 THEN 'SUCCESS_EMPTY' WHEN records > 0 THEN 'DATAX_READY' ELSE 'RAW_READY_NO_PROJECTION' END AS output,
CASE WHEN report IS DISTINCT FROM true THEN 'PENDING' WHEN execution IS DISTINCT FROM 'SUCCESS' THEN CASE WHEN blocker AND failure = 'ROBOTS_UNREACHABLE' THEN 'EXTERNAL_BLOCKER' ELSE 'EXECUTION_FAILED' END WHEN coalesce(physical, '') = '' THEN 'PHYSICAL_SOURCE_UNRESOLVED' ELSE projection END AS pipeline FROM ({_out_sql})""")
def output_classes(spark, sf_dir):
    """C16, C23."""
    c = _c("blocker", "report", "execution", "acquisition", "resources", "records")
    return _out(spark, sf_dir).select("k", R.output_class(*c).alias("output"), R.pipeline_class(*_c("report", "execution", "blocker", "failure", "physical", "projection")).alias("pipeline"))


_SUMMARY = """CASE WHEN dns IS DISTINCT FROM true THEN 'DNS_FAILURE' WHEN probed IS DISTINCT FROM true THEN 'NO_ROOT_PROBE' WHEN ok IS DISTINCT FROM true THEN CASE WHEN coalesce(error, '') = '' THEN 'REQUEST_ERROR' ELSE error END WHEN code IS NULL THEN 'NO_HTTP_STATUS' WHEN code >= 200 AND code < 300 THEN 'HTTP_2XX' WHEN code >= 300 AND code < 400 THEN 'HTTP_3XX'
WHEN code IN (401, 403) THEN 'ACCESS_RESTRICTED' WHEN code = 404 THEN 'HTTP_404' WHEN code >= 400 AND code < 500 THEN 'HTTP_4XX' WHEN code >= 500 THEN 'HTTP_5XX' ELSE 'HTTP_OTHER' END"""
_variant, _variant_sql = cases({"dns": [True, True, True, False, None], "probed": [True, True, True, False], "ok": [True, True, False, None], "error": ["TLS_ERROR", "CONNECT_TIMEOUT", "CONNECT_ERROR", "ODD", "", None], "code": [200, 301, 403, 404, 410, 503, 100, None]})


@query(f"""SELECT k, summary, CASE WHEN summary = 'HTTP_2XX' THEN 'RECOVERED_HTTP' WHEN summary = 'HTTP_3XX' THEN 'REDIRECTING' WHEN summary = 'ACCESS_RESTRICTED' THEN 'ACCESS_RESTRICTED' WHEN summary IN ('HTTP_404', 'HTTP_4XX') THEN 'HTTP_CLIENT_ERROR' WHEN summary = 'HTTP_5XX' THEN 'SERVER_ERROR' WHEN summary = 'DNS_FAILURE' THEN 'DNS_FAILURE' WHEN summary = 'TLS_ERROR' THEN 'TLS_FAILURE'
WHEN summary IN ('CONNECT_TIMEOUT', 'READ_TIMEOUT', 'CONNECTION_REFUSED', 'CONNECT_ERROR') THEN 'NETWORK_FAILURE' ELSE 'UNRESOLVED' END AS status, CASE status WHEN 'RECOVERED_HTTP' THEN 'ENTRYPOINT_REVIEW' WHEN 'REDIRECTING' THEN 'ENTRYPOINT_REDIRECT_REVIEW' WHEN 'ACCESS_RESTRICTED' THEN 'ACCESS_REVIEW' WHEN 'HTTP_CLIENT_ERROR' THEN 'SOURCE_URL_REVIEW' WHEN 'DNS_FAILURE' THEN 'SOURCE_URL_REVIEW'
WHEN 'TLS_FAILURE' THEN 'TLS_OR_SOURCE_REVIEW' WHEN 'UNRESOLVED' THEN 'MANUAL_REVIEW' ELSE 'SOURCE_AVAILABILITY_REVIEW' END AS route FROM (SELECT *, {_SUMMARY} AS summary FROM ({_variant_sql}))""")
def recovery_variants(spark, sf_dir):
    """C18."""
    v = _variant(spark, sf_dir).withColumn("summary", R.variant_summary(*_c("dns", "probed", "ok", "error", "code")))
    return v.select("k", "summary", R.final_status(F.col("summary")).alias("s")).select("k", "summary", "s.*")


@query(f"""WITH v AS (SELECT o_custkey, k, {_SUMMARY} AS summary FROM ({_variant_sql}) JOIN orders ON o_orderkey = k),
r AS (SELECT *, coalesce(map {{{', '.join(f"'{s}': {n}" for s, n in R.VARIANT_RANKS.items())}}}[summary], 1) AS rank FROM v)
SELECT o_custkey, arg_max(k, (rank, -k)) AS k, arg_max(summary, (rank, -k)) AS status FROM r GROUP BY 1""")
def best_variants(spark, sf_dir):
    """W12, J21."""
    from ..operators.resolution import best_variant

    v = _variant(spark, sf_dir).withColumn("status", R.variant_summary(*_c("dns", "probed", "ok", "error", "code")))
    v = v.join(table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("k")), "k")
    return best_variant(v, "o_custkey", R.VARIANT_RANKS, "k").select("o_custkey", "k", "status")


MESSAGES = [*LOGS[:-1], "Executable doesn't exist at x", "run playwright install", "please download new browsers", None]
_thrown, _thrown_sql = cases({"kind": ["ConnectTimeout", "ReadTimeout", "TooManyRedirects", "ProxyError", "ConnectError", "ConnectError", "ConnectError", "RemoteProtocolError", "ValueError"], "log": MESSAGES, "resources": [0, 0, 2], "returncode": [0, 1, 2]})


@query(f"""SELECT k, CASE kind WHEN 'ConnectTimeout' THEN 'CONNECT_TIMEOUT' WHEN 'ReadTimeout' THEN 'READ_TIMEOUT' WHEN 'TooManyRedirects' THEN 'TOO_MANY_REDIRECTS' WHEN 'ProxyError' THEN 'PROXY_ERROR' WHEN 'RemoteProtocolError' THEN 'REMOTE_PROTOCOL_ERROR'
WHEN 'ConnectError' THEN CASE WHEN {_holds('log', 'certificate', 'ssl', 'tls')} THEN 'TLS_ERROR' WHEN {_holds('log', 'refused')} THEN 'CONNECTION_REFUSED' WHEN {_holds('log', 'name', 'getaddrinfo')} THEN 'DNS_OR_NAME_RESOLUTION' ELSE 'CONNECT_ERROR' END ELSE upper(kind) END AS exception,
CASE WHEN {_holds('log', "executable doesn't exist", 'playwright install', 'download new browsers')} THEN 'PLAYWRIGHT_BROWSER_MISSING' ELSE 'PLAYWRIGHT_ERROR' END AS render,
CASE WHEN resources > 0 THEN 'RECOVERED_RESOURCES' WHEN returncode = 0 THEN 'REACHABLE_NO_RESOURCES' WHEN {_holds('log', '403', 'forbidden')} THEN 'ACCESS_RESTRICTED' WHEN {_holds('log', 'certificate', 'ssl', 'tls')} THEN 'TLS_FAILURE' WHEN {_holds('log', 'getaddrinfo', 'name resolution')} THEN 'DNS_FAILURE' WHEN {_holds('log', 'timeout')} THEN 'TIMEOUT' ELSE 'EXECUTION_ERROR' END AS reconciled FROM ({_thrown_sql})""")
def exception_classes(spark, sf_dir):
    """C17, C19, C24."""
    t = _thrown(spark, sf_dir)
    return t.select("k", R.exception_class(*_c("kind", "log")).alias("exception"), R.render_exception(F.col("log")).alias("render"), R.reconciliation_probe(*_c("returncode", "resources", "log")).alias("reconciled"))


_form, _form_sql = cases({"code": [200, 302, 404, 500, None], "final": ["https://www.a.org/x", "https://data.a.org/y", "https://b.org/z", None], "signals": [True, True, False, None], "inputs": [0, 20, 60, None], "hits": [0, 3, 9, None], "seeds": [0, 1, 3], "found": [0, 2]})


@query(f"""SELECT k, CASE WHEN code >= 200 AND code < 400 AND (final LIKE 'https://www.a.org/%' OR final LIKE 'https://data.a.org/%') AND signals AND coalesce(inputs, 0) >= 20 AND coalesce(hits, 0) >= 3 THEN 'TRANSTATS_FORM_RESOURCE_CONFIRMED' WHEN code >= 200 AND code < 400 THEN 'TRANSTATS_PAGE_REACHABLE_SEMANTICS_INCOMPLETE' ELSE 'TRANSTATS_FORM_RESOURCE_UNREACHABLE' END AS status,
CASE WHEN status = 'TRANSTATS_FORM_RESOURCE_CONFIRMED' THEN 'PROMOTE_CUSTOM_FORM_RESOURCE' ELSE 'B10_STATUS' END AS route, CASE WHEN seeds > 0 AND found > 0 THEN 'RESOLVED_CURATED_HTTP_SEEDS' WHEN seeds > 0 THEN 'CURATED_SEEDS_REACHABLE_NO_RESOURCES' ELSE 'CURATED_SEEDS_UNREACHABLE' END AS seed_status,
CASE WHEN seeds > 0 AND found > 0 THEN 'PROMOTE_HTML_CURATED_SEEDS' ELSE 'B10_STATUS' END AS seed_route FROM ({_form_sql})""")
def form_and_seed_probes(spark, sf_dir):
    """C20, C21."""
    f = _form(spark, sf_dir).select("k", R.form_resource(F.col("code"), F.col("final"), F.lit("https://a.org/"), F.col("signals"), F.col("inputs"), F.lit(20), F.col("hits")).alias("s"), R.curated_seeds(*_c("seeds", "found")).alias("t"))
    return f.select("k", "s.*", F.col("t.status").alias("seed_status"), F.col("t.route").alias("seed_route"))


_runtime, _runtime_sql = cases({"playwright": [True, True, False, None], "driver": [True, True, False], "has_binary": [True, False], "referenced": [True, False], "selenium": [True, False], "pyppeteer": [True, False, None]})


@query(f"""SELECT k, CASE WHEN playwright AND driver THEN CASE WHEN NOT has_binary THEN 'PLAYWRIGHT_PACKAGE_NO_BROWSER_BINARY' WHEN referenced THEN 'USE_EXISTING_PLAYWRIGHT' ELSE 'PLAYWRIGHT_RUNTIME_READY' END WHEN selenium THEN 'SELENIUM_PACKAGE_AVAILABLE' WHEN pyppeteer THEN 'PYPPETEER_PACKAGE_AVAILABLE' ELSE 'NO_BROWSER_RUNTIME_DETECTED' END AS strategy FROM ({_runtime_sql})""")
def browser_runtimes(spark, sf_dir):
    """C22."""
    return _runtime(spark, sf_dir).select("k", R.browser_runtime(*_c("playwright", "driver", "has_binary", "referenced", "selenium", "pyppeteer")).alias("strategy"))


PATHS = ["/", "/wp-json/wp/v2/posts", "/?rest_route=/x", "/jsonapi/node", "/v3/api-docs", "/dataset/7", "/files/a.CSV", "/api/v1", "/collect?id=1", "/graphql", "/series/x", "/img/pixel.gif", "/a.parquet", "/b.json", "/page.html", "/OEMBED", "/query"]
HOSTS = ["https://www.a.org", "https://a.org", "http://b.net", "https://www.google-analytics.com", "https://cdn.a.org"]
TYPES = ["application/json; charset=utf-8", "application/ld+json", "text/csv", "text/html", "application/vnd.ms-excel", "", None]
_net, _net_sql = cases({"host": HOSTS, "path": PATHS, "kind": TYPES})


@query(f"""SELECT k, CASE WHEN {_holds('u', '/wp-json/', '/wp/v2/', 'oembed', 'rest_route=')} THEN 'CMS_WORDPRESS_API' WHEN {_holds('u', '/jsonapi/')} THEN 'CMS_DRUPAL_API' WHEN {_holds('u', 'swagger', 'openapi', 'api-docs')} THEN 'API_DOCUMENTATION'
WHEN {_holds('u', '/dataset', '/data/', '/statistics', '/estadistic', '/indicator', '/series', '/query', '/download', '/catalog', '/resource', '/report', '.csv', '.xlsx', '.xls', '.ods', '.json', '.xml')} THEN 'POSSIBLE_DATA_API' ELSE 'GENERIC_API' END AS api_class,
CASE WHEN contains(u, 'google-analytics.com') OR {_holds('u', '/collect', '/analytics', 'gtag', 'pixel', 'telemetry', 'beacon', '/track')} THEN 'ANALYTICS_TELEMETRY' WHEN {_holds('u', '/wp-json/', '/wp-admin/admin-ajax', 'rest_route=', '/jsonapi/', '/graphql')} THEN 'CMS_OR_GENERIC_BACKEND'
WHEN regexp_matches(lower(u), '\\.(csv|xlsx|xls|ods|json|xml|parquet)$') OR {_holds('u', '/dataset', '/data/', '/statistics', '/estadistic', '/indicator', '/series', '/query', '/download', '/resource', '/report', '.csv', '.xlsx', '.xls', '.ods', '.parquet')} OR {_holds('kind', 'text/csv', 'application/csv', 'application/vnd.ms-excel', 'application/vnd.openxmlformats-officedocument', 'application/xml', 'text/xml')} THEN 'DATA_ENDPOINT'
WHEN {_holds('kind', 'application/json', 'application/ld+json', 'application/problem+json')} THEN CASE WHEN own THEN 'SAME_ORIGIN_JSON' ELSE 'THIRD_PARTY_JSON' END WHEN own THEN 'SAME_ORIGIN_XHR' ELSE 'THIRD_PARTY_XHR' END AS category FROM (SELECT *, host || path AS u, host IN ('https://www.a.org', 'https://a.org') AS own FROM ({_net_sql}))""")
def url_classes(spark, sf_dir):
    """X17, X18."""
    n = _net(spark, sf_dir).withColumn("u", F.concat("host", "path"))
    return n.select("k", R.api_url_class(F.col("u")).alias("api_class"), R.network_category(F.col("u"), F.col("kind"), F.lit("https://A.org/start")).alias("category"))
