"""Classification rules C01 to C24, X17 and X18: ordered decision tables as expressions over columns.

HTTP codes come as arrays (of the site, of robots.txt), logs as text. A null flag counts as false, a null array as empty, a
null text as empty. Free-text notes for readers are left to the caller."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import urls as U
from .audit import decision_table

# Fixed values (SURVEY Appendix A): tokens of logs and URLs, and the classes that they name.
NAME_TOKENS = ["name or service not known", "nodename nor servname", "getaddrinfo failed"]
UNAVAILABLE_TOKENS = [*NAME_TOKENS, "connection refused", "connecterror", "dns", "ssl error"]
STAGE_REASONS = {
    "DNS_OR_NAME_RESOLUTION": [*NAME_TOKENS, "name resolution"],
    "CONNECTION_REFUSED": ["connection refused"],
    "CONNECT_TIMEOUT": ["connecttimeout", "connect timeout"],
    "READ_TIMEOUT": ["readtimeout", "read timeout"],
    "SSL_ERROR": ["ssl", "certificate verify failed", "tls"],
    "REDIRECT_PROBLEM": ["too many redirects", "redirect loop"],
}
DIAGNOSES = {
    ("DNS_OR_NAME_RESOLUTION", "SOURCE_URL_REVIEW"): [*NAME_TOKENS, "name resolution", "temporary failure in name resolution"],
    ("SSL_TLS_ERROR", "SOURCE_URL_OR_TLS_REVIEW"): ["certificate verify failed", "sslerror", "ssl error", "tls", "certificate"],
    ("CONNECTION_REFUSED", "SOURCE_AVAILABILITY_REVIEW"): ["connection refused"],
    ("CONNECT_TIMEOUT", "NETWORK_RETRY_OR_SOURCE_REVIEW"): ["connecttimeout", "connect timeout"],
    ("READ_TIMEOUT", "NETWORK_RETRY_OR_SOURCE_REVIEW"): ["readtimeout", "read timeout"],
    ("REDIRECT_LOOP_OR_LIMIT", "ENTRYPOINT_REDIRECT_REVIEW"): ["too many redirects", "redirect loop"],
}
FORENSICS = {
    ("DNS_OR_NAME_RESOLUTION", "SOURCE_URL_REVIEW"): [*NAME_TOKENS, "temporary failure in name resolution", "name resolution error"],
    ("SSL_TLS_ERROR", "TLS_OR_SOURCE_REVIEW"): ["certificate verify failed", "sslerror", "ssl error", "tls error", "certificate error"],
    ("CONNECTION_REFUSED", "SOURCE_AVAILABILITY_REVIEW"): ["connection refused"],
    ("CONNECT_TIMEOUT", "NETWORK_OR_SOURCE_RETRY"): ["connecttimeout", "connect timeout"],
    ("READ_TIMEOUT", "NETWORK_OR_SOURCE_RETRY"): ["readtimeout", "read timeout"],
    ("REDIRECT_LOOP_OR_LIMIT", "ENTRYPOINT_REDIRECT_REVIEW"): ["too many redirects", "redirect loop"],
    ("REMOTE_PROTOCOL_ERROR", "NETWORK_OR_SERVER_REVIEW"): ["remoteprotocolerror", "server disconnected", "remote protocol"],
    ("PROXY_ERROR", "NETWORK_ENVIRONMENT_REVIEW"): ["proxyerror", "proxy error"],
}
SIGNALS = {
    "TRACEBACK": r"(?i)Traceback \(most recent call last\):",
    "UNCONTROLLED_WORKFLOW_ERROR": r"(?i)Fallo no controlado en workflow",
    "PARSER_REJECTED_MARKUP": r"(?i)ParserRejectedMarkup",
    "UNICODE_ENCODE_ERROR": r"(?i)UnicodeEncodeError",
    "LOGGING_ERROR": r"(?i)--- Logging error ---",
    "EXPLICIT_ERROR_LOG": r"(?i)\[(?:ERROR|CRITICAL)\]",
}
POSSIBLE_DATA = ["/dataset", "/datasets", "/data/", "/statistics", "/estadistic", "/indicator", "/indicators", "/series", "/query", "/download", "/catalog", "/resource", "/resources", "/report", "/reports", ".csv", ".xlsx", ".xls", ".ods", ".json", ".xml"]
ANALYTICS_HOSTS = ["google-analytics.com", "googletagmanager.com", "doubleclick.net", "clarity.ms", "hotjar.com", "facebook.com", "connect.facebook.net", "sentry.io", "cloudflareinsights.com", "recaptcha.net", "google.com/recaptcha"]
ANALYTICS_URLS = ["/collect", "/analytics", "gtag", "pixel", "telemetry", "beacon", "/track"]
CMS_URLS = ["/wp-json/", "/wp-admin/admin-ajax", "rest_route=", "/jsonapi/", "/graphql"]
DATA_URLS = ["/dataset", "/datasets", "/data/", "/statistics", "/estadistic", "/indicator", "/indicators", "/series", "/query", "/download", "/resource", "/resources", "/report", "/reports", ".csv", ".xlsx", ".xls", ".ods", ".parquet"]
STRUCTURED = [".csv", ".xlsx", ".xls", ".ods", ".json", ".xml", ".parquet"]
STRUCTURED_TYPES = ["text/csv", "application/csv", "application/vnd.ms-excel", "application/vnd.openxmlformats-officedocument", "application/xml", "text/xml"]
JSON_TYPES = ["application/json", "application/ld+json", "application/problem+json"]
READY = {"READY_HTTP_HTML": ("OPERATIONAL_HTTP_HTML", "html", False), "READY_DATA_API": ("OPERATIONAL_DATA_API", "api", True), "READY_HTML_WITH_API_DISCOVERY": ("OPERATIONAL_HTML_API_DISCOVERY", "html", True)}
SEED_EXTENSIONS = [".csv", ".xlsx", ".xls", ".ods", ".json", ".xml", ".parquet", ".zip", ".pdf"]
SEED_WORDS = ["data", "datos", "estadistic", "statistics", "export", "download", "descarga", "bolet", "report", "reporte", "csv", "xlsx", "pdf", "indicador", "indicator"]
VARIANT_RANKS = {"HTTP_2XX": 100, "HTTP_3XX": 90, "ACCESS_RESTRICTED": 80, "HTTP_404": 70, "HTTP_4XX": 60, "HTTP_5XX": 50, "TLS_ERROR": 40, "CONNECTION_REFUSED": 35, "CONNECT_TIMEOUT": 30, "READ_TIMEOUT": 25, "CONNECT_ERROR": 20, "DNS_FAILURE": 10, "NO_ROOT_PROBE": 0}


def _low(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _any(text: Column, tokens: list[str]) -> Column:
    """Whether the text holds one of the tokens; as one alternation, so the text is read once."""
    return text.rlike("|".join(r"\Q" + t + r"\E" for t in tokens))


def _codes(codes: Column) -> Column:
    return F.coalesce(codes, F.array().cast("array<int>"))


def _has(codes: Column, *wanted: int) -> Column:
    return F.exists(_codes(codes), lambda c: c.isin(*wanted))


def _within(codes: Column, low: int, high: int) -> Column:
    return F.exists(_codes(codes), lambda c: (c >= low) & (c < high))


def _none(codes: Column) -> Column:
    return F.size(_codes(codes)) == 0


def _yes(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def _table(names: tuple[str, ...], rows: list[tuple], default: tuple) -> Column:
    """``decision_table`` of rows (condition, value, ...); a null condition does not hold."""
    named = lambda values: dict(zip(names, values, strict=True))
    return decision_table([(_yes(cond), named(values)) for cond, *values in rows], named(default))


def probe_status(timed_out: Column, robots: Column, site: Column, resources: Column, execution: Column, returncode: Column, log: Column) -> Column:
    """C01. (status, action) of a source's probe."""
    failed = F.coalesce(F.upper(execution).isin("FAILED", "ERROR"), F.lit(False))
    broken = failed | (returncode != 0)
    refused = broken & ~_none(site) & ~_within(site, 200, 400)
    rows = [
        (timed_out, "TIMEOUT", "review_reachability_or_runtime"),
        (_none(site) & _has(robots, 401, 403), "ROBOTS_BLOCKED", "review_robots_policy"),
        (resources > 0, "GREEN_RESOURCES", "candidate_for_b6_http_html"),
        (refused & _has(site, 403), "HTTP_403", "review_access_or_waf"),
        (refused & _has(site, 404), "HTTP_404", "review_entrypoint"),
        (failed & _any(_low(log), UNAVAILABLE_TOKENS), "UNAVAILABLE", "review_domain_or_network"),
        (broken, "EXECUTION_ERROR", "inspect_persisted_output"),
        (_within(site, 200, 400), "REACHABLE_NO_RESOURCES", "review_seed_or_workflow"),
        (_has(site, 403), "HTTP_403", "review_access_or_waf"),
        (_has(site, 404), "HTTP_404", "review_entrypoint"),
        (_none(site) & _has(robots, 404, 405), "REACHABLE_NO_RESOURCES", "review_seed_or_workflow"),
    ]
    return _table(("status", "action"), rows, ("EXECUTION_ERROR", "inspect_persisted_output"))


def stage_reason(log: Column, site: Column) -> Column:
    """C03. What a stage's codes, else its log, say of a failure; null if nothing."""
    out = F.when(_has(site, 403), "SITE_HTTP_403").when(_has(site, 401), "SITE_HTTP_401").when(_within(site, 500, 1 << 30), "SITE_HTTP_5XX")
    for reason, tokens in STAGE_REASONS.items():
        out = out.when(_any(_low(log), tokens), reason)
    return out


def stage_status(returncode: Column, execution: Column, resources: Column, robots: Column, site: Column, log: Column, timed_out: Column) -> Column:
    """C02. (status, reason) of a characterisation stage."""
    failed = (returncode != 0) | F.coalesce(F.upper(execution).isin("FAILED", "ERROR"), F.lit(False))
    reason, reached = stage_reason(log, site), _within(site, 200, 400)
    status = (
        F.when(_yes(resources > 0), "SUCCESS_RESOURCES").when(_yes(timed_out), "TIMEOUT").when(failed & _has(site, 401, 403), "ACCESS_RESTRICTED")
        .when(_none(site) & _has(robots, 401, 403), "ROBOTS_REVIEW").when(reason.isin("DNS_OR_NAME_RESOLUTION", "CONNECTION_REFUSED", "CONNECT_TIMEOUT", "SSL_ERROR"), "UNAVAILABLE")
        .when(reached & ~failed, "REACHABLE_NO_RESOURCES").when(reached, "EXECUTION_ERROR").when(_has(site, 401, 403), "ACCESS_RESTRICTED").when(failed, "EXECUTION_ERROR").otherwise("NO_EVIDENCE")
    )
    shown = F.when(status == "TIMEOUT", "SUBPROCESS_TIMEOUT").when(status == "ACCESS_RESTRICTED", F.when(_has(site, 403), "SITE_HTTP_403").otherwise("SITE_HTTP_401")).when(status == "ROBOTS_REVIEW", "ROBOTS_ACCESS_RESTRICTED").otherwise(reason)
    return F.struct(status.alias("status"), shown.alias("reason"))


def diagnose(characterization: Column, site: Column, log: Column) -> Column:
    """C04. (reason, route) of a source that is not ready."""
    rows = [
        (characterization == "ACCESS_RESTRICTED", "HTTP_ACCESS_RESTRICTED", "ACCESS_REVIEW"),
        (characterization == "REACHABLE_NEEDS_DEEPER_REVIEW", "NO_RESOURCES_AFTER_HTML_API", "B7_OR_CUSTOM_REVIEW"),
        (characterization == "ROBOTS_REVIEW", "ROBOTS_POLICY_REVIEW", "ROBOTS_REVIEW"),
        (characterization == "UNAVAILABLE", "SOURCE_UNAVAILABLE", "SOURCE_URL_REVIEW"),
        *[(_any(_low(log), tokens), *named) for named, tokens in DIAGNOSES.items()],
        (_has(site, 403), "HTTP_403", "ACCESS_REVIEW"),
        (_has(site, 401), "HTTP_401", "ACCESS_REVIEW"),
        (_within(site, 500, 1 << 30), "HTTP_5XX", "SOURCE_AVAILABILITY_REVIEW"),
        (_any(_low(log), ["max retries exceeded", "connection error", "connecterror"]), "NETWORK_OR_CONNECTION_ERROR", "SOURCE_AVAILABILITY_REVIEW"),
    ]
    return _table(("reason", "route"), rows, ("UNKNOWN_EXECUTION_ERROR", "MANUAL_DIAGNOSTIC_REVIEW"))


def failure(characterization: Column, site: Column, robots: Column, log: Column) -> Column:
    """C05. (reason, route) of a failed source from all its evidence."""
    only_redirects = ~F.exists(_codes(robots), lambda c: ~c.isin(301, 302, 307, 308))
    rows = [
        (characterization == "ACCESS_RESTRICTED", "HTTP_ACCESS_RESTRICTED", "ACCESS_REVIEW"),
        (characterization == "REACHABLE_NEEDS_DEEPER_REVIEW", "NO_RESOURCES_AFTER_HTML_API", "B7_OR_CUSTOM_REVIEW"),
        *[(_any(_low(log), tokens), *named) for named, tokens in FORENSICS.items()],
        (_has(site, 403), "HTTP_403", "ACCESS_REVIEW"),
        (_has(site, 401), "HTTP_401", "ACCESS_REVIEW"),
        (_within(site, 500, 1 << 30), "SITE_HTTP_5XX", "SOURCE_AVAILABILITY_REVIEW"),
        (_none(site) & _within(robots, 500, 1 << 30), "ROBOTS_HTTP_5XX_BLOCKING", "ROBOTS_OR_SOURCE_REVIEW"),
        (_none(site) & ~_none(robots) & only_redirects, "ROBOTS_REDIRECT_WITHOUT_SITE_CRAWL", "ENTRYPOINT_OR_ROBOTS_REVIEW"),
        (_none(site) & _none(robots), "NO_HTTP_TRACE_EXECUTION_FAILURE", "SOURCE_URL_OR_NETWORK_REVIEW"),
    ]
    return _table(("reason", "route"), rows, ("UNCLASSIFIED_EXECUTION_FAILURE", "MANUAL_DIAGNOSTIC_REVIEW"))


_DECISION = ("b6_status", "b6_route", "workflow_strategy", "discover_apis", "browser_review", "custom_review")


def ready_decision(characterization: Column, api_quality: Column, workflow_hint: Column) -> Column:
    """C06. What a candidate that gave resources becomes."""
    api = characterization == "API_CANDIDATE"
    html_api = ("READY_HTML_WITH_API_DISCOVERY", "PROMOTE_OPERATIONAL_CONFIG", "html", True, False, False)
    rows = [
        (characterization == "HTTP_HTML_CANDIDATE", "READY_HTTP_HTML", "PROMOTE_OPERATIONAL_CONFIG", "html", False, False, False),
        (api & (api_quality == "DATA_API_EVIDENCE"), "READY_DATA_API", "PROMOTE_OPERATIONAL_CONFIG", "api", True, False, False),
        (api & (api_quality == "GENERIC_API_REVIEW"), "API_SEMANTIC_REVIEW", "REVIEW_BEFORE_PROMOTION", None, True, False, True),
        (api, *html_api),
    ]
    out = _table(_DECISION, rows, ("READY_REVIEW", "REVIEW_BEFORE_PROMOTION", None, False, False, True))
    other = out["b6_status"] == "READY_REVIEW"
    return F.struct(*[F.when(other, v).otherwise(out[c]).alias(c) if (v := {"workflow_strategy": workflow_hint, "discover_apis": _yes(workflow_hint == "api")}.get(c)) is not None else out[c].alias(c) for c in _DECISION])


RECONCILED = [  # action, run status (None: any other), and the decision
    ("RETRY_CRAWL", "RECOVERED_RESOURCES", "READY_RECONCILED_HTTP_API", "PROMOTE_OPERATIONAL_CONFIG", "html", True, False, False),
    ("RETRY_CRAWL", "REACHABLE_NO_RESOURCES", "B7_B8_CANDIDATE", "B7_BROWSER_CHARACTERIZATION", None, True, True, True),
    ("RETRY_CRAWL", None, "RECONCILIATION_TECHNICAL_HOLD", "TECHNICAL_REVIEW", None, True, False, True),
    ("DEFER_B7_B8", None, "B7_B8_CANDIDATE", "B7_BROWSER_CHARACTERIZATION", None, True, True, True),
    ("HOLD_ACCESS_REVIEW", None, "ACCESS_RESTRICTED", "ACCESS_POLICY_REVIEW", None, False, False, False),
    ("HOLD_TLS_REVIEW", None, "TLS_TECHNICAL_HOLD", "TLS_CLIENT_REVIEW", None, False, False, True),
    ("RETIRED_NO_SUBSTITUTION", None, "RETIRED_HISTORICAL_SOURCE", "B10_HISTORICAL_STATUS", None, False, False, False),
    ("ARCHIVE_NO_LIVE_PROMOTION", None, "ARCHIVE_ONLY", "B10_ARCHIVE_STATUS", "html", False, False, True),
    ("NEEDS_IDENTITY_REVIEW", None, "IDENTITY_REVIEW_REQUIRED", "B8_IDENTITY_CUSTOM_REVIEW", None, False, False, True),
]


def reconciliation_decision(action: Column, run_status: Column) -> Column:
    """C07. What a reconciled source becomes, by the action taken and its outcome."""
    rows = [((action == a) & (F.lit(True) if s is None else _yes(run_status == s)), *rest) for a, s, *rest in RECONCILED]
    return _table(_DECISION, rows, ("UNRESOLVED_RECONCILIATION", "MANUAL_REVIEW", None, False, False, True))


def ready_workflow(b6_status: Column, workflow: Column) -> Column:
    """C08. (operational_status, workflow_strategy, discover_apis) of a ready source; null for other states."""
    known = lambda k: F.create_map(*[F.lit(x) for s, row in READY.items() for x in (s, row[k])])
    chosen = F.coalesce(F.nullif(workflow, F.lit("")), F.try_element_at(known(1), b6_status))
    return F.when(b6_status.isin(*READY), F.struct(F.try_element_at(known(0), b6_status).alias("operational_status"), chosen.alias("workflow_strategy"), F.try_element_at(known(2), b6_status).alias("discover_apis")))


_PLAN = ("operational_status", "workflow_strategy", "discover_apis", "browser_required", "custom_required", "next_phase")


def plan_merge(b6_status: Column, b6_route: Column, workflow: Column, browser_route: Column, has_browser: Column) -> Column:
    """C09. The operational plan of a source from its resolution and its browser result; ``error`` tells a browser candidate
    without one."""
    ready = ready_workflow(b6_status, workflow)
    browsed = b6_route == "B7_BROWSER_CHARACTERIZATION"
    custom = lambda apis: ("B8_CUSTOM_CANDIDATE", None, apis, False, True, "B8_CUSTOM")
    rows = [
        (b6_status.isin(*READY), "", None, False, False, False, "OPERATIONAL_CONFIG"),
        (browsed & (browser_route == "PROMOTE_JAVASCRIPT_WORKFLOW"), "OPERATIONAL_JAVASCRIPT", "javascript", True, True, False, "OPERATIONAL_CONFIG"),
        (browsed, *custom(False)),
        (b6_status == "API_SEMANTIC_REVIEW", *custom(True)),
        *[(b6_status == s, s, None, False, False, False, "B10_STATUS") for s in ("ACCESS_RESTRICTED", "TLS_TECHNICAL_HOLD", "RETIRED_HISTORICAL_SOURCE", "ARCHIVE_ONLY")],
    ]
    out = _table(_PLAN, rows, custom(False))
    is_ready = out["operational_status"] == ""
    fields = {c: out[c] for c in _PLAN}
    for c in ("operational_status", "workflow_strategy", "discover_apis"):
        fields[c] = F.when(is_ready, ready[c]).otherwise(out[c])
    fields["workflow_strategy"] = F.when(out["operational_status"] == "ARCHIVE_ONLY", workflow).otherwise(fields["workflow_strategy"])
    error = F.when(_yes(browsed) & ~_yes(has_browser) & ~_yes(b6_status.isin(*READY)), "MISSING_BROWSER_RESOLUTION")
    return F.struct(*[v.alias(c) for c, v in fields.items()], error.alias("error"))


def browser_result(navigation_ok: Column, downloads: Column, data_events: Column, xhr_events: Column) -> Column:
    """C10. (status, route) of a browser characterisation."""
    rows = [
        (downloads > 0, "BROWSER_FILE_DISCOVERY", "B7_OPERATIONAL_BROWSER"),
        (data_events > 0, "BROWSER_DATA_NETWORK_EVIDENCE", "B7_NETWORK_REVIEW"),
        (xhr_events > 0, "BROWSER_GENERIC_NETWORK_EVIDENCE", "B7_NETWORK_REVIEW"),
        (navigation_ok, "BROWSER_NO_DATA_EVIDENCE", "B8_CUSTOM_REVIEW"),
    ]
    return _table(("status", "route"), rows, ("BROWSER_EXECUTION_ERROR", "B8_CUSTOM_REVIEW"))


def candidate_strategy(b6_status: Column, b7_status: Column, controls: Column, keyword_links: Column) -> Column:
    """C11. (candidate_class, strategy) of a custom candidate; ``controls`` counts its forms, selects and buttons."""
    by_page = b7_status == "B8_CUSTOM_CANDIDATE"
    rows = [
        (b6_status == "IDENTITY_REVIEW_REQUIRED", "IDENTITY_RESEARCH_REQUIRED", "IDENTITY_RESEARCH"),
        (b6_status == "API_SEMANTIC_REVIEW", "API_SEMANTIC_REVIEW", "API_SEMANTIC_PROBE"),
        (b7_status == "JAVASCRIPT_NETWORK_REVIEW", "BROWSER_NETWORK_SEMANTIC_REVIEW", "NETWORK_ENDPOINT_PROBE"),
        (by_page & (controls > 0), "BROWSER_INTERACTION_REVIEW", "SAFE_BROWSER_INTERACTION"),
        (by_page & (keyword_links > 0), "BROWSER_INTERACTION_REVIEW", "DATA_LINK_TRAVERSAL"),
        (by_page, "BROWSER_INTERACTION_REVIEW", "CUSTOM_SITE_REVIEW"),
    ]
    return _table(("candidate_class", "strategy"), rows, ("CUSTOM_GENERAL_REVIEW", "CUSTOM_SITE_REVIEW"))


def custom_probe(identity_status: Column, http: Column, structured_files: Column, files: Column, data_events: Column, blocked: Column, browsed: Column) -> Column:
    """C12. (status, route) of a custom probe. ``http``: array of (json_data, resource_kind, skipped); counts of the browser's
    findings; ``browsed``: whether there is a browser result."""
    results = F.coalesce(http, F.array().cast("array<struct<json_data:boolean,resource_kind:string,skipped:boolean>>"))
    data = F.exists(results, lambda r: ~_yes(r["skipped"]) & (_yes(r["json_data"]) | _yes(r["resource_kind"] == "STRUCTURED_FILE")))
    rows = [
        (identity_status == "UNRESOLVED_NO_SAFE_SUCCESSOR", "CUSTOM_IDENTITY_UNRESOLVED", "B10_STATUS"),
        (data, "CUSTOM_DATA_ENDPOINT_CONFIRMED", "PROMOTE_CUSTOM_WORKFLOW"),
        (structured_files > 0, "CUSTOM_STRUCTURED_FILES_CONFIRMED", "PROMOTE_CUSTOM_WORKFLOW"),
        (files > 0, "CUSTOM_FILES_CONFIRMED", "PROMOTE_CUSTOM_WORKFLOW"),
        (data_events > 0, "CUSTOM_DATA_NETWORK_CONFIRMED", "PROMOTE_CUSTOM_WORKFLOW"),
        (blocked > 0, "CUSTOM_REQUIRES_FORM_POLICY", "B8_POLICY_REVIEW"),
        ((F.size(results) > 0) | _yes(browsed), "CUSTOM_NO_DATA_EVIDENCE", "B10_STATUS"),
    ]
    return _table(("status", "route"), rows, ("CUSTOM_EXECUTION_ERROR", "B10_STATUS"))


def custom_resolution(status: Column, policy_status: Column, endpoints: Column, seeds: Column, form_confirmed: Column, identity_status: Column, candidate_entrypoint: Column) -> Column:
    """C13. (resolution_status, workflow_strategy, next_phase, entrypoint_override, error) of a custom candidate. What cannot
    be resolved has a null status and says why."""
    policy = status == "CUSTOM_REQUIRES_FORM_POLICY"
    curated, post = policy & (policy_status == "RESOLVED_CURATED_HTTP_SEEDS"), policy & (policy_status == "READ_ONLY_POST_QUERY_CANDIDATES")
    error = lambda name: (None, None, None, name)
    rows = [
        ((status == "CUSTOM_DATA_ENDPOINT_CONFIRMED") & (endpoints > 0), "OPERATIONAL_CUSTOM_DATA_API", "custom", "OPERATIONAL_CONFIG", None),
        (status == "CUSTOM_DATA_ENDPOINT_CONFIRMED", *error("NO_CONFIRMED_ENDPOINT")),
        (status == "CUSTOM_NO_DATA_EVIDENCE", "NO_PUBLIC_DATA_EVIDENCE", None, "B10_STATUS", None),
        (status == "CUSTOM_IDENTITY_UNRESOLVED", "IDENTITY_UNRESOLVED", None, "B10_STATUS", None),
        (~_yes(policy), *error("UNSUPPORTED_PROBE_STATUS")),
        (policy_status.isNull(), *error("MISSING_POLICY")),
        (policy_status == "RESOLVED_NO_PUBLIC_DATA_SCOPE", "NO_PUBLIC_DATA_SCOPE", None, "B10_STATUS", None),
        (curated & (seeds > 0), "OPERATIONAL_HTTP_HTML_CURATED", "html", "OPERATIONAL_CONFIG", None),
        (curated, *error("NO_SUCCESSFUL_SEED")),
        (post & _yes(form_confirmed), "OPERATIONAL_CUSTOM_FORM_RESOURCE", "custom", "OPERATIONAL_CONFIG", None),
        (post, *error("FORM_NOT_CONFIRMED")),
    ]
    out = _table(("resolution_status", "workflow_strategy", "next_phase", "error"), rows, error("UNSUPPORTED_POLICY_STATUS"))
    override = F.when(_yes((status == "CUSTOM_NO_DATA_EVIDENCE") & (identity_status == "RESOLVED_SAME_INSTITUTION")), F.nullif(candidate_entrypoint, F.lit("")))
    return F.struct(*[out[c].alias(c) for c in ("resolution_status", "workflow_strategy", "next_phase")], override.alias("entrypoint_override"), out["error"].alias("error"))


def error_signals(text: Column) -> Column:
    """C15. Names of the error signals in a log segment, in a fixed order."""
    return F.filter(F.array(*[F.when(text.rlike(rx), F.lit(n)) for n, rx in SIGNALS.items()]), lambda x: x.isNotNull())


def log_class(expected: Column, actual: Column, state: Column, errors: Column, resources: Column) -> Column:
    """C14. (classification, blocks, severity): evidence against success blocks, missing evidence warns."""
    known = F.nullif(expected, F.lit("")).isNotNull()
    rows = [
        (~_yes(state == "SUCCEEDED"), "CHECKPOINT_NOT_SUCCEEDED", True, "ERROR"),
        (errors > 0, "PROCESS_OK_WITH_INTERNAL_ERROR", True, "ERROR"),
        (known & (F.nullif(actual, F.lit("")) != expected), "WORKFLOW_MISMATCH", True, "ERROR"),
        (resources == 0, "ZERO_RESOURCES_REVIEW", True, "REVIEW"),
        (known & actual.isNull(), "WORKFLOW_NOT_OBSERVED_WARNING", False, "WARNING"),
        (resources.isNull(), "RESOURCE_COUNT_NOT_OBSERVED_WARNING", False, "WARNING"),
    ]
    return _table(("classification", "blocks", "severity"), rows, ("CLEAN_SUCCESS", False, "OK"))


def output_class(blocker: Column, has_report: Column, execution: Column, acquisition: Column, resources: Column, records: Column) -> Column:
    """C16. Whether a source's output can be consumed. ``blocker``: the source is known to be blocked from outside."""
    return (
        F.when(_yes(blocker & (execution == "FAILED")), "EXTERNAL_BLOCKER").when(~_yes(has_report), "EVIDENCE_MISSING").when(~_yes(execution == "SUCCESS"), "EXECUTION_NOT_SUCCESS")
        .when(_yes(acquisition), "ACQUISITION_JOB_READY").when(~_yes(resources != 0), "SUCCESS_EMPTY").when(_yes(records > 0), "DATAX_READY").otherwise("RAW_READY_NO_PROJECTION")
    )


def reconciliation_probe(returncode: Column, resources: Column, log: Column) -> Column:
    """C17."""
    text = _low(log)
    return (
        F.when(_yes(resources > 0), "RECOVERED_RESOURCES").when(_yes(returncode == 0), "REACHABLE_NO_RESOURCES").when(_any(text, ["403", "forbidden"]), "ACCESS_RESTRICTED")
        .when(_any(text, ["certificate", "ssl", "tls"]), "TLS_FAILURE").when(_any(text, ["getaddrinfo", "name resolution"]), "DNS_FAILURE").when(_any(text, ["timeout"]), "TIMEOUT").otherwise("EXECUTION_ERROR")
    )


def variant_summary(dns_ok: Column, probed: Column, ok: Column, error_type: Column, code: Column) -> Column:
    """C18. What a probe of one URL variant found."""
    by_code = (
        F.when(code.isNull(), "NO_HTTP_STATUS").when(code.between(200, 299), "HTTP_2XX").when(code.between(300, 399), "HTTP_3XX").when(code.isin(401, 403), "ACCESS_RESTRICTED")
        .when(code == 404, "HTTP_404").when(code.between(400, 499), "HTTP_4XX").when(code >= 500, "HTTP_5XX").otherwise("HTTP_OTHER")
    )
    failed = F.coalesce(F.nullif(error_type, F.lit("")), F.lit("REQUEST_ERROR"))
    return F.when(~_yes(dns_ok), "DNS_FAILURE").when(~_yes(probed), "NO_ROOT_PROBE").when(~_yes(ok), failed).otherwise(by_code)


def final_status(summary: Column) -> Column:
    """C18. (status, route) by the best variant's summary; null: there was none."""
    rows = [
        (summary == "HTTP_2XX", "RECOVERED_HTTP", "ENTRYPOINT_REVIEW"),
        (summary == "HTTP_3XX", "REDIRECTING", "ENTRYPOINT_REDIRECT_REVIEW"),
        (summary == "ACCESS_RESTRICTED", "ACCESS_RESTRICTED", "ACCESS_REVIEW"),
        (summary.isin("HTTP_404", "HTTP_4XX"), "HTTP_CLIENT_ERROR", "SOURCE_URL_REVIEW"),
        (summary == "HTTP_5XX", "SERVER_ERROR", "SOURCE_AVAILABILITY_REVIEW"),
        (summary == "DNS_FAILURE", "DNS_FAILURE", "SOURCE_URL_REVIEW"),
        (summary == "TLS_ERROR", "TLS_FAILURE", "TLS_OR_SOURCE_REVIEW"),
        (summary.isin("CONNECT_TIMEOUT", "READ_TIMEOUT", "CONNECTION_REFUSED", "CONNECT_ERROR"), "NETWORK_FAILURE", "SOURCE_AVAILABILITY_REVIEW"),
    ]
    return _table(("status", "route"), rows, ("UNRESOLVED", "MANUAL_REVIEW"))


def exception_class(kind: Column, message: Column) -> Column:
    """C19. Class of a request's exception by the name of its type and its message."""
    text = _low(message)
    connect = F.when(_any(text, ["certificate", "ssl", "tls"]), "TLS_ERROR").when(_any(text, ["refused"]), "CONNECTION_REFUSED").when(_any(text, ["name", "getaddrinfo"]), "DNS_OR_NAME_RESOLUTION").otherwise("CONNECT_ERROR")
    named = {"ConnectTimeout": "CONNECT_TIMEOUT", "ReadTimeout": "READ_TIMEOUT", "TooManyRedirects": "TOO_MANY_REDIRECTS", "ProxyError": "PROXY_ERROR", "RemoteProtocolError": "REMOTE_PROTOCOL_ERROR"}
    out = F.when(kind == "ConnectError", connect)
    for a, b in named.items():
        out = out.when(kind == a, b)
    return out.otherwise(F.upper(kind))


def form_resource(code: Column, final_url: Column, entrypoint: Column, signals_ok: Column, inputs: Column, minimum: Column, field_hits: Column) -> Column:
    """C20. (status, route) of a download form's probe."""
    reached = code.between(200, 399)
    confirmed = reached & U.same_site(final_url, entrypoint) & _yes(signals_ok) & (F.coalesce(inputs, F.lit(0)) >= minimum) & (F.coalesce(field_hits, F.lit(0)) >= 3)
    rows = [(confirmed, "TRANSTATS_FORM_RESOURCE_CONFIRMED", "PROMOTE_CUSTOM_FORM_RESOURCE"), (reached, "TRANSTATS_PAGE_REACHABLE_SEMANTICS_INCOMPLETE", "B10_STATUS")]
    return _table(("status", "route"), rows, ("TRANSTATS_FORM_RESOURCE_UNREACHABLE", "B10_STATUS"))


def seed_resource(url: Column) -> Column:
    """C21. Whether a link of a curated seed looks like a resource."""
    return F.coalesce(F.lower(U.path(url)).rlike(r"(" + "|".join(r"\Q" + e + r"\E" for e in SEED_EXTENSIONS) + r")$"), F.lit(False)) | _any(_low(url), SEED_WORDS)


def curated_seeds(reached: Column, discovered: Column) -> Column:
    """C21. (status, route) by the number of seeds that answered and of resource links on them."""
    rows = [((reached > 0) & (discovered > 0), "RESOLVED_CURATED_HTTP_SEEDS", "PROMOTE_HTML_CURATED_SEEDS"), (reached > 0, "CURATED_SEEDS_REACHABLE_NO_RESOURCES", "B10_STATUS")]
    return _table(("status", "route"), rows, ("CURATED_SEEDS_UNREACHABLE", "B10_STATUS"))


def browser_runtime(playwright: Column, driver: Column, binary: Column, referenced: Column, selenium: Column, pyppeteer: Column) -> Column:
    """C22. Strategy by the browser packages that an environment reports."""
    started = _yes(playwright & driver)
    return (
        F.when(started & _yes(binary) & _yes(referenced), "USE_EXISTING_PLAYWRIGHT").when(started & _yes(binary), "PLAYWRIGHT_RUNTIME_READY").when(started, "PLAYWRIGHT_PACKAGE_NO_BROWSER_BINARY")
        .when(_yes(selenium), "SELENIUM_PACKAGE_AVAILABLE").when(_yes(pyppeteer), "PYPPETEER_PACKAGE_AVAILABLE").otherwise("NO_BROWSER_RUNTIME_DETECTED")
    )


def pipeline_class(has_report: Column, execution: Column, blocker: Column, failure_code: Column, physical: Column, projection: Column) -> Column:
    """C23. A source's class in the pipeline; ``projection`` is its projection's, of sources that ran and are known."""
    return (
        F.when(~_yes(has_report), "PENDING").when(~_yes(execution == "SUCCESS") & _yes(blocker & (failure_code == "ROBOTS_UNREACHABLE")), "EXTERNAL_BLOCKER").when(~_yes(execution == "SUCCESS"), "EXECUTION_FAILED")
        .when(F.nullif(physical, F.lit("")).isNull(), "PHYSICAL_SOURCE_UNRESOLVED").otherwise(projection)
    )


def render_exception(message: Column) -> Column:
    """C24."""
    return F.when(_any(_low(message), ["executable doesn't exist", "playwright install", "download new browsers"]), "PLAYWRIGHT_BROWSER_MISSING").otherwise("PLAYWRIGHT_ERROR")


def api_url_class(url: Column) -> Column:
    """X17. What an API's URL says of its content."""
    low = _low(url)
    wordpress = _any(low, ["/wp-json/", "/wp/v2/", "oembed"]) | _any(U.query(low), ["rest_route="])
    return F.when(wordpress, "CMS_WORDPRESS_API").when(_any(low, ["/jsonapi/"]), "CMS_DRUPAL_API").when(_any(low, ["swagger", "openapi", "api-docs"]), "API_DOCUMENTATION").when(_any(low, POSSIBLE_DATA), "POSSIBLE_DATA_API").otherwise("GENERIC_API")


def network_category(url: Column, content_type: Column, entry: Column) -> Column:
    """X18. Category of a network event of a page."""
    low, kind = _low(url), _low(content_type)
    own = (U.canonical_host(low) != "") & (U.canonical_host(low) == U.canonical_host(_low(entry)))
    suffix = F.regexp_extract(U.path(low), r"[^/.][^/]*(\.[^./]+)$", 1)
    return (
        F.when(_any(U.host(low), ANALYTICS_HOSTS) | _any(low, ANALYTICS_URLS), "ANALYTICS_TELEMETRY").when(_any(low, CMS_URLS), "CMS_OR_GENERIC_BACKEND")
        .when(suffix.isin(*STRUCTURED) | _any(low, DATA_URLS) | _any(kind, STRUCTURED_TYPES), "DATA_ENDPOINT")
        .when(_any(kind, JSON_TYPES), F.when(own, "SAME_ORIGIN_JSON").otherwise("THIRD_PARTY_JSON")).when(own, "SAME_ORIGIN_XHR").otherwise("THIRD_PARTY_XHR")
    )
