"""Dataset views over the benchmark tables, as Spark frames and as the equal SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.operators.intel import observables

EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-01 00:00:00"

# Fixed text of the three checks that have a remediation.
CHECK_NAMES = {
    "ECONOMY": "Ensure SSH root login is disabled",
    "SMALL": "Ensure password authentication is disabled in SSH",
    "PROMO": "Ensure auditd is installed",
}


# Declared columns of the benchmark tables in use: no inference job per read.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TIMES = {"events": ["ts"], "orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}


def with_instants(df: DataFrame, name: str) -> DataFrame:
    """Zone-less times become instants."""
    times = TIMES.get(name, [])
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times}) if times else df


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return with_instants(spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet"), name)


def host_of(key: str) -> Column:
    return F.concat(F.lit("host-"), F.floor(F.sqrt(F.col(key) % 2500)).cast("int").cast("string"))


def v_logs(spark: SparkSession, sf: str, read=table) -> DataFrame:
    user = F.concat(F.lit("user"), F.col("user_id"))
    peer = F.concat(
        F.lit("10.0."), F.floor(F.col("user_id") / 256).cast("int"), F.lit("."), F.col("user_id") % 256
    )
    message = (
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit("Failed password for "), user, F.lit(" from "), peer, F.lit(" port 22 ssh2")),
        )
        .when(F.col("event_type") == "signup", F.concat(F.lit("sudo: session opened for "), user))
        .otherwise(F.concat(F.col("event_type"), F.lit(" by "), user))
    )
    source = F.when(F.col("event_type") == "error", "/var/log/auth.log").otherwise("/var/log/syslog")
    return read(spark, sf, "events").select(
        "event_id", F.col("ts").alias("event_ts"), message.alias("message"),
        F.col("event_type").alias("log_type"), source.alias("source"),
        host_of("event_id").alias("host"), "user_id",
    )


def v_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def v_metrics(spark: SparkSession, sf: str, read=table) -> DataFrame:
    e = read(spark, sf, "events")
    value, kind = F.col("value"), F.col("event_type")
    cpu = F.when(
        kind == "click",
        F.struct(F.struct(F.struct((value / 100).alias("pct")).alias("norm")).alias("total")),
    )
    memory = F.when(
        kind == "view",
        F.struct(F.struct(F.struct((value / 100).alias("pct")).alias("used")).alias("actual")),
    )
    load = F.when(kind == "purchase", F.struct(F.when(F.col("event_id") % 10 != 0, value).alias("1")))
    system = F.when(
        kind.isin("click", "view", "purchase"),
        F.struct(cpu.alias("cpu"), memory.alias("memory"), load.alias("load")),
    )
    network = F.when(
        kind == "signup",
        F.struct(F.struct((value * 10).alias("bytes")).alias("in"), F.struct((value * 5).alias("bytes")).alias("out")),
    )
    return e.select(
        "event_id", F.col("ts").alias("event_ts"),
        F.struct(host_of("event_id").alias("name")).alias("host"),
        system.alias("system"), network.alias("network"),
    )


def v_anomalies(spark: SparkSession, sf: str, read=table) -> DataFrame:
    return read(spark, sf, "events").where("event_type = 'error'").select(
        "event_id", F.col("ts").alias("event_ts"), host_of("event_id").alias("host"),
        (F.col("value") / 500).alias("anomaly_score"),
    )


def v_vulns(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.substring("o_orderpriority", 1, 1)

    def pick(*values):
        col = F.lit(values[4])
        for digit, value in zip("1234", values):
            col = F.when(rank == digit, F.lit(value)).otherwise(col)
        return col

    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("event_ts"), host_of("o_orderkey").alias("host"),
        (F.col("o_orderkey") % 1024).cast("int").alias("port"),
        F.concat(F.lit("svc-"), F.col("o_orderkey") % 20).alias("service"),
        pick("critical", "high", "medium", "unknown", "low").alias("severity"),
        F.concat(F.lit("order status "), F.col("o_orderstatus")).alias("description"),
        pick(1.0, 0.8, 0.5, 0.0, 0.2).alias("vulnerability_score"),
    )


def v_compliance(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    check = F.concat(F.lit("Check "), F.col("p_type"))
    for kind, name in CHECK_NAMES.items():
        check = F.when(F.col("p_type") == kind, F.lit(name)).otherwise(check)
    status = (
        F.when(F.col("l_returnflag") == "R", "FAIL").when(F.col("l_returnflag") == "A", "PASS").otherwise("NOT_RUN")
    )
    return (
        table(spark, sf, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_shipdate").alias("event_ts"), host_of("l_orderkey").alias("host"),
            F.col("l_linestatus").alias("framework"), check.alias("check_name"), status.alias("status"),
        )
    )


def v_compliance_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """The compliance rows without the check name: no join with the check table."""
    status = (
        F.when(F.col("l_returnflag") == "R", "FAIL").when(F.col("l_returnflag") == "A", "PASS").otherwise("NOT_RUN")
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("event_ts"), host_of("l_orderkey").alias("host"),
        F.col("l_linestatus").alias("framework"), status.alias("status"),
    )


def v_assets(spark: SparkSession, sf: str) -> DataFrame:
    """Asset dimension: every host of a number below forty, plus the `default` row for the others."""
    heavy = F.count_if(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")) / F.count("*")
    named = (
        table(spark, sf, "customer")
        .groupBy(host_of("c_custkey").alias("asset"))
        .agg(heavy.alias("heavy"))
        .where("try_cast(substr(asset, 6) AS INT) < 40")
        .select(
            "asset", F.concat(F.lit("Asset "), "asset").alias("name"),
            F.when(F.col("heavy") >= 0.45, "high").when(F.col("heavy") >= 0.38, "medium")
            .otherwise("low").alias("criticality"),
        )
        .select(
            "*",
            F.when(F.col("criticality") == "high", 0.4).otherwise(0.3).alias("anomaly_weight"),
            F.when(F.col("criticality") == "high", 0.3).otherwise(0.4).alias("vulnerability_weight"),
            F.lit(0.3).alias("compliance_weight"),
        )
    )
    default = spark.range(1).select(
        F.lit("default").alias("asset"), F.lit("Default Asset").alias("name"), F.lit("low").alias("criticality"),
        F.lit(0.3).alias("anomaly_weight"), F.lit(0.3).alias("vulnerability_weight"),
        F.lit(0.4).alias("compliance_weight"),
    )
    return named.unionByName(default).withColumn("total_weight", F.lit(1.0))


IPV4 = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
URL_HOST = r"^[a-z]+://([^/:?#]+)"


def _document_rows(spark: SparkSession, sf: str, read=table) -> DataFrame:
    text = F.lit(None).cast("string")
    return read(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("log_id"), F.col("doc_id").alias("num_id"),
        F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(IPV4), F.lit(0)))).alias("ip"),
        text.alias("domain"), text.alias("url"), F.sha2("text", 256).alias("hash"),
        host_of("doc_id").alias("host"), (F.col("lang") == "en").alias("listed"),
    )


def _page_rows(spark: SparkSession, sf: str, read=table) -> DataFrame:
    text = F.lit(None).cast("string")
    return read(spark, sf, "pages").select(
        F.concat(F.lit("p"), F.col("page_id")).alias("log_id"), F.col("page_id").alias("num_id"), F.lit(None).cast("array<string>").alias("ip"),
        F.nullif(F.regexp_extract("url", URL_HOST, 1), F.lit("")).alias("domain"), "url", text.alias("hash"),
        host_of("page_id").alias("host"), F.col("url").contains("/en/").alias("listed"),
    )


def v_beat_logs(spark: SparkSession, sf: str, read=table) -> DataFrame:
    """Log corpus with observables: every document (all its ips, hash) and every page (url, domain).

    `listed` marks the English rows, whose observables make up the indicator feeds.
    """
    return _document_rows(spark, sf, read).unionByName(_page_rows(spark, sf, read))


def _feed(rows: DataFrame, kinds: list[str]) -> DataFrame:
    level = F.when(F.col("num_id") % 4 == 0, "critical").when(F.col("num_id") % 4 == 1, "high").when(
        F.col("num_id") % 4 == 2, "medium").otherwise("low")
    texts = (level.alias("threat_level"), F.concat(F.lit("seen in "), "log_id").alias("description"))
    found = observables(rows.where("listed").select("log_id", "num_id", *kinds), "log_id", ("num_id",))
    return found.select("type", F.col("value").alias("indicator"), *texts)


def v_feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The observables of the listed rows as two feeds: documents (ip, hash), pages (domain, url)."""
    return _feed(_document_rows(spark, sf), ["ip", "hash"]), _feed(_page_rows(spark, sf), ["domain", "url"])


def v_messages(spark: SparkSession, sf: str, read=table) -> DataFrame:
    kind = F.col("event_type")
    bad_type = F.when(F.col("event_id") % 5 == 0, "reboot").when(F.col("event_id") % 100 == 3, "get_status")
    return read(spark, sf, "events").select(
        "event_id", F.col("ts").alias("event_ts"),
        F.when(kind == "signup", "register").when(kind.isin("click", "view"), "heartbeat")
        .when(kind == "purchase", "send_data").otherwise(bad_type).alias("type"),
        F.concat(F.lit("worker-"), F.col("user_id")).alias("worker_id"),
        F.when((kind == "signup") & (F.col("event_id") % 11 != 0),
               F.when(F.col("event_id") % 2 == 0, "scanner").otherwise("log_collector")).alias("worker_type"),
        F.when(F.col("event_id") % 3 != 0, host_of("event_id")).alias("host"),
        F.when((kind == "purchase") & (F.col("event_id") % 7 != 0), F.col("props")).alias("data"),
    )


def v_training(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "normal").otherwise("junk")
    return (
        table(spark, sf, "documents").select("doc_id", "text")
        .join(table(spark, sf, "labels"), "doc_id")
        .select("doc_id", F.col("text").alias("message"), kind.alias("threat_type"))
    )


# --------------------------------------------------------------------------------------
# The same views as SQL common table expressions.

def _host(key: str) -> str:
    return f"('host-' || CAST(CAST(floor(sqrt({key} % 2500)) AS INTEGER) AS VARCHAR))"


_CHECK_CASE = "CASE p_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in CHECK_NAMES.items()
) + " ELSE 'Check ' || p_type END"
_STATUS_CASE = "CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'A' THEN 'PASS' ELSE 'NOT_RUN' END"

VIEW_SQL: dict[str, str] = {
    "v_logs": f"""
        SELECT event_id, ts AS event_ts,
          CASE WHEN event_type='error' THEN 'Failed password for user' || user_id || ' from 10.0.'
                 || CAST(user_id // 256 AS INTEGER) || '.' || (user_id % 256) || ' port 22 ssh2'
               WHEN event_type='signup' THEN 'sudo: session opened for user' || user_id
               ELSE event_type || ' by user' || user_id END AS message,
          event_type AS log_type,
          CASE WHEN event_type='error' THEN '/var/log/auth.log' ELSE '/var/log/syslog' END AS source,
          {_host('event_id')} AS host, user_id
        FROM events""",
    "v_lines": """
        SELECT doc_id, source, lang, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line
        FROM (SELECT doc_id, source, lang, parts, unnest(range(1, len(parts) + 1)) AS i
              FROM (SELECT doc_id, source, lang, string_split(text, chr(10)) AS parts FROM documents))""",
    "v_features": f"""
        SELECT event_id, ts AS event_ts, {_host('event_id')} AS host,
          CASE WHEN event_type='click' THEN value/100 END AS cpu_usage,
          CASE WHEN event_type='view' THEN value/100 END AS memory_usage,
          CASE WHEN event_type='purchase' THEN CASE WHEN event_id % 10 <> 0 THEN value ELSE 0.0 END END AS load_1m,
          CASE WHEN event_type='signup' THEN value*10 END AS network_in_bytes,
          CASE WHEN event_type='signup' THEN value*5 END AS network_out_bytes
        FROM events""",
    "v_anomalies": f"""
        SELECT event_id, ts AS event_ts, {_host('event_id')} AS host, value/500 AS anomaly_score
        FROM events WHERE event_type='error'""",
    "v_vulns": f"""
        SELECT o_orderkey, o_orderdate AS event_ts, {_host('o_orderkey')} AS host,
          CAST(o_orderkey % 1024 AS INTEGER) AS port, 'svc-' || (o_orderkey % 20) AS service,
          CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'critical' WHEN '2' THEN 'high'
            WHEN '3' THEN 'medium' WHEN '4' THEN 'unknown' ELSE 'low' END AS severity,
          'order status ' || o_orderstatus AS description,
          CASE substr(o_orderpriority,1,1) WHEN '1' THEN 1.0::DOUBLE WHEN '2' THEN 0.8::DOUBLE
            WHEN '3' THEN 0.5::DOUBLE WHEN '4' THEN 0.0::DOUBLE ELSE 0.2::DOUBLE END AS vulnerability_score
        FROM orders""",
    "v_compliance": f"""
        SELECT l_shipdate AS event_ts, {_host('l_orderkey')} AS host, l_linestatus AS framework,
          {_CHECK_CASE} AS check_name, {_STATUS_CASE} AS status
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_compliance_hosts": f"""
        SELECT l_shipdate AS event_ts, {_host('l_orderkey')} AS host, l_linestatus AS framework,
          {_STATUS_CASE} AS status
        FROM lineitem""",
    "v_assets": """
        SELECT asset, name, criticality,
          CASE WHEN asset='default' THEN 0.3::DOUBLE WHEN criticality='high' THEN 0.4::DOUBLE ELSE 0.3::DOUBLE END AS anomaly_weight,
          CASE WHEN asset='default' THEN 0.3::DOUBLE WHEN criticality='high' THEN 0.3::DOUBLE ELSE 0.4::DOUBLE END AS vulnerability_weight,
          CASE WHEN asset='default' THEN 0.4::DOUBLE ELSE 0.3::DOUBLE END AS compliance_weight,
          1.0::DOUBLE AS total_weight
        FROM (SELECT asset, name, CASE WHEN heavy >= 0.45 THEN 'high' WHEN heavy >= 0.38 THEN 'medium' ELSE 'low' END AS criticality
              FROM (SELECT HOST_C AS asset, 'Asset ' || HOST_C AS name,
                      CAST(count(*) FILTER (WHERE c_mktsegment IN ('BUILDING','MACHINERY')) AS DOUBLE) / count(*) AS heavy
                    FROM customer GROUP BY 1)
              WHERE TRY_CAST(substr(asset, 6) AS INTEGER) < 40
              UNION ALL SELECT 'default', 'Default Asset', 'low')""".replace("HOST_C", _host("c_custkey")),
    "v_beat_logs": f"""
        SELECT 'd' || doc_id AS log_id, doc_id AS num_id,
          list_sort(list_distinct(regexp_extract_all(text, '{IPV4}'))) AS ip, NULL::VARCHAR AS domain, NULL::VARCHAR AS url,
          sha256(text) AS hash, {_host('doc_id')} AS host, lang = 'en' AS listed FROM documents
        UNION ALL
        SELECT 'p' || page_id, page_id, NULL, nullif(regexp_extract(url, '{URL_HOST}', 1), ''), url, NULL,
          {_host('page_id')}, contains(url, '/en/') FROM pages""",
    "v_observables": """
        SELECT log_id, num_id, host, listed, 'ip' AS type, unnest(ip) AS value FROM v_beat_logs
        UNION ALL SELECT log_id, num_id, host, listed, 'domain', domain FROM v_beat_logs WHERE domain IS NOT NULL
        UNION ALL SELECT log_id, num_id, host, listed, 'url', url FROM v_beat_logs WHERE url IS NOT NULL
        UNION ALL SELECT log_id, num_id, host, listed, 'hash', hash FROM v_beat_logs WHERE hash IS NOT NULL""",
    "v_indicators": """
        SELECT type, value AS indicator,
          CASE num_id % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS threat_level,
          'seen in ' || log_id AS description
        FROM v_observables WHERE listed""",
    "v_messages": f"""
        SELECT event_id, ts AS event_ts,
          CASE WHEN event_type='signup' THEN 'register' WHEN event_type IN ('click','view') THEN 'heartbeat'
               WHEN event_type='purchase' THEN 'send_data' WHEN event_id % 5 = 0 THEN 'reboot'
               WHEN event_id % 100 = 3 THEN 'get_status' END AS type,
          'worker-' || user_id AS worker_id,
          CASE WHEN event_type='signup' AND event_id % 11 <> 0
               THEN CASE WHEN event_id % 2 = 0 THEN 'scanner' ELSE 'log_collector' END END AS worker_type,
          CASE WHEN event_id % 3 <> 0 THEN {_host('event_id')} END AS host,
          CASE WHEN event_type='purchase' AND event_id % 7 <> 0 THEN props END AS data
        FROM events""",
    "v_training": """
        SELECT d.doc_id, d.text AS message,
          CASE WHEN toxic=1 THEN 'toxic' WHEN quality=1 THEN 'normal' ELSE 'junk' END AS threat_type
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}

# Views that read other views.
VIEW_NEEDS = {"v_observables": ["v_beat_logs"], "v_indicators": ["v_observables"]}


def with_views(names: str, body: str) -> str:
    """Prefix `body` with the definitions of the named views, dependencies first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in VIEW_NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    definitions = ",\n".join(f"{name} AS ({VIEW_SQL[name]})" for name in ordered)
    separator = ",\n" if body.lstrip().startswith("+") else "\n"
    return f"WITH {definitions}{separator}{body.lstrip().lstrip('+')}"
