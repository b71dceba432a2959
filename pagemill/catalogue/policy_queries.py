"""Fetch policy: error classes, backoff, retries, pacing, breaker, budget."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.catalogue.text_queries import tokens_sql
from pagemill.functions import policy
from pagemill.functions import text as T
from pagemill.operators import replay as R
from pagemill.session import spread

# Every event as a request outcome. User groups stand for platforms; one of them is hot.
OUTCOMES = """outcomes AS (SELECT event_id, epoch_us(ts) AS t, CASE WHEN user_id < 50 THEN -1 ELSE user_id END AS k,
  CASE WHEN event_type <> 'error' AND event_type <> 'view' THEN NULL WHEN event_id % 3 = 0 THEN 'RATE_LIMITED'
    WHEN event_id % 3 = 1 THEN 'SERVER_ERROR' ELSE 'CONTENT_EMPTY' END AS code FROM events)"""


def outcomes(spark, sf_dir):
    code = (
        F.when(~F.col("event_type").isin("error", "view"), F.lit(None).cast("string"))
        .when(F.col("event_id") % 3 == 0, F.lit("RATE_LIMITED"))
        .when(F.col("event_id") % 3 == 1, F.lit("SERVER_ERROR"))
        .otherwise(F.lit("CONTENT_EMPTY"))
    )
    key = F.when(F.col("user_id") < 50, F.lit(-1)).otherwise(F.col("user_id"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", at.alias("at"), key.cast("bigint").alias("k"), code.alias("code"))


STATUS = """statuses AS (SELECT event_id, CASE event_type WHEN 'error' THEN 500 + event_id % 4 WHEN 'click' THEN 429
  WHEN 'view' THEN 404 WHEN 'signup' THEN 401 ELSE NULL END AS status,
  CASE WHEN event_type = 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connect' ELSE '' END ELSE '' END AS failure
  FROM events)"""


@query(
    f"""WITH {STATUS}, c AS (SELECT event_id, status, CASE WHEN status = 429 THEN 'RATE_LIMITED' WHEN status = 401 THEN 'AUTH_EXPIRED'
          WHEN status = 404 THEN 'PAGE_NOT_FOUND' WHEN status >= 500 THEN 'SERVER_ERROR'
          WHEN failure IN ('timeout', 'connect') THEN 'NETWORK_ERROR' ELSE 'UNKNOWN_ERROR' END AS error_code, failure FROM statuses)
        SELECT event_id, 'generic' AS platform, 'fetch' AS stage, 'failed' AS status, error_code,
          error_code NOT IN ('PAGE_NOT_FOUND', 'UNKNOWN_ERROR') AS retryable,
          CASE error_code WHEN 'RATE_LIMITED' THEN 'wait and retry' WHEN 'AUTH_EXPIRED' THEN 'refresh login session and retry'
            WHEN 'PAGE_NOT_FOUND' THEN 'skip' WHEN 'SERVER_ERROR' THEN 'retry later' WHEN 'NETWORK_ERROR' THEN 'retry'
            ELSE 'inspect error and retry' END AS next_action,
          CASE error_code WHEN 'RATE_LIMITED' THEN 'Rate limit hit' WHEN 'AUTH_EXPIRED' THEN 'Auth failed (401)'
            WHEN 'PAGE_NOT_FOUND' THEN 'Page not found' WHEN 'SERVER_ERROR' THEN 'Server error (' || c.status || ')'
            WHEN 'NETWORK_ERROR' THEN CASE failure WHEN 'timeout' THEN 'Request timed out' ELSE 'Connection failed' END
            ELSE 'odd' END AS message FROM c"""
)
def error_rows(spark, sf_dir):
    kind, key = F.col("event_type"), F.col("event_id")
    status = (
        F.when(kind == "error", 500 + key % 4).when(kind == "click", F.lit(429)).when(kind == "view", F.lit(404))
        .when(kind == "signup", F.lit(401))
    ).cast("int")
    failure = F.when(
        kind == "purchase", F.when(key % 3 == 0, F.lit("timeout")).when(key % 3 == 1, F.lit("connect")).otherwise(F.lit(""))
    ).otherwise(F.lit(""))
    error = policy.classify_status(status, failure, F.lit("odd"))
    rows = table(spark, sf_dir, "events").select("event_id", error.alias("e"))
    row = policy.error_row(F.lit("generic"), F.lit("page"), "fetch", F.col("e"))
    rows = rows.select("event_id", row.alias("r"))
    return rows.select(
        "event_id", "r.platform", "r.stage", "r.status", "r.error_code", "r.retryable", "r.next_action", "r.message"
    )


@query(
    """WITH r AS (SELECT event_id, ts, CAST(event_id % 6 AS INTEGER) AS attempt,
          CASE user_id % 4 WHEN 0 THEN 'amazon' WHEN 1 THEN 'wikipedia' WHEN 2 THEN 'base' ELSE 'somewhere' END AS platform FROM events)
        SELECT event_id, platform,
          CASE WHEN attempt >= CASE platform WHEN 'amazon' THEN 4 WHEN 'wikipedia' THEN 2 ELSE 3 END THEN 'dead' ELSE 'retry_wait' END AS status,
          CASE WHEN attempt < CASE platform WHEN 'amazon' THEN 4 WHEN 'wikipedia' THEN 2 ELSE 3 END
            THEN epoch_us(ts) + [2, 5, 10][least(attempt, 2) + 1] * 1000000 END AS not_before_us,
          CAST([2, 5, 10][least(attempt, 2) + 1] AS DOUBLE) AS backoff,
          CASE platform WHEN 'amazon' THEN 12 WHEN 'wikipedia' THEN 60 WHEN 'base' THEN 24 ELSE 30 END AS rpm FROM r"""
)
def retry_transition(spark, sf_dir):
    platform = (
        F.when(F.col("user_id") % 4 == 0, F.lit("amazon")).when(F.col("user_id") % 4 == 1, F.lit("wikipedia"))
        .when(F.col("user_id") % 4 == 2, F.lit("base")).otherwise(F.lit("somewhere"))
    )
    attempt = (F.col("event_id") % 6).cast("int")
    state = policy.after_failure(platform, attempt, F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", platform.alias("platform"), state["status"].alias("status"),
        F.unix_micros(state["not_before"]).alias("not_before_us"), policy.backoff_seconds(attempt).alias("backoff"),
        policy.requests_per_minute(platform).alias("rpm"),
    )


PACE = 6 * 3600 * 1_000_000
HOLD = 2 * 3600 * 1_000_000


def pace_sql(burst: int) -> str:
    return f"""WITH RECURSIVE o AS MATERIALIZED (SELECT event_id, user_id AS k, epoch_us(ts) AS t,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
      s AS (SELECT k, n, event_id, t, CAST({burst} AS DOUBLE) - 1 AS tokens, t AS admitted FROM o WHERE n = 1
        UNION ALL SELECT k, n, event_id, t, CASE WHEN refill >= 1 THEN refill - 1 ELSE 0 END,
          CASE WHEN refill >= 1 THEN start ELSE start + CAST(round((1 - refill) * {PACE}) AS BIGINT) END
        FROM (SELECT o.k, o.n, o.event_id, o.t, greatest(o.t, s.admitted) AS start,
            least({burst}, s.tokens + (greatest(o.t, s.admitted) - s.admitted) / {PACE}.0) AS refill
          FROM s JOIN o ON o.k = s.k AND o.n = s.n + 1))
      SELECT event_id, CAST(round(admitted / 1000000.0) AS BIGINT) AS admitted_s FROM s"""


def paced(spark, sf_dir, burst: int):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("k"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    )
    out = R.admit_times(rows, ["k"], "at", ["event_id"], F.lit(PACE).cast("bigint"), burst)
    return out.select("event_id", F.round(F.col("admitted_at") / 1e6).cast("bigint").alias("admitted_s"))


@query(pace_sql(1))
def pacing_replay(spark, sf_dir):
    return paced(spark, sf_dir, 1)


@query(pace_sql(3))
def token_bucket_replay(spark, sf_dir):
    return paced(spark, sf_dir, 3)


@query(
    f"""WITH RECURSIVE {OUTCOMES}, o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, event_id) AS n,
          CASE WHEN code IS NULL THEN 0 WHEN code = 'CONTENT_EMPTY' THEN 2 ELSE 1 END AS kind FROM outcomes),
        s AS (SELECT k, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS event_id, CAST(0 AS BIGINT) AS failed,
            CAST(0 AS BIGINT) AS until, true AS allowed FROM o WHERE n = 1
          UNION ALL SELECT k, n, event_id,
            CASE WHEN NOT ok THEN failed0 WHEN kind = 0 THEN 0 WHEN kind = 1 THEN failed0 + 1 ELSE failed0 END,
            CASE WHEN NOT ok THEN until0 WHEN kind = 1 AND failed0 + 1 >= 2 THEN t + {HOLD} ELSE 0 END, ok
          FROM (SELECT o.k, o.n, o.event_id, o.t, o.kind, (s.until = 0 OR s.until <= o.t) AS ok, s.until AS until0,
              CASE WHEN s.until > 0 AND s.until <= o.t THEN 0 ELSE s.failed END AS failed0
            FROM s JOIN o ON o.k = s.k AND o.n = s.n + 1))
        SELECT k, event_id, allowed FROM s WHERE n > 0"""
)
def breaker_replay(spark, sf_dir):
    rows = outcomes(spark, sf_dir).withColumns({"kind": R.outcome(F.col("code")), "pause": F.lit(HOLD).cast("bigint")})
    return R.breaker_replay(rows, "k", "at", "event_id", "kind", "pause")


BUDGET = 60_000


@query(
    f"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {tokens_sql('text')} AS used, row_number() OVER (ORDER BY doc_id) AS n FROM documents),
        s AS (SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS doc_id, CAST(0 AS BIGINT) AS spent, CAST(0 AS BIGINT) AS c, true AS ok
          UNION ALL SELECT n, doc_id, CASE WHEN ok THEN spent + used ELSE spent END,
            CASE WHEN ok AND used > 0 THEN c + 1 ELSE c END, ok
          FROM (SELECT d.n, d.doc_id, d.used, s.spent, s.c,
              s.c = 0 OR s.spent + greatest(1, s.spent // greatest(s.c, 1)) <= {BUDGET} AS ok FROM s JOIN d ON d.n = s.n + 1))
        SELECT doc_id, ok AS admitted FROM s WHERE n > 0"""
)
def budget_gate(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", T.token_estimate(F.col("text")).alias("used")
    )
    return R.budget_gate(docs, ["doc_id"], "used", BUDGET).select("doc_id", "admitted")


@query(
    """WITH e AS (SELECT event_id, event_id % 7 AS k, [429, 401, 403, 404, 500 + event_id % 100, 418, 200][event_id % 7 + 1] AS status,
           CASE WHEN event_id % 3 = 0 THEN 'http_status' WHEN event_id % 11 = 1 THEN 'timeout' WHEN event_id % 11 = 2 THEN 'connect' WHEN event_id % 11 = 3 THEN 'ValueError' END AS exc, event_type AS detail FROM events),
         c AS (SELECT *, CASE WHEN exc = 'http_status' AND status = 429 THEN 'RATE_LIMITED' WHEN exc = 'http_status' AND status IN (401, 403) THEN 'AUTH_EXPIRED' WHEN exc = 'http_status' AND status = 404 THEN 'PAGE_NOT_FOUND'
           WHEN exc = 'http_status' AND status BETWEEN 500 AND 599 THEN 'SERVER_ERROR' WHEN exc IN ('timeout', 'connect') THEN 'NETWORK_ERROR' WHEN exc IS NOT NULL THEN 'UNKNOWN_ERROR'
           WHEN event_id % 2 = 0 THEN 'CONTENT_EMPTY' END AS code FROM e)
       SELECT event_id, code AS error_code, CASE code WHEN 'AUTH_EXPIRED' THEN 'Auth failed (' || status || ')' WHEN 'SERVER_ERROR' THEN 'Server error (' || status || ')' WHEN 'RATE_LIMITED' THEN 'Rate limit hit'
           WHEN 'PAGE_NOT_FOUND' THEN 'Page not found' WHEN 'NETWORK_ERROR' THEN CASE exc WHEN 'timeout' THEN 'Request timed out' ELSE 'Connection failed' END
           WHEN 'UNKNOWN_ERROR' THEN detail WHEN 'CONTENT_EMPTY' THEN 'Page body is empty or too short' END AS message,
         CASE WHEN event_id % 13 = 0 THEN 'CAPTCHA: ' || detail WHEN event_id % 2 = 0 AND exc = 'http_status' AND status IN (401, 403) THEN 'AUTH_EXPIRED: ' || detail END AS sign_in,
         ['WIKIPEDIA_FETCH_FAILED', 'AMAZON_FETCH_FAILED', 'GENERIC_FETCH_FAILED'][event_id % 3 + 1] || '/' || coalesce(exc, 'none') || '/' || detail AS normalised FROM c"""
)
def normalised_errors(spark, sf_dir):
    """Failures by one ordered list of rules over what was thrown, status, page and session; and in their platform's terms."""
    from pagemill.functions import errors as R

    key = F.col("event_id")
    pick = lambda values, n: F.element_at(F.array(*[v if not isinstance(v, (str, int)) else F.lit(v) for v in values]), (key % n + 1).cast("int"))
    thrown = F.when(key % 3 == 0, "http_status").when(key % 11 == 1, "timeout").when(key % 11 == 2, "connect").when(key % 11 == 3, "ValueError")
    rows = table(spark, sf_dir, "events").select(
        "event_id", thrown.alias("exc"), pick([429, 401, 403, 404, (key % 100 + 500).cast("int"), 418, 200], 7).cast("int").alias("status"), F.col("event_type").alias("detail"),
        F.when(key % 2 == 0, F.lit("")).otherwise(F.repeat(F.lit("fine page "), 30)).alias("html"), pick(["wikipedia", "amazon", "else"], 3).alias("platform"),
    )
    own = F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in (("error_code", "CAPTCHA", "string"), ("agent_hint", "x", "string"), ("message", "m", "string"), ("retryable", False, "boolean"), ("status_code", None, "int"))])
    rows = rows.select(
        "*", R.classify(F.col("exc"), F.col("status"), F.col("detail"), F.col("html"), F.lit("http://x")).alias("e"),
        R.auth_failure(F.when(key % 13 == 0, "CAPTCHA"), own, F.col("exc"), F.col("status"), key % 2 == 0, F.col("detail")).alias("s"),
        R.normalised_error(F.col("platform"), F.lit("page"), F.lit("fetch"), F.coalesce("exc", F.lit("none")), F.col("detail")).alias("n"),
    )
    return rows.select("event_id", "e.error_code", "e.message", F.when(F.col("s").isNotNull(), F.concat_ws(": ", "s.error_code", "s.message")).alias("sign_in"), F.concat_ws("/", "n.normalized_code", "n.error_type", "n.message").alias("normalised"))
