"""Row-local derivations: text, time, author, size, score, wording, keys."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from revlens.config import REPORT_BANDS
from revlens.functions import authors, keys, numbers, risk, times, wording
from revlens.functions.labels import reverted_label
from revlens.functions.text import clean_text, tokens
from revlens.operators import features
from revlens.operators.deltas import delta_or_zero
from revlens.operators.tables import rule_explanations
from revlens.plans.registry import query, table, texts
from revlens.plans.views import EDITS_SQL, EVENTS_SQL, edits, raw_events
from revlens.sources.events import to_messages

CLEAN_SQL = "lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', ' ', 'g'))"


@query(
    "clean_text",
    f"SELECT doc_id, md5({CLEAN_SQL}) AS clean_md5, CAST(length({CLEAN_SQL}) AS INTEGER) AS clean_chars "
    "FROM documents",
)
def _clean(spark, sf):
    cleaned = clean_text(F.col("text"))
    return texts(spark, sf).select(
        "doc_id", F.md5(cleaned).alias("clean_md5"), F.length(cleaned).alias("clean_chars")
    )


@query(
    "token_counts",
    f"""SELECT doc_id,
      CAST(len(list_filter(regexp_split_to_array({CLEAN_SQL}, '\\s+'), lambda t: length(t) >= 2)) AS INTEGER)
        AS n_tokens FROM documents""",
)
def _tokens(spark, sf):
    counted = F.size(tokens(clean_text(F.col("text"))))
    return texts(spark, sf).select("doc_id", counted.alias("n_tokens"))


@query(
    "anonymous_variants",
    EDITS_SQL
    + """SELECT id, "user" AS user_name, is_anon = 1 AS anon,
      regexp_matches("user", '^([0-9]{1,3}\\.){3}[0-9]{1,3}$') AS anon_ipv4,
      regexp_matches("user", '^([0-9]{1,3}\\.){3}[0-9]{1,3}$|^[0-9a-fA-F:]+:') AS anon_prefix,
      regexp_matches("user", '^([0-9]{1,3}\\.){3}[0-9]{1,3}$|^[0-9a-fA-F:]+:[0-9a-fA-F:]+$') AS anon_record
    FROM edits""",
)
def _anon(spark, sf):
    user = F.col("user")
    return edits(spark, sf).select(
        "id",
        user.alias("user_name"),
        authors.is_anon(user).alias("anon"),
        authors.is_anon_ipv4(user).alias("anon_ipv4"),
        authors.is_anon_prefix(user).alias("anon_prefix"),
        authors.is_anon_record(user).alias("anon_record"),
    )


@query(
    "parsed_times",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS dump_epoch,
      CAST(epoch_ms(date_trunc('second', ts)) + extract('millisecond' FROM ts)::BIGINT % 1000 // 100 * 100
        AS BIGINT) AS history_ms,
      CAST(floor(epoch(ts)) AS BIGINT) AS iso_epoch, CAST(floor(epoch(ts)) AS BIGINT) AS seconds_epoch,
      CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS zoned_epoch, CAST(NULL AS BIGINT) AS broken_epoch
    FROM events""",
)
def _times(spark, sf):
    ts = F.col("ts").cast("timestamp")
    seconds = F.unix_timestamp(ts)
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        F.unix_timestamp(times.dump_time(F.concat(iso, F.lit("Z")))).alias("dump_epoch"),
        F.unix_millis(times.history_time(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S"))).alias(
            "history_ms"
        ),
        F.unix_timestamp(times.iso_time(F.concat(iso, F.lit("Z")))).alias("iso_epoch"),
        F.unix_timestamp(times.epoch_time(seconds)).alias("seconds_epoch"),
        F.unix_timestamp(times.iso_time(F.concat(iso, F.lit("+02:00")))).alias("zoned_epoch"),
        F.unix_timestamp(times.iso_time(F.concat(F.lit("at "), iso))).alias("broken_epoch"),
    )


@query(
    "time_features",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day,
      CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(isodow(ts) AS INTEGER) AS iso_weekday
    FROM events""",
)
def _clock(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id",
        times.hour_of_day(ts).alias("hour_of_day"),
        times.day_of_week(ts).alias("day_of_week"),
        times.day_of_week(ts, iso=True).alias("iso_weekday"),
    )


@query(
    "length_deltas",
    EVENTS_SQL
    + """SELECT id, CAST(new_len - coalesce(old_len, 0) AS DOUBLE) AS per_side,
      coalesce(CAST(new_len - old_len AS DOUBLE), 0.0) AS whole FROM raw""",
)
def _length(spark, sf):
    new, old = F.col("length.new"), F.col("length.old")
    return raw_events(spark, sf).select(
        "id",
        delta_or_zero(new, old).alias("per_side"),
        delta_or_zero(new, old, per_side=False).alias("whole"),
    )


_RECORD_SQL = """SELECT CAST(id AS VARCHAR) AS page_id, title AS page_title, namespace,
  coalesce(CAST(new_rev AS VARCHAR), '') AS rev_id, coalesce(comment, '') AS comment,
  lower(regexp_replace(coalesce(comment, ''), '[^a-zA-Z0-9\\s]', ' ', 'g')) AS comment_clean,
  lower(regexp_replace(title, '[^a-zA-Z0-9\\s]', ' ', 'g')) AS title_clean,
  CAST(hour(event_time) AS INTEGER) AS hour_of_day,
  CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
  CAST(new_len - coalesce(old_len, 0) AS DOUBLE) AS length_delta,
  anon = 1 AS is_anon, anon AS is_anon_int, uname AS contributor_username,
  coalesce(dt, '') AS timestamp FROM raw"""


@query("event_json_features", EVENTS_SQL + _RECORD_SQL)
def _json_features(spark, sf):
    """Events go through JSON text and back before they become records."""
    from revlens.schemas import EVENT

    messages = to_messages(raw_events(spark, sf))
    parsed = messages.select(F.inline(F.array(F.from_json("value", EVENT))))
    return features.prepare_events(parsed)


@query(
    "article_edit_features",
    EVENTS_SQL
    + """SELECT id, CAST(new_len - coalesce(old_len, 0) AS DOUBLE) AS length_delta, anon AS is_anon_int,
      CAST(hour(event_time) AS INTEGER) AS hour_of_day,
      CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
      lower(regexp_replace(coalesce(comment, ''), '[^a-zA-Z0-9\\s]', ' ', 'g')) AS comment_clean,
      lower(regexp_replace(title, '[^a-zA-Z0-9\\s]', ' ', 'g')) AS title_clean
    FROM raw WHERE type = 'edit' AND namespace = 0""",
)
def _article(spark, sf):
    rows = features.event_features(features.article_edits(raw_events(spark, sf)))
    return rows.select("id", *features.FEATURE_DEFAULTS)


_KEYED_SQL = """coalesce(CAST(CASE WHEN new_rev IS NULL THEN id ELSE new_rev END AS VARCHAR), '')"""


@query(
    "raw_prediction_rows",
    EVENTS_SQL
    + f"""SELECT sha256(wiki || ':' || {_KEYED_SQL}) AS id, {_KEYED_SQL} AS rev_id, title AS page_title,
      namespace, uname AS user_name, anon AS is_anon, coalesce(comment, '') AS comment,
      CAST(new_len - coalesce(old_len, 0) AS DOUBLE) AS length_delta,
      coalesce(dt, '2024-02-01T00:00:00.000000') AS timestamp, wiki,
      CAST(0 AS INTEGER) AS scored, '2024-02-01T00:00:00.000000' AS created_at FROM raw""",
)
def _raw_rows(spark, sf):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = features.raw_predictions(raw_events(spark, sf), now)
    return rows.withColumnRenamed("user", "user_name").drop("risk_score", "risk_label")


@query(
    "null_fill",
    EDITS_SQL
    + """SELECT id, coalesce(regexp_replace(lower(comment), '[^a-z0-9\\s]', ' ', 'g'), '') AS comment_clean,
      CAST(coalesce(hour(TRY_CAST(nullif("timestamp", '') AS TIMESTAMP)), 0) AS INTEGER) AS hour_of_day,
      CAST(coalesce(dayofweek(TRY_CAST(nullif("timestamp", '') AS TIMESTAMP)) + 1, 1) AS INTEGER)
        AS day_of_week
    FROM edits""",
)
def _fill(spark, sf):
    rows = features.prediction_features(edits(spark, sf))
    return rows.select("id", "comment_clean", "hour_of_day", "day_of_week")


@query(
    "string_flags",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'R' END AS INTEGER) AS flag,
      coalesce(CAST(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'R' END AS INTEGER), 0)
        AS filled FROM lineitem""",
)
def _flags(spark, sf):
    text = F.when(F.col("l_returnflag") == "R", "true").when(F.col("l_returnflag") == "A", "false")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        reverted_label(text).alias("flag"),
        F.coalesce(reverted_label(text), F.lit(0)).alias("filled"),
    )


@query(
    "risk_bands",
    EDITS_SQL
    + """SELECT id, CASE WHEN coalesce(risk_score, 0) >= 0.20 THEN 'HIGH'
        WHEN coalesce(risk_score, 0) >= 0.08 THEN 'MEDIUM' ELSE 'LOW' END AS shipped,
      CASE WHEN coalesce(risk_score, 0) >= 0.68 THEN 'HIGH'
        WHEN coalesce(risk_score, 0) >= 0.30 THEN 'MEDIUM' ELSE 'LOW' END AS report FROM edits""",
)
def _bands(spark, sf):
    score = F.col("risk_score")
    return edits(spark, sf).select(
        "id", risk.risk_band(score).alias("shipped"), risk.risk_band(score, REPORT_BANDS).alias("report")
    )


RISKY_SQL = (
    "(?i)(\\brevert|\\brvv\\b|\\brv\\b|\\bvandaliz|\\bvandalism\\b|\\bvandal\\b|\\bspam\\b|\\bundo\\b|"
    "\\bundid\\b|\\btest edit|bot: reverting|\\bcv\\b|copyvio|off-?topic|not notable)"
)
SCORE_SQL = f"""greatest(0.0, least(0.05::DOUBLE
  + CASE WHEN is_anon = 1 THEN 0.18::DOUBLE ELSE 0 END
  + CASE WHEN length_delta < -500 THEN 0.22::DOUBLE ELSE 0 END
  + CASE WHEN abs(length_delta) > 1000 THEN 0.10::DOUBLE ELSE 0 END
  + CASE WHEN is_anon = 1 AND trim(coalesce(comment, '')) = '' THEN 0.10::DOUBLE ELSE 0 END
  - CASE WHEN lower("user") LIKE 'bot%' THEN 0.03::DOUBLE ELSE 0 END
  + CASE WHEN regexp_matches(coalesce(comment, ''), '{RISKY_SQL}') THEN 0.25::DOUBLE ELSE 0 END,
  0.99::DOUBLE))"""


@query(
    "heuristic_score",
    EDITS_SQL
    + f""", scored_rows AS (SELECT id, {SCORE_SQL} AS s FROM edits)
    SELECT id, round(s, 6) AS risk_score, CASE WHEN s >= 0.20 THEN 'HIGH' WHEN s >= 0.08 THEN 'MEDIUM'
      ELSE 'LOW' END AS risk_label FROM scored_rows""",
)
def _heuristic(spark, sf):
    columns = (F.col(c) for c in ("comment", "user", "is_anon", "length_delta"))
    scored = edits(spark, sf).select("id", risk.heuristic_score(*columns).alias("s"))
    return scored.select(
        "id", F.round("s", 6).alias("risk_score"), risk.risk_band(F.col("s")).alias("risk_label")
    )


@query(
    "pass_through_score",
    """SELECT event_id, round(CAST('0x' || substr(md5('pass:' || event_id), 1, 8) AS UBIGINT)
      / 4294967296.0::DOUBLE * 0.4::DOUBLE + 0.1::DOUBLE, 9) AS risk_score FROM events""",
)
def _pass_through(spark, sf):
    score = risk.pass_through_score(F.col("event_id"))
    return table(spark, sf, "events").select("event_id", F.round(score, 9).alias("risk_score"))


@query(
    "linear_score",
    EDITS_SQL
    + """SELECT id, round(1 / (1 + exp(-(-2.0::DOUBLE + length_delta * -0.0004::DOUBLE
      + is_anon * 0.9::DOUBLE + namespace * 0.3::DOUBLE))), 6) AS score FROM edits""",
)
def _linear(spark, sf):
    weights = {"length_delta": -0.0004, "is_anon": 0.9, "namespace": 0.3}
    return edits(spark, sf).select(
        "id", F.round(risk.linear_score(-2.0, weights), 6).alias("score")
    )


@query(
    "positive_probability",
    EDITS_SQL + "SELECT id, coalesce(risk_score, 0.5) AS score FROM edits",
)
def _probability(spark, sf):
    score = F.col("risk_score")
    vector = F.when(score.isNotNull(), array_to_vector(F.array(1 - score, score)))
    return edits(spark, sf).select("id", risk.positive_probability(vector).alias("score"))


EXPLAIN_SQL = """'This edit was flagged as **' || coalesce(risk_label, 'None') || '** risk because '
  || CASE WHEN len(reasons) > 0 THEN array_to_string(reasons[1:2], '; ')
     WHEN coalesce(risk_score, 0) >= 0.7 THEN 'multiple statistical features (edit size, user type, comment) combined to produce a high risk score'
     ELSE 'the combination of edit characteristics slightly elevated the risk score' END
  || '. The automated classifier assigned a risk score of ' || printf('%.1f', coalesce(risk_score, 0) * 100)
  || '% based on TF-IDF analysis of the edit comment and numerical features including content size change and user anonymity.'"""
REASONS_SQL = """reasoned AS (SELECT *, list_filter([
    CASE WHEN regexp_matches(lower(coalesce(comment, '')), 'revert|undo|vandal|spam|rv|copyvio')
      THEN 'the edit comment contains keywords associated with reverts or vandalism' END,
    CASE WHEN length_delta < -500 THEN 'a large amount of content was removed ('
        || CAST(abs(trunc(length_delta)) AS BIGINT) || ' bytes deleted)'
      WHEN length_delta < 0 AND is_anon = 1 THEN 'an anonymous user removed content without explanation' END,
    CASE WHEN is_anon = 1 AND abs(length_delta) > 1000 THEN 'an anonymous user made a large content change' END,
    CASE WHEN is_anon = 1 AND trim(coalesce(comment, '')) = ''
      THEN 'the anonymous editor provided no edit summary' END],
    lambda r: r IS NOT NULL) AS reasons FROM edits)"""


@query(
    "explanations",
    EDITS_SQL
    + f""", {REASONS_SQL}
    SELECT id AS edit_id, {EXPLAIN_SQL} AS explanation, 'rule-based-fallback' AS model FROM reasoned""",
)
def _explanations(spark, sf):
    return rule_explanations(edits(spark, sf)).drop("generated_at")


@query(
    "explanation_lengths",
    EDITS_SQL
    + f""", {REASONS_SQL}
    SELECT id AS edit_id, CAST(length({EXPLAIN_SQL}) AS INTEGER) AS n_chars FROM reasoned""",
)
def _explanation_lengths(spark, sf):
    return rule_explanations(edits(spark, sf)).select(
        "edit_id", F.length("explanation").alias("n_chars")
    )


_SIGNED_SQL = """CASE WHEN length_delta >= 0 THEN '+' ELSE '' END || CAST(trunc(length_delta) AS BIGINT)"""


@query(
    "explain_prompt",
    EDITS_SQL
    + f"""SELECT id, 'Wikipedia edit details:' || chr(10) || '- Article: "' || page_title || '"' || chr(10)
      || '- Risk label: ' || coalesce(risk_label, 'None') || ' (score: '
      || coalesce(printf('%.1f', risk_score * 100) || '%', 'unknown') || ')' || chr(10)
      || '- Edit size: ' || CASE WHEN length_delta >= 0 THEN 'added ' || {_SIGNED_SQL} || ' bytes'
         ELSE 'removed ' || CAST(abs(trunc(length_delta)) AS BIGINT) || ' bytes' END || chr(10)
      || '- Made by: ' || CASE WHEN is_anon = 1 THEN 'an anonymous (IP) user' ELSE 'a registered user' END
      || chr(10) || '- Edit comment: "'
      || CASE WHEN coalesce(comment, '') = '' THEN '(no comment)' ELSE substr(comment, 1, 200) END
      || '"' || chr(10) || chr(10) || 'Explain why this edit was flagged as '
      || coalesce(risk_label, 'None') || ' risk in 2-3 sentences.' AS prompt FROM edits""",
)
def _prompt(spark, sf):
    columns = (
        F.col(c)
        for c in ("page_title", "comment", "length_delta", "is_anon", "risk_score", "risk_label")
    )
    return edits(spark, sf).select("id", wording.explain_prompt(*columns).alias("prompt"))


_URL_SQL = """CASE WHEN trim(rev_id) <> '' THEN 'https://en.wikipedia.org/wiki/Special:Diff/' || trim(rev_id)
  ELSE 'https://en.wikipedia.org/wiki/' || replace(page_title, ' ', '_') END"""


@query(
    "alerts",
    EDITS_SQL
    + f"""SELECT id, 'Edit risk ' || risk_label || ' alert: ' || page_title AS subject,
      'Edit risk flagged an edit on ' || page_title || ' as ' || risk_label || ' risk (score '
      || coalesce(printf('%.1f', risk_score * 100) || '%', 'not scored') || ').' || chr(10) || chr(10)
      || 'Size change: ' || {_SIGNED_SQL} || ' bytes' || chr(10) || 'Edit summary: '
      || CASE WHEN coalesce(comment, '') = '' THEN '(no edit summary)' ELSE substr(comment, 1, 500) END
      || chr(10) || 'Diff/page: ' || {_URL_SQL} AS body
    FROM edits WHERE risk_label = 'HIGH'""",
)
def _alerts(spark, sf):
    names = ("rev_id", "page_title", "comment", "length_delta", "risk_score", "risk_label")
    return (
        edits(spark, sf)
        .filter(F.col("risk_label") == "HIGH")
        .select(
            "id",
            wording.alert_subject(F.col("page_title"), F.col("risk_label")).alias("subject"),
            wording.alert_body(*(F.col(c) for c in names)).alias("body"),
        )
    )


@query("diff_urls", EDITS_SQL + f"SELECT id, {_URL_SQL} AS url FROM edits")
def _urls(spark, sf):
    url = wording.diff_url(F.col("rev_id"), F.col("page_title"))
    return edits(spark, sf).select("id", url.alias("url"))


@query(
    "age_text",
    """WITH a AS (SELECT event_id, greatest(0, CAST(floor((epoch_us(TIMESTAMP '2024-01-30 12:00:00')
        - epoch_us(ts)) / 1000000) AS BIGINT)) AS s FROM events)
    SELECT event_id, CASE WHEN s < 60 THEN s || 's ago' WHEN s < 3600 THEN (s // 60) || 'm ago'
      WHEN s < 86400 THEN (s // 3600) || 'h ago' ELSE (s // 86400) || 'd ago' END AS age FROM a""",
)
def _age(spark, sf):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    age = times.age_text(F.col("ts").cast("timestamp"), now)
    return table(spark, sf, "events").select("event_id", age.alias("age"))


@query(
    "byte_texts",
    """WITH s AS (SELECT p_partkey, CAST(p_size AS DOUBLE) * p_size * p_size * p_retailprice AS n FROM part)
    SELECT p_partkey, CASE WHEN n < 1024 THEN printf('%.1f B', n)
      WHEN n < 1048576 THEN printf('%.1f KB', n / 1024)
      WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576) ELSE printf('%.1f GB', n / 1073741824) END
      AS size_text FROM s""",
)
def _bytes(spark, sf):
    side = F.col("p_size").cast("double")
    size = side * F.col("p_size") * F.col("p_size") * F.col("p_retailprice")
    return table(spark, sf, "part").select("p_partkey", numbers.byte_text(size).alias("size_text"))


@query(
    "surrogate_keys",
    EDITS_SQL + "SELECT id, sha256(wiki || ':' || rev_id) AS edit_key FROM edits",
)
def _keys(spark, sf):
    key = keys.edit_key(F.col("wiki"), F.col("rev_id"))
    return edits(spark, sf).select("id", key.alias("edit_key"))


@query(
    "display_numbers",
    """SELECT event_id, printf('%.3f', value / 500) AS score_text, printf('%.1f', value / 500 * 100) || '%'
      AS percent_text, round(value / 500, 4) AS rounded FROM events""",
)
def _numbers(spark, sf):
    score = F.col("value") / 500
    return table(spark, sf, "events").select(
        "event_id",
        numbers.fixed(score, 3).alias("score_text"),
        numbers.percent(score).alias("percent_text"),
        numbers.round_exact(score, 4).alias("rounded"),
    )
