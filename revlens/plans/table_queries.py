"""Counts, labels, feed questions, joins, windows and exact metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions.labels import blank_comment, label_from_signals, risky_comment, weak_label
from revlens.functions.times import created_text
from revlens.operators import confusion, deltas, feed, ranking, splits, stats, tables
from revlens.operators.features import history_steps
from revlens.operators.tfidf import tfidf
from revlens.plans.registry import query, table, texts
from revlens.plans.scalar_queries import EXPLAIN_SQL, REASONS_SQL, RISKY_SQL, SCORE_SQL
from revlens.plans.views import EDITS_SQL, edits, revisions, turns
from revlens.session import scratch_path
from revlens.sinks.bucketed import latest_bucketed, write_bucketed
from revlens.sources.files import size_rows, size_totals

# ---- labels ---------------------------------------------------------------------------------

# accented letters are word characters to the JVM's regex but not to the SQL engine's, so the SQL
# side turns them into a plain letter no pattern contains
_LABELED_SQL = f"""WITH sized AS (
  SELECT doc_id, source, regexp_replace(regexp_replace(text, '[^\\x00-\\x7F\\p{{L}}\\p{{N}}]', ' ', 'g'),
      '[^\\x00-\\x7F]', 'x', 'g') AS comment, doc_id % 4 = 0 AS anon,
    CAST(n_chars - lag(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS DOUBLE) AS length_delta
  FROM documents),
labeled AS (
  SELECT doc_id, source, length_delta, CAST(coalesce(regexp_matches(comment, '{RISKY_SQL}')
    OR length_delta < -500 OR (anon AND abs(length_delta) > 1000) OR (anon AND trim(comment) = ''), FALSE)
    AS INTEGER) AS label FROM sized)
"""


def weak_labeled(spark, sf, null_as_zero=True):
    """Documents labelled by rule. Only the two comment signals, not the texts, reach the shuffle."""
    signals = revisions(spark, sf).select(
        "rev_id",
        "page_id",
        "is_anon_int",
        "text_bytes",
        risky_comment(F.col("comment")).alias("risky"),
        blank_comment(F.col("comment")).alias("blank"),
    )
    sized = deltas.with_previous(signals, "page_id", "rev_id", "text_bytes", "previous_bytes")
    delta = (F.col("text_bytes") - F.col("previous_bytes")).cast("double")
    label = label_from_signals(
        F.col("risky"), F.col("blank"), F.col("is_anon_int").cast("boolean"), delta, null_as_zero
    )
    return sized.select(
        F.col("rev_id").alias("doc_id"),
        F.col("page_id").alias("source"),
        delta.alias("length_delta"),
        label.alias("label"),
    )


@query("weak_labels", _LABELED_SQL + "SELECT * FROM labeled")
def _weak(spark, sf):
    return weak_labeled(spark, sf)


@query(
    "weak_labels_edits",
    EDITS_SQL
    + f"""SELECT id, CAST(regexp_matches(comment, '{RISKY_SQL}') OR length_delta < -500
      OR (is_anon = 1 AND abs(length_delta) > 1000)
      OR (is_anon = 1 AND (comment IS NULL OR trim(comment) = '')) AS INTEGER) AS label FROM edits""",
)
def _weak_edits(spark, sf):
    """Three-valued labels: a NULL comment without another reason stays unlabelled."""
    label = weak_label(
        F.col("comment"), F.col("is_anon"), F.col("length_delta"), null_as_zero=False
    )
    return edits(spark, sf).select("id", label.alias("label"))


_STATS_SQL = """SELECT count(*) AS total, CAST(coalesce(sum(label), 0) AS BIGINT) AS positive,
  CAST(count(*) - coalesce(sum(label), 0) AS BIGINT) AS negative,
  round(coalesce(sum(label), 0) / greatest(count(*), 1), 4) AS positive_rate FROM labeled"""


@query("weak_label_stats", _LABELED_SQL + _STATS_SQL)
def _weak_stats(spark, sf):
    return stats.label_stats(weak_labeled(spark, sf))


@query(
    "weak_label_stats_by_source",
    _LABELED_SQL
    + """SELECT source, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positive,
      round(sum(label) / count(*), 4) AS positive_rate FROM labeled GROUP BY source""",
)
def _weak_by_source(spark, sf):
    return stats.split_stats(weak_labeled(spark, sf), "source")


@query(
    "label_counts",
    """WITH l AS (SELECT d.doc_id, l.toxic AS label FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT count(label) AS total, count(*) FILTER (WHERE label = 1) AS positive, count(*) FILTER (WHERE label = 0) AS negative,
      count(*) FILTER (WHERE label IS NULL) AS null_labels,
      round(count(*) FILTER (WHERE label = 1) / greatest(count(label), 1), 3) AS pos_rate FROM l""",
)
def _label_counts(spark, sf):
    """Documents without a label count as NULL labels."""
    docs = table(spark, sf, "documents").select("doc_id")
    labeled = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    return stats.label_counts(labeled, "toxic")


@query(
    "observed_label_stats",
    """WITH labeled AS (SELECT d.doc_id, l.toxic AS label FROM documents d JOIN labels l USING (doc_id)) """
    + _STATS_SQL,
)
def _observed_stats(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return stats.label_stats(docs.join(table(spark, sf, "labels"), "doc_id"), "toxic")


@query(
    "filter_waterfall",
    """WITH h AS (SELECT event_type <> 'signup' AS a,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id, value FROM events),
    c AS (SELECT count(*) AS c0, count(*) FILTER (WHERE a) AS c1, count(*) FILTER (WHERE a AND k > 0) AS c2,
      count(*) FILTER (WHERE a AND k > 0 AND user_id % 10 <> 9) AS c3,
      count(*) FILTER (WHERE a AND k > 0 AND user_id % 10 <> 9 AND k <> 2) AS c4 FROM h)
    SELECT CAST(0 AS INTEGER) AS step, 'input' AS name, c0 AS n_rows FROM c
    UNION ALL SELECT 1, 'revision_entity', c1 FROM c UNION ALL SELECT 2, 'create_type', c2 FROM c
    UNION ALL SELECT 3, 'article_space', c3 FROM c UNION ALL SELECT 4, 'known_revert_flag', c4 FROM c""",
)
def _waterfall(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "signup", "user").otherwise("revision").alias("event_entity"),
        F.when(k == 0, "delete").otherwise("create").alias("event_type"),
        F.when(F.col("user_id") % 10 == 9, "1").otherwise("0").alias("page_namespace"),
        F.when(k != 2, F.when(F.col("value") > 250, "true").otherwise("false")).alias(
            "revision_is_identity_reverted"
        ),
    )
    return stats.waterfall(rows, history_steps())


# ---- size deltas ----------------------------------------------------------------------------


@query(
    "length_delta_lag",
    """SELECT doc_id, source, lag(n_chars) OVER w AS previous_bytes,
      n_chars - lag(n_chars) OVER w AS length_delta
    FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)""",
)
def _lag(spark, sf):
    sizes = revisions(spark, sf).select("rev_id", "page_id", "text_bytes")
    sized = deltas.with_previous(sizes, "page_id", "rev_id", "text_bytes", "previous_bytes")
    return sized.select(
        F.col("rev_id").alias("doc_id"),
        F.col("page_id").alias("source"),
        "previous_bytes",
        (F.col("text_bytes") - F.col("previous_bytes")).alias("length_delta"),
    )


@query(
    "length_delta_parent_join",
    """SELECT conv_id || '-' || turn AS rev_id,
      coalesce(lag(length(text)) OVER w, 0) AS parent_bytes,
      CAST(length(text) - coalesce(lag(length(text)) OVER w, 0) AS DOUBLE) AS length_delta
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def _parent(spark, sf):
    sized = deltas.with_parent_size(turns(spark, sf))
    return sized.select("rev_id", "parent_bytes", "length_delta")


@query(
    "length_delta_placeholder",
    """SELECT doc_id AS rev_id, CAST(0 AS BIGINT) AS parent_bytes, CAST(n_chars AS DOUBLE) AS length_delta
    FROM documents""",
)
def _placeholder(spark, sf):
    sized = deltas.with_placeholder_parent(revisions(spark, sf))
    return sized.select("rev_id", "parent_bytes", "length_delta")


# ---- breakdowns -----------------------------------------------------------------------------


@query(
    "event_breakdown",
    "SELECT event_type, count(*) AS n_rows FROM events GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _breakdown(spark, sf):
    return stats.count_by(table(spark, sf, "events"), "event_type")


@query(
    "editor_type_counts",
    EDITS_SQL
    + """SELECT CASE WHEN is_anon = 1 THEN 'anonymous' ELSE 'registered' END AS editor_type,
      count(*) AS n_rows FROM edits GROUP BY 1""",
)
def _editors(spark, sf):
    return stats.editor_types(edits(spark, sf).withColumnRenamed("is_anon", "is_anon_int"))


@query(
    "edits_by_hour",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS n_rows FROM events GROUP BY 1",
)
def _by_hour(spark, sf):
    hours = table(spark, sf, "events").select(F.hour("ts").alias("hour_of_day"))
    return stats.count_by(hours, "hour_of_day", descending=False)


@query("band_counts", EDITS_SQL + "SELECT risk_label, count(*) AS n_rows FROM edits GROUP BY 1")
def _band_counts(spark, sf):
    return stats.count_by(edits(spark, sf), "risk_label")


@query(
    "band_summary",
    EDITS_SQL
    + """SELECT risk_label, count(*) AS n_rows, round(avg(risk_score), 3) AS avg_score
      FROM edits GROUP BY 1""",
)
def _band_summary(spark, sf):
    return stats.band_summary(edits(spark, sf))


@query(
    "band_domain_counts",
    EDITS_SQL
    + """, d(band_order, risk_label) AS (VALUES (CAST(0 AS INTEGER), 'HIGH'), (1, 'MEDIUM'), (2, 'LOW'),
      (3, 'UNSCORED'))
    SELECT band_order, d.risk_label, count(e.id) AS n_rows FROM d
    LEFT JOIN edits e ON d.risk_label = coalesce(e.risk_label, 'UNSCORED') GROUP BY 1, 2""",
)
def _domain(spark, sf):
    return stats.band_domain_counts(edits(spark, sf))


_PAGE_SQL = """SELECT * FROM edits WHERE wiki = 'enwiki' AND scored = 1
  ORDER BY created_at DESC, id DESC LIMIT 100 OFFSET 100"""


@query(
    "page_band_counts",
    EDITS_SQL
    + f""", page AS ({_PAGE_SQL}), d(band_order, risk_label) AS (VALUES (CAST(0 AS INTEGER), 'HIGH'),
      (1, 'MEDIUM'), (2, 'LOW'), (3, 'UNSCORED'))
    SELECT band_order, d.risk_label, count(p.id) AS n_rows FROM d
    LEFT JOIN page p ON d.risk_label = coalesce(p.risk_label, 'UNSCORED') GROUP BY 1, 2""",
)
def _page_bands(spark, sf):
    """Bands on one page of the feed."""
    matching = feed.feed_filter(edits(spark, sf), scored_only=True)
    return stats.band_domain_counts(feed.feed_page(matching, page=2, page_size=100))


_FEED_STATS_SQL = """SELECT count(*) AS total_edits, count(*) FILTER (WHERE risk_label = 'HIGH') AS high_risk,
  count(*) FILTER (WHERE risk_label = 'MEDIUM') AS medium_risk, count(*) FILTER (WHERE risk_label = 'LOW') AS low_risk,
  count(*) FILTER (WHERE scored = 0) AS unscored, round(coalesce(avg(risk_score), 0), 4) AS avg_risk_score,
  coalesce(max(created_at), '') AS last_updated FROM edits"""


@query("feed_stats", EDITS_SQL + _FEED_STATS_SQL)
def _feed_stats(spark, sf):
    return stats.feed_stats(edits(spark, sf))


@query(
    "kpi_shares",
    EDITS_SQL
    + f""", s AS ({_FEED_STATS_SQL})
    SELECT total_edits, high_risk, round(high_risk / total_edits * 100, 1) AS high_percent FROM s""",
)
def _kpi(spark, sf):
    return stats.kpi_shares(stats.feed_stats(edits(spark, sf)))


@query(
    "scoring_progress",
    EDITS_SQL
    + """SELECT count(*) FILTER (WHERE scored = 1 AND risk_score IS NOT NULL) AS already_scored, count(*) AS total_edits,
      count(*) FILTER (WHERE scored = 1 AND risk_score IS NOT NULL) = count(*) AND count(*) > 0 AS complete FROM edits""",
)
def _progress(spark, sf):
    return stats.scoring_progress(edits(spark, sf))


@query(
    "score_histogram",
    EDITS_SQL
    + """, r AS (SELECT min(risk_score) AS lo, (max(risk_score) - min(risk_score)) / 40 AS w FROM edits),
    b AS (SELECT CAST(range AS INTEGER) AS bin, lo + range * w AS low_edge, lo + (range + 1) * w AS high_edge
      FROM range(40), r)
    SELECT bin, low_edge, high_edge, count(e.id) AS n_rows,
      CASE WHEN low_edge >= 0.68 THEN 'HIGH' WHEN low_edge >= 0.30 THEN 'MEDIUM' ELSE 'LOW' END AS band
    FROM b LEFT JOIN edits e ON e.risk_score >= low_edge AND (e.risk_score < high_edge OR bin = 39)
    GROUP BY ALL""",
)
def _histogram(spark, sf):
    return stats.score_histogram(edits(spark, sf))


@query(
    "size_manifest",
    """WITH s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS n FROM documents GROUP BY 1)
    SELECT source AS name, n AS compressed_bytes, round(n / 1e6, 1) AS compressed_mb,
      n * 7 AS decompressed_bytes_estimate, round(n * 7 / 1e9, 2) AS decompressed_gb_estimate FROM s""",
)
def _sizes(spark, sf):
    sums = table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("n"))
    return size_rows(sums, "source", "n")


@query(
    "size_totals",
    """WITH s AS (SELECT source, sum(n_chars) AS n FROM documents GROUP BY 1)
    SELECT count(*) AS total_files, round(sum(n) / 1e9, 2) AS total_compressed_gb,
      round(sum(n) * 7 / 1e9, 2) AS total_decompressed_gb_estimate,
      sum(n) * 7 >= 10000000000 AS requirement_10gb_met FROM s""",
)
def _totals(spark, sf):
    return size_totals(_sizes(spark, sf))


@query(
    "tag_counts",
    """SELECT page_id, CAST((length(html) - length(replace(html, '<li>', ''))) // 4 AS INTEGER) AS list_items,
      CAST((length(html) - length(replace(html, '<a ', ''))) // 3 AS INTEGER) AS links FROM pages""",
)
def _tags(spark, sf):
    """Occurrences of a tag per page, as revision tags are counted in dumps."""

    def occurrences(tag):
        return F.size(F.split("html", tag, -1)) - 1

    return table(spark, sf, "pages").select(
        "page_id", occurrences("<li>").alias("list_items"), occurrences("<a ").alias("links")
    )


# ---- feed -----------------------------------------------------------------------------------


@query("feed_page", EDITS_SQL + _PAGE_SQL.replace("SELECT *", "SELECT id, page_title, risk_label, created_at"))
def _feed_page(spark, sf):
    matching = feed.feed_filter(edits(spark, sf), scored_only=True)
    page = feed.feed_page(matching, page=2, page_size=100)
    return page.select("id", "page_title", "risk_label", "created_at")


def _deep_sql(stamp: str) -> str:
    """The last full page of 200 of all edits, past ten thousand rows where there are that many."""
    return (
        EDITS_SQL
        + f""", stamped AS (SELECT id, page_title, {stamp} AS created_at FROM edits),
    n AS (SELECT greatest(0, count(*) // 200 - 1) AS page FROM stamped),
    numbered AS (SELECT *, row_number() OVER (ORDER BY created_at DESC NULLS LAST, id DESC) - 1 AS place FROM stamped)
    SELECT id, page_title, created_at FROM numbered, n WHERE place >= page * 200 AND place < page * 200 + 200"""
    )


def _deep_page(spark, sf, stamp):
    rows = edits(spark, sf).withColumn("created_at", stamp)
    page = max(0, rows.count() // 200 - 1) + 1
    return feed.feed_page(rows, page, 200).select("id", "page_title", "created_at")


@query("feed_page_deep", _deep_sql("created_at"))
def _feed_page_deep(spark, sf):
    return _deep_page(spark, sf, F.col("created_at"))


@query("feed_page_deep_nulls", _deep_sql("CASE WHEN CAST(id AS BIGINT) % 5 < 3 THEN NULL ELSE created_at END"))
def _feed_page_deep_nulls(spark, sf):
    """Three fifths of all rows have no stamp and come last."""
    stamp = F.when(F.col("id").cast("bigint") % 5 < 3, None).otherwise(F.col("created_at"))
    return _deep_page(spark, sf, stamp)


@query("feed_page_deep_tied", _deep_sql("'2024-01-01T00:00:00.000000'"))
def _feed_page_deep_tied(spark, sf):
    """All rows share one stamp, as after a backfill in one batch."""
    return _deep_page(spark, sf, F.lit("2024-01-01T00:00:00.000000"))


@query(
    "feed_page_after",
    EDITS_SQL
    + """SELECT id, created_at FROM edits WHERE wiki = 'enwiki' AND risk_label = 'HIGH'
      AND (created_at < '2024-01-20T00:00:00' OR created_at IS NULL
        OR (created_at = '2024-01-20T00:00:00' AND id < ''))
      ORDER BY created_at DESC, id DESC LIMIT 50""",
)
def _feed_after(spark, sf):
    matching = feed.feed_filter(edits(spark, sf), risk_label="HIGH")
    return feed.feed_after(matching, "2024-01-20T00:00:00", "").select("id", "created_at")


_SEARCH_SQL = """wiki = 'enwiki' AND (contains(lower(page_title), 'undid') OR contains(lower(comment), 'undid')
  OR contains(lower("user"), 'undid') OR contains(rev_id, 'undid'))"""


@query("feed_search", EDITS_SQL + f"SELECT id, comment, page_title FROM edits WHERE {_SEARCH_SQL}")
def _search(spark, sf):
    matching = feed.feed_filter(edits(spark, sf), search=" UNDID ")
    return matching.select("id", "comment", "page_title")


@query(
    "feed_search_wildcards",
    EDITS_SQL
    + """SELECT id, page_title FROM edits WHERE wiki = 'enwiki' AND (page_title ILIKE '%page _5%'
      OR comment ILIKE '%page _5%' OR "user" ILIKE '%page _5%' OR rev_id ILIKE '%page _5%')""",
)
def _search_wild(spark, sf):
    matching = feed.feed_filter(edits(spark, sf), search="page _5", wildcards=True)
    return matching.select("id", "page_title")


@query(
    "feed_count",
    EDITS_SQL
    + f"""SELECT count(*) AS total, CAST(3 AS INTEGER) AS page, CAST(50 AS INTEGER) AS page_size,
      150 < count(*) AS has_more FROM edits WHERE {_SEARCH_SQL}""",
)
def _count(spark, sf):
    return feed.feed_count(feed.feed_filter(edits(spark, sf), search="undid"), 3, 50)


@query("edit_by_id", EDITS_SQL + "SELECT * FROM edits WHERE id = '77' LIMIT 1")
def _by_id(spark, sf):
    return feed.edit_by_id(edits(spark, sf), "77")


@query(
    "pending_oldest",
    EDITS_SQL + "SELECT id, created_at FROM edits WHERE scored = 0 ORDER BY created_at, id LIMIT 1",
)
def _pending(spark, sf):
    return feed.pending_oldest(edits(spark, sf)).select("id", "created_at")


@query(
    "first_scored",
    EDITS_SQL
    + """SELECT id, risk_score FROM edits WHERE risk_score IS NOT NULL
      ORDER BY created_at DESC, id DESC LIMIT 100""",
)
def _first_scored(spark, sf):
    return feed.first_scored(edits(spark, sf)).select("id", "risk_score")


@query(
    "edit_records",
    EDITS_SQL
    + """SELECT id, page_title, is_anon = 1 AS is_anon, comment, round(risk_score, 4) AS risk_score,
      scored = 1 AS scored FROM edits WHERE comment IS NOT NULL""",
)
def _records(spark, sf):
    return feed.as_records(edits(spark, sf)).select(
        "id", "page_title", "is_anon", "comment", "risk_score", "scored"
    )


@query("rejected_records", EDITS_SQL + "SELECT id FROM edits WHERE comment IS NULL")
def _rejected(spark, sf):
    return feed.rejected_records(edits(spark, sf)).select("id")


@query(
    "display_rows",
    EDITS_SQL
    + """, s AS (SELECT *, CASE WHEN "timestamp" = '' THEN created_at ELSE "timestamp" END AS stamp FROM edits),
    a AS (SELECT *, greatest(0, CAST(floor(epoch(TIMESTAMP '2024-02-01') - epoch(CAST(
      replace(stamp, 'Z', '') AS TIMESTAMP))) AS BIGINT)) AS secs FROM s)
    SELECT id, coalesce(risk_label, 'UNSCORED') AS risk, coalesce(printf('%.3f', risk_score), '') AS score_text,
      coalesce(printf('%.1f', risk_score * 100) || '%', 'not scored') AS percent_text,
      CASE WHEN is_anon = 1 THEN 'anonymous' ELSE 'registered' END AS editor,
      coalesce(comment, '') AS edit_summary, stamp AS timestamp,
      CASE WHEN secs < 60 THEN secs || 's ago' WHEN secs < 3600 THEN (secs // 60) || 'm ago'
        WHEN secs < 86400 THEN (secs // 3600) || 'h ago' ELSE (secs // 86400) || 'd ago' END AS age FROM a""",
)
def _display(spark, sf):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return feed.display_rows(edits(spark, sf), now).select(
        "id", "risk", "score_text", "percent_text", "editor", "edit_summary", "timestamp", "age"
    )


# ---- keyed tables ---------------------------------------------------------------------------


@query(
    "latest_by_key",
    """SELECT user_id, event_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _latest(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return tables.latest_by_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query(
    "insert_or_ignore",
    """WITH known AS (SELECT user_id, event_id, value FROM events WHERE event_type = 'signup'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    incoming AS (SELECT user_id, event_id, value FROM events WHERE event_type <> 'signup'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)
    SELECT * FROM known UNION ALL
    SELECT * FROM incoming WHERE user_id NOT IN (SELECT user_id FROM known)""",
)
def _ignore(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value", "ts", "event_type")
    order = [F.asc("ts"), F.asc("event_id")]
    signup = F.col("event_type") == "signup"
    known = tables.latest_by_key(events.filter(signup), ["user_id"], order)
    merged = tables.insert_or_ignore(known, events.filter(~signup), ["user_id"], order)
    return merged.select("user_id", "event_id", "value")


@query(
    "rescore_merge",
    EDITS_SQL
    + f""", fresh AS (SELECT id, {SCORE_SQL} AS s FROM edits WHERE namespace = 0)
    SELECT e.id, round(coalesce(s, risk_score), 6) AS risk_score,
      CASE WHEN s IS NULL THEN risk_label WHEN s >= 0.20 THEN 'HIGH' WHEN s >= 0.08 THEN 'MEDIUM'
        ELSE 'LOW' END AS risk_label,
      CASE WHEN s IS NULL THEN scored ELSE 1 END AS scored, created_at
    FROM edits e LEFT JOIN fresh f USING (id)""",
)
def _rescore(spark, sf):
    """Article edits get a fresh score, the others keep theirs."""
    from revlens.functions.risk import heuristic_score

    rows = edits(spark, sf)
    score = heuristic_score(*(F.col(c) for c in ("comment", "user", "is_anon", "length_delta")))
    fresh = rows.filter(F.col("namespace") == 0).select("id", score.alias("risk_score"))
    # every score three times, twice with a lower value: the highest counts, no row is multiplied
    lower = fresh.select("id", (F.col("risk_score") / 2).alias("risk_score"))
    merged = tables.update_scores(rows, fresh.unionAll(lower).unionAll(lower))
    return merged.select(
        "id", F.round("risk_score", 6).alias("risk_score"), "risk_label", "scored", "created_at"
    )


@query(
    "pending_scored",
    EDITS_SQL
    + f""", p AS (SELECT *, CASE WHEN scored = 0 THEN {SCORE_SQL} END AS s FROM edits)
    SELECT id, round(coalesce(s, risk_score), 6) AS risk_score,
      CASE WHEN s IS NULL THEN risk_label WHEN s >= 0.20 THEN 'HIGH' WHEN s >= 0.08 THEN 'MEDIUM'
        ELSE 'LOW' END AS risk_label, created_at FROM p""",
)
def _score_pending(spark, sf):
    from revlens.streaming.scorer import score_pending

    done = score_pending(edits(spark, sf))
    return done.select("id", F.round("risk_score", 6).alias("risk_score"), "risk_label", "created_at")


def _explained(rows):
    """Stored explanations: those of the scored edits outside article space."""
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return tables.rule_explanations(rows.filter(F.col("namespace") == 1), now)


@query(
    "unexplained_edits",
    EDITS_SQL
    + "SELECT id FROM edits WHERE id NOT IN (SELECT id FROM edits WHERE namespace = 1)",
)
def _unexplained(spark, sf):
    rows = edits(spark, sf)
    return tables.unexplained_edits(rows, _explained(rows)).select("id")


@query(
    "unexplained_edits_not_in",
    EDITS_SQL
    + """, x AS (SELECT CASE WHEN part = 1 AND namespace = 1 AND id = (SELECT min(id) FROM edits WHERE namespace = 1) THEN NULL
        ELSE id END AS id, part FROM edits, (VALUES (0), (1)) parts(part) WHERE namespace = 1)
    SELECT part, count(*) AS n_rows FROM (SELECT part, e.id FROM edits e, (VALUES (CAST(0 AS INTEGER)), (1)) parts(part)
      WHERE e.id NOT IN (SELECT id FROM x WHERE x.part = parts.part)) GROUP BY part""",
)
def _unexplained_not_in(spark, sf):
    """As SQL's ``NOT IN``: with a NULL among the explained ids (part 1) nothing is unexplained."""
    rows = edits(spark, sf)
    stored = _explained(rows)
    first = stored.agg(F.min("edit_id")).scalar()
    holed = stored.withColumn("edit_id", F.when(F.col("edit_id") != first, F.col("edit_id")))
    left = [
        tables.unexplained_edits(rows, explained, not_in=True).select(F.lit(part).alias("part"))
        for part, explained in enumerate((stored, holed))
    ]
    return left[0].unionByName(left[1]).groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "unexplained_edits_bucketed",
    EDITS_SQL
    + "SELECT id FROM edits WHERE id NOT IN (SELECT id FROM edits WHERE namespace = 1)",
)
def _unexplained_bucketed(spark, sf):
    """Edits and explanations stored in buckets of the id: joined where they lie."""
    rows = edits(spark, sf)
    stored = write_bucketed(rows, scratch_path(spark, "predictions"), "id", 16)
    explained = write_bucketed(_explained(rows), scratch_path(spark, "explanations"), "edit_id", 16)
    return tables.unexplained_edits(stored, explained).select("id")


@query(
    "explanation_upsert_bucketed",
    EDITS_SQL
    + f""", {REASONS_SQL}
    SELECT id AS edit_id, {EXPLAIN_SQL} AS explanation,
      CASE WHEN scored = 1 THEN '2024-02-02 00:00:00' ELSE '2024-02-01 00:00:00' END AS generated_at
    FROM reasoned""",
)
def _explanation_upsert_bucketed(spark, sf):
    """Explanations appended to buckets, those of scored edits twice; the newest per edit."""
    rows, path = edits(spark, sf), scratch_path(spark, "explanations")
    first, second = (F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp") for d in (1, 2))
    write_bucketed(tables.rule_explanations(rows, first), path, "edit_id", 16)
    again = tables.rule_explanations(rows.filter(F.col("scored") == 1), second)
    stored = write_bucketed(again, path, "edit_id", 16, append=True)
    return latest_bucketed(stored, "edit_id", [F.desc("generated_at"), F.desc("explanation")]).drop("model")


@query(
    "explanation_cache",
    EDITS_SQL
    + f""", {REASONS_SQL},
    req AS (SELECT CAST(event_id + 1000 AS VARCHAR) AS edit_id, event_type = 'view' AS force FROM events),
    a AS (SELECT edit_id, namespace IS NOT NULL AS found, coalesce(namespace = 1, FALSE) AND NOT force AS cached,
      {EXPLAIN_SQL} AS text FROM req LEFT JOIN reasoned ON edit_id = id)
    SELECT edit_id, CASE WHEN found THEN text END AS explanation, cached, found,
      CASE WHEN cached THEN '2024-02-01 00:00:00' WHEN found THEN '2024-02-02 00:00:00' END AS generated_at
    FROM a""",
)
def _cache(spark, sf):
    """Requests for every edit shifted by 1000 ids, so some are unknown; views ask for a refresh. Two
    texts are stored per explained edit, of which the newer one answers."""
    rows = edits(spark, sf)
    requests = table(spark, sf, "events").select(
        (F.col("event_id") + 1000).cast("string").alias("edit_id"),
        (F.col("event_type") == "view").alias("force_refresh"),
    )
    now = F.lit("2024-02-02 00:00:00").cast("timestamp")
    stored = _explained(rows)
    older = stored.withColumns({"explanation": F.lit("old text"), "generated_at": F.lit("2024-01-01 00:00:00")})
    return tables.answer_explanations(requests, rows, stored.unionByName(older), now).drop("model")


@query(
    "explanation_upsert",
    EDITS_SQL
    + f""", {REASONS_SQL}
    SELECT id AS edit_id, {EXPLAIN_SQL} AS explanation,
      CASE WHEN scored = 1 THEN '2024-02-02 00:00:00' ELSE '2024-02-01 00:00:00' END AS generated_at
    FROM reasoned""",
)
def _explanation_upsert(spark, sf):
    """Every edit explained once, scored ones explained again later; the later text counts."""
    rows = edits(spark, sf)
    first, second = (F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp") for d in (1, 2))
    stored = tables.rule_explanations(rows, first)
    again = tables.rule_explanations(rows.filter(F.col("scored") == 1), second)
    return tables.latest_explanations(stored.unionByName(again)).drop("model")


@query(
    "edit_details",
    EDITS_SQL
    + """SELECT id, page_title AS title, coalesce(risk_label, 'UNSCORED') AS risk,
      coalesce(printf('%.1f', risk_score * 100) || '%', 'not scored') AS score_text,
      CASE WHEN coalesce(comment, '') = '' THEN 'No edit summary provided by the editor.' ELSE comment END
        AS summary FROM edits""",
)
def _details(spark, sf):
    return feed.edit_details(edits(spark, sf))


@query(
    "source_union",
    """SELECT 'event' AS kind, CAST(event_id AS VARCHAR) AS id, event_type AS title FROM events
    UNION ALL SELECT 'document', CAST(doc_id AS VARCHAR), NULL FROM documents""",
)
def _union(spark, sf):
    events = table(spark, sf, "events").select(
        F.lit("event").alias("kind"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("title"),
    )
    docs = table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("id")
    )
    return events.unionByName(docs, allowMissingColumns=True)


# ---- splits, terms, metrics -----------------------------------------------------------------


def _hash_sql(salt: str, key: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}:' || {key}), 1, 8) AS UBIGINT)"


@query(
    "hash_split_stats",
    f"""WITH s AS (SELECT l.toxic AS label, CASE WHEN {_hash_sql('split42', 'd.doc_id')} % 100 < 80
        THEN 'train' ELSE 'test' END AS split FROM documents d JOIN labels l USING (doc_id))
    SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positive,
      round(sum(label) / count(*), 4) AS positive_rate FROM s GROUP BY split""",
)
def _split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    labeled = docs.join(table(spark, sf, "labels"), "doc_id").withColumnRenamed("toxic", "label")
    return stats.split_stats(splits.with_split(labeled, "doc_id"))


@query(
    "fold_counts",
    f"""SELECT CAST({_hash_sql('fold42', 'doc_id')} % 3 AS INTEGER) AS fold, count(*) AS n_rows
    FROM labels GROUP BY 1""",
)
def _folds(spark, sf):
    folded = splits.with_fold(table(spark, sf, "labels"), "doc_id")
    return stats.count_by(folded, "fold", descending=False)


@query(
    "tfidf",
    """WITH words AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(
        lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', ' ', 'g')), '\\s+'), lambda t: length(t) >= 2)) AS token
      FROM documents),
    terms AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(token), 1, 8) AS UBIGINT) % 256 AS INTEGER) AS bucket,
      count(*) AS tf FROM words GROUP BY ALL),
    dfs AS (SELECT bucket, CASE WHEN count(*) >= 2 THEN ln(((SELECT count(*) FROM documents) + 1.0)
      / (count(*) + 1.0)) ELSE 0 END AS idf FROM terms GROUP BY 1)
    SELECT doc_id, bucket, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf
    FROM terms JOIN dfs USING (bucket)""",
)
def _tfidf(spark, sf):
    scored = tfidf(texts(spark, sf), "doc_id", "text")
    return scored.select(
        "doc_id", "bucket", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf")
    )


def _size_scores(spark, sf):
    """Labelled documents with their length as score."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("s"))
    return docs.join(table(spark, sf, "labels"), "doc_id").select(
        "s", F.col("toxic").alias("label"), (F.col("s") > 2500).cast("int").alias("prediction")
    )


_SCORED_SQL = """WITH x AS (SELECT CAST(n_chars AS DOUBLE) AS s, toxic AS label,
  CAST(n_chars > 2500 AS INTEGER) AS prediction FROM documents JOIN labels USING (doc_id))
"""


@query(
    "ranking_metrics",
    _SCORED_SQL
    + """, t AS (SELECT s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM x GROUP BY s),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM t WINDOW w AS (ORDER BY s DESC)),
    p AS (SELECT *, tp / (tp + fp) AS prec, lag(tp / (tp + fp)) OVER (ORDER BY s DESC) AS prev FROM c),
    r AS (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM x),
    n AS (SELECT count(*) FILTER (WHERE label = 1) AS np, count(*) FILTER (WHERE label = 0) AS nn FROM x)
    SELECT CAST(np AS BIGINT) AS positives, CAST(nn AS BIGINT) AS negatives,
      round((SELECT sum(rk) FROM r WHERE label = 1) / np / nn - (np + 1) / 2.0 / nn, 9) AS roc_auc,
      round((SELECT sum(pos * (prec + coalesce(prev, prec)) / 2) FROM p) / np, 9) AS pr_auc,
      2 * (SELECT count(*) FROM x) AS unscored FROM n""",
)
def _ranking(spark, sf):
    """All rows with their score, once more without one, and once more with NaN."""
    rows = _size_scores(spark, sf)
    none, nan = (rows.withColumn("s", F.lit(v).cast("double")) for v in (None, "NaN"))
    areas = ranking.ranking_metrics(rows.unionAll(none).unionAll(nan), "s", "label")
    return areas.select(
        "positives",
        "negatives",
        F.round("roc_auc", 9).alias("roc_auc"),
        F.round("pr_auc", 9).alias("pr_auc"),
        "unscored",
    )


@query(
    "confusion_matrix",
    _SCORED_SQL
    + """SELECT label AS actual, prediction AS predicted, count(*) AS n_rows FROM x GROUP BY 1, 2""",
)
def _confusion(spark, sf):
    return confusion.confusion_matrix(_size_scores(spark, sf))


@query(
    "confusion_cells",
    _SCORED_SQL
    + """SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
      count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM x""",
)
def _cells(spark, sf):
    return confusion.confusion_cells(_size_scores(spark, sf))


@query(
    "confusion_document",
    _SCORED_SQL
    + """, c AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM x GROUP BY 1, 2)
    SELECT 'run' AS run_id, '[' || string_agg('{"actual":' || actual || ',"predicted":' || predicted
        || ',"count":' || n || '}', ',' ORDER BY actual, predicted) || ']' AS confusion_matrix,
      CAST(sum(CASE WHEN actual = 1 AND predicted = 1 THEN n ELSE 0 END) AS BIGINT) AS tp,
      CAST(sum(CASE WHEN actual = 0 AND predicted = 0 THEN n ELSE 0 END) AS BIGINT) AS tn FROM c""",
)
def _confusion_document(spark, sf):
    document = confusion.confusion_document(_size_scores(spark, sf), "run")
    return document.select(
        "run_id", F.to_json("confusion_matrix").alias("confusion_matrix"), "tp", "tn"
    )


@query(
    "weighted_metrics",
    _SCORED_SQL
    + """, k AS (SELECT unnest([0, 1]) AS c),
    m AS (SELECT c, count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE label = c AND prediction = c) AS hit,
      count(*) FILTER (WHERE prediction = c) AS claimed FROM k, x GROUP BY c),
    q AS (SELECT support, hit, coalesce(hit / nullif(claimed, 0), 0) AS p,
      coalesce(hit / nullif(support, 0), 0) AS r FROM m)
    SELECT round(sum(support * coalesce(2 * p * r / nullif(p + r, 0), 0)) / sum(support), 9) AS f1,
      round(sum(support * p) / sum(support), 9) AS precision,
      round(sum(support * r) / sum(support), 9) AS recall,
      round(sum(hit) / sum(support), 9) AS accuracy FROM q""",
)
def _weighted(spark, sf):
    metrics = confusion.weighted_metrics(confusion.confusion_cells(_size_scores(spark, sf)))
    return metrics.select(*[F.round(c, 9).alias(c) for c in metrics.columns])
