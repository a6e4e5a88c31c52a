"""Training and model scoring over the supplied tables. SQL computes what the stages learn, the split and
the rows kept; the fit itself is iterative: its SQL twins say what must hold of the scores, and tests hold
them against SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.config import HISTORY, SHIPPED_BANDS, WEAK, RiskBands
from revlens.functions.risk import risk_band
from revlens.functions.text import clean_text
from revlens.functions.times import day_of_week, hour_of_day
from revlens.ml.features import fitted_stages
from revlens.ml.scoring import rescore, score
from revlens.ml.training import fit_final, hashed_rows, train
from revlens.operators.confusion import confusion_cells
from revlens.operators.splits import with_fold, with_split
from revlens.plans.registry import query, table
from revlens.plans.views import EDITS_SQL, edits, revisions
from revlens.session import stage_table


def labeled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an observed label as labelled revisions."""
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("rev_id"), F.col("toxic").alias("label")
    )
    day = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("rev_id") * 5003)
    return (
        revisions(spark, sf)
        .join(labels, "rev_id")
        .select(
            F.col("rev_id").cast("string").alias("revision_id"),
            "label",
            F.col("text_bytes").cast("double").alias("length_delta"),
            "is_anon_int",
            hour_of_day(day).alias("hour_of_day"),
            day_of_week(day).alias("day_of_week"),
            clean_text(F.col("comment")).alias("comment_clean"),
            clean_text(F.col("page_title")).alias("title_clean"),
        )
    )


def _fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, PipelineModel]:
    """The labelled documents, written once, and the classifier fitted on them."""
    rows = stage_table(labeled_documents(spark, sf), "labeled-documents")
    hashed, text = hashed_rows(rows, "revision_id", WEAK)
    return rows, fit_final(stage_table(hashed, "hashed"), text, WEAK)


# the labelled documents with their cleaned texts, as the stages get them
_LABELED_SQL = """WITH cleaned AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS revision_id, d.doc_id, l.toxic AS label,
    lower(regexp_replace(d.text, '[^a-zA-Z0-9\\s]', ' ', 'g')) AS comment_clean,
    lower(regexp_replace(d.source, '[^a-zA-Z0-9\\s]', ' ', 'g')) AS title_clean
  FROM documents d JOIN labels l USING (doc_id))
"""


def _band_agrees(score: Column, label: Column, bands: RiskBands = SHIPPED_BANDS) -> Column:
    wanted = F.when(score >= bands.high, "HIGH").when(score >= bands.medium, "MEDIUM").otherwise("LOW")
    return label == wanted


@query(
    "stage_token_counts",
    _LABELED_SQL
    + """SELECT revision_id,
      CAST(len(list_filter(regexp_split_to_array(comment_clean, '\\s+'), lambda t: length(t) >= 2)) AS DOUBLE) AS comment_tokens,
      CAST(len(list_filter(regexp_split_to_array(title_clean, '\\s+'), lambda t: length(t) >= 2)) AS DOUBLE) AS title_tokens
    FROM cleaned""",
)
def _stage_tokens(spark, sf):
    """Tokens each text has by the classifier's own tokenizer and hashing stages."""
    hashed, _ = hashed_rows(labeled_documents(spark, sf), "revision_id", WEAK)

    def total(column):
        return F.aggregate(vector_to_array(column), F.lit(0.0), lambda n, x: n + x)

    return hashed.select(
        "revision_id", total("comment_tf").alias("comment_tokens"), total("title_tf").alias("title_tokens")
    )


_M = "4294967296"
_C1, _C2, _C3, _C4 = "3432918353", "461845907", "2246822507", "3266489909"


def _rotated(x: str, by: int) -> str:
    return f"(({x}) * {1 << by} % {_M} + ({x}) // {1 << 32 - by})"


# Hashed bucket of every token, by 32-bit Murmur3 with seed 42 over its bytes, all of them ASCII here;
# then counts per document and bucket.
_HASHED_SQL = f"""{_LABELED_SQL.rstrip()},
tokens AS (
  SELECT revision_id, 'comment' AS stage, 256 AS buckets, unnest(regexp_split_to_array(comment_clean, '\\s+')) AS token FROM cleaned
  UNION ALL SELECT revision_id, 'title', 128, unnest(regexp_split_to_array(title_clean, '\\s+')) FROM cleaned),
counted AS (SELECT revision_id, stage, buckets, token, CAST(count(*) AS DOUBLE) AS n FROM tokens WHERE length(token) >= 2 GROUP BY ALL),
bytes AS (SELECT token, list_transform(string_split(token, ''), lambda c: CAST(ascii(c) AS UBIGINT)) AS b
  FROM (SELECT DISTINCT token FROM counted)),
pieces AS (SELECT token, len(b) AS size,
    list_transform(range(len(b) // 4), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216) AS ks,
    coalesce(list_sum(list_transform(range(len(b) % 4), lambda i: CAST(b[len(b) - len(b) % 4 + i + 1] * CAST(pow(256, i) AS UBIGINT) AS UBIGINT))), 0) AS rest
  FROM bytes),
multiplied AS (SELECT token, size, list_transform(ks, lambda k: CAST(k AS UBIGINT) * {_C1} % {_M}) AS ks, CAST(rest AS UBIGINT) * {_C1} % {_M} AS rest FROM pieces),
mixed AS (SELECT token, size, list_transform(ks, lambda k: {_rotated("k", 15)} * {_C2} % {_M}) AS ks, {_rotated("rest", 15)} * {_C2} % {_M} AS rest FROM multiplied),
body AS (SELECT token, xor(CAST(xor(CAST(list_reduce(list_prepend(CAST(42 AS UBIGINT), ks),
    lambda h, k: CAST(({_rotated("xor(h, k)", 13)} * 5 + 3864292196) % {_M} AS UBIGINT)) AS UBIGINT), CAST(rest AS UBIGINT)) AS UBIGINT), CAST(size AS UBIGINT)) AS h FROM mixed),
first AS (SELECT token, xor(h, h // 65536) * {_C3} % {_M} AS h FROM body),
second AS (SELECT token, xor(h, h // 8192) * {_C4} % {_M} AS h FROM first),
tf AS (SELECT revision_id, stage, CAST(xor(h, h // 65536) % buckets AS INTEGER) AS bucket, sum(n) AS tf
  FROM counted JOIN second USING (token) GROUP BY ALL),
n AS (SELECT count(*) AS n_docs FROM cleaned),
learned AS (SELECT stage, bucket, n_docs, count(*) AS df,
    CASE WHEN count(*) >= 2 THEN ln((n_docs + 1) / (count(*) + 1)) ELSE 0 END AS idf FROM tf, n GROUP BY stage, bucket, n_docs)
"""


@query(
    "stage_idf",
    _HASHED_SQL
    + """SELECT l.stage, l.bucket, l.n_docs, l.df, round(l.idf, 9) AS idf, round(sqrt(greatest(0,
        (sum(tf * tf) - sum(tf) * sum(tf) / l.n_docs) / (l.n_docs - 1))) * l.idf, 6) AS deviation
    FROM tf JOIN learned l ON tf.stage = l.stage AND tf.bucket = l.bucket GROUP BY l.stage, l.bucket, l.n_docs, l.df, l.idf""",
)
def _stage_idf(spark, sf):
    """What the fitted stages learned: documents and inverse document frequency of every hashed bucket,
    and the deviation that the scaler divides its feature by."""
    hashed, _ = hashed_rows(labeled_documents(spark, sf), "revision_id", WEAK)
    fitted = Pipeline(stages=fitted_stages(WEAK)).fit(stage_table(hashed, "hashed"))
    deviations = [float(x) for x in fitted.stages[3].std]
    learned, offset = [], 0
    for name, stage in (("comment", fitted.stages[0]), ("title", fitted.stages[1])):
        for bucket, (idf, df) in enumerate(zip(stage.idf.toArray(), stage.docFreq)):
            if df:
                learned.append((name, bucket, int(stage.numDocs), int(df), round(float(idf), 9), round(deviations[offset + bucket], 6)))
        offset += len(stage.idf)
    # a row per bucket, a few hundred whatever the documents
    return spark.createDataFrame(learned, "stage string, bucket int, n_docs long, df long, idf double, deviation double")


@query(
    "logreg_scores",
    _LABELED_SQL
    + """SELECT revision_id, label, TRUE AS is_logistic_of_margin, TRUE AS band_agrees FROM cleaned""",
)
def _scores(spark, sf):
    """Classifier fitted on the labelled documents, applied to the same rows: the score is the logistic
    function of the margin that the coefficients give, and the band that of the score. Score and margin
    come from one pass over the features, so repeated ids stay as many as they are; a test computes
    margins, scores and ranking in SQL from the model's own numbers."""
    rows, model = _fitted(spark, sf)
    last = model.stages[-1]
    weights = F.array(*[F.lit(float(c)) for c in last.coefficients.toArray()])
    margin = F.aggregate(
        F.zip_with(vector_to_array("features"), weights, lambda x, c: x * c),
        F.lit(float(last.intercept)),
        lambda total, x: total + x,
    )
    featured = PipelineModel(stages=model.stages[:-1]).transform(rows)
    scored = score(featured.select("revision_id", "label", "features"), PipelineModel(stages=[last]))
    wanted = 1 / (1 + F.exp(-margin))
    return scored.select(
        "revision_id",
        "label",
        (F.abs(F.col("risk_score") - wanted) < 1e-9).alias("is_logistic_of_margin"),
        _band_agrees(F.col("risk_score"), risk_band(F.col("risk_score"))).alias("band_agrees"),
    )


def exported_model(model: PipelineModel) -> list[tuple[int, float, float]]:
    """Per feature: its weight before scaling (inverse document frequency, or 1), what the scaler
    divides it by, and its coefficient; last the intercept, as feature -1."""
    by_kind = {type(s).__name__: [t for t in model.stages if type(t).__name__ == type(s).__name__] for s in model.stages}
    idf = [float(x) for stage in by_kind["IDFModel"] for x in stage.idf.toArray()]
    deviations = [float(x) for x in by_kind["StandardScalerModel"][0].std]
    last = model.stages[-1]
    weights = idf + [1.0] * (len(deviations) - len(idf))
    rows = list(zip(range(len(deviations)), weights, deviations, (float(c) for c in last.coefficients.toArray())))
    return [*rows, (-1, 1.0, 1.0, float(last.intercept))]


def _hash_sql(salt: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}:' || doc_id), 1, 8) AS UBIGINT)"


@query(
    "logreg_cv_metrics",
    f"""WITH s AS (SELECT doc_id, toxic, {_hash_sql("split42")} % 100 < 80 AS train, {_hash_sql("fold42")} % 3 AS fold
      FROM documents JOIN labels USING (doc_id))
    SELECT 'train rows' AS fact, count(*) FILTER (WHERE train) AS value FROM s
    UNION ALL SELECT 'test rows', count(*) FILTER (WHERE NOT train) FROM s
    UNION ALL SELECT 'rows of fold ' || fold, count(*) FROM s WHERE train GROUP BY fold
    UNION ALL SELECT 'rows in confusion cells', count(*) FILTER (WHERE NOT train) FROM s
    UNION ALL SELECT 'positive rows in confusion cells', count(*) FILTER (WHERE NOT train AND toxic = 1) FROM s""",
)
def _cv(spark, sf):
    """Split, search over all 18 fold fits, refit and held-out scores: the rows that each of them had."""
    cfg = replace(HISTORY, min_rows=1, share_fits=False)
    rows = stage_table(labeled_documents(spark, sf), "labeled-documents")
    result = train(rows, "revision_id", cfg)
    folds = with_fold(with_split(rows, "revision_id", cfg.train_percent).filter("split = 'train'"), "revision_id", cfg.folds)
    facts = [("train rows", result.rows["train"]), ("test rows", result.rows["test"])]
    out = spark.createDataFrame(facts, "fact string, value long")
    by_fold = folds.groupBy("fold").agg(F.count(F.lit(1)).alias("value"))
    out = out.unionAll(by_fold.select(F.concat(F.lit("rows of fold "), F.col("fold").cast("string")), "value"))
    cells = confusion_cells(result.scored)
    for fact, names in (("rows in confusion cells", ("tp", "fp", "tn", "fn")), ("positive rows in confusion cells", ("tp", "fn"))):
        total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
        out = out.unionAll(cells.select(F.lit(fact), total.cast("long")))
    return out


@query(
    "model_rescore",
    EDITS_SQL
    + """SELECT id, page_title, comment, created_at, CAST(1 AS INTEGER) AS scored, TRUE AS band_agrees,
      TRUE AS score_in_range FROM edits""",
)
def _rescore(spark, sf):
    """A model fitted on documents gives every stored edit a new score and band; the rest stays. Scores
    are held against SQL in a test."""
    _, model = _fitted(spark, sf)
    rows = rescore(edits(spark, sf), model)
    return rows.select(
        "id", "page_title", "comment", "created_at", "scored",
        _band_agrees(F.col("risk_score"), F.col("risk_label")).alias("band_agrees"),
        F.col("risk_score").between(0, 1).alias("score_in_range"),
    )
