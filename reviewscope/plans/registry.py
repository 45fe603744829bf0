"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewscope.functions import calendar, cleaning, numbers, text
from reviewscope.models import best_items, factors, frames, recommender, sentiment, shared_trees, sparse_logistic, trees, tuning
from reviewscope.operators import dictionary, encode, evaluate, heavy_words, sentences, slices, summarize, words
from reviewscope.plans import prepare
from reviewscope.plans.standin import (
    dated, labelled_texts, ratings, raw_reviews, reviews, rule_scored, table, texts,
)
from reviewscope.schema import ENCODED_REVIEWS, ID_COLUMNS, RATINGS, VOTE_COLUMNS
from reviewscope.session import materialize, scratch_path
from reviewscope.sources import (
    enforce_schema, load_reviews, read_csv_reviews, read_csv_split, read_csv_typed, scan_table, write_csv, write_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _digest(df: DataFrame, column: str = "text") -> DataFrame:
    """Show a long text by its length and checksum."""
    return df.withColumn("n_chars", F.length(column)).withColumn(column, F.md5(column))


def _joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


# --- scans and sinks -------------------------------------------------------

@query
def scan_csv_reviews(spark, sf_dir):
    path = scratch_path(spark, "raw", ".csv")
    write_csv(raw_reviews(spark, sf_dir), path, compression="gzip")
    return _digest(dated(cleaning.clean_reviews(read_csv_reviews(spark, path))))


SPLIT_ROWS = 25_000  # of a compressed file, which is one split


@query
def scan_csv_split(spark, sf_dir):
    path = scratch_path(spark, "raw", ".csv")
    write_csv(raw_reviews(spark, sf_dir), path, compression="gzip", file_rows=SPLIT_ROWS)
    return _digest(dated(cleaning.clean_reviews(read_csv_split(spark, path))))


@query
def scan_csv_infer(spark, sf_dir):
    path = scratch_path(spark, "ratings", ".csv")
    write_csv(dated(ratings(spark, sf_dir)), path)
    # Small ids are found to be int and larger ones bigint; one type for both.
    typed = read_csv_typed(spark, path)
    return dated(typed.select([F.col(c).cast("bigint") if c in ID_COLUMNS else F.col(c) for c in typed.columns]))


@query
def scan_table_sql(spark, sf_dir):
    dated(ratings(spark, sf_dir)).createOrReplaceTempView("review_ratings")
    return scan_table(spark, "review_ratings")


@query
def schema_enforced_scan(spark, sf_dir):
    path = scratch_path(spark, "encoded", ".parquet")
    write_parquet(reviews(spark, sf_dir).withColumn("date", F.col("date").cast("timestamp")), path)
    loaded = load_reviews(spark, path, ENCODED_REVIEWS)
    return _digest(dated(enforce_schema(loaded, ENCODED_REVIEWS)))


@query
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "scaled", ".csv")
    scaled = encode.minmax_scale(ratings(spark, sf_dir), ID_COLUMNS)
    write_csv(scaled.select(*ID_COLUMNS, *VOTE_COLUMNS, "stars"), path)
    back = load_reviews(spark, path)
    return back.select(*[F.round(c, 6).alias(c) for c in ID_COLUMNS], *VOTE_COLUMNS, "stars")


@query
def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean", ".parquet")
    write_parquet(cleaning.clean_reviews(raw_reviews(spark, sf_dir)), path)
    return _digest(dated(load_reviews(spark, path)))


# --- projections and filters -----------------------------------------------

@query
def project_columns(spark, sf_dir):
    return ratings(spark, sf_dir).select("user_id", "business_id", "stars")


@query
def label_binarize(spark, sf_dir):
    return frames.id_frame(ratings(spark, sf_dir))


@query
def filter_by_rating(spark, sf_dir):
    votes = [F.sum(c).alias(f"sum_{c}") for c in VOTE_COLUMNS]
    rated = ratings(spark, sf_dir).where(F.col("stars").isin(RATINGS))
    return rated.groupBy("stars").agg(F.count("*").alias("n_reviews"), *votes)


@query
def filter_conjunction(spark, sf_dir):
    return rule_scored(spark, sf_dir).filter("prediction == 1.0 AND truelabel == 1")


def _gappy_scores(spark, sf_dir) -> DataFrame:
    """Scores with NaN for unlabelled texts and NULL for texts in one language."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    score = (F.col("n_chars") - 1400) / F.lit(1000.0)
    score = F.when(F.col("lang") == "de", None).when(F.col("quality").isNull(), float("nan")).otherwise(score)
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(
        labels, "doc_id", "left").select("doc_id", score.alias("prediction"))


@query
def filter_nan(spark, sf_dir):
    scores = _gappy_scores(spark, sf_dir).where(numbers.is_number(F.col("prediction")))
    return scores.withColumn("prediction", F.round("prediction", 6))


@query
def dropna_any(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left").na.drop(how="any")


@query
def join_predictions_source(spark, sf_dir):
    scored = ratings(spark, sf_dir).select(
        "review_id", (F.col("useful") > 4).cast("double").alias("prediction"))
    # What is shown of a text is made before the join, so that texts are not shuffled by review.
    source = _digest(reviews(spark, sf_dir).select("review_id", "user_id", "business_id", "stars", "text"))
    return scored.join(source, "review_id")


# --- aggregations ----------------------------------------------------------

def _string_keys(spark, sf_dir, *more: Column) -> DataFrame:
    return ratings(spark, sf_dir).select(
        F.col("review_id").alias("row_id"),
        *[F.md5(F.col(c).cast("string")).alias(c) for c in ID_COLUMNS], "stars", *more,
    )


@query
def encode_ids(spark, sf_dir):
    return encode.encode_ids(_string_keys(spark, sf_dir), ID_COLUMNS, row_key="row_id")


@query
def encode_ids_by_load(spark, sf_dir):
    """The rows of each half of the months, encoded as they arrive: the second load appends to the codes of the first."""
    folder = scratch_path(spark, "dictionary")
    rows = _string_keys(spark, sf_dir, F.when(F.dayofmonth("date") <= 15, 1).otherwise(2).alias("load"))
    loads = [rows.where(F.col("load") == n) for n in (1, 2)]
    first, second = (
        encode.apply_codes(part, dictionary.extend(part, ID_COLUMNS, folder), ID_COLUMNS, row_key="row_id") for part in loads)
    return first.unionByName(second)


@query
def split_sizes(spark, sf_dir):
    split = slices.hash_split(ratings(spark, sf_dir), "review_id")
    return split.groupBy("split").agg(F.count("*").alias("n_rows"))


@query
def distinct_keys(spark, sf_dir):
    return summarize.distinct_keys(ratings(spark, sf_dir))


@query
def distinct_values(spark, sf_dir):
    return summarize.distinct_values(ratings(spark, sf_dir), "business_id")


@query
def word_freq_by_rating(spark, sf_dir):
    return words.word_freq_by_rating(reviews(spark, sf_dir))


@query
def top_words_by_rating(spark, sf_dir):
    return words.top_words_by_rating(reviews(spark, sf_dir))


@query
def heavy_words_by_rating(spark, sf_dir):
    return heavy_words.heavy_words_by_rating(reviews(spark, sf_dir))


@query
def crosstab_day_stars(spark, sf_dir):
    return summarize.crosstab_day_stars(ratings(spark, sf_dir))


@query
def crosstab_month_stars(spark, sf_dir):
    stars = F.substring("o_orderpriority", 1, 1).cast("int").alias("stars")
    return summarize.crosstab_month_stars(
        table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("date"), stars))


@query
def box_stats(spark, sf_dir):
    rated = ratings(spark, sf_dir, "value")
    measures = summarize.melt(rated, ["stars"], [*VOTE_COLUMNS, "value"], into="y")
    boxes = summarize.box_stats(measures, ["measure", "stars"], "y")
    shown = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return boxes.select("measure", "stars", "n", *[F.round(c, 6).alias(c) for c in shown], "n_outliers")


@query
def box_outliers(spark, sf_dir):
    measured = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return summarize.box_outliers(measured, ["event_type"], "value", spread_by=["event_id"])


@query
def scatter_counts(spark, sf_dir):
    clouds = [("cool", "cool"), ("cool", "funny"), ("cool", "useful"), ("useful", "funny")]
    return summarize.scatter_counts(ratings(spark, sf_dir), clouds)


# --- slices ----------------------------------------------------------------

@query
def head_slice(spark, sf_dir):
    return slices.first_rows(dated(ratings(spark, sf_dir)), 2_500, "review_id")


@query
def scaled_subset(spark, sf_dir):
    encoded, scaled = encode.encode_and_scale(_string_keys(spark, sf_dir), ID_COLUMNS, row_key="row_id")
    subset = slices.first_rows(scaled, 800, "row_id")
    return subset.select("row_id", *[F.round(c, 9).alias(c) for c in ID_COLUMNS], "stars")


@query
def prepare_tables(spark, sf_dir):
    # Cleaned files come from the CSV form, like any other raw input.
    path = scratch_path(spark, "raw", ".csv")
    write_csv(raw_reviews(spark, sf_dir), path, compression="gzip")
    tables = prepare.prepare_tables(read_csv_reviews(spark, path), scratch_path(spark, "prepared"))
    scaled = tables["scaled"].select(*[F.round(c, 9).alias(c) for c in ID_COLUMNS], "text", "date", "stars")
    return _digest(dated(scaled))


# --- scalar functions ------------------------------------------------------

@query
def clean_byte_prefix(spark, sf_dir):
    raw = raw_reviews(spark, sf_dir)
    mixed = F.when(F.col("review_id") < "b'8", F.col("text")).otherwise(F.substr("text", F.lit(3)))
    return _digest(raw.select("review_id", cleaning.strip_byte_prefix(mixed).alias("text"),
                              cleaning.strip_byte_prefix(F.col("user_id")).alias("user_id")))


@query
def clean_quotes(spark, sf_dir):
    quoted = texts(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("'\""), "text", F.lit("\"''")).alias("text"))
    return _digest(quoted.withColumn("text", cleaning.strip_quotes(F.col("text"))))


@query
def strip_punctuation(spark, sf_dir):
    documents = texts(spark, sf_dir)
    return documents.withColumn("text", text.strip_punctuation(F.col("text")))


@query
def weekday_name(spark, sf_dir):
    parsed = calendar.parse_date(F.col("date"))
    return dated(ratings(spark, sf_dir)).select("review_id", calendar.weekday_name(parsed).alias("day"))


@query
def month_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", calendar.DATE_FORMAT).alias("date"))
    return orders.select("o_orderkey", calendar.month_name(calendar.parse_date(F.col("date"))).alias("month"))


@query
def round_abs(spark, sf_dir):
    score = (F.col("value") - 20) / F.lit(8.0)
    return table(spark, sf_dir, "events").select("event_id", numbers.round_abs(score).alias("prediction"))


@query
def minmax_ids(spark, sf_dir):
    scaled = encode.minmax_scale(
        ratings(spark, sf_dir).select(F.col("review_id").alias("row_id"), *ID_COLUMNS), ID_COLUMNS)
    return scaled.select("row_id", *[F.round(c, 9).alias(c) for c in ID_COLUMNS])


# --- text ------------------------------------------------------------------

def _tokens(spark, sf_dir) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", text.word_tokens(F.col("text")).alias("tokens"))


def _shown_tokens(df: DataFrame, column: str) -> DataFrame:
    return df.select("doc_id", F.size(column).alias("n_tokens"), _joined(F.col(column)).alias(column))


@query
def word_tokens(spark, sf_dir):
    return _shown_tokens(_tokens(spark, sf_dir), "tokens")


@query
def abbreviation_scores(spark, sf_dir):
    uses = materialize(sentences.piece_uses(texts(spark, sf_dir)), "uses")
    return sentences.abbreviation_scores(uses).select(
        "word", "n_dot", "n_plain", *[F.round(c, 6).alias(c) for c in ("ratio", "score")])


@query
def sentence_tokens(spark, sf_dir):
    cut = sentences.sentences(texts(spark, sf_dir), "doc_id")
    return cut.select("doc_id", "sentence", F.size("tokens").alias("n_tokens"), _joined(F.col("tokens")).alias("tokens"))


@query
def tokens_no_stopwords(spark, sf_dir):
    kept = _tokens(spark, sf_dir).withColumn("tokens", text.remove_stop_words(F.col("tokens")))
    return _shown_tokens(kept, "tokens")


@query
def tokens_clean(spark, sf_dir):
    kept = _tokens(spark, sf_dir).withColumn("tokens", text.clean_tokens(F.col("tokens")))
    return _shown_tokens(kept, "tokens")


@query
def bigrams(spark, sf_dir):
    pairs = _tokens(spark, sf_dir).select(
        "doc_id", F.posexplode(text.bigrams(text.clean_tokens(F.col("tokens")))).alias("place", "pair"))
    return pairs.select("doc_id", F.col("place").cast("bigint").alias("place"), "pair.w1", "pair.w2")


def _ml_words(spark, sf_dir) -> DataFrame:
    documents = texts(spark, sf_dir)
    return Tokenizer(inputCol="text", outputCol="tokens").transform(documents).drop("text")


@query
def ml_tokenize(spark, sf_dir):
    return _shown_tokens(_ml_words(spark, sf_dir), "tokens")


def _ml_kept(spark, sf_dir) -> DataFrame:
    return StopWordsRemover(inputCol="tokens", outputCol="kept").transform(_ml_words(spark, sf_dir)).drop("tokens")


@query
def ml_stopwords(spark, sf_dir):
    return _shown_tokens(_ml_kept(spark, sf_dir), "kept")


def _ml_hashed(documents: DataFrame) -> DataFrame:
    """``documents`` with the (bucket, weight) entries of their hashed terms as ``entries``."""
    hashed = PipelineModel(stages=sentiment.text_stages()).transform(documents)
    return hashed.withColumn("entries", sentiment.sparse_entries(F.col(sentiment.FEATURES)))


@query
def ml_hashing_tf(spark, sf_dir):
    entries = _ml_hashed(texts(spark, sf_dir)).select("doc_id", F.explode("entries").alias("e"))
    return entries.select("doc_id", "e.bucket", "e.weight")


# --- sampling and features -------------------------------------------------

@query
def random_split(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("review_id")
    parts = slices.random_split(rows, "review_id", [0.7, 0.3], seed=trees.SEED)
    whole = parts[0].withColumn("first", F.lit(1)).unionByName(parts[1].withColumn("first", F.lit(0)))
    n, first = whole.agg(F.count("*")).scalar(), whole.agg(F.sum("first")).scalar()
    expected = F.abs(first - 0.7 * n) <= 5 * F.sqrt(0.21 * n)  # five standard deviations of the drawn share
    return whole.groupBy("review_id").agg(F.count("*").alias("n_parts")).withColumn("share_expected", expected)


@query
def hash_split(spark, sf_dir):
    return slices.hash_split(ratings(spark, sf_dir), "review_id").select("review_id", "split")


@query
def assemble_features(spark, sf_dir):
    vectors = frames.assembled_array(frames.id_frame(ratings(spark, sf_dir)))
    parts = [F.col("features")[i].alias(f"feature_{i}") for i in range(3)]
    return vectors.select(F.col("review_id"), *parts, "label")


# --- models ----------------------------------------------------------------

def _scaled_ids(spark, sf_dir) -> DataFrame:
    rated = ratings(spark, sf_dir).withColumn("row_id", F.col("review_id"))
    return encode.minmax_scale(rated, ID_COLUMNS)


def _id_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return slices.train_test(frames.id_frame(_scaled_ids(spark, sf_dir), "row_id"), "row_id")


def _rating_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return slices.train_test(frames.rating_frame(ratings(spark, sf_dir), "review_id"), "review_id")


def _text_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return slices.train_test(labelled_texts(spark, sf_dir), "doc_id")


def _judged(scored: DataFrame, margin: float = 0.05) -> dict:
    """From a classifier's report: class sizes, majority baseline, and whether the model stays above it but for a margin."""
    got = {r["metric"]: r["value"] for r in evaluate.classifier_report(scored).collect()}
    baseline = got["F1 weighted, majority class"]
    return {
        "n_positive": int(got["TP"] + got["FN"]), "n_negative": int(got["FP"] + got["TN"]),
        "majority_f1": round(baseline, 9), "holds_up": got["F1 weighted"] >= baseline - margin,
    }


JUDGED = "n_positive bigint, n_negative bigint, majority_f1 double, holds_up boolean"


def _judged_frame(spark, scored: DataFrame) -> DataFrame:
    return spark.createDataFrame([tuple(_judged(scored).values())], JUDGED)


def _tuned(spark, model, facts: dict) -> DataFrame:
    """Every grid point, whether its metric is usable, and what the chosen model's report says."""
    table = tuning.grid_table(model, spark)
    usable = F.col("metric").isNotNull() & ~F.isnan("metric") & (F.col("metric") >= 0)
    return table.select("point", "parameters", usable.alias("usable"), *[F.lit(v).alias(k) for k, v in facts.items()])


@query
def lr_sentiment(spark, sf_dir):
    train, test = _text_parts(spark, sf_dir)
    return _judged_frame(spark, sentiment.fit_sentiment(train, "doc_id").transform(test))


@query
def lr_gradient_steps(spark, sf_dir):
    rows = materialize(_ml_hashed(labelled_texts(spark, sf_dir)).select(*sparse_logistic.entry_rows(F.col("entries"), "doc_id", "label")), "hashed-texts")
    train, test = slices.train_test(rows, "doc_id")
    judge = sparse_logistic.probability(spark, sparse_logistic.fit_steps(train, steps=3, rate=0.01, reg=0.01))
    return test.select("doc_id", "trueLabel", F.round(judge("buckets", "weights"), 6).alias("probability"))


@query
def dt_classify(spark, sf_dir):
    train, test = _id_parts(spark, sf_dir)
    return _judged_frame(spark, trees.fit_in_order(trees.tree_pipeline(), train, "row_id").transform(test))


@query
def dt_stump(spark, sf_dir):
    # Few values, so the tree tries every cut between two of them and SQL can follow.
    lengths = table(spark, sf_dir, "documents").select("doc_id", F.least(F.floor(F.col("n_chars") / 200), F.lit(20)).alias("length"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    train, test = slices.train_test(lengths.join(labels, "doc_id"), "doc_id")
    stump = trees.fit_in_order(trees.tree_pipeline(["length"], maxDepth=1), train, "doc_id")
    return stump.transform(test).select("doc_id", "length", "prediction", "trueLabel")


@query
def gbt_classify(spark, sf_dir):
    train, test = _id_parts(spark, sf_dir)
    return _judged_frame(spark, trees.fit_in_order(trees.boosted_pipeline(), train, "row_id").transform(test))


@query
def rf_binary(spark, sf_dir):
    train, test = _id_parts(spark, sf_dir)
    return _judged_frame(spark, trees.fit_in_order(trees.forest_pipeline(), train, "row_id").transform(test))


@query
def rf_multiclass(spark, sf_dir):
    stars = _scaled_ids(spark, sf_dir).select("row_id", *ID_COLUMNS, F.col("stars").cast("double").alias("label"))
    train, test = slices.train_test(stars, "row_id")
    scored = trees.fit_in_order(trees.forest_pipeline(), train, "row_id").transform(test)
    return scored.groupBy("trueLabel").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("prediction").between(1, 5)).alias("n_predicted"),
    )


@query
def als_recommend(spark, sf_dir):
    train, test = _rating_parts(spark, sf_dir)
    scored = recommender.score_all(recommender.fit_als(train, "review_id"), test)
    return scored.select("review_id", "trueLabel", numbers.is_number(F.col("prediction")).alias("scored"))


@query
def als_top_items(spark, sf_dir):
    rated = frames.rating_frame(ratings(spark, sf_dir), "review_id")
    top = recommender.top_items(recommender.fit_als(rated, "review_id"), 5)
    return top.groupBy("user_id").agg(
        F.count_distinct("business_id").alias("n_items"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
    )


def _heavy_ratings(spark, sf_dir) -> DataFrame:
    """Ratings of which one user gives a third."""
    rated = frames.rating_frame(ratings(spark, sf_dir), "review_id")
    heavy = F.when(F.col("review_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    return rated.withColumn("user_id", heavy)


SMALL_MODEL = {"rank": 3, "iterations": 2, "reg": 0.1}


def _heavy_model(spark, sf_dir) -> factors.FactorModel:
    return factors.fit_factors(_heavy_ratings(spark, sf_dir), **SMALL_MODEL)


def _shown_factors(side: str, table: DataFrame) -> DataFrame:
    return table.select(F.lit(side).alias("side"), F.col("id").cast("bigint").alias("id"),
                        *[F.round(c, 6).alias(c) for c in factors.factor_columns(SMALL_MODEL["rank"])])


@query
def als_factors(spark, sf_dir):
    model = _heavy_model(spark, sf_dir)
    return _shown_factors("user", model.users).unionByName(_shown_factors("business", model.items))


@query
def als_scores(spark, sf_dir):
    train, test = slices.train_test(_heavy_ratings(spark, sf_dir), "review_id")
    model = factors.fit_factors(train, **SMALL_MODEL)
    scored = factors.score_pairs(model, test.select("review_id", "user_id", "business_id", "trueLabel"))
    return scored.select("review_id", "trueLabel", F.round("prediction", 6).alias("prediction"))


@query
def als_best_items(spark, sf_dir):
    found = best_items.best_items(_heavy_model(spark, sf_dir), 5, first_band=64).table
    return found.select("user_id", F.col("business_id").cast("bigint").alias("business_id"), "rank", F.round("score", 6).alias("score"))


def _coverage(model, test: DataFrame) -> dict:
    row = evaluate.rating_report(recommender.score_all(model, test)).first()
    return {"n_rows": row["n_rows"], "n_scored": row["n_scored"]}


@query
def als_tuned(spark, sf_dir):
    train, test = _rating_parts(spark, sf_dir)
    model = tuning.tune_on_split(recommender.als(), tuning.ALS_GRID, tuning.label_rmse(), train, "review_id")
    return _tuned(spark, model, _coverage(model.bestModel, test))


@query
def als_tuned_cv(spark, sf_dir):
    train, test = _rating_parts(spark, sf_dir)
    model = tuning.tune_by_folds(recommender.als(), tuning.ALS_GRID, tuning.label_rmse(), train, "review_id", folds=3)
    return _tuned(spark, model, _coverage(model.bestModel, test))


def _assembled_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Features are assembled once, not again for every grid point."""
    return tuple(frames.assemble().transform(part) for part in _id_parts(spark, sf_dir))


@query
def dt_tuned_tvs(spark, sf_dir):
    train, test = _assembled_parts(spark, sf_dir)
    tree = trees.tree_pipeline().getStages()[-1]
    model = tuning.tune_on_split(tree, tuning.TREE_GRID, tuning.weighted_f1(), train, "row_id")
    return _tuned(spark, model, _judged(model.bestModel.transform(test)))


@query
def dt_tuned_cv(spark, sf_dir):
    train, test = _assembled_parts(spark, sf_dir)
    tree = trees.tree_pipeline().getStages()[-1]
    model = tuning.tune_by_folds(tree, tuning.TREE_GRID, tuning.score_auc(), train, "row_id")
    return _tuned(spark, model, _judged(model.bestModel.transform(test)))


@query
def dt_grid_folds(spark, sf_dir):
    """Every point of the tree grid on every fold, from passes that all points and folds share."""
    text = F.col("text")
    rows = labelled_texts(spark, sf_dir).select(
        "doc_id", "label", F.length(text).alias("n_chars"),
        (F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))).alias("n_commas"),
        (F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))).alias("n_periods"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).alias("n_capitals"),
    )
    return shared_trees.cross_validate(
        rows, "doc_id", "label", ["n_chars", "n_commas", "n_periods", "n_capitals"],
        tuning.TREE_GRID["maxBins"], tuning.TREE_GRID["maxDepth"], [0.0, 0.005, 0.02]).table


@query
def gbt_tuned_tvs(spark, sf_dir):
    train, test = _assembled_parts(spark, sf_dir)
    boosted = trees.boosted_pipeline().getStages()[-1]
    model = tuning.tune_on_split(boosted, tuning.BOOSTED_GRID, tuning.weighted_f1(), train, "row_id", parallelism=8)
    return _tuned(spark, model, _judged(model.bestModel.transform(test)))


# --- metrics ---------------------------------------------------------------

@query
def confusion_counts(spark, sf_dir):
    return evaluate.confusion_counts(rule_scored(spark, sf_dir))


@query
def precision_recall(spark, sf_dir):
    ratio = evaluate.precision_recall(rule_scored(spark, sf_dir))
    return ratio.select([F.round(c, 9).alias(c) for c in ratio.columns])


@query
def f1_weighted(spark, sf_dir):
    return evaluate.f1_weighted(rule_scored(spark, sf_dir)).select(F.round("f1_weighted", 9).alias("f1_weighted"))


@query
def auc_hard(spark, sf_dir):
    return evaluate.auc_hard(rule_scored(spark, sf_dir)).select(F.round("auc_hard", 9).alias("auc_hard"))


@query
def metrics_table(spark, sf_dir):
    return evaluate.metrics_table(rule_scored(spark, sf_dir)).withColumn("value", F.round("value", 9))


@query
def rmse(spark, sf_dir):
    scored = rule_scored(spark, sf_dir).withColumn("prediction", F.col("n_chars") / F.lit(3000.0))
    return evaluate.rmse(scored).select(F.round("rmse", 9).alias("rmse"))
