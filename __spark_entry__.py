"""

Every query runs over whole tables. Stand-ins: an article is a row of ``documents`` (``lang`` as its
category) or ``conversations`` (``role`` as its category); ``labels.quality`` is the second label;
``pages`` holds markup and links; ``events`` and ``orders`` give numbers and dates.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressroom.functions.text import compose_text, lower_text, with_clean_text
from pressroom.functions.tokens import (
    ENGLISH_STOP_WORDS,
    FEED_STOP_WORDS,
    FULL_STOP_WORDS,
    gap_tokenizer,
    match_tokenizer,
    stop_word_remover,
    term_counts,
)
from pressroom.operators import evaluate, labels, profile, split
from pressroom.operators.combine import union_mixed, union_sources
from pressroom.operators.dedupe import append_unseen
from pressroom.operators.vectors import tfidf_table, vector_terms
from pressroom.plans import bayes_counts, boosting, forests, tune
from pressroom.plans import train as training
from pressroom.plans.boosted_text import train_boosted_text, training_rows
from pressroom.plans.features import count_pipeline, term_table_pipeline
from pressroom.plans.models import MAIN_PARAMS, fit_classifier
from pressroom.plans.predict import predict
from pressroom.schemas import SEARCH_FIELDS
from pressroom.session import scratch_path
from pressroom.sources import catalog, feeds, ledger, messages, requests, search, store
from pressroom.streaming.ingest import start_ingest, start_ledger_ingest
from pressroom.streaming.learn import start_learning, start_scoring_latest
from pressroom.streaming.score import start_scoring

# --- training-data operators, present only together with their subpackage -------------------------


def _optional() -> tuple[dict, dict]:
    """Queries and SQL of the subpackage and the pipeline, or none where those files are absent."""
    try:
        from pressroom.llm import registry  # first, as the pipeline is part of it

        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name != "corpus_pipeline" and not missing.name.startswith("pressroom.llm"):
            raise
        return {}, {}
    queries = registry.QUERIES | {"pipeline": corpus_pipeline.run}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return queries, registry.ORACLE_SQL | sql


# --- tables ---------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a key."""
    return _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("category"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents, with their quality as the category."""
    quality = _table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("category")
    )
    return _documents(spark, sf_dir).drop("category").join(quality, "doc_id")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations")


def _search_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as search articles; two fields are null."""
    link = F.format_string("talk/%d/%d", "conv_id", "turn")
    return _turns(spark, sf_dir).select(
        F.col("role").alias("title"),
        F.lit(None).cast("string").alias("published_date"), link.alias("link"),
        F.lit("talk").alias("clean_url"), F.col("text").alias("summary"),
        F.lit(None).cast("string").alias("media"), F.col("role").alias("topic"),
    )


# --- sources --------------------------------------------------------------------------------


def _links():
    return F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))


def feed_catalog(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("lang"),
        _links().alias("links"),
    )
    one = F.to_json(F.create_map("lang", F.get("links", F.lit(0))))
    many = F.to_json(F.create_map("lang", "links"))
    bodies = pages.select(
        "page_id", F.when(F.size("links") == 1, one).otherwise(many).alias("body")
    )
    return catalog.flatten_catalog(catalog.parse_catalog(bodies, "body", "page_id"))


def feed_items(spark, sf_dir):
    escaped = F.col("html")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    title = F.regexp_replace(
        F.regexp_extract("html", "<title>([^<]*)</title>", 1), "&", "&amp;"
    )
    body = F.concat(
        F.lit("<rss><channel><item><title>"), title,
        F.lit("</title><description>"), escaped, F.lit("</description></item></channel></rss>"),
    )
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("category"), body.alias("body")
    )
    return feeds.feed_articles(pages, "body", "page_id", "category")


def _responses(spark, sf_dir):
    """One search response per page, a record per link; a link with a comma lacks the topic."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", _links().alias("links"))

    def record(link):
        values = {
            "title": F.concat(F.col("url"), link), "published_date": F.lit(None).cast("string"),
            "link": link, "clean_url": F.col("url"), "summary": F.concat(F.lit("to "), link),
            "media": F.lit(None).cast("string"), "topic": F.lit("link"),
        }

        def with_keys(names):
            return F.create_map(*(x for n in names for x in (F.lit(n), values[n])))

        return F.when(
            F.contains(link, F.lit(",")), with_keys(f for f in SEARCH_FIELDS if f != "topic")
        ).otherwise(with_keys(SEARCH_FIELDS))

    body = F.struct(F.size("links").alias("page_size"), F.transform("links", record).alias("articles"))
    return pages.select("page_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def search_projection(spark, sf_dir):
    return search.search_articles(_responses(spark, sf_dir), "body", "page_id")


def search_groups(spark, sf_dir):
    return search.search_groups(_responses(spark, sf_dir), "body", "page_id").select(
        "page_id", F.size("articles").cast("long").alias("n_articles"),
        F.array_join("articles.link", " ").alias("links"),
    )


def source_union(spark, sf_dir):
    return union_sources(
        _table(spark, sf_dir, "documents").select("text", F.col("lang").alias("category")),
        _turns(spark, sf_dir).select("text", F.col("role").alias("category")),
        _table(spark, sf_dir, "pages").select(
            F.col("html").alias("text"), F.lit("page").alias("category")
        ),
        _table(spark, sf_dir, "benchmark").select("text", F.lit("benchmark").alias("category")),
    )


def mixed_union(spark, sf_dir):
    return union_mixed(
        _table(spark, sf_dir, "documents").select("text", F.col("lang").alias("category")),
        _search_turns(spark, sf_dir),
    )


def request_plan(spark, sf_dir):
    api = F.transform(
        F.sequence(F.lit(1), F.length("event_type")),
        lambda i: F.struct(
            F.lit("GET").alias("requestType"),
            F.concat(F.lit("https://"), F.col("event_type"), F.lit("/"), i.cast("string")).alias("url"),
            F.create_map(F.lit("topic"), F.col("event_type"), F.lit("page"), i.cast("string")).alias("queryString"),
            F.create_map(F.lit("key"), F.lit("secret"), F.lit("host"), F.lit("h")).alias("headers"),
            F.when(i % 2 == 0, i).alias("APIlimit"),
        ),
    )
    config = F.struct(api.alias("api"), F.floor(F.col("value") / 10).cast("int").alias("MaxAPIS"))
    body = F.to_json(F.struct(F.create_map("event_type", config).alias("RapidAPI")))
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events = events.select("event_id", body.alias("body"))
    return requests.request_plan(events, "body", "event_id").select(
        "event_id", "config_key", F.col("api_index").cast("long").alias("api_index"),
        "hit", "url", "output_name", F.col("query_string")["topic"].alias("topic"),
        F.col("query_string")["page"].alias("page"), F.array_join("header_names", ",").alias("header_names"),
        "api_limit",
    )


def archive_keys(spark, sf_dir):
    month = F.when(
        F.col("o_orderstatus") != "P", F.concat(F.lit("-"), F.month("o_orderdate").cast("string"))
    ).otherwise("")
    path = F.concat(F.lit("./Data/"), F.year("o_orderdate").cast("string"), month, F.lit(".json"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
    return requests.with_archive_keys(orders, "path")


def message_roundtrip(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("text", "category")
    return messages.decode_messages(messages.encode_messages(docs)).select("text", "category")


def message_rejects(spark, sf_dir):
    """Messages of which some are no list or no JSON, counted by reason."""
    events = _table(spark, sf_dir, "events").select("event_id", "props")
    kind = F.col("event_id") % 4
    value = (F.when(kind == 0, F.concat(F.lit('[{"text": "'), F.col("event_id"), F.lit('"}]')))
             .when(kind == 1, F.col("props")).when(kind == 2, F.concat(F.lit("[{"), F.col("props"))))
    rejected = messages.rejected_messages(events.select(value.alias("value")))
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


def store_scan(spark, sf_dir):
    """Articles written to a store, and those of one category read back by a filter in its scan."""
    path = scratch_path(spark, "store")
    append_unseen(_documents(spark, sf_dir).select("text", "category"), path)
    return store.scan_store(spark, path, {"category": "fr"}).select("text", "category")


def project_fill(spark, sf_dir):
    joined = _table(spark, sf_dir, "documents").join(
        _table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return store.project_fill(joined, ("doc_id", "text", "lang", "quality", "toxic"))


def csv_dropna(spark, sf_dir):
    path = scratch_path(spark, "csv")
    (
        _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("category"))
        .join(_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
        .write.option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return store.read_training_csv(spark, path)


# --- insert if absent -----------------------------------------------------------------------


_LANDED_BYTES = 1 << 27


def insert_if_absent(spark, sf_dir):
    path = scratch_path(spark, "store")
    docs = _documents(spark, sf_dir).select("text", "category")
    append_unseen(_turns(spark, sf_dir).select("text", F.col("role").alias("category")), path)
    for _ in range(2):  # the second time adds nothing
        append_unseen(docs, path)
    return store.scan_store(spark, path).select("text", "category")


def stream_ingest(spark, sf_dir):
    landed, path = scratch_path(spark, "landed"), scratch_path(spark, "store")
    docs = messages.encode_messages(_documents(spark, sf_dir))
    turns = messages.encode_messages(_search_turns(spark, sf_dir), keep_nulls=True)
    messages.write_message_files(union_sources(docs, turns), landed)
    stream = messages.stream_message_files(spark, landed)
    for _ in range(2):  # the second run replays everything from a fresh checkpoint
        start_ingest(stream, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return store.scan_store(spark, path)


def landed_files(size: int) -> int:
    """Files of each of three batches of messages, none over ``_LANDED_BYTES`` or so."""
    return max(1, -(-size // (3 * _LANDED_BYTES)))


def ledger_ingest(spark, sf_dir):
    """Documents and broken messages in several batches, and all batches again from a fresh checkpoint."""
    landed, root = scratch_path(spark, "landed"), scratch_path(spark, "ledger")
    docs = messages.encode_messages(_documents(spark, sf_dir)).select("value")
    broken = _table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    read = ((_documents(spark, sf_dir), "text"), (broken, "value"))
    size = sum(df.agg(F.sum(F.octet_length(c))).first()[0] or 0 for df, c in read)
    files = landed_files(size)  # of a batch; dealt without a key, as many broken messages may be alike
    messages.write_message_files(union_sources(docs, broken).repartition(3 * files), landed)
    stream = messages.stream_message_files(spark, landed, max_files=files)
    for _ in range(2):  # the same source, so the second time each number is known
        start_ledger_ingest(stream, root, scratch_path(spark, "checkpoint")).awaitTermination()
    stored = ledger.scan_articles(spark, root).select("text", "category", F.lit(None).cast("string").alias("reason"))
    rejected = ledger.read_rejects(spark, root).groupBy("value", "reason").agg(F.count("*").alias("n"))
    return union_sources(stored.withColumn("n", F.lit(1).cast("long")), rejected.select(
        F.col("value").alias("text"), F.lit(None).cast("string").alias("category"), "reason", "n"))


def ledger_scan(spark, sf_dir):
    """Two batches compacted into one, of which a category is read."""
    root = scratch_path(spark, "ledger")
    turns = _turns(spark, sf_dir).select("text", F.col("role").alias("category"))
    for batch, articles in enumerate((_documents(spark, sf_dir).select("text", "category"), turns)):
        ledger.commit_batch(messages.encode_messages(articles), root, batch)
    ledger.compact(spark, root)
    return ledger.scan_articles(spark, root, {"category": "fr"}).select("text", "category")


# --- text and features ----------------------------------------------------------------------


def compose(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select(
        "page_id", compose_text(F.col("url"), F.col("html")).alias("text")
    )


def strip_markup(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return with_clean_text(pages, "text")


def lower(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", lower_text(F.col("text")).alias("text"))


def _token_totals(df: DataFrame, tokens_col: str) -> DataFrame:
    """Texts and occurrences per token. Each text is counted in its row first."""
    return (
        df.select(F.inline(term_counts(F.col(tokens_col))))
        .groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n"))
    )


def gap_tokens(spark, sf_dir):
    return _token_totals(gap_tokenizer().transform(_documents(spark, sf_dir)), "words")


def match_tokens(spark, sf_dir):
    return _token_totals(match_tokenizer().transform(_documents(spark, sf_dir)), "words")


def filtered_tokens(spark, sf_dir):
    tokens = gap_tokenizer().transform(_documents(spark, sf_dir))
    return _token_totals(stop_word_remover(FULL_STOP_WORDS).transform(tokens), "filtered")


def count_vectors(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    model = count_pipeline().fit(docs)
    return vector_terms(model.transform(docs), "features", model.stages[-1].vocabulary, "doc_id")


def tfidf_vectors(spark, sf_dir):
    tokens = match_tokenizer().transform(_documents(spark, sf_dir))
    kept = stop_word_remover(ENGLISH_STOP_WORDS).transform(tokens)
    return tfidf_table(kept.select("doc_id", "filtered"), "doc_id", "filtered").select(
        "doc_id", "term", F.round("value", 6).alias("value")
    )


def tfidf_stages(spark, sf_dir):
    """The model form, over the whole vocabulary."""
    docs = _documents(spark, sf_dir)
    model = term_table_pipeline().fit(docs)
    entries = model.transform(docs).select("doc_id", F.inline(F.arrays_zip(
        F.col("features.indices").alias("index"), F.col("features.values").alias("value"))))
    return entries.join(model.stages[-1].terms(spark), "index").select(
        "doc_id", "term", F.round("value", 6).alias("value")
    )


def _indexed(spark, sf_dir, indexer):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("category"))
    model = indexer.fit(docs)
    return model, model.transform(docs)


def label_index(spark, sf_dir):
    return _indexed(spark, sf_dir, labels.frequency_indexer())[1]


def label_alpha(spark, sf_dir):
    return _indexed(spark, sf_dir, labels.alphabetical_indexer())[1]


def label_first_seen(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("category"))
    return labels.first_seen_ids(docs, "doc_id").select("category", "categoryId")


def label_map(spark, sf_dir):
    return labels.label_map(_indexed(spark, sf_dir, labels.frequency_indexer())[1])


def label_lookup(spark, sf_dir):
    model, indexed = _indexed(spark, sf_dir, labels.frequency_indexer())
    table = labels.indexer_label_map(spark, model)
    return labels.lookup_category(indexed.drop("category"), table, "label")


# --- counts, splits, batches ----------------------------------------------------------------


def category_profile(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("category"))
    return profile.category_profile(docs, "doc_id")


def category_distinct(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("category"))
    return profile.category_ids(docs, "doc_id")


def split_hash(spark, sf_dir):
    key = F.col("doc_id")
    weights = {"main": split.MAIN_SPLIT, "tuned": split.TUNED_SPLIT, "boosted": split.BOOSTED_SPLIT}
    return _table(spark, sf_dir, "documents").select(
        "doc_id", *(split.hash_part(key, w).alias(f"{n}_part") for n, (w, _) in weights.items())
    )


def split_exact(spark, sf_dir):
    """A fifth of the documents, rounded up, held out."""
    rest, part = split.exact_split(_documents(spark, sf_dir).select("doc_id"), "doc_id", 0.2)
    return union_sources(rest.withColumn("part", F.lit(0)), part.withColumn("part", F.lit(1)))


def split_random(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    # Which row goes where is up to the partitioning; each part's share and the whole are not.
    weights = split.TUNED_SPLIT[0]
    parts = split.random_split(docs, *split.TUNED_SPLIT)
    marked = union_sources(*(p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)))
    once = marked.groupBy("doc_id").agg(F.count("*").alias("times"), F.min("part").alias("part"))
    every = docs.join(once, "doc_id", "left")
    expected = F.array(*(F.lit(w / sum(weights)) for w in weights))[F.col("part")]
    total = docs.agg(F.count("*").alias("total"))
    return (
        every.groupBy("part").agg(F.count("*").alias("n"), F.max("times").alias("times")).crossJoin(total)
        .select("part", (F.col("times") == 1).alias("disjoint"),
                (F.abs(F.col("n") / F.col("total") - expected) < 0.05).alias("in_share")))


def batches(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    return split.with_batches(orders, "o_orderkey")


def batch_bounds(spark, sf_dir):
    return split.batch_bounds(_table(spark, sf_dir, "events"))


# --- models ---------------------------------------------------------------------------------


def _naive_bayes(df: DataFrame) -> training.Trained:
    return training.train(df, "nb", {"smoothing": 1.0}, key="doc_id")


def nb_predict(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return predict(_naive_bayes(docs).model, docs.select("doc_id", "text")).select(
        "doc_id", "predicted"
    )


def stream_predict(spark, sf_dir):
    model = _naive_bayes(_documents(spark, sf_dir)).model
    schema = _table(spark, sf_dir, "documents").schema
    # A glob, since a stream's plain path must be a directory and the table may be one file.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    out = scratch_path(spark, "scored")
    start_scoring(
        model, stream.select("doc_id", "text"), out, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    return spark.read.schema("doc_id long, predicted string").parquet(out)


def nb_stream(spark, sf_dir):
    """Naive Bayes kept from a stream of documents in several batches, scoring them all at its end."""
    docs, landed, model = _documents(spark, sf_dir), scratch_path(spark, "landed"), scratch_path(spark, "counts")
    docs.repartition(4, "doc_id").write.parquet(landed)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    start_learning(stream, model, scratch_path(spark, "checkpoint")).awaitTermination()
    scored = scratch_path(spark, "scored")
    start_scoring_latest(
        spark.readStream.schema(docs.schema).parquet(landed).select("doc_id", "text"), "doc_id", model, scored,
        scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema("doc_id long, predicted string").parquet(f"{scored}/*").select("doc_id", "predicted")


def lr_predict(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    model = training.train(docs, "lr", key="doc_id").model
    return predict(model, docs.select("doc_id", "text")).select("doc_id", "predicted")


def rf_predict(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    params = {"numTrees": 10, "maxDepth": 5, "seed": 42}
    model = training.train(
        docs, "rf", params, features=count_pipeline(FULL_STOP_WORDS),
        key="doc_id", split=split.TUNED_SPLIT,
    ).model
    return predict(model, docs.select("doc_id", "text")).select("doc_id", "predicted")


def lr_shares(spark, sf_dir):
    """Logistic regression on groups of two columns: its probabilities are the groups' shares.

    Shares are given as rows of the group, so that a tie of decimals can't tell two optima apart.
    """
    docs = _table(spark, sf_dir, "documents")
    third, long = F.col("doc_id") % 3, (F.col("n_chars") > 1500).cast("int")
    group = (third * 2 + long).cast("int")
    rows = docs.select(
        group.alias("group"), (F.col("lang") == "en").cast("double").alias("label"),
        array_to_vector(F.array(*((group == i).cast("double") for i in range(6)))).alias("features"))
    model = fit_classifier(
        rows, "lr", {"regParam": 0.0, "tol": 1e-12, "maxIter": 500, "fitIntercept": False, "standardization": False})
    sizes = rows.groupBy("group").agg(F.count("*").alias("size"))
    scored = model.transform(rows.dropDuplicates(["group"])).join(sizes, "group")
    hits = F.round(vector_to_array("probability")[1] * F.col("size")).cast("long")
    return scored.select("group", "size", hits.alias("hits"), "prediction")


def _presence(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    prepared = training.prepare(docs, count_pipeline(binary=True), split=([1.0, 0.0], 1), key="doc_id")
    text = prepared.text_model.transform(docs).select("doc_id", "features")
    return prepared, text


def _stump(spark, sf_dir, family, params):
    """One split on the presence of a term, predicted for every document."""
    prepared, text = _presence(spark, sf_dir)
    try:
        model = fit_classifier(prepared.train, family, params, len(prepared.labels))
    finally:
        training.release(prepared)
    named = labels.category_namer(prepared.labels).transform(model.transform(text))
    return named.select("doc_id", "predicted")


def rf_stump(spark, sf_dir):
    return _stump(spark, sf_dir, "rf", {
        "numTrees": 1, "bootstrap": False, "maxDepth": 1, "featureSubsetStrategy": "all", "impurity": "gini", "seed": 1})


def boosted_stump(spark, sf_dir):
    return _stump(spark, sf_dir, "boosted", {"rounds": 1, "max_depth": 1})


_BOOSTED = {"max_depth": 3, "learning_rate": 0.3, "subsample": 0.8}


def boosted_predict(spark, sf_dir):
    """Softmax boosting over the whole TF-IDF vocabulary, in batches of the reference's size."""
    docs = _documents(spark, sf_dir)
    model, _ = train_boosted_text(docs, "doc_id", settings=boosting.Settings(**_BOOSTED))
    return model.predict(docs.select("doc_id", "text")).select("doc_id", "predicted")


def _softmax(spark, sf_dir, depth):
    """The first round on all documents: each class's tree, splits by term and leaves by weight."""
    docs = _documents(spark, sf_dir)
    text_model, names, rows = training_rows(docs, "doc_id")
    booster = boosting.boost(
        rows, boosting.Booster(len(names)), 1, boosting.Settings(max_depth=depth))
    nodes = boosting.model_table(spark, booster)
    terms = text_model.stages[-1].terms(spark).select("term", F.col("index").alias("feature"))
    categories = F.get(F.array(*(F.lit(n) for n in names)), F.col("class"))
    return nodes.join(terms, "feature", "left").select(
        categories.alias("category"), "node", "term", "bin", "absent_left",
        F.round("gain", 6).alias("gain"), F.round("weight", 6).alias("weight"))


def softmax_stump(spark, sf_dir):
    return _softmax(spark, sf_dir, 1)


def softmax_tree(spark, sf_dir):
    return _softmax(spark, sf_dir, 2)


def param_grid(spark, sf_dir):
    """The logistic-regression grid for every label column, without points its classes rule out."""
    docs, marks = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    targets = union_sources(
        *(
            df.agg(F.count_distinct(c).alias("n_classes")).select(F.lit(c).alias("target"), "n_classes")
            for df, c in ((docs, "lang"), (marks, "quality"), (marks, "toxic"))
        )
    )
    return tune.with_grid(targets, tune.LR_RANGES).where("family != 'binomial' OR n_classes <= 2")


def _prepared_quality(spark, sf_dir):
    return training.prepare(
        _quality(spark, sf_dir), count_pipeline(FULL_STOP_WORDS), split=split.TUNED_SPLIT, key="doc_id"
    )


def grid_search(spark, sf_dir):
    """The whole naive Bayes grid."""
    prepared = _prepared_quality(spark, sf_dir)
    try:
        return tune.search(prepared, "nb", parallelism=4, stop_above=1.0).trials
    finally:
        training.release(prepared)


# The points of the naive Bayes grid that plain SQL can score: no zero smoothing, no complement.
_NB_POINTS = [p for p in tune.grid_points(tune.NB_RANGES)
              if p["smoothing"] > 0 and p["modelType"] != "complement"]


def grid_best(spark, sf_dir):
    """Every trial of a search with the winner marked."""
    prepared = _prepared_quality(spark, sf_dir)
    try:
        found = tune.search(prepared, "nb", _NB_POINTS, parallelism=3, stop_above=1.0)
    finally:
        training.release(prepared)
    return _rounded(found.trials, "accuracy", "precision", "recall", "f1")


def cross_validate(spark, sf_dir):
    prepared = _prepared_quality(spark, sf_dir)
    try:
        return tune.cross_validate(prepared, parallelism=4).folds
    finally:
        training.release(prepared)


def cross_validate_nb(spark, sf_dir):
    """Five folds by the hash of the key, naive Bayes over its smoothings."""
    prepared = training.prepare(_quality(spark, sf_dir), key="doc_id", folds=5)
    try:
        found = tune.cross_validate(
            prepared, {"smoothing": [0.5, 1.0, 2.0]}, folds=5, parallelism=3, family="nb")
    finally:
        training.release(prepared)
    return _rounded(found.folds.select("trial", "params", "f1"), "f1")


# A part of the grid of forests: 384 of its points, which two fits serve.
_FOREST_PART = {
    "numTrees": (10, 50), "maxDepth": (3, 4, 5, 10), "minInstancesPerNode": (1,), "maxBins": (32,),
    "subsamplingRate": (0.8,), "featureSubsetStrategy": ("sqrt",),
}


def forest_search(spark, sf_dir):
    """Many points of the grid of forests, read off one deep forest for each impurity."""
    numbered_points = ((t, tune.grid_point(tune.RF_RANGES, t)) for t in range(tune.grid_size(tune.RF_RANGES)))
    points = [(t, p) for t, p in numbered_points if all(p[k] in v for k, v in _FOREST_PART.items())]
    prepared = _prepared_quality(spark, sf_dir)
    try:
        return forests.search_forests(prepared, points)
    finally:
        training.release(prepared)


def grid_counts(spark, sf_dir):
    """The points of ``grid_best`` from one pass of counts and one of scores."""
    prepared = _prepared_quality(spark, sf_dir)
    try:
        trials = _rounded(bayes_counts.search_counts(prepared, _NB_POINTS), "accuracy", "precision", "recall", "f1")
        rows = trials.orderBy("trial").collect()  # a row per point
    finally:
        training.release(prepared)
    first = max(rows, key=lambda r: (r["f1"], -r["trial"]))["trial"]
    return spark.createDataFrame(rows, trials.schema).select(
        "*", F.lit(None).cast("string").alias("error"), (F.col("trial") == first).alias("best"))


def folds_counts(spark, sf_dir):
    """The folds of ``cross_validate_nb`` from one pass of counts and one of scores."""
    prepared = training.prepare(_quality(spark, sf_dir), key="doc_id", folds=5)
    try:
        points = [{"smoothing": s} for s in (0.5, 1.0, 2.0)]
        found = _rounded(bayes_counts.cross_validate_counts(prepared, points, 5).drop("f1_std"), "f1")
        return spark.createDataFrame(found.collect(), found.schema)  # a row per point
    finally:
        training.release(prepared)


def train_job(spark, sf_dir):
    """Store, train from the store, save, load, and predict every document."""
    docs, path, model = _documents(spark, sf_dir), scratch_path(spark, "store"), scratch_path(spark, "model")
    append_unseen(docs.select("text", "category"), path)
    training.train_from_store(spark, path, model, scratch_path(spark, "metrics"), "nb", {"smoothing": 1.0})
    loaded, _ = training.load(spark, model)
    return predict(loaded, docs.select("doc_id", "text")).select("doc_id", "predicted")


def _nb_counts(spark, sf_dir):
    return _naive_bayes(_quality(spark, sf_dir)).counts


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if c in cols else c for c in df.columns))


def metrics(spark, sf_dir):
    scores = evaluate.weighted_metrics(_nb_counts(spark, sf_dir))
    return _rounded(evaluate.metric_rows("nb", scores), "value")


def metric_file(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    store.write_metrics(evaluate.weighted_metrics(_nb_counts(spark, sf_dir)), path)
    names = ("accuracy", "precision", "recall", "f1")
    back = spark.read.schema(", ".join(f"{n} double" for n in names)).csv(path)
    return _rounded(back, *names)


def accuracy(spark, sf_dir):
    docs = _quality(spark, sf_dir)
    held_out = split.hash_split(docs, "doc_id", split.MAIN_SPLIT[0])[1]
    scored = predict(_naive_bayes(docs).model, held_out)
    return _rounded(evaluate.accuracy(scored, "category", "predicted"), "accuracy")


def class_report(spark, sf_dir):
    report = evaluate.classification_report(_nb_counts(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


def leaderboard(spark, sf_dir):
    """Accuracy of the four families on one split; boosting has its own features, the whole TF-IDF."""
    prepared = training.prepare(
        _documents(spark, sf_dir), count_pipeline(FULL_STOP_WORDS),
        split=split.TUNED_SPLIT, key="doc_id",
    )
    settings = {
        "LRModel": ("lr", MAIN_PARAMS),
        "NBModel": ("nb", {}),
        "RFCModel": ("rf", {"numTrees": 10, "maxDepth": 5, "seed": 42}),
    }
    try:
        scores = {
            name: evaluate.weighted_metrics(
                training.local_counts(
                    fit_classifier(prepared.train, family, params, len(prepared.labels))
                    .transform(prepared.test)
                )
            )
            for name, (family, params) in settings.items()
        }
    finally:
        training.release(prepared)
    _, counts = train_boosted_text(
        _documents(spark, sf_dir), "doc_id", settings=boosting.Settings(**_BOOSTED), split=split.TUNED_SPLIT)
    return evaluate.leaderboard(scores | {"BoostedModel": evaluate.weighted_metrics(counts)})


def leaderboard_nb(spark, sf_dir):
    """Ranks of several naive Bayes settings on one split."""
    prepared = _prepared_quality(spark, sf_dir)
    try:
        scores = {
            f"{p['modelType']} {p['smoothing']}": evaluate.weighted_metrics(
                training.local_counts(
                    fit_classifier(prepared.train, "nb", p, len(prepared.labels)).transform(prepared.test)))
            for p in _NB_POINTS
        }
    finally:
        training.release(prepared)
    board = _rounded(evaluate.leaderboard(scores), "score")
    return board.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "model")))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: naive Bayes from raw text to category, on sf0.001."""
    return nb_predict(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "feed_catalog": feed_catalog,
        "feed_items": feed_items,
        "search_projection": search_projection,
        "search_groups": search_groups,
        "source_union": source_union,
        "mixed_union": mixed_union,
        "request_plan": request_plan,
        "archive_keys": archive_keys,
        "message_roundtrip": message_roundtrip,
        "insert_if_absent": insert_if_absent,
        "stream_ingest": stream_ingest,
        "ledger_ingest": ledger_ingest,
        "ledger_scan": ledger_scan,
        "message_rejects": message_rejects,
        "store_scan": store_scan,
        "project_fill": project_fill,
        "csv_dropna": csv_dropna,
        "compose_text": compose,
        "strip_markup": strip_markup,
        "lower_text": lower,
        "gap_tokens": gap_tokens,
        "match_tokens": match_tokens,
        "filtered_tokens": filtered_tokens,
        "count_vectors": count_vectors,
        "tfidf_vectors": tfidf_vectors,
        "tfidf_stages": tfidf_stages,
        "label_index": label_index,
        "label_alpha": label_alpha,
        "label_first_seen": label_first_seen,
        "label_map": label_map,
        "label_lookup": label_lookup,
        "category_profile": category_profile,
        "category_distinct": category_distinct,
        "split_hash": split_hash,
        "split_exact": split_exact,
        "split_random": split_random,
        "batches": batches,
        "batch_bounds": batch_bounds,
        "nb_predict": nb_predict,
        "stream_predict": stream_predict,
        "nb_stream": nb_stream,
        "lr_predict": lr_predict,
        "lr_shares": lr_shares,
        "rf_stump": rf_stump,
        "boosted_stump": boosted_stump,
        "rf_predict": rf_predict,
        "boosted_predict": boosted_predict,
        "softmax_stump": softmax_stump,
        "softmax_tree": softmax_tree,
        "param_grid": param_grid,
        "grid_best": grid_best,
        "grid_search": grid_search,
        "cross_validate": cross_validate,
        "cross_validate_nb": cross_validate_nb,
        "grid_counts": grid_counts,
        "forest_search": forest_search,
        "folds_counts": folds_counts,
        "leaderboard_nb": leaderboard_nb,
        "train_job": train_job,
        "metrics": metrics,
        "metric_file": metric_file,
        "accuracy": accuracy,
        "class_report": class_report,
        "leaderboard": leaderboard,
    } | _optional()[0]


# --- oracles --------------------------------------------------------------------------------


def _in_list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_GAP = r"list_filter(regexp_split_to_array(lower(text), '\W'), lambda x: length(x) >= 1)"
_MATCH = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')"


def _kept(tokens: str, stop_words: list[str]) -> str:
    return f"list_filter({tokens}, lambda w: w NOT IN ({_in_list(stop_words)}))"


def _totals_sql(tokens: str) -> str:
    return f"""
    WITH t AS (SELECT doc_id, unnest({tokens}) AS term FROM documents)
    SELECT term, count(DISTINCT doc_id) AS n_docs, count(*) AS n FROM t GROUP BY term"""


def _tfidf_sql(terms: str = "") -> str:
    return f"""
    WITH all_t AS (SELECT doc_id, unnest({_kept(_MATCH, ENGLISH_STOP_WORDS)}) AS term FROM documents),
    vocab AS (SELECT term FROM all_t GROUP BY term ORDER BY count(*) DESC, term {terms}),
    t AS (SELECT * FROM all_t SEMI JOIN vocab USING (term)),
    tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    w AS (
      SELECT doc_id, term,
             n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS weight
      FROM tf JOIN df USING (term)
    )
    SELECT doc_id, term,
           round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 6) AS value
    FROM w"""



def _softmax_sql(depth: int) -> str:
    """The first round of softmax boosting: a tree per language, by the same whole-number gradients."""
    edges = ", ".join(f"{e!r}::DOUBLE" for e in boosting.TFIDF_EDGES)
    part = lambda g, h: f"(({g})::DOUBLE / {one}) * (({g})::DOUBLE / {one}) / (({h})::DOUBLE / {one} + 1.0::DOUBLE)"
    one = f"{boosting.SCALE}::DOUBLE"
    gain = f"{part('lg', 'lh')} + {part('tg - lg', 'th - lh')} - {part('tg', 'th')}"
    levels = ""
    for i in range(depth):
        levels += f"""
    tot{i} AS (SELECT class, node, sum(g) AS tg, sum(h) AS th FROM state{i} GROUP BY ALL),
    hist{i} AS (
      SELECT class, node, term, bin, sum(g) AS g, sum(h) AS h FROM state{i} JOIN bins USING (doc_id) GROUP BY ALL
    ), cum{i} AS (
      SELECT class, node, term, bin, sum(g) OVER w AS g, sum(h) OVER w AS h,
        sum(g) OVER (PARTITION BY class, node, term) AS fg, sum(h) OVER (PARTITION BY class, node, term) AS fh
      FROM hist{i} WINDOW w AS (PARTITION BY class, node, term ORDER BY bin)
    ), cand{i} AS (
      SELECT class, node, term, bin, false AS absent_left, g AS lg, h AS lh FROM cum{i}
      UNION ALL
      SELECT class, node, term, bin, true, g + tg - fg, h + th - fh FROM cum{i} JOIN tot{i} USING (class, node)
    ), best{i} AS (
      SELECT class, node, term, bin, absent_left, {gain} AS gain FROM cand{i} JOIN tot{i} USING (class, node)
      WHERE lh >= {boosting.SCALE} AND th - lh >= {boosting.SCALE}
      QUALIFY gain > 1e-6 AND row_number() OVER (PARTITION BY class, node ORDER BY gain DESC, term, bin, absent_left) = 1
    ), state{i + 1} AS (
      SELECT s.doc_id, s.class, g, h, 2 * s.node
        + CASE WHEN (CASE WHEN b.bin IS NULL THEN x.absent_left ELSE b.bin <= x.bin END) THEN 0 ELSE 1 END AS node
      FROM state{i} s JOIN best{i} x USING (class, node) LEFT JOIN bins b ON b.doc_id = s.doc_id AND b.term = x.term
    ),"""
    splits = " UNION ALL ".join(f"SELECT * FROM best{i}" for i in range(depth))
    totals = " UNION ALL ".join(f"SELECT * FROM tot{i}" for i in range(depth + 1))
    return f"""
    WITH v AS ({_tfidf_sql().replace("round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 6)", "weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id))")}),
    bins AS (SELECT doc_id, term, (1 + len(list_filter([{edges}], lambda e: e < value)))::INT AS bin FROM v),
    langs AS (SELECT DISTINCT lang AS class FROM documents WHERE lang IS NOT NULL),
    k AS (SELECT 1.0::DOUBLE / count(*) AS p FROM langs),
    state0 AS (
      SELECT doc_id, class, round((p - CASE WHEN lang = class THEN 1 ELSE 0 END) * {boosting.SCALE})::BIGINT AS g,
        round(2 * p * (1 - p) * {boosting.SCALE})::BIGINT AS h, 1 AS node
      FROM documents, langs, k WHERE lang IS NOT NULL
    ),{levels}
    tot{depth} AS (SELECT class, node, sum(g) AS tg, sum(h) AS th FROM state{depth} GROUP BY ALL),
    splits AS ({splits}), totals AS ({totals})
    SELECT class AS category, node::INT AS node, term, bin, absent_left, round(gain, 6) AS gain, NULL::DOUBLE AS weight
    FROM splits
    UNION ALL
    SELECT class, node::INT, NULL, NULL, NULL, NULL,
      round(-0.3::DOUBLE * (tg::DOUBLE / {one}) / (th::DOUBLE / {one} + 1.0::DOUBLE), 6)
    FROM totals ANTI JOIN splits USING (class, node)"""


_DRAW = "(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 6))::BIGINT % 10000)"

_LANG_DOCS = "SELECT doc_id, text, lang AS category FROM documents"
_QUALITY_DOCS = """SELECT d.doc_id, d.text, 'q' || l.quality AS category
                   FROM documents d JOIN labels l USING (doc_id)"""


def _nb_sql(
    docs: str,
    select: str,
    stop_words: list[str] = FEED_STOP_WORDS,
    train_below: int = 7000,
    smoothing: float = 1.0,
    bernoulli: bool = False,
    also: str = "",
) -> str:
    """Naive Bayes trained on the hash-split part, scored on every document.

    ``also`` narrows the training part.

    A Bernoulli model counts a term once per document and also scores the absent terms: the sum
    of their logs is a constant per class, corrected by the terms that are there.
    """
    s = f"{smoothing!r}::DOUBLE"
    if bernoulli:
        amount = "1"
        totals = f"SELECT category, ln(count(*) + 2 * {s}) AS lt FROM train GROUP BY category"
        theta = f"""
      SELECT category, term, th - ln(1 - exp(th)) AS th, ln(1 - exp(th)) AS absent FROM (
        SELECT tot.category, v.term, ln(coalesce(cnt.n, 0) + {s}) - tot.lt AS th
        FROM vocab v CROSS JOIN tot
        LEFT JOIN cnt ON cnt.category = tot.category AND cnt.term = v.term
      )"""
    else:
        amount = "count(*)"
        totals = f"""SELECT category, ln(sum(n) + {s} * (SELECT count(*) FROM vocab)) AS lt
                     FROM cnt GROUP BY category"""
        theta = f"""
      SELECT tot.category, v.term, ln(coalesce(cnt.n, 0) + {s}) - tot.lt AS th, 0.0 AS absent
      FROM vocab v CROSS JOIN tot
      LEFT JOIN cnt ON cnt.category = tot.category AND cnt.term = v.term"""
    return f"""
    WITH docs AS ({docs}),
    t AS (SELECT doc_id, unnest({_kept(_GAP, stop_words)}) AS term FROM docs),
    all_tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY doc_id, term),
    vocab AS (SELECT term FROM all_tf GROUP BY term ORDER BY sum(n) DESC, term LIMIT 10000),
    tf AS (
      SELECT doc_id, term, {amount if bernoulli else 'n'} AS n FROM all_tf JOIN vocab USING (term)
    ),
    train AS (SELECT doc_id, category FROM docs WHERE {_DRAW} < {train_below} {also}),
    prior AS (
      SELECT category,
             ln(count(*) + {s})
             - ln((SELECT count(*) + {s} * count(DISTINCT category) FROM train)) AS lp
      FROM train GROUP BY category
    ),
    cnt AS (SELECT category, term, sum(n) AS n FROM tf JOIN train USING (doc_id) GROUP BY category, term),
    tot AS ({totals}),
    theta AS ({theta}),
    base AS (SELECT category, sum(absent) AS absent FROM theta GROUP BY category),
    part AS (
      SELECT tf.doc_id, theta.category, sum(tf.n * theta.th) AS s
      FROM tf JOIN theta USING (term) GROUP BY tf.doc_id, theta.category
    ),
    nb AS (
      SELECT d.doc_id, any_value(d.category) AS category,
             arg_max(p.category, p.lp + base.absent + coalesce(part.s, 0)) AS predicted
      FROM docs d CROSS JOIN prior p JOIN base ON base.category = p.category
      LEFT JOIN part ON part.doc_id = d.doc_id AND part.category = p.category
      GROUP BY d.doc_id
    )
    {select}"""


def _held_out_sql(train_below: int = 7000, where: str = "") -> str:
    where = where or f"{_DRAW} >= {train_below}"
    return f"""
    , held AS (SELECT category, predicted FROM nb WHERE {where}),
    classes AS (SELECT category AS class FROM held UNION SELECT predicted FROM held),
    scores AS (
      SELECT class,
             count(*) FILTER (category = class AND predicted = class) AS tp,
             count(*) FILTER (category = class) AS support,
             count(*) FILTER (predicted = class) AS predicted
      FROM classes CROSS JOIN held GROUP BY class
    ),
    per_class AS (
      SELECT class, tp, support,
             coalesce(tp / nullif(predicted, 0), 0.0) AS precision,
             coalesce(tp / nullif(support, 0), 0.0) AS recall,
             coalesce(2.0 * tp / nullif(predicted + support, 0), 0.0) AS f1
      FROM scores
    ),
    weighted AS (
      SELECT sum(tp) / sum(support) AS accuracy,
             sum(precision * support) / sum(support) AS precision,
             sum(recall * support) / sum(support) AS recall,
             sum(f1 * support) / sum(support) AS f1
      FROM per_class
    )"""


_HELD_OUT = _held_out_sql()


def _unpivoted() -> str:
    return " UNION ALL ".join(
        f"SELECT 'nb' AS model, '{m}' AS metric, round({m}, 6) AS value FROM weighted"
        for m in ("accuracy", "precision", "recall", "f1")
    )


_REPORT = _HELD_OUT + """
    , ordered AS (
      SELECT category,
             CAST(CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS DOUBLE) AS VARCHAR) AS label
      FROM docs GROUP BY category
    )
    SELECT o.label AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1, 6) AS f1, support
    FROM per_class JOIN ordered o ON o.category = per_class.class
    UNION ALL
    SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
           round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL
    SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
           CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL
    SELECT 'weighted avg', round(any_value(w.precision), 6), round(any_value(w.recall), 6),
           round(any_value(w.f1), 6), CAST(sum(support) AS BIGINT) FROM per_class, weighted w"""

_SEARCH_TURNS = """
    SELECT CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS category, role AS title,
           CAST(NULL AS VARCHAR) AS published_date, concat('talk/', conv_id, '/', turn) AS link,
           'talk' AS clean_url, text AS summary, CAST(NULL AS VARCHAR) AS media, role AS topic
    FROM conversations"""

_MIXED = f"""
    SELECT text, lang AS category, CAST(NULL AS VARCHAR) AS title,
           CAST(NULL AS VARCHAR) AS published_date, CAST(NULL AS VARCHAR) AS link,
           CAST(NULL AS VARCHAR) AS clean_url, CAST(NULL AS VARCHAR) AS summary,
           CAST(NULL AS VARCHAR) AS media, CAST(NULL AS VARCHAR) AS topic
    FROM documents UNION ALL {_SEARCH_TURNS}"""


def _label_sql(order: str) -> str:
    return f"""
    WITH o AS (
      SELECT lang AS category, CAST(row_number() OVER (ORDER BY {order}) - 1 AS DOUBLE) AS label
      FROM documents GROUP BY lang
    )
    SELECT d.doc_id, o.category, o.label FROM documents d JOIN o ON o.category = d.lang"""


def _first_seen_sql(column: str) -> str:
    return f"""SELECT {column} AS category, row_number() OVER (ORDER BY min(doc_id)) - 1 AS "categoryId",
               count(*) AS count FROM documents GROUP BY {column}"""


def _search_sql() -> str:
    """Scores of every point in ``_NB_POINTS``, and which is best."""
    scores = "accuracy", "precision", "recall", "f1"
    trials = " UNION ALL ".join(
        "SELECT * FROM (" + _nb_sql(
            _QUALITY_DOCS,
            _held_out_sql(7778) + f"""
            SELECT {i} AS trial, '{json.dumps(p)}' AS params,
                   {', '.join(f'round({m}, 6) AS {m}' for m in scores)} FROM weighted""",
            FULL_STOP_WORDS, 7778, p["smoothing"], p["modelType"] == "bernoulli",
        ) + ")"
        for i, p in enumerate(_NB_POINTS)
    )
    return f"""
    SELECT trial, params, accuracy, precision, recall, f1, CAST(NULL AS VARCHAR) AS error,
           row_number() OVER (ORDER BY f1 DESC, trial) = 1 AS best
    FROM ({trials})"""


_FOLD = "(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 7, 6))::BIGINT % 5)"


def _folds_sql() -> str:
    """Mean F1 over five folds of the training part, for three smoothings."""
    trials = " UNION ALL ".join(
        "SELECT * FROM (" + _nb_sql(
            _QUALITY_DOCS,
            _held_out_sql(where=f"{_DRAW} < 7000 AND {_FOLD} = {fold}")
            + f""" SELECT {i} AS trial, '{{"smoothing": {s}}}' AS params, f1 FROM weighted""",
            smoothing=s, also=f"AND {_FOLD} <> {fold}",
        ) + ")"
        for i, s in enumerate((0.5, 1.0, 2.0)) for fold in range(5)
    )
    return f"SELECT trial, params, round(avg(f1), 6) AS f1 FROM ({trials}) GROUP BY trial, params"


# Presence of the 10,000 most frequent terms, and how often each comes with each class.
_PRESENCE = f"""
    WITH docs AS ({_LANG_DOCS}),
    t AS (SELECT doc_id, unnest({_kept(_GAP, FEED_STOP_WORDS)}) AS term FROM docs),
    vocab AS (
      SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS place
      FROM t GROUP BY term ORDER BY count(*) DESC, term LIMIT 10000
    ),
    tf AS (SELECT DISTINCT doc_id, term FROM t JOIN vocab USING (term)),
    classes AS (
      SELECT category, count(*) AS total, row_number() OVER (ORDER BY count(*) DESC, category) AS class
      FROM docs GROUP BY category
    ),
    n AS (SELECT count(*) AS n FROM docs),
    seen AS (SELECT term, count(*) AS with_term FROM tf GROUP BY term),
    both_ AS (SELECT term, category, count(*) AS c FROM tf JOIN docs USING (doc_id) GROUP BY term, category),
    cells AS (
      SELECT term, place, category, class, total, n, with_term, coalesce(c, 0) AS c
      FROM vocab CROSS JOIN classes CROSS JOIN n JOIN seen USING (term) LEFT JOIN both_ USING (term, category)
      WHERE with_term < n
    )"""

_RF_STUMP = _PRESENCE + """,
    best AS (
      SELECT term FROM cells GROUP BY term, place, n, with_term
      ORDER BY round(sum(c * c) / with_term + sum((total - c) * (total - c)) / (n - with_term), 9) DESC, place LIMIT 1
    ),
    leaf AS (
      SELECT arg_max(category, c * 1000 - class) AS yes, arg_max(category, (total - c) * 1000 - class) AS no
      FROM cells JOIN best USING (term)
    )
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM tf JOIN best USING (term)) THEN yes ELSE no END AS predicted
    FROM docs CROSS JOIN leaf"""

_BOOSTED_STUMP = _PRESENCE + """,
    split AS (
      SELECT *, 2 * c - with_term AS s1, 2 * (total - c) - (n - with_term) AS s0 FROM cells
    ),
    best AS (
      SELECT category, class, term, s1 / with_term AS yes, s0 / (n - with_term) AS no FROM split
      QUALIFY row_number() OVER (
        PARTITION BY category
        ORDER BY round(s1 * s1 / with_term + s0 * s0 / (n - with_term), 9) DESC, place) = 1
    ),
    margin AS (
      SELECT doc_id, best.category, class, CASE WHEN tf.doc_id IS NULL THEN no ELSE yes END AS m
      FROM docs CROSS JOIN best LEFT JOIN tf USING (doc_id, term)
    )
    SELECT doc_id, category AS predicted FROM margin
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(m, 9) DESC, class) = 1"""


def _leaderboard_sql() -> str:
    """Accuracy and rank of the points of ``_search_sql``."""
    return f"""
    SELECT *, CAST(row_number() OVER (ORDER BY score DESC, model) AS INTEGER) AS rank FROM (
      SELECT concat(params::JSON ->> '$.modelType', ' ', params::JSON ->> '$.smoothing') AS model, accuracy AS score
      FROM ({_search_sql()}))"""


def _grid_sql() -> str:
    source = """SELECT 'lang' AS target, count(DISTINCT lang) AS n_classes FROM documents
                UNION ALL SELECT 'quality', count(DISTINCT quality) FROM labels
                UNION ALL SELECT 'toxic', count(DISTINCT toxic) FROM labels"""
    columns, trial, joins = [], "CAST(0 AS BIGINT)", []
    for name, values in tune.LR_RANGES.items():
        def literal(v):
            if isinstance(v, bool):
                return str(v).lower()
            if isinstance(v, float):
                return f"{v!r}::DOUBLE"
            return f"'{v}'" if isinstance(v, str) else f"{v}::INTEGER"

        rows = ", ".join(f"({i}, {literal(v)})" for i, v in enumerate(values))
        joins.append(f'CROSS JOIN (VALUES {rows}) AS g_{name}(i, "{name}")')
        trial = f"({trial} * {len(values)} + g_{name}.i)"
        columns.append(f'g_{name}."{name}"')
    return f"""
    SELECT target, n_classes, CAST({trial} AS BIGINT) AS trial, {', '.join(columns)}
    FROM ({source}) {' '.join(joins)}
    WHERE g_family."family" <> 'binomial' OR n_classes <= 2"""


def oracle_sql() -> dict[str, str]:
    hash_part = f"""
    SELECT doc_id, CASE WHEN {_DRAW} < 7000 THEN 0 ELSE 1 END AS main_part,
           CASE WHEN {_DRAW} < 7778 THEN 0 ELSE 1 END AS tuned_part,
           CASE WHEN {_DRAW} < 8000 THEN 0 ELSE 1 END AS boosted_part
    FROM documents"""
    complete = """
    WITH p AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages),
    ok AS (SELECT * FROM p WHERE len(links) > 0 AND NOT contains(array_to_string(links, ' '), ','))"""
    nb_predict_sql = _nb_sql(_LANG_DOCS, "SELECT doc_id, predicted FROM nb")
    return {
        "feed_catalog": """
            WITH p AS (
              SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS category,
                     regexp_extract_all(html, 'href="([^"]*)"', 1) AS urls
              FROM pages
            )
            SELECT page_id, category, CAST(unnest(range(len(urls))) AS INTEGER) AS position,
                   unnest(urls) AS url FROM p""",
        "feed_items": r"""
            WITH p AS (
              SELECT page_id, url AS category,
                     regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1) || html,
                                    '<[^>]*>', '', 'g') AS text
              FROM pages
            )
            SELECT * FROM p WHERE NOT contains(text, '<')""",
        "search_projection": complete + """
            , a AS (SELECT page_id, url, unnest(links) AS link FROM ok)
            SELECT page_id, url || link AS title, CAST(NULL AS VARCHAR) AS published_date, link,
                   url AS clean_url, 'to ' || link AS summary, CAST(NULL AS VARCHAR) AS media,
                   'link' AS topic FROM a""",
        "search_groups": complete + """
            SELECT page_id, len(links) AS n_articles, array_to_string(links, ' ') AS links FROM ok""",
        "source_union": """
            SELECT text, lang AS category FROM documents
            UNION ALL SELECT text, role FROM conversations
            UNION ALL SELECT html, 'page' FROM pages
            UNION ALL SELECT text, 'benchmark' FROM benchmark""",
        "mixed_union": _MIXED,
        "request_plan": """
            WITH c AS (
              SELECT event_id, event_type, length(event_type) AS n,
                     CAST(floor(value / 10) AS BIGINT) // length(event_type) AS hits
              FROM events
            ),
            a AS (SELECT event_id, event_type, hits, unnest(range(1, n + 1)) AS j FROM c),
            h AS (SELECT *, unnest(range(hits)) AS h FROM a)
            SELECT event_id, event_type AS config_key, j AS api_index, h AS hit,
                   concat('https://', event_type, '/', j) AS url, concat(j, '-', h, '.json') AS output_name,
                   event_type AS topic, CAST(j AS VARCHAR) AS page, 'key,host' AS header_names,
                   CAST(CASE WHEN j % 2 = 0 THEN j END AS INTEGER) AS api_limit
            FROM h""",
        "archive_keys": """
            WITH p AS (
              SELECT o_orderkey,
                     concat('./Data/', year(o_orderdate),
                            CASE WHEN o_orderstatus <> 'P' THEN concat('-', month(o_orderdate)) ELSE '' END,
                            '.json') AS path
              FROM orders
            ),
            s AS (
              SELECT *, string_split(split_part(string_split(path, '/')[-1], '.', 1), '-') AS k FROM p
            )
            SELECT o_orderkey, path, len(k) = 2 AS archive_ok,
                   CASE WHEN len(k) = 2 THEN k[1] END AS year,
                   CASE WHEN len(k) = 2 THEN k[2] END AS month,
                   CASE WHEN len(k) = 2 THEN concat('https://api.nytimes.com/svc/archive/v1/', k[1], '/', k[2],
                                                    '.json') END AS request_url,
                   CASE WHEN len(k) = 2 THEN concat('./Data/NYTimeData/', k[1], '-', k[2], '.json') END
                     AS output_name
            FROM s""",
        "message_roundtrip": "SELECT text, lang AS category FROM documents",
        "message_rejects": """
            SELECT CASE event_id % 4 WHEN 1 THEN 'not a list' WHEN 2 THEN 'not JSON' ELSE 'null' END AS reason,
                   count(*) AS n FROM events WHERE event_id % 4 <> 0 GROUP BY 1""",
        "insert_if_absent": """
            SELECT text, lang AS category FROM documents UNION SELECT text, role FROM conversations""",
        "stream_ingest": f"SELECT DISTINCT * FROM ({_MIXED})",
        "ledger_ingest": """
            SELECT DISTINCT text, lang AS category, CAST(NULL AS VARCHAR) AS reason, 1 AS n FROM documents
            UNION ALL SELECT props, NULL, 'not a list', count(*) FROM events GROUP BY props""",
        "ledger_scan": "SELECT DISTINCT text, lang AS category FROM documents WHERE lang = 'fr'",
        "store_scan": "SELECT DISTINCT text, lang AS category FROM documents WHERE lang = 'fr'",
        "project_fill": """
            SELECT CASE WHEN doc_id = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS doc_id,
                   coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                   CASE WHEN coalesce(quality, 0) = 0 THEN '' ELSE CAST(quality AS VARCHAR) END AS quality,
                   CASE WHEN coalesce(toxic, 0) = 0 THEN '' ELSE CAST(toxic AS VARCHAR) END AS toxic
            FROM documents LEFT JOIN labels USING (doc_id)""",
        "csv_dropna": f"""
            SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang AS category,
                   CAST(quality AS VARCHAR) AS quality
            FROM documents JOIN labels USING (doc_id)
            WHERE quality IS NOT NULL AND text NOT IN ({_in_list(store.CSV_MISSING)})""",
        "compose_text": "SELECT page_id, url || html AS text FROM pages",
        "strip_markup": """
            SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS text FROM pages
            WHERE NOT contains(regexp_replace(html, '<[^>]*>', '', 'g'), '<')""",
        "lower_text": "SELECT doc_id, lower(text) AS text FROM documents",
        "gap_tokens": _totals_sql(_GAP),
        "match_tokens": _totals_sql(_MATCH),
        "filtered_tokens": _totals_sql(_kept(_GAP, FULL_STOP_WORDS)),
        "count_vectors": f"""
            WITH t AS (SELECT doc_id, unnest({_kept(_GAP, FEED_STOP_WORDS)}) AS term FROM documents),
            vocab AS (SELECT term FROM t GROUP BY term ORDER BY count(*) DESC, term LIMIT 10000)
            SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS value FROM t JOIN vocab USING (term)
            GROUP BY doc_id, term""",
        "tfidf_vectors": _tfidf_sql(),
        "tfidf_stages": _tfidf_sql(),
        "label_index": _label_sql("count(*) DESC, lang"),
        "label_alpha": _label_sql("lang"),
        "label_first_seen": f'SELECT category, "categoryId" FROM ({_first_seen_sql("source")})',
        "label_map": """
            SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS INTEGER) AS label,
                   lang AS category FROM documents GROUP BY lang""",
        "label_lookup": _label_sql("count(*) DESC, lang"),
        "category_profile": _first_seen_sql("lang"),
        "category_distinct": f'SELECT category, "categoryId" FROM ({_first_seen_sql("lang")})',
        "split_hash": hash_part,
        "split_exact": """
            SELECT doc_id, CASE WHEN row_number() OVER (
              ORDER BY concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT, doc_id)
              <= (SELECT ceil(count(*) / 5.0) FROM documents) THEN 1 ELSE 0 END AS part
            FROM documents""",
        "split_random": """
            SELECT part::INTEGER AS part, count(*) = count(DISTINCT doc_id) AS disjoint, count(*) > 0 AS in_share
            FROM documents CROSS JOIN (SELECT unnest([0, 1]) AS part) GROUP BY part""",
        "batches": """
            SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 10000 AS batch FROM orders""",
        "batch_bounds": """
            WITH n AS (SELECT count(*) AS n FROM events),
            b AS (SELECT n, unnest(range(n // 10000 + 1)) AS batch FROM n)
            SELECT batch, batch * 10000 AS start_row, least(batch * 10000 + 10000, n) AS end_row FROM b""",
        "nb_predict": nb_predict_sql,
        "stream_predict": nb_predict_sql,
        "nb_stream": _nb_sql(_LANG_DOCS, "SELECT doc_id, predicted FROM nb", train_below=10_000).replace("LIMIT 10000", ""),
        "param_grid": _grid_sql(),
        "grid_best": _search_sql(),
        "cross_validate_nb": _folds_sql(),
        "grid_counts": _search_sql(),
        "folds_counts": _folds_sql(),
        "leaderboard_nb": _leaderboard_sql(),
        "lr_shares": """
            SELECT CAST(doc_id % 3 * 2 + CAST(n_chars > 1500 AS INTEGER) AS INTEGER) AS "group",
                   count(*) AS size, count(*) FILTER (lang = 'en') AS hits,
                   CASE WHEN avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                     AS prediction
            FROM documents GROUP BY 1""",
        "rf_stump": _RF_STUMP,
        "boosted_stump": _BOOSTED_STUMP,
        "softmax_stump": _softmax_sql(1),
        "softmax_tree": _softmax_sql(2),
        "train_job": "SELECT d.doc_id, predicted FROM documents d JOIN (" + _nb_sql(
            "SELECT DISTINCT md5(text) AS doc_id, text, lang AS category FROM documents",
            "SELECT doc_id, predicted FROM nb") + ") nb ON nb.doc_id = md5(d.text)",
        "metrics": _nb_sql(_QUALITY_DOCS, f"{_HELD_OUT} {_unpivoted()}"),
        "metric_file": _nb_sql(
            _QUALITY_DOCS,
            _HELD_OUT + """ SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
                            round(recall, 6) AS recall, round(f1, 6) AS f1 FROM weighted""",
        ),
        "accuracy": _nb_sql(
            _QUALITY_DOCS,
            """SELECT round(avg(CASE WHEN category = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy
               FROM nb WHERE """ + f"{_DRAW} >= 7000",
        ),
        "class_report": _nb_sql(_QUALITY_DOCS, _REPORT),
    } | _optional()[1]
