"""Count and TF-IDF features, as pipeline stages and as a table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.functions.tokens import term_counts
from pressroom.operators.blocks import encoded, lists, with_block_terms
from pressroom.operators.split import with_row_index
from pressroom.session import numbered, scratch_path, write_and_read

# More terms than a model of the library can number.
_EVERY_TERM = (1 << 31) - 1
# The most terms that are broadcast as hot in tfidf_table.
HOT_TERMS = 10_000


def vocabulary(df: DataFrame, tokens_col: str, size: int) -> DataFrame:
    """``(term, n)``: the ``size`` most frequent terms by total count, ties in term order.

    Counts combine before the shuffle. How many terms have which count tells the count at the cut;
    terms above it are kept as they are, and only those tied at it are put in order.
    """
    # An inner explode of a column infers a filter that would run the tokenizer a second time.
    counted = (
        df.select(F.explode_outer(tokens_col).alias("term")).where("term IS NOT NULL")
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = write_and_read(counted, "term-counts")
    # one row per distinct count, in the order of the counts: fewer than the square root of all tokens
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    cut = (counted.groupBy("n").agg(F.count(F.lit(1)).alias("terms"))
           .withColumn("before", F.coalesce(F.sum("terms").over(above), F.lit(0)))
           .where(F.col("before") < size).agg(F.min("n").alias("n"), F.max("before").alias("before"))).first()
    if cut["n"] is None:
        return counted.limit(0)
    tied = counted.where(F.col("n") == cut["n"]).orderBy("term").limit(size - cut["before"])
    return counted.where(F.col("n") > cut["n"]).unionByName(tied).orderBy(F.desc("n"), "term")


class VocabularyVectorizer(
    Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Count vectors over the most frequent terms, with a repeatable vocabulary.

    The built-in estimator leaves ties at the cut unordered; this one orders them by term, so two
    fits on the same data agree. ``vocabSize=0`` keeps every term, where there is no cut and the
    built-in one serves. A model of the library lists its terms on every node whatever their number;
    ``tfidf_table`` does not. Fits to the built-in ``CountVectorizerModel``.
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "terms to keep, 0 for all",
                      typeConverter=TypeConverters.toInt)
    binary = Param(Params._dummy(), "binary", "1 for any count above 0",
                   typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, vocabSize=10_000, binary=False):
        super().__init__()
        self._setDefault(vocabSize=10_000, binary=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        columns = {"inputCol": self.getInputCol(), "outputCol": self.getOutputCol()}
        size, binary = self.getOrDefault(self.vocabSize), self.getOrDefault(self.binary)
        if size == 0:
            return CountVectorizer(vocabSize=_EVERY_TERM, binary=binary, **columns).fit(dataset)
        terms = [r["term"] for r in vocabulary(dataset, self.getInputCol(), size).collect()]
        return CountVectorizerModel.from_vocabulary(terms, binary=binary, **columns)


class SmoothIdfScaler(
    Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Scale count vectors by ``ln((1 + n) / (1 + df)) + 1``.

    The built-in IDF has no ``+ 1``, which the weights of a product cannot add later, so the
    fitted stage is an ``ElementwiseProduct`` of idf + 1.
    """

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        idf = IDF(inputCol=self.getInputCol(), outputCol=self.getOutputCol()).fit(dataset).idf
        return ElementwiseProduct(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
            scalingVec=Vectors.dense(idf.toArray() + 1.0),
        )


def vector_entries(df: DataFrame, vector_col: str, *keep: str) -> DataFrame:
    """``(…keep, index, value)`` of the non-zero entries of sparse vectors."""
    raw = df.select(*keep, F.unwrap_udt(vector_col).alias("v"))
    pairs = F.arrays_zip(F.col("v.indices").alias("index"), F.col("v.values").alias("value"))
    return raw.select(*keep, F.inline(pairs)).where("value != 0")


def vector_terms(df: DataFrame, vector_col: str, terms: list[str], *keep: str) -> DataFrame:
    """``(…keep, term, value)``: vector entries named by the model's vocabulary."""
    entries = vector_entries(df, vector_col, *keep)
    names = numbered(df.sparkSession, terms, "index", "term")
    return entries.join(names, "index").select(*keep, "term", "value")


def document_frequencies(df: DataFrame, tokens_col: str) -> DataFrame:
    """``(term, df)``: in how many rows each term is, written once."""
    # the outer form, since an inner one infers a filter that would run the tokenizer a second time
    terms = df.select(F.explode_outer(F.array_distinct(tokens_col)).alias("term")).where("term IS NOT NULL")
    return write_and_read(
        terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")


def numbered_terms(df: DataFrame, tokens_col: str) -> DataFrame:
    """``(term, df, index)``: every term with its number in the order of the terms, from 0.

    Terms are dealt to ranges of their order and numbered there, so the vocabulary is in no place
    whole, however large.
    """
    return write_and_read(
        with_row_index(document_frequencies(df, tokens_col), "term", "index"), "terms")


def tfidf_table(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """``(id, term, value)`` TF-IDF over the whole vocabulary, however large.

    value = n * (ln((1 + docs) / (1 + df)) + 1), each document scaled to length 1.
    """
    frequencies = document_frequencies(df, tokens_col)
    return _scaled(df, id_col, tokens_col, frequencies, df.count()).select(id_col, "term", "value")


def tfidf_rows(
    df: DataFrame, id_col: str, tokens_col: str, terms: DataFrame, docs: int, *keep: str
) -> DataFrame:
    """``(id, …keep, indices, values)``: the TF-IDF of each row as two arrays, by term number.

    ``terms`` is a table as ``numbered_terms`` makes it, of these rows or of others; terms that it
    lacks are left out, as a fitted vocabulary does. Rows without any term have empty arrays. Ids
    should be distinct; rows are looked up block by block, and no posting is shuffled.
    """
    kept = [id_col, *(c for c in keep if c != id_col)]
    rows, repeated = _tfidf_parts(*encoded(df, tokens_col, *kept), terms, docs, kept)
    return rows if repeated is None else rows.unionByName(repeated)


def _tfidf_parts(
    encoded_rows: DataFrame, found: DataFrame, terms: DataFrame, docs: int, kept: list[str],
) -> tuple[DataFrame, DataFrame | None]:
    """``tfidf_rows`` of ids that come once, and of others, whose rows each get the entries of all of them."""
    id_col = kept[0]
    schema = T.StructType([*encoded_rows.select(*kept).schema.fields, *T._parse_datatype_string(
        "indices array<long>, values array<double>, _square double").fields])

    def scale(rows: pa.Table, row: np.ndarray, n: np.ndarray, at: np.ndarray, known: pa.Table) -> pa.Table:
        idf = np.log((1.0 + docs) / (1.0 + known.column("df").to_numpy())) + 1.0
        weight = n * idf[at]
        square = np.bincount(row, weight * weight, minlength=rows.num_rows)
        value = weight / np.sqrt(square)[row]
        index = known.column("index").to_numpy()[at].astype(np.int64)
        return pa.table([*(rows.column(c) for c in kept), lists(index, row, rows.num_rows),
                         lists(value, row, rows.num_rows), pa.array(square, pa.float64())], names=schema.names)

    scaled = with_block_terms(encoded_rows, found, terms, ["df", "index"], scale, schema)
    repeats = encoded_rows.groupBy(F.col(id_col).alias("_id")).count().where("count > 1").select("_id")
    if repeats.isEmpty():
        return scaled.drop("_square"), None
    scaled, repeats = write_and_read(scaled, "tfidf"), write_and_read(repeats, "repeated-ids")
    same = scaled[id_col].eqNullSafe(repeats["_id"])
    once = scaled.join(repeats, same, "left_anti").drop("_square")
    again = scaled.join(repeats, same).drop("_id")
    weights = F.transform("values", lambda v: v * F.sqrt("_square"))
    merged = again.groupBy(F.col(id_col).alias("_id")).agg(
        F.flatten(F.collect_list(F.arrays_zip(F.col("indices").alias("index"), weights.alias("value")))).alias("_p"),
        F.sqrt(F.sum("_square")).alias("_norm"))
    pairs = F.sort_array(F.transform("_p", lambda p: F.struct(p["index"].alias("index"), (p["value"] / F.col("_norm")).alias("value"))))
    merged = merged.select("_id", pairs.alias("_p")).select(
        "_id", F.col("_p.index").alias("indices"), F.col("_p.value").alias("values"))
    again = again.select(*kept)
    return once, again.join(merged, again[id_col].eqNullSafe(merged["_id"])).drop("_id")


def with_terms(
    postings: DataFrame, id_col: str, terms: DataFrame, count_col: str, *columns: str
) -> DataFrame:
    """``postings`` (of ``id_col`` and ``term``) with columns of a table by term; rows of others fall out.

    ``count_col`` tells how many postings a term has about. Terms in more than 1/HOT_TERMS of all
    postings number fewer than HOT_TERMS, so that part may be broadcast; it takes the heavy terms out
    of the join on ``term``, whose remaining keys are all small. Hot rows pass the join under a key of
    their own document, so they spread evenly.
    """
    total = terms.agg(F.coalesce(F.sum(count_col), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col(count_col) * HOT_TERMS > F.lit(total)
    hot = terms.where(is_hot).select(
        "term", F.lit(True).alias("_hot"), *(F.col(c).alias(f"hot_{c}") for c in columns))
    cold = terms.where(~is_hot).select(
        F.concat(F.lit("t"), "term").alias("_probe"), F.lit(True).alias("_cold"),
        *(F.col(c).alias(f"cold_{c}") for c in columns))
    probe = F.when(F.col("_hot").isNull(), F.concat(F.lit("t"), "term")).otherwise(
        F.concat(F.lit("d"), F.col(id_col).cast("string")))
    return (
        postings.join(F.broadcast(hot), "term", "left").withColumn("_probe", probe)
        .join(cold, "_probe", "left").where("_hot OR _cold")
        .select(*postings.columns, *(F.coalesce(f"hot_{c}", f"cold_{c}").alias(c) for c in columns)))


def _scaled(
    df: DataFrame, id_col: str, tokens_col: str, frequencies: DataFrame, docs: int, *also: str
) -> DataFrame:
    """``(id, term, …also, value)``: weighted postings, by the frequencies and what else they hold."""
    postings = df.select(id_col, F.inline(term_counts(F.col(tokens_col))))
    weighed = with_terms(postings, id_col, frequencies, "df", "df", *also).withColumn(
        "weight", _weight(F.col("df"), docs))
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
    return weighed.select(id_col, "term", *also, (F.col("weight") / norm).alias("value"))


def _weight(df: Column, docs: int) -> Column:
    return F.col("n") * (F.log((F.lit(1.0) + docs) / (F.lit(1.0) + df)) + 1.0)


class TermTable(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """TF-IDF of any vocabulary as a stage: the fitted model names a written table of numbered terms.

    ``transform`` adds ``outputCol``, a struct of ``indices`` and ``values`` (arrays by term number).
    It joins, so rows need a distinct id, the column ``idCol``. The table lies at ``path``, or in
    the scratch folder where none is given; a model that is to be kept needs a path to keep.
    """

    idCol = Param(Params._dummy(), "idCol", "column of distinct row ids", typeConverter=TypeConverters.toString)
    path = Param(Params._dummy(), "path", "where the terms are written", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, idCol=None, path=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _model(self, frequencies: DataFrame, docs: int) -> TermTableModel:
        spark = frequencies.sparkSession
        path = self.getOrDefault(self.path) if self.isSet(self.path) else scratch_path(spark, "term-table")
        with_row_index(frequencies, "term", "index").write.mode("overwrite").parquet(path)
        return TermTableModel(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
            idCol=self.getOrDefault(self.idCol), path=path, docs=docs)

    def _fit(self, dataset: DataFrame) -> TermTableModel:
        return self._model(document_frequencies(dataset, self.getInputCol()), dataset.count())

    def fit_rows(self, dataset: DataFrame, *keep: str) -> tuple[TermTableModel, DataFrame]:
        """The fitted model and its ``rows`` of the same dataset, whose texts are read once."""
        kept = [self.getOrDefault(self.idCol), *(c for c in keep if c != self.getOrDefault(self.idCol))]
        rows, found = encoded(dataset, self.getInputCol(), *kept)
        frequencies = found.groupBy(F.col("_term").alias("term")).agg(F.sum("_in").alias("df"))
        model = self._model(frequencies, rows.count())
        return model, model._rows(rows, found, kept)


class TermTableModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """What ``TermTable`` fits: where the terms are, and how many rows they come from."""

    idCol, path = TermTable.idCol, TermTable.path
    docs = Param(Params._dummy(), "docs", "rows fitted on", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, idCol=None, path=None, docs=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def terms(self, spark: SparkSession) -> DataFrame:
        """``(term, df, index)`` of the fitted vocabulary."""
        return spark.read.schema("term string, df long, index long").parquet(self.getOrDefault(self.path))

    def rows(self, dataset: DataFrame, *keep: str) -> DataFrame:
        """``(id, …keep, indices, values)`` of a dataset: what ``transform`` adds, without its join.

        A repeated id gives a row for each pair of its rows, as that join does.
        """
        kept = [self.getOrDefault(self.idCol), *(c for c in keep if c != self.getOrDefault(self.idCol))]
        return self._rows(*encoded(dataset, self.getInputCol(), *kept), kept)

    def _rows(self, encoded_rows: DataFrame, found: DataFrame, kept: list[str]) -> DataFrame:
        key, terms = kept[0], self.terms(found.sparkSession)
        once, repeated = _tfidf_parts(encoded_rows, found, terms, self.getOrDefault(self.docs), kept)
        if repeated is None:
            return once
        entries = repeated.select(F.col(key).alias("_row"), "indices", "values")
        others = repeated.drop("indices", "values")
        return once.unionByName(others.join(entries, others[key].eqNullSafe(entries["_row"])).drop("_row"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key = self.getOrDefault(self.idCol)
        rows = tfidf_rows(
            dataset.select(key, self.getInputCol()), key, self.getInputCol(),
            self.terms(dataset.sparkSession), self.getOrDefault(self.docs))
        rows = rows.select(F.col(key).alias("_row"), F.struct("indices", "values").alias(self.getOutputCol()))
        return dataset.join(rows, dataset[key].eqNullSafe(rows["_row"])).drop("_row")
