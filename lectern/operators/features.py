"""Bag-of-words, TF-IDF and hashed features.

The vocabulary comes from one aggregation over the corpus, ordered by corpus
count and then by word, so it is the same whatever the partitioning.  Everything
after that is a narrow transform by standard ML stages, or a join where the
vocabulary is too large for a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    RegexTokenizer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import scores as sc
from lectern.functions import text as tx
from lectern.functions.stopwords import ENGLISH_STOP_WORDS
from lectern.operators.ranking import largest, numbered
from lectern.plans.storage import (
    MAX_LOOKUP_BYTES,
    MAX_LOOKUP_ROWS,
    LookupSize,
    lookup_join,
    materialize,
    materialize_vectors,
    measure_lookup,
)


@dataclass(frozen=True)
class FeatureSpec:
    """How a text becomes a feature vector; training and scoring share one."""

    pattern: str = tx.LETTERS_ONLY
    min_token_length: int = tx.MIN_TOKEN_LENGTH
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS
    vocab_size: int = 20000
    min_df: float = 5
    binary_tf: bool = True
    use_idf: bool = True
    input_col: str = "text"
    output_col: str = "features"


def token_stages(spec: FeatureSpec) -> list:
    """Tokenizer and stop-word filter.

    Tokens leave the tokenizer in lower case, so the filter ignores case by
    comparing with the lower-cased list, without converting every token again.
    """
    return [
        RegexTokenizer(
            inputCol=spec.input_col,
            outputCol="tokens",
            pattern=spec.pattern,
            toLowercase=True,
            minTokenLength=spec.min_token_length,
        ),
        StopWordsRemover(
            inputCol="tokens",
            outputCol="filtered_tokens",
            stopWords=[w.lower() for w in spec.stop_words],
            caseSensitive=True,
        ),
    ]


def word_statistics(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Per word: occurrences in the corpus and documents that contain it.

    Both come from one explode and one aggregation with map-side partials.  The
    pieces of a document are sorted, so a piece that differs from its
    predecessor is the first of its kind there.  Each document also gets one
    empty piece; the row of the empty word therefore holds the number of
    documents, including those without any token.
    """
    word, before = F.col("word"), F.col("before")
    pieces = df.select(
        F.sort_array(
            F.concat(F.array(F.lit("")), tx.split_words(F.col(spec.input_col), spec.pattern))
        ).alias("pieces")
    )
    return (
        pieces.select(
            F.inline(
                F.arrays_zip(
                    F.col("pieces").alias("word"),
                    F.concat(F.array(F.lit(None).cast("string")), F.col("pieces")).alias("before"),
                )
            )
        )
        .filter(
            (word == "")
            | (
                tx.is_token(word, spec.min_token_length)
                & ~tx.is_stop_word(word, spec.stop_words)
            )
        )
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("corpus_count"),
            F.count_if(before.isNull() | (before != word)).alias("doc_freq"),
        )
    )


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary: a written table with one row per word."""

    table: DataFrame  # idx, word, corpus_count, doc_freq, idf
    n_docs: int
    size: LookupSize

    @cached_property
    def words(self) -> list:
        """Rows (word, idf) in index order, for stages that keep the vocabulary
        in each task; refused beyond the lookup bounds."""
        if not self.size.small:
            raise ValueError(
                f"vocabulary of {self.size.rows} words, {self.size.nbytes} bytes exceeds "
                f"{MAX_LOOKUP_ROWS} words or {MAX_LOOKUP_BYTES} bytes"
            )
        return self.table.orderBy("idx").select("word", "idf").collect()


def rank_vocabulary(stats: DataFrame, n_docs: int, spec: FeatureSpec) -> DataFrame:
    """The ``vocab_size`` most frequent words that enough documents contain.

    ``min_df`` is a number of documents from 1 upwards, below 1 a fraction.
    ``stats`` is a written table.  Neither the selection nor the numbering takes
    place in one task, whatever the size of the vocabulary.
    """
    needed = spec.min_df if spec.min_df >= 1 else spec.min_df * n_docs
    usable = stats.filter((F.col("word") != "") & (F.col("doc_freq") >= F.lit(float(needed))))
    top = largest(usable, "corpus_count", ["word"], spec.vocab_size)
    idf = F.log(F.lit(n_docs + 1.0) / (F.col("doc_freq") + 1.0))
    return numbered(top, [F.desc("corpus_count"), "word"]).select(
        (F.col("rank") - 1).cast("int").alias("idx"), "word", "corpus_count", "doc_freq", idf.alias("idf")
    )


def fit_vocabulary(df: DataFrame, spec: FeatureSpec) -> Vocabulary:
    """Read the corpus once, write the word statistics, rank them."""
    stats = word_statistics(df, spec)
    if spec.min_df >= 1:
        stats = stats.filter((F.col("word") == "") | (F.col("doc_freq") >= spec.min_df))
    stats = materialize(stats, "word-statistics")
    total = stats.filter(F.col("word") == "").select("doc_freq").first()
    n_docs = int(total["doc_freq"]) if total else 0
    table = materialize(rank_vocabulary(stats, n_docs, spec), "vocabulary")
    return Vocabulary(table, n_docs, measure_lookup(table, "word"))


def counting_stages(words: Sequence, spec: FeatureSpec) -> list:
    """Term counts over a known vocabulary, then (optionally) times idf."""
    out = "tf" if spec.use_idf else spec.output_col
    if not words:
        raise ValueError("empty vocabulary: no word reaches min_df")
    stages = token_stages(spec) + [
        CountVectorizerModel.from_vocabulary(
            [w["word"] for w in words], inputCol="filtered_tokens", outputCol=out
        ).setBinary(spec.binary_tf)
    ]
    if spec.use_idf:
        # The document frequencies are known, so idf needs no second fit: it is
        # a fixed factor per index.
        stages.append(
            ElementwiseProduct(
                scalingVec=Vectors.dense([w["idf"] for w in words]),
                inputCol="tf",
                outputCol=spec.output_col,
            )
        )
    return stages


@dataclass(frozen=True)
class FittedFeatures:
    """``pipeline`` holds the vocabulary in its stages; None beyond the lookup bounds."""

    spec: FeatureSpec
    vocabulary: Vocabulary
    pipeline: PipelineModel | None

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the feature vectors of ``df``, by the stages or, without, by joins.

        Both give the same vectors for the same rows; the stages leave their
        intermediate columns as well.
        """
        if self.pipeline is None:
            return vectors_by_join(df, self.vocabulary, self.spec)
        return self.pipeline.transform(df)

    def meta(self) -> dict:
        return {
            "num_features": self.vocabulary.size.rows,
            "n_docs": self.vocabulary.n_docs,
            "vocab_size": self.spec.vocab_size,
            "min_df": float(self.spec.min_df),
            "input_col": self.spec.input_col,
            "output_col": self.spec.output_col,
            "pattern": self.spec.pattern,
            "min_token_length": self.spec.min_token_length,
            "binary_tf": self.spec.binary_tf,
        }


def fit_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> FittedFeatures:
    """Fit vocabulary and idf; pass the training rows only.

    A vocabulary beyond the lookup bounds is never collected: documents then meet it
    in a join.
    """
    return with_stages(spec, fit_vocabulary(df, spec))


def with_stages(spec: FeatureSpec, vocabulary: Vocabulary) -> FittedFeatures:
    """Features over a fitted vocabulary, with stages if tasks may hold it."""
    if not vocabulary.size.small:
        return FittedFeatures(spec, vocabulary, None)
    stages = counting_stages(vocabulary.words, spec)
    return FittedFeatures(spec, vocabulary, PipelineModel(stages=stages))


def hashing_stages(spec: FeatureSpec, num_features: int = 1 << 16) -> list:
    """Hashed term counts: nothing to fit, no idf."""
    return token_stages(spec) + [
        HashingTF(
            inputCol="filtered_tokens",
            outputCol=spec.output_col,
            numFeatures=num_features,
            binary=spec.binary_tf,
        )
    ]


def hashed_features(df: DataFrame, spec: FeatureSpec, num_features: int = 1 << 16) -> DataFrame:
    return PipelineModel(stages=hashing_stages(spec, num_features)).transform(df)


def _entries_in_place(df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec, keep) -> DataFrame:
    """(id, idx, tf), counted inside each document's row: nothing is shuffled."""
    if not vocabulary.words:
        none = df.select("id", *keep, F.lit(0).alias("idx"), F.lit(0.0).alias("tf"))
        return none.filter(F.lit(False))
    counts = replace(spec, use_idf=False)
    counted = PipelineModel(stages=counting_stages(vocabulary.words, counts)).transform(df)
    entries = sc.vector_entries(F.col(counts.output_col))
    return counted.select("id", *keep, F.inline(entries)).withColumnRenamed("value", "tf")


def _word_counts(numbered_docs: DataFrame, row: str, spec: FeatureSpec, *keep: str) -> DataFrame:
    """(row, keep..., word, tf) of written documents with a number of their own.

    The rows of a document lie together, so the counts are nearly complete before
    they are shuffled.
    """
    pieces = tx.split_words(F.col(spec.input_col), spec.pattern)
    if spec.binary_tf:
        pieces = F.array_distinct(pieces)
    word = F.col("word")
    rows = numbered_docs.select(row, *keep, F.explode(pieces).alias("word")).filter(
        tx.is_token(word, spec.min_token_length) & ~tx.is_stop_word(word, spec.stop_words)
    )
    return rows.groupBy(row, *keep, "word").agg(F.count(F.lit(1)).cast("double").alias("tf"))


def _entries_by_join(df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec, keep, *of: str) -> DataFrame:
    """(id, word, tf, idx, of...) for a vocabulary too large to hold: counts per document
    and word, written, then a join with the words.  Documents are numbered and written
    first, so that equal ids stay apart."""
    columns = dict.fromkeys(["id", *keep, spec.input_col])
    numbered = df.select(*columns).withColumn("_row", F.monotonically_increasing_id())
    numbered = materialize(numbered, "numbered")
    counted = materialize(_word_counts(numbered, "_row", spec, "id", *keep), "word-counts")
    words = vocabulary.table.select("word", "idx", *of)
    return lookup_join(counted, words, "word", vocabulary.size, spread_by=("_row",))


def vectors_by_join(df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec) -> DataFrame:
    """``df`` with its feature vectors, for a vocabulary that no task could hold.

    Words are replaced by their indices in a join, spread over salts, and gathered
    per document into a sparse vector, which is as long as the document and not as
    the vocabulary.  Documents without a known word get zeros.  Rows are numbered
    first: ids may repeat or be missing.  The result is a written table.
    """
    number = "_document"
    while number in df.columns:
        number += "_"
    docs = materialize(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    counted = materialize(_word_counts(docs, number, spec), "word-counts")
    words = vocabulary.table.select("word", "idx", "idf")
    known = lookup_join(counted, words, "word", vocabulary.size, spread_by=(number,))
    value = F.col("tf") * F.col("idf") if spec.use_idf else F.col("tf")
    entry = F.struct(F.col("idx").alias("idx"), value.alias("value"))
    gathered = known.groupBy(number).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    joined = docs.join(gathered, number, "left").drop(number)
    return materialize_vectors(joined, vocabulary.size.rows, "_entries", spec.output_col, "features")


def _known_terms(df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec, keep, *of: str) -> DataFrame:
    """(id, keep..., idx, tf) with the columns ``of`` of the vocabulary, in one join."""
    if not vocabulary.size.small:
        return _entries_by_join(df, vocabulary, spec, keep, *(c for c in of if c != "word"))
    entries = _entries_in_place(df, vocabulary, spec, keep)
    return lookup_join(entries, vocabulary.table.select("idx", *of), "idx", vocabulary.size) if of else entries


def term_entries(df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec, *keep: str) -> DataFrame:
    """Count of each vocabulary index per document (1 when binary)."""
    return _known_terms(df, vocabulary, spec, keep).select("id", *keep, "idx", "tf")


def term_frequency(
    df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec, *keep: str
) -> DataFrame:
    """``term_entries`` with the words."""
    return _known_terms(df, vocabulary, spec, keep, "word").select("id", *keep, "idx", "word", "tf")


def tfidf_weights(df: DataFrame, vocabulary: Vocabulary, spec: FeatureSpec) -> DataFrame:
    """Per document and vocabulary word: tf, idf and their product."""
    return _known_terms(df, vocabulary, spec, (), "word", "idf").select(
        "id", "idx", "word", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )
