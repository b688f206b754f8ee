"""A training corpus from ``documents``: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents``; the last returns the tokens. ``run`` writes each
stage's rows to the shared folder and reads them again as the next one's docs.

In every stage: an empty table gives an empty result; texts are read whole,
however long; columns beyond those of ``documents`` come along with their values,
whatever their names, up to the last stage; a null ``lang``, ``source`` or
``n_chars`` changes nothing. What else a stage does with nulls, empty texts,
ties and repeated rows is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crashgrid.llm import decontaminate, secret_scan, sentencepiece_bpe, simhash, toxicity
from crashgrid.llm.queries import public_model, remainder, table
from crashgrid.llm.shared import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; trained as in ``op4_toxicity``.

    Null and empty texts have no toxic token and stay. Repeated rows are judged
    alike and stay or go together. Labels without a document, or whose id or label
    is null, teach nothing; with labels of one class, or none, all stay or go by
    the constant score that fits that class (none: all stay).
    """
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels), threshold=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id.

    Null and empty texts are one group. A document without an id stays only if its
    group has no id at all. Of rows alike in id and text that stays whose other
    columns come first as JSON; of wholly equal rows, one.
    """
    return simhash.keep_one(docs, shingle_words=4, bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go.

    An item of fewer words, but not none, is found as a whole. Null and empty texts
    hold no words and stay; repeated rows stay or go together. An empty benchmark,
    or one of null texts, leaves all.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays.

    Overlapping finds are one mark. ``n_chars`` is counted anew where a text changed.
    Null texts stay null, empty ones empty, repeated rows come back as often.
    """
    return secret_scan.redact_secrets(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of them and of what they decode to.

    A null text is encoded as an empty one. Repeated rows come back as often, null
    ids too. Only the id of a document comes along.
    """
    return sentencepiece_bpe.round_trip(docs, sentencepiece_bpe.load_vocabulary(public_model()))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", tokenize),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
