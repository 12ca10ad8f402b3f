"""Corpus pipeline: from raw documents to token ids, one dealt operator per stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``docs``. ``run`` applies them to ``documents``.

Defined results of all stages: an empty table stays empty; extra columns pass through
under their own names; null and empty texts are scored like empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, langid, mixing, ngram_join, quality_cnn
from marquee.llm.common import lookup_join, read, remainder, stored
from marquee.llm.queries import MIX_FRACTION, MIX_WEIGHTS, VOCABULARY, domain_of
from marquee.session import ensure_checkpoint_dir


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns _c0, _c1, ..., so that no column of a result clashes, and the new names."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects (predicted 0) go.

    Learns from a bounded sample of labels with crc32(doc_id) mod 5 <> 0. Without labels of both
    kinds nothing can be learned, and a document goes only if label 1 is rarer than the threshold.
    """
    labels = read(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    net = quality_cnn.learn(docs.select("doc_id", "text"), labels)
    rows, names = _renamed(docs)
    scored = quality_cnn.classify(rows, net, text=names["text"])
    return scored.filter("predicted = 1").select(*names.values()).toDF(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that it rejects go: null texts, texts without a letter, and those
    whose language it cannot tell with the calibrated confidence."""
    learn = docs.filter(remainder(F.col("doc_id"), 3) != 1)
    model = langid.fit(*langid.training_sample(learn, "lang"))
    rows, names = _renamed(docs)
    found = langid.identify(rows, model, text=names["text"])
    return found.filter("NOT rejected").select(*names.values()).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one row of each group of linked texts stays, that with the smallest doc_id (rows without an id
    come last).

    Groups are told by their texts, not by ids: an id that stands on unlike texts stays on each of them. Of rows equal
    in id and text, and of wordless ones among these, the least row stays.
    """
    rows, names = _renamed(docs)
    doc_id, text = F.col(names["doc_id"]), F.col(names["text"])
    row = F.xxhash64(doc_id.isNull(), doc_id, text)
    linked = ngram_join.link_groups(rows.select(doc_id.alias("doc_id"), row.alias("_row"), text.alias("text")), group="_group")
    linked = stored(linked.withColumn("_group", F.coalesce("_group", "_row")), "groups", rebalance=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    several = linked.groupBy("_group").agg(first, F.count("*").alias("n")).filter("n > 1")
    several = stored(several.select("_group", F.col("first._row").alias("_first")), "several", rebalance=True)
    members = stored(lookup_join(linked, several, ["_group"], "inner").groupBy("_row", "_first")
                     .agg(F.count("*").alias("n")), "members", rebalance=True)
    rows = lookup_join(rows.withColumn("_row", row), members.filter("_row <> _first").select("_row").distinct(),
                       ["_row"], "left_anti")
    twice = members.filter("_row = _first AND n > 1").select("_row")
    least = lookup_join(rows, twice, ["_row"], "left_semi").groupBy("_row").agg(
        F.min(F.struct(*names.values())).alias("r")).select("r.*")
    single = lookup_join(rows, twice, ["_row"], "left_anti").select(*names.values())
    return single.unionByName(least).toDF(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: 80 % of the tokens by the target weights of domain, language and source, one epoch at most."""
    rows, names = _renamed(docs)
    rows = rows.withColumns({"domain": domain_of(F.col(names["source"])), "lang": F.col(names["lang"]),
                             "source": F.col(names["source"])})
    mixed = mixing.mix(rows, MIX_WEIGHTS, MIX_FRACTION, max_epochs=1.0, doc_id=names["doc_id"], text=names["text"])
    return mixed.select(*names.values()).toDF(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: doc_id, ids, n_tokens, SHA-256 of the ids and of the decoded bytes."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    coded = bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.digests(coded, keep=["doc_id", "ids"])


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

# The trained stages and the byte-pair encoding have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn on the whole of ``documents``."""
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
