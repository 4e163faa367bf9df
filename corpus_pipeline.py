"""From raw documents to packed training sequences, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.

1. quality rules: documents that the rules reject go.
2. near duplicates: one document of each group stays (five-word shingles, similarity from 0.8 on);
   of rows with the same id and text, one.
3. benchmark decontamination: documents with at least one word in twenty inside a benchmark passage go.
4. personal data: spans are replaced by their kind in brackets; ``n_chars`` follows the new text.
5. best-fit packing: the texts' tokens in sequences of at most 4096, one row per piece.

A row with a null id or text is handled by each operator as its module says: a null text has no
words, so stage 1 rejects it. Rows that repeat an id with different texts are judged each by itself. Extra columns pass
through the first four stages unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_duplicates, packing, pii, quality_rules
from tidemark.llm.common import stored, table
from tidemark.llm.registry import tokenizer_file


def _own(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and these by the former ones; extra columns stay as they are."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(n).alias(c) for c, n in names.items()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, n = _own(docs)
    return _back(quality_rules.judge(own, text=n["text"], lang=n["lang"]).where("kept"), n)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, n = _own(docs)
    # a row is told by its id and text: a copy must not take another text of its id along
    row = [n["doc_id"], "text_hash"]
    own = own.withColumn("text_hash", F.xxhash64(n["text"]))
    found = near_duplicates.groups(own, n["doc_id"], n["text"], shingle=5, percent=80, carry=("text_hash",))
    gone = found.where("NOT kept").select(*row).distinct()
    return _back(own.join(gone, row, "left_anti").dropDuplicates(row), n)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, n = _own(docs)
    # told apart by id and text, so null and repeated ids do no harm
    keyed = own.withColumn("doc_key", F.concat_ws(":", F.col(n["doc_id"]).cast("string"), F.xxhash64(n["text"]).cast("string")))
    index = decontamination.build_index(keyed, id="doc_key", text=n["text"])
    found = decontamination.search(index, table(spark, sf_dir, "benchmark"), window=13)
    gone = found.where(decontamination.contaminated()).select(F.col("id").alias("doc_key")).distinct()
    return _back(keyed.join(gone, "doc_key", "left_anti"), n)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, n = _own(docs)
    tagger = pii.train(own, id=n["doc_id"], text=n["text"])
    masked = _back(pii.find(own, tagger, text=n["text"], mask=n["text"]), n)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicate),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("best-fit packing", pack),
]

#: The tagger, the sketches and the tokenizer have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k + 1}")
    return docs
