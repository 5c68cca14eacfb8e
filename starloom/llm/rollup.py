"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

Two tables live in a shared folder. The ledger holds, for every live document, the numbers it is counted with. The
totals are additive, so a batch only brings differences: an insert adds a document, a delete takes one away, a revised
count adds the new numbers and takes the old ones away. A batch is applied once: it writes the new entries of the
ledger and the differences as files of their own, and then, as the last step, a small commit record by an atomic
rename. Whatever a lost or repeated attempt has written besides is never looked at, and a
batch whose name is among the commits changes nothing.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import tiktoken
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
KEYS = ("source", "lang", "tokenizer")
EVENTS = "op string, doc_id long, source string, lang string, tokenizer string, tokens long, seq long"


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, version: str, path: str = VOCABULARY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens`` of whole texts; NULL and empty texts have no tokens."""
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [len(_tokenizer(path).encode_ordinary(t or "")) for t in batch["text"]]
            yield batch.drop(columns="text").assign(doc_id=batch["doc_id"].astype("Int64"), tokens=found)

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), "source", "lang", F.col(text_col).alias("text"))
    return named.mapInPandas(count, "doc_id long, source string, lang string, tokens long").select(
        "doc_id", "source", "lang", F.lit(version).alias("tokenizer"), "tokens")


class Overtaken(RuntimeError):
    """Another batch was committed meanwhile, so what this one found in the ledger may be out of date."""


class Rollup:
    """The ledger and the totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._known: dict[str, tuple[str, str]] = {}  # commits never change

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        return jvm, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> list[tuple[str, str]]:
        """(batch, attempt) in the order of their commits."""
        jvm, files = self._files()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        if not files.exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in files.listStatus(folder))
        for name in (n for n in names if n[0].isdigit() and n not in self._known):
            stream = files.open(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/{name}"))
            try:
                self._known[name] = tuple(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("~"))
            finally:
                stream.close()
        return [self._known[n] for n in names if n[0].isdigit()]

    def _commit(self, number: int, batch: str, attempt: str) -> None:
        jvm, files = self._files()
        hadoop = jvm.org.apache.hadoop.fs
        new, done = hadoop.Path(f"{self.folder}/new-{attempt}"), hadoop.Path(f"{self.folder}/commits/{number:012d}")
        files.mkdirs(done.getParent())
        stream = files.create(new, False)
        stream.write(bytearray(f"{batch}~{attempt}".encode()))
        stream.close()
        context = hadoop.FileContext.getFileContext(
            files.makeQualified(done).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        keep = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)  # replace nothing
        try:
            context.rename(files.makeQualified(new), files.makeQualified(done), keep)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            raise Overtaken(f"another writer committed a batch while {batch} was applied; apply it again") from None

    def _committed(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{part}/{attempt}" for _, attempt in self.commits()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    LEDGER = "doc_id long, tokenizer string, source string, lang string, tokens long, live boolean, version long"

    def ledger(self) -> DataFrame:
        """The newest entry of each document and tokenizer, live or not."""
        newest = Window.partitionBy("doc_id", "tokenizer").orderBy(F.col("version").desc())
        entries = self._committed("ledger", self.LEDGER)
        return entries.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens``; keys without a document are left out."""
        sums = self._committed("changes", "source string, lang string, tokenizer string, documents long, tokens long")
        return sums.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where(
            "documents != 0")

    def apply(self, batch: str, events: DataFrame) -> bool:
        """Apply the events of a batch, unless it has been; says whether it was applied.

        ``events``: op (insert, delete, revise), doc_id, source, lang, tokenizer, tokens, seq. Of several events of one
        document and tokenizer the one with the largest ``seq`` counts, of equal ones the largest in all columns. An
        insert of a live document and a revision of an unknown one set its numbers, a delete of an unknown one does
        nothing. Sources, languages and tokens may be NULL (no tokens); events without a document or operation are
        left out.
        """
        if "~" in batch or "/" in batch:
            raise ValueError("a batch name holds neither ~ nor /")
        done = self.commits()  # a commit takes the number after these, which only one writer can
        if batch in {name for name, _ in done}:
            return False
        attempt, number = uuid.uuid4().hex, len(done)
        order = [F.col(c).desc_nulls_last() for c in ("seq", "op", "tokens", "source", "lang")]
        last = Window.partitionBy("doc_id", "tokenizer").orderBy(*order)
        named = events.where("doc_id IS NOT NULL AND op IN ('insert', 'delete', 'revise')").withColumn(
            "tokenizer", F.coalesce("tokenizer", F.lit("")))
        wanted = named.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(
            "doc_id", "tokenizer", F.col("source").alias("_source"), F.col("lang").alias("_lang"),
            F.coalesce("tokens", F.lit(0)).alias("_tokens"), (F.col("op") != "delete").alias("_live"))
        old = self.ledger().where("live").select(
            "doc_id", "tokenizer", "source", "lang", "tokens", F.lit(True).alias("_had"))
        both = wanted.join(old, ["doc_id", "tokenizer"], "left").where("_live OR _had")
        both.select("doc_id", "tokenizer", F.col("_source").alias("source"), F.col("_lang").alias("lang"),
                    F.col("_tokens").alias("tokens"), F.col("_live").alias("live"),
                    F.lit(number).cast("long").alias("version")).write.parquet(f"{self.folder}/ledger/{attempt}")
        signed = F.explode(F.array(
            F.struct(F.col("_had").alias("use"), "source", "lang", F.lit(-1).alias("sign"), "tokens"),
            F.struct(F.col("_live").alias("use"), F.col("_source").alias("source"), F.col("_lang").alias("lang"),
                     F.lit(1).alias("sign"), F.col("_tokens").alias("tokens"))))
        both.select("tokenizer", signed.alias("c")).where("c.use").groupBy("c.source", "c.lang", "tokenizer").agg(
            F.sum("c.sign").cast("long").alias("documents"), F.sum(F.expr("c.sign * c.tokens")).alias("tokens")).where(
            "documents != 0 OR tokens != 0").select(*KEYS, "documents", "tokens").write.parquet(
            f"{self.folder}/changes/{attempt}")
        self._commit(number, batch, attempt)
        return True
