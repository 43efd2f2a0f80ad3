"""A ledger of model replies: every prompt is paid for once.

A prompt is known by the hash of the model's name and its text.  Prompts without a reply in the ledger
(an anti-join on the key) are asked in steps of bounded size, and each step is appended to the ledger
when its calls are done; replies come back to their rows by an equi-join on the key.  A run that breaks
off leaves its finished steps, and the next one asks only for what is still open.  A call that fails after
all attempts is a row with an error and no reply: it is reported, and open again for the next run.
Speculative execution would repeat calls of a running step and should be off while replies are paid for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.sources.shared import fresh
from clausewise.sources.steps import in_steps

from .providers import with_reply

ROW = "key string, reply string, error string, written timestamp"


class Ledger:
    """Replies of ``provider`` in the append-only table at ``path``.  ``every`` bounds the prompts of a step,
    ``tasks`` the calls that run at once."""

    def __init__(self, spark: SparkSession, path: str, provider: Callable[[str], str], model: str = "", every: int = 1000, tasks: int = 8,
                 attempts: int = 3, pause: float = 2.0):
        self.spark, self.path, self.provider, self.model, self.every = spark, path, provider, model, every
        self.tasks, self.attempts, self.pause = tasks, attempts, pause

    def _written(self) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).parquet(self.path)

    def rows(self) -> DataFrame:
        """(key, reply, error): the newest reply of each key, or its newest error if it has none."""
        newest = F.max_by(F.struct("reply", "error"), F.struct(F.col("reply").isNotNull(), "written"))
        return self._written().groupBy("key").agg(newest.alias("r")).select("key", "r.reply", "r.error")

    def ask(self, prompts: DataFrame, prompt: str = "prompt") -> DataFrame:
        """``prompts`` with the columns reply and error.  Equal prompts are one call; a null prompt is none,
        and has neither reply nor error.  ``prompts`` is computed once and written to the shared folder."""
        path = fresh(self.spark, "prompts")
        key = F.sha2(F.concat(F.lit(self.model + "\0"), F.col(prompt)), 256)
        keyed = prompts.withColumn("__key", key)
        keyed.write.parquet(path)
        stored = self.spark.read.schema(keyed.schema).parquet(path)
        answered = self._written().where("reply is not null").select(F.col("key").alias("__key"))
        todo = stored.where("__key is not null").groupBy("__key").agg(F.first(prompt).alias("__prompt")).join(answered, "__key", "left_anti")
        for step in in_steps(todo, self.every, "open-prompts"):
            with_reply(step, self.provider, "__prompt", self.tasks, self.attempts, self.pause).select(
                F.col("__key").alias("key"), "reply", "error", F.current_timestamp().alias("written")).write.mode("append").parquet(self.path)
        return stored.join(self.rows().withColumnRenamed("key", "__key"), "__key", "left").drop("__key")
