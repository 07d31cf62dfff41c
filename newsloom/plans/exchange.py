"""Model steps that wait: requests go out as files, and the step is done once answers have landed."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators.batching import assign_batches
from newsloom.operators.profile import batch_status
from newsloom.operators.tasks import RESPONSE, Task, request_json
from newsloom.session import store
from newsloom.sources.writers import make_folder, write_request_files
from newsloom.streaming.answers import take_in, taken_in

# What a batch can be reported as when no more answers will come for it.
ENDED = ("failed", "expired", "cancelled")
# Stretches of batches that requests are dealt out by.
STRETCHES = 256
SENT = "custom_id string, digest string, batch_no bigint, after bigint"


class Waiting(Exception):
    """Answers are missing; the step is to be taken up again after `wait_time` seconds."""

    def __init__(self, task: str, n_running: int, wait_time: int):
        super().__init__(f"{task}: {n_running} batches without all their answers, ask again in {wait_time} s")
        self.wait_time = wait_time


@dataclass
class Exchange:
    """The files of one task of one run, under the folder `path`:

    requests/run_id=/task_name=/batch_no=   request lines, one file per 200
    sent/run_id=/task_name=/wave=           which request went out in which batch
    answers/run_id=/task_name=              where answer files are to land, of any number and names
    taken/run_id=/task_name=                what has been read of them

    An instance is a predictor: called with requests it reads what has landed, sends what has
    not been sent, and gives the answers, or raises `Waiting`. So a step that fails or waits
    is called again with the same requests, and none goes out twice. A request whose text
    has changed goes out anew, and answers to the old text do not count. Of several answers
    to a request the last one that landed counts.
    """

    spark: SparkSession
    path: str
    run_id: str
    task: Task

    def folder(self, kind: str) -> str:
        return f"{self.path}/{kind}/run_id={self.run_id}/task_name={self.task.name}"

    def poll(self) -> None:
        """Read the answer files that have landed since the last time."""
        make_folder(self.spark, self.folder("answers"))
        make_folder(self.spark, f"{self.folder('taken')}/answers")
        take_in(self.spark, self.folder("answers"), self.folder("taken"), f"{self.folder('taken')}/_progress")

    def sent(self) -> DataFrame:
        """The requests sent, each in its last wave: SENT."""
        make_folder(self.spark, self.folder("sent"))
        waves = self.spark.read.schema(f"{SENT}, wave bigint").parquet(self.folder("sent"))
        last = F.max(F.struct("wave", "digest", "batch_no", "after")).alias("s")
        return waves.groupBy("custom_id").agg(last).select("custom_id", "s.digest", "s.batch_no", "s.after")

    def send(self, requests: DataFrame, asked: DataFrame | None = None) -> None:
        """Write request files for what has not been sent as it is; `asked` are the custom_id and
        digest of the requests, if they are known.

        What to send and its batches are found by the digests; texts are exchanged once, and not
        at all if nothing is to be sent. The list of a wave is written after its files: a
        send that failed in between writes the same files again.
        """
        asked = (requests.select("custom_id", self.digest()) if asked is None else asked).select("custom_id", "digest")
        fresh = store(asked.join(self.sent(), ["custom_id", "digest"], "left_anti"), "unsent")
        if fresh.isEmpty():
            return
        waves = self.spark.read.schema(f"{SENT}, wave bigint").parquet(self.folder("sent"))
        before = waves.agg(
            F.coalesce(F.max("batch_no") + 1, F.lit(0)).alias("batches"), F.coalesce(F.max("wave") + 1, F.lit(0)).alias("wave")
        ).first()
        # Answers that have been read by now are not to these requests.
        read = taken_in(self.spark, self.folder("taken")).agg(F.max("epoch").alias("epoch")).first()["epoch"]
        batched = assign_batches(fresh, ["custom_id"]).withColumn("batch_no", F.col("batch_no") + before["batches"])
        batched = store(batched, "batched")
        rows = Observation()
        lines = self._in_batches(requests, batched).observe(rows, F.count(F.lit(1)).alias("n"))
        lines = lines.withColumns({"run_id": F.lit(self.run_id), "task_name": F.lit(self.task.name)})
        write_request_files(lines, f"{self.path}/requests", F.col("line"), replace=False, dealt=True)
        if rows.get["n"] != batched.count():
            raise RuntimeError(f"{self.task.name}: requests changed while they were sent")
        batched.select(
            "custom_id", "digest", "batch_no", F.lit(-1 if read is None else read).cast("bigint").alias("after")
        ).write.mode("overwrite").parquet(f"{self.folder('sent')}/wave={before['wave']}")

    def digest(self) -> Column:
        return F.sha2(request_json(self.task), 256).alias("digest")

    def _in_batches(self, requests: DataFrame, batched: DataFrame) -> DataFrame:
        """The lines of the requests in `batched`, with batch_no and pos, each batch in one partition.

        Batches follow on one another by custom_id. So a request's stretch of batches is found
        by the first id of each, and texts meet their batch where its file is written. They meet
        in a window, which takes the rows as the stretches deal them out: a join of large tables
        is exchanged by all its keys, and would leave a piece of each batch in every task.
        """
        ends = batched.agg(F.min("batch_no").alias("low"), F.max("batch_no").alias("high")).first()
        size = -(-(ends["high"] - ends["low"] + 1) // STRETCHES)
        placed = batched.withColumn("stretch", F.floor((F.col("batch_no") - ends["low"]) / size).cast("int"))
        firsts = placed.groupBy("stretch").agg(F.min("custom_id").alias("id")).orderBy("stretch").collect()
        known = F.array(*[F.lit(r.id) for r in firsts])
        stretch = F.size(F.filter(known, lambda first: first <= F.col("custom_id"))) - 1
        lines = requests.select("custom_id", request_json(self.task).alias("line"), stretch.alias("stretch"))
        lines = lines.withColumn("digest", F.sha2("line", 256))
        both = lines.unionByName(placed, allowMissingColumns=True).repartition(len(firsts), "stretch")
        same = Window.partitionBy("stretch", "custom_id", "digest")
        met = both.withColumns({c: F.max(c).over(same) for c in ("batch_no", "pos")})
        return met.where(F.col("line").isNotNull() & F.col("batch_no").isNotNull())

    def answers(self) -> DataFrame:
        """Every request sent (custom_id, batch_no), with model, content and error of its answer,
        and whether there is one (`answered`) or the batch has ended without (`ended`)."""
        taken = taken_in(self.spark, self.folder("taken"))
        requests = self.sent()
        to = taken.where(F.col("custom_id").isNotNull()).select(
            F.col("custom_id").alias("__id"), "epoch",
            F.struct("epoch", "ord", "model", "content", "error").alias("answer"),
        )
        # Only the last answer to a request has to meet it, and tells if it is recent enough.
        last = to.groupBy("__id").agg(F.max("answer").alias("a"))
        reports = (
            taken.where(F.col("status").isin(*ENDED) & F.col("batch_no").isNotNull())
            .groupBy(F.col("batch_no").alias("__batch"))
            .agg(F.max(F.struct("epoch", "ord", "status"))["status"].alias("ended"))
        )
        found = requests.join(
            last, (F.col("custom_id") == F.col("__id")) & (F.col("a.epoch") > F.col("after")), "left"
        ).join(reports, F.col("batch_no") == F.col("__batch"), "left")
        answered = F.col("__id").isNotNull()
        lost = F.when(~answered & F.col("ended").isNotNull(), F.concat(F.lit("batch "), "ended"))
        return found.select(
            "custom_id", "batch_no", "a.model", "a.content", F.coalesce("a.error", lost).alias("error"),
            answered.alias("answered"), F.col("ended").isNotNull().alias("ended"),
        )

    def batches(self, answers: DataFrame | None = None) -> DataFrame:
        """A line per batch: n_requests, n_answered, n_errors, and its status, with what
        `profile.batch_status` reads."""
        answers = self.answers() if answers is None else answers
        open_ = F.count_if(~F.col("answered") & ~F.col("ended"))
        good = F.count_if(F.col("answered") & F.col("error").isNull())
        bad = F.count_if(F.col("error").isNotNull())
        return answers.groupBy("batch_no").agg(
            F.count("*").alias("n_requests"),
            F.count_if("answered").alias("n_answered"),
            bad.alias("n_errors"),
            F.when(open_ > 0, "running").otherwise("completed").alias("status"),
            F.when(good > 0, good.cast("string")).alias("output"),
            F.when(bad > 0, bad.cast("string")).alias("error"),
        )

    def __call__(self, requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The predictor; raises `Waiting` while answers to these requests are missing, and
        RuntimeError if all batches ended with nothing but errors."""
        # Texts stay where they are: what is known of a request is its digest.
        asked = store(requests.select("custom_id", F.col("model").alias("__model"), self.digest(), *keep), "asked")
        if asked.isEmpty():
            return self.spark.createDataFrame([], f"{RESPONSE}").join(asked.select("custom_id", *keep), "custom_id")
        self.poll()
        self.send(requests, asked)
        own = asked.select("custom_id").distinct()
        answers = store(self.answers().join(own, "custom_id", "left_semi"), "answers")
        state = batch_status(self.batches(answers)).first()
        if state["status"] == "WAIT":
            raise Waiting(self.task.name, state["n_running"], state["wait_time"])
        if state["status"] == "ALL_ERROR_END":
            raise RuntimeError(f"{self.task.name}: all batches ended with errors")
        return asked.select("custom_id", "__model", *keep).join(answers, "custom_id", "left").select(
            "custom_id", F.coalesce("model", "__model").alias("model"), "content", "error", *keep
        )
