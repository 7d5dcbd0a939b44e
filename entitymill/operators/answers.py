"""Calls of a model, one for each prompt, that can be stopped and taken up again.

What has been asked is a committed table: a row for each call, with its answer or its error and the
number of the attempt. A run asks only for prompts without an answer that have attempts left. It goes
in rounds of a bounded number of prompts; a round is asked by many tasks, in batches, and committed
under a name made of its prompts and attempts, so a run that dies loses at most its last round, and a
round that is committed is never asked again.

The function that asks is given by the caller: (list of prompts, attempt) to a list of answers. If it
fails for a batch, its prompts are asked one by one, so one bad prompt costs no other its answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.scratch import written
from entitymill.sources.commits import Table

#: Attempts for a prompt, prompts in one call of the function, prompts in a round.
ATTEMPTS, BATCH, ROUND = 3, 16, 10_000
CALLS = "id string, model string, attempt int, answer string, error string"

Ask = Callable[[list[str], int], list[str]]


def prompt_id(model: str) -> F.Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(model), F.col("prompt")), 256)


def _ask(ask: Ask, model: str, size: int):
    schema = pa.schema([("id", pa.string()), ("model", pa.string()), ("attempt", pa.int32()), ("answer", pa.string()), ("error", pa.string())])

    def call(rows: list[tuple[str, str, int]]) -> list[tuple]:
        attempt = rows[0][2]
        try:
            answers = ask([p for _, p, _ in rows], attempt)
            if len(answers) != len(rows):
                raise ValueError(f"{len(answers)} answers to {len(rows)} prompts")
            return [(i, model, attempt, a, None if a is not None else "no answer") for (i, _, _), a in zip(rows, answers)]
        except Exception as e:  # noqa: BLE001 (whatever the caller's function raises is a failed attempt)
            if len(rows) == 1:
                return [(rows[0][0], model, attempt, None, f"{type(e).__name__}: {e}"[:500])]
            return [r for one in rows for r in call([one])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(rows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*call(rows)), schema)], schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "prompt", "attempt"))):
                held.setdefault(row[2], []).append(row)
                if len(held[row[2]]) == size:
                    yield out(held.pop(row[2]))
        for rows in held.values():
            yield out(rows)

    return run


def open_prompts(prompts: DataFrame, calls: DataFrame, model: str, attempts: int = ATTEMPTS) -> DataFrame:
    """id, prompt and attempt (its number) of prompts without an answer that have attempts left."""
    asked = calls.groupBy("id").agg(F.count("*").alias("n"), F.count("answer").alias("done"))
    rows = prompts.where("prompt IS NOT NULL").select(prompt_id(model).alias("id"), "prompt").dropDuplicates(["id"])
    rows = rows.join(asked, "id", "left").where(F.col("done").isNull() | ((F.col("done") == 0) & (F.col("n") < attempts)))
    return rows.select("id", "prompt", (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("attempt"))


def answer(spark: SparkSession, prompts: DataFrame, ask: Ask, path: str, model: str = "", attempts: int = ATTEMPTS, batch: int = BATCH, per_round: int = ROUND) -> DataFrame:
    """prompts (prompt and more) with answer and error: asks for those that have no answer yet, and again
    for those that failed, until all are answered or out of attempts. Equal prompts are asked once."""
    table = Table(spark, path)
    empty = spark.createDataFrame([], CALLS)
    while True:
        rest = written(open_prompts(prompts, table.read(schema=empty.schema), model, attempts))
        n = rest.count()
        if not n:
            break
        rounds = -(-n // per_round)
        for i in range(rounds):
            part = rest.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == i)
            size, mark = part.agg(F.count("*"), F.bit_xor(F.xxhash64("id", "attempt"))).first()
            if size:
                spread = part.repartition(max(1, min(size // batch, spark.sparkContext.defaultParallelism)))
                table.append(spread.mapInArrow(_ask(ask, model, batch), CALLS), f"{model}-{size}-{mark}")
    last = table.read(schema=empty.schema).groupBy("id").agg(F.max("answer").alias("answer"), F.max_by("error", "attempt").alias("_error"))
    rows = prompts.withColumn("_id", F.when(F.col("prompt").isNotNull(), prompt_id(model))).join(last.withColumnRenamed("id", "_id"), "_id", "left")
    return rows.withColumn("error", F.when(F.col("answer").isNull(), F.col("_error"))).drop("_id", "_error")
