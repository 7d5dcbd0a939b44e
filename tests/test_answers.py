"""Calls that fail, are stopped and go on."""

import os

import pytest

from entitymill.operators import answers
from entitymill.sources import readers
from entitymill.sources.commits import Table


def counting(log, bad=(), dies=None):
    def ask(prompts, attempt):
        with open(log, "a") as f:
            f.writelines(f"{attempt} {p}\n" for p in prompts)
        if dies and os.path.exists(dies) and any(p == "p25" for p in prompts):
            raise SystemExit("killed")
        if any(p in bad and attempt < 3 for p in prompts) and len(prompts) > 1:
            raise RuntimeError("batch")
        out = []
        for p in prompts:
            if p in bad and (attempt < 2 or p == "p9"):
                raise RuntimeError(f"no {p}")
            out.append(f'{{"name": "{p}"}}' if p != "p4" else "sorry")
        return out

    return ask


def test_asks_once_and_retries(spark, tmp_path):
    log, path = f"{tmp_path}/log", f"file://{tmp_path}/calls"
    prompts = spark.createDataFrame([(i, f"p{i % 12}") for i in range(30)] + [(99, None)], "id long, prompt string").withColumnRenamed("id", "k")
    out = {(r.k, r.prompt): (r.answer, r.error) for r in answers.answer(spark, prompts, counting(log, ("p3", "p9")), path, "m", batch=4, per_round=5).collect()}
    assert len(out) == 31 and out[99, None] == (None, None)
    for (k, p), (a, e) in out.items():
        if p == "p9":
            assert a is None and e == "RuntimeError: no p9"
        elif p:
            assert e is None and a == ("sorry" if p == "p4" else f'{{"name": "{p}"}}')
    calls = Table(spark, path).read().collect()
    assert sorted(c.attempt for c in calls if c.error) == [1, 1, 2, 3] and len(calls) == 12 + 3
    asked = len(open(log).readlines())
    again = answers.answer(spark, prompts, counting(log), path, "m")
    assert again.count() == 31 and len(open(log).readlines()) == asked
    # what is no answer has no items
    items = readers.answer_items(again.where("k < 12"), "k", "answer", "name: string")
    assert {r.k: r.name for r in items.collect()} == {i: f"p{i}" for i in range(12) if i not in (4, 9)}


def test_goes_on_after_it_was_killed(spark, tmp_path):
    log, path, flag = f"{tmp_path}/log", f"file://{tmp_path}/calls", f"{tmp_path}/flag"
    open(flag, "w").close()
    prompts = spark.createDataFrame([(f"p{i}",) for i in range(60)], "prompt string")
    with pytest.raises(Exception):
        answers.answer(spark, prompts, counting(log, dies=flag), path, batch=2, per_round=6)
    done = {r.id for r in Table(spark, path).read(schema=spark.createDataFrame([], answers.CALLS).schema).collect()}
    os.remove(flag)
    os.remove(log)
    out = answers.answer(spark, prompts, counting(log), path, batch=2, per_round=6)
    assert out.where("answer IS NULL").count() == 0 and out.count() == 60
    assert 0 < len(done) < 60 and len(open(log).readlines()) == 60 - len(done)


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "prompt string")
    assert answers.answer(spark, none, lambda p, a: p, f"file://{tmp_path}/t").count() == 0
