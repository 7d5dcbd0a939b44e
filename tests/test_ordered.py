"""Places, successors and minima over ranges against sorted lists."""

import bisect
import random

import pytest

from entitymill import scratch
from entitymill.operators import ordered, resolve


def words(n, seed, most=6):
    r = random.Random(seed)
    return sorted({"".join(r.choice("aあい会b社") for _ in range(r.randrange(1, most))) for _ in range(n)})


def test_places_and_successors(spark):
    keys, probes = words(300, 1), words(200, 2)
    in_order = sorted(x.encode() for x in keys)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        k, p = ordered.places(spark.createDataFrame([(x,) for x in keys], "s string"), spark.createDataFrame([(x,) for x in probes], "s string"), "s")
        assert {r.s: r.place for r in k.collect()} == {x.decode(): i for i, x in enumerate(in_order)}
        assert {r.s: r.place for r in p.collect()} == {x: bisect.bisect_left(in_order, x.encode()) for x in probes}
        near = ordered.successors(spark.createDataFrame([(x,) for x in keys], "s string"), spark.createDataFrame([(x,) for x in [*probes, "\U0010ffff"]], "s string"), "s")
        at = lambda x: bisect.bisect_left(in_order, x.encode())
        assert {r.s: r.next and r.next.s for r in near.collect()} == {x: in_order[at(x)].decode() if at(x) < len(in_order) else None for x in [*probes, "\U0010ffff"]}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("n, fan", [(1, 2), (50, 2), (500, 3), (500, 64), (5000, 4)])
def test_range_minima(spark, monkeypatch, n, fan):
    monkeypatch.setattr(ordered, "FAN", fan)
    r = random.Random(n * fan)
    values = [r.randrange(1000) for _ in range(n)]
    ranges = [(i, *sorted((r.randrange(n + 1), r.randrange(n + 1)))) for i in range(60)] + [(99, 0, n)]
    got = ordered.range_minima(spark.createDataFrame(list(enumerate(values)), "place long, v int"), spark.createDataFrame(ranges, "i int, low long, high long"), "v", ["i"])
    assert {x.i: x.v for x in got.collect()} == {i: min(values[a:b]) for i, a, b in ranges if a < b}


def test_one_character_meets_few_rows(spark):
    """A name that every entity starts with or holds meets one successor, and a few blocks."""
    dim = spark.range(20_000).selectExpr("lpad(CAST(id AS STRING), 5, '0') AS id", "concat('社', id) AS name_normalized")
    names = spark.createDataFrame([("社",), ("社1",), ("9",), ("x",)], "name string")
    assert dict(map(tuple, resolve.by_prefix(names, dim).collect())) == {"社": "00000", "社1": "00001", "9": None, "x": None}
    found = resolve.containing(names, dim)
    assert dict(map(tuple, found.collect())) == {"社": "00000", "社1": "00001", "9": "00009"}
    plan = found._jdf.queryExecution().toString()
    assert "_grams" not in plan
    cut = ordered._blocks(3, ordered.F.lit(1), ordered.F.lit(19_999))
    size = spark.range(1).select(ordered.F.aggregate(cut, ordered.F.lit(0).cast("long"), lambda t, x: t + x["stop"] - x["start"])).first()[0]
    assert size <= 2 * ordered.FAN * 3


def test_labels_and_aliases_of_common_parts(spark):
    """The longest alias inside a label or around it, by loops over all pairs; every one shares its parts with many."""
    from entitymill.operators import mapping

    r = random.Random(6)
    made = lambda n, most: "".join(r.choice("会社ab") for _ in range(r.randrange(1, most)))
    aliases = list({made(0, 9): i for i in range(150)})
    labels = sorted({made(0, 14) for _ in range(200)} | {"会", "z", "会社z"})
    rows = [(a, f"c{i}", i) for i, a in enumerate(aliases)]
    got = {x.label: x.canonical for x in mapping.map_labels(spark.createDataFrame([(x,) for x in [*labels, None, ""]], "label string"), spark.createDataFrame(rows, "alias string, canonical string, pos int")).collect()}
    for n in labels:
        hits = [(-len(a), i, c) for a, c, i in rows if len(a) >= mapping.MIN_ALIAS and (a in n or n in a)]
        assert got[n] == (next((c for a, c, _ in rows if a == n), None) or (min(hits)[2] if hits else None)), n


def test_names_that_become_columns_are_few(spark, monkeypatch):
    from entitymill.operators import reshape

    monkeypatch.setattr(reshape, "MOST_COLUMNS", 3)
    long = spark.range(4).selectExpr("id AS k", "CAST(id AS STRING) AS name", "'v' AS value")
    assert reshape.matrix(long.where("k < 3"), "k", []).columns == ["k", "0", "1", "2"]
    with pytest.raises(ValueError):
        reshape.matrix(long, "k", [])


def test_empty_tables(spark):
    dim, names = spark.createDataFrame([("1", "a"), ("2", None), ("3", "")], "id string, name_normalized string"), spark.createDataFrame([("a",), ("",), ("b",)], "name string")
    assert resolve.by_prefix(names.limit(0), dim).count() == 0 and resolve.containing(names.limit(0), dim).count() == 0
    assert dict(map(tuple, resolve.by_prefix(names, dim.limit(0)).collect())) == {"a": None, "": None, "b": None}
    assert resolve.containing(names, dim.limit(0)).count() == 0
    assert dict(map(tuple, resolve.by_prefix(names, dim).collect())) == {"a": "1", "": "3", "b": None}


def test_sweep(spark):
    folder = scratch.new_folder(spark)
    spark.range(1).write.parquet(folder)
    top, name = folder.rsplit("/", 1)
    assert scratch.sweep(spark, top, 3600) == [] and name in scratch.sweep(spark, top, 0)
