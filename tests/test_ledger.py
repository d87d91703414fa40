import json
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ledger


def test_typed_canonical():
    t = ledger.typed_canonical
    assert t(None) == b"n;" and t(True) == b"b1;" and t(1) == t(1.0) == b"d3ff0000000000000;" and t(-0.0) != t(0)
    assert t("é") == b"s2:c3a9;" and t([]) == b"a0:;" and t({"b": 1, "a": None}) == b"o2:s1:61;n;s1:62;d3ff0000000000000;;"
    for bad in (2**53, float("nan"), float("inf"), 10**400, "\ud800", {1: 2}, {"\ud800": 1}, (1,), b"x"):
        with pytest.raises(ledger.CanonicalError):
            t(bad)
    rng = random.Random(1)

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        return [None, rng.random() < 0.5, rng.randrange(-9, 9), rng.random(), rng.choice(["", "x", "é中"]), [value(depth - 1) for _ in range(rng.randrange(3))] if depth else 0, {rng.choice("abc"): value(depth - 1) for _ in range(3)} if depth else 0][kind]

    for _ in range(2000):  # neither the order of keys nor the notation of numbers counts
        v = value(3)
        assert t(v) == t(json.loads(json.dumps(v, sort_keys=True)))


def test_digests_and_names(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"b":2.0,"a":1}',), ("{",), (None,)], "p string")
    got = [r.h for r in df.select(ledger.typed_digest("p").alias("h")).collect()]
    assert got[0] == got[1] is not None and got[2] is None and got[3] is None
    assert spark.createDataFrame([("  Ａß  x ",)], "n string").select(ledger.fold_name("n")).first()[0] == "ass x"


def test_partition_must_be_exact(spark):
    frame = spark.createDataFrame([(1,), (2,)], "k int")
    states = lambda rows: spark.createDataFrame(rows, "k int, state string")
    ok = ledger.partition_counts(frame, states([(1, "a"), (2, "b")]), "k", ["a", "b"]).first()
    assert tuple(ok) == (2, 1, 1, True)
    for bad in ([(1, "a")], [(1, "a"), (2, "b"), (3, "a")], [(1, "a"), (1, "b"), (2, "b")]):
        assert not ledger.partition_counts(frame, states(bad), "k", ["a", "b"]).first().exact


def test_plan_refuses_disorder(spark):
    p = ledger.Plan().add("a", (), lambda: spark.range(3))
    assert p.add("b", ("a",), lambda x: x.where("id > 0")).run()["b"].count() == 2
    with pytest.raises(ValueError):
        p.add("c", ("zz",), lambda x: x)
    with pytest.raises(ValueError):
        p.add("a", (), lambda: spark.range(1))


def test_weakest_and_falsifiers(spark):
    df = spark.createDataFrame([("x", "high"), ("x", "low"), ("y", "high"), ("z", None)], "g string, l string")
    assert {(r.g, r.level) for r in ledger.weakest(df, ["g"], "l", ["low", "high"]).collect()} == {("x", "low"), ("y", "high"), ("z", "unknown")}
    f = spark.createDataFrame([("a", True, False), ("a", True, True), ("b", False, True), ("c", True, False)], "g string, e boolean, t boolean")
    assert {(r.g, r.s) for r in f.groupBy("g").agg(ledger.falsifier_state(F.col("e"), F.col("t")).alias("s")).collect()} == {("a", "triggered"), ("b", "not_evaluable"), ("c", "compatible")}
