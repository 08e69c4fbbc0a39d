"""The closed form of the merge against the steps it stands for, done one by one on dicts."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kbetl.operators import delta
from kbetl.operators.delta import DeltaPlan

PLAN = DeltaPlan(
    key="acc", natural_key="uid", kept_on_update=("nm",), attachments={"sequences": "seq"},
    children={"genes": ("acc", "g"), "links": ("acc", "l")}, dimensions={"taxonomy": "t"},
)
SCHEMAS = {
    "proteins": "acc string, uid string, nm string, v int, dataset string",
    "sequences": "acc string, seq string",
    "genes": "acc string, g string, flag string",
    "links": "acc string, l string",
    "taxonomy": "t int, name string",
}
CASES = 150

pytestmark = pytest.mark.usefixtures("codegen")


def random_side(rng, case, side):
    """Small key space, so that keys and natural keys collide, move, swap, repeat and vanish."""
    tables = {name: {} for name in SCHEMAS}
    for a in rng.sample(range(6), rng.randint(0, 6)):
        acc = f"{case}-A{a}"
        uid = None if rng.random() < 0.15 else f"{case}-U{rng.randrange(5)}"
        tables["proteins"][acc] = [uid, rng.choice([None, f"{side}{a}"]), rng.randrange(9), rng.choice("xy")]
        if rng.random() < 0.6:
            tables["sequences"][acc] = [f"{side}-seq{a}"]
        for g in rng.sample(range(4), rng.randint(0, 3)):
            tables["genes"][acc, f"g{g}"] = [rng.choice([None, side, "same"])]
        for n in rng.sample(range(3), rng.randint(0, 2)):
            tables["links"][acc, f"l{n}"] = []
    for t in rng.sample(range(5), 3):
        tables["taxonomy"][case * 10 + t] = [f"{side}{t}"]
    return tables


def sequential(prod, stage, refresh=False, scope=None):
    p = {name: dict(t) for name, t in prod.items()}

    def drop(accs):
        p["proteins"] = {a: r for a, r in p["proteins"].items() if a not in accs}
        p["sequences"] = {a: r for a, r in p["sequences"].items() if a not in accs}
        for child in ("genes", "links"):
            p[child] = {k: r for k, r in p[child].items() if k[0] not in accs}

    p["taxonomy"].update(stage["taxonomy"])
    drop({
        a for a, (uid, *_) in p["proteins"].items()
        for b, (uid2, *_) in stage["proteins"].items() if uid is not None and uid == uid2 and a != b
    })
    for a, (uid, nm, v, ds) in stage["proteins"].items():
        old = p["proteins"].get(a)
        p["proteins"][a] = [uid, old[1] if old else nm, v, ds]
    p["sequences"].update(stage["sequences"])
    for child in ("genes", "links"):
        p[child] = {k: r for k, r in p[child].items() if k[0] not in stage["proteins"] or k in stage[child]}
        for k, r in stage[child].items():
            if refresh:
                p[child][k] = r
            else:
                p[child].setdefault(k, r)
    present = {uid for uid, *_ in stage["proteins"].values() if uid is not None}
    drop({
        a for a, (uid, _, _, ds) in p["proteins"].items()
        if uid not in present and (scope is None or ds == scope or a in stage["proteins"])
    })
    return p


def to_frames(spark, sides):
    frames = {}
    for name, schema in SCHEMAS.items():
        data = [
            (*(k if isinstance(k, tuple) else (k,)), *v) for side in sides for k, v in side[name].items()
        ]
        frames[name] = spark.createDataFrame(data, schema)
    return frames


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(7)
    return [(random_side(rng, c, "p"), random_side(rng, c, "s")) for c in range(CASES)]


def expected(results, name):
    out = [(*(k if isinstance(k, tuple) else (k,)), *v) for r in results for k, v in r[name].items()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("options", [{}, {"refresh": True}, {"scope": "x"}, {"work": True}])
def test_closed_form_equals_the_steps(spark, cases, tmp_path, options):
    prod = to_frames(spark, [p for p, _ in cases])
    stage = to_frames(spark, [s for _, s in cases])
    got = delta.apply_delta(
        prod, stage, PLAN,
        refresh_payload="refresh" in options,
        scope=F.col("dataset") == "x" if "scope" in options else None,
        work_dir=str(tmp_path / "work") if "work" in options else None,
    )
    want = [sequential(p, s, options.get("refresh", False), options.get("scope")) for p, s in cases]
    for name in SCHEMAS:
        assert rows(got[name]) == expected(want, name), name


def test_single_steps(spark, cases):
    prod = to_frames(spark, [p for p, _ in cases])
    stage = to_frames(spark, [s for _, s in cases])
    moved = {
        a for p, s in cases for a, (u, *_) in p["proteins"].items()
        for b, (u2, *_) in s["proteins"].items() if u is not None and u == u2 and a != b
    }
    gone = {
        a for p, s in cases for a, (u, *_) in p["proteins"].items()
        if u is None or u not in {r[0] for r in s["proteins"].values()}
    }
    args = prod["proteins"], stage["proteins"], "uid", "acc"
    assert {r[0] for r in rows(delta.changed_keys(*args))} == moved
    assert {r[0] for r in rows(delta.removed_keys(*args))} == gone
    assert {r.acc for r in delta.rekey_delete(*args).collect()} == {a for p, _ in cases for a in p["proteins"]} - moved
    left = delta.delete_removed(prod, stage["proteins"], PLAN)
    assert {r.acc for r in left["genes"].collect()} == {k[0] for p, _ in cases for k in p["genes"]} - gone
    assert {r.acc for r in left["sequences"].collect()} == {a for p, _ in cases for a in p["sequences"]} - gone


def test_insert_ignore_and_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "k int, p string, q string")
    new = spark.createDataFrame([(2, "n", "m"), (3, "n", None)], "k int, p string, q string")
    assert rows(delta.insert_ignore(old, new, ["k"])) == [(1, "a", "x"), (2, None, "y"), (3, "n", None)]
    assert rows(delta.upsert(old, new, ["k"])) == [(1, "a", "x"), (2, "n", "m"), (3, "n", None)]
    assert rows(delta.upsert(old, new, ["k"], ["q"])) == [(1, "a", "x"), (2, None, "m"), (3, "n", None)]


def test_categories(spark):
    prod = spark.createDataFrame([("a", "u1"), ("b", "u2"), ("c", "u3"), ("d", None)], "acc string, uid string")
    stage = spark.createDataFrame([("a", "u1"), ("x", "u2"), ("n", "u4"), ("m", None)], "acc string, uid string")
    got = delta.classify_changes(prod, stage, "uid", "acc")
    assert rows(got, "uid", "change") == [("u1", "UPDATED"), ("u2", "REKEYED"), ("u3", "REMOVED"), ("u4", "NEW")]
    assert rows(delta.delta_report(prod, stage, "uid", "acc")) == [
        ("NEW", 1), ("REKEYED", 1), ("REMOVED", 1), ("UPDATED", 1),
    ]


def test_hot_natural_key_stays_linear(spark):
    """Thousands of rows with one natural key on both sides: no row-to-row matches."""
    prod = spark.range(4000).select(F.col("id").alias("acc"), F.lit("hot").alias("uid"))
    stage = spark.range(2000, 6000).select(F.col("id").alias("acc"), F.lit("hot").alias("uid"))
    assert delta.changed_keys(prod, stage, "uid", "acc").count() == 4000
    assert delta.classify_changes(prod, stage, "uid", "acc").count() == 1
