"""Decoding against one path lookup per field, on random and on damaged records."""

import json
import random

import pytest
from pyspark.sql import functions as F

from driftlake.operators import decode
from driftlake.operators.envelope import OPS
from driftlake.spec import TableSpec

SPEC = TableSpec("t", {"id": "string"}, {"a": "string", "b": "string"})
SPECS = [
    SPEC,
    TableSpec("t", {"id": "bigint"}, {"a": "double", "b": "int"}),
    TableSpec("t", {"id": "int"}, {"a": "bigint", "b": "boolean"}, prefer_source_time=True),
    TableSpec("t", {"id": "double"}, {"a": "decimal(20,4)", "b": "float"}),
]
SCALARS = [
    None, 1, 0, -7, 1.5, 1e3, 12345678901234567890, True, False, "x", "", "7", " 8 ", 'é\n"q"',
    "null", 2147483648, "2.5", {"k": 1.50, "z": [1, {"y": None}]}, [1, "2"], {}, "\u0000", 1e-7, 123456.789012345, -0.0,
]


def random_record(rnd):
    def row():
        return {k: rnd.choice(SCALARS) for k in rnd.sample(["id", "a", "b", "other"], rnd.randrange(5))}

    shapes = {
        "before": lambda: rnd.choice([row(), row(), None, rnd.choice(SCALARS)]),
        "after": lambda: rnd.choice([row(), row(), None, rnd.choice(SCALARS)]),
        "source": lambda: rnd.choice(
            [{"ts_ms": rnd.choice(SCALARS), "lsn": rnd.choice(SCALARS)}, rnd.choice(SCALARS)]
        ),
        "op": lambda: rnd.choice(["c", "u", "d", "r", "C", "t", None, 5]),
    }
    names = [n for n in ("before", "after", "op", "ts_ms", "source", "id", "a", "b", "junk") if rnd.random() < 0.55]
    rnd.shuffle(names)
    record = {n: shapes.get(n, lambda: rnd.choice(SCALARS))() for n in names}
    return json.dumps(record, ensure_ascii=rnd.random() < 0.5)


def damaged(rnd, text):
    at = rnd.randrange(len(text) + 1)
    if rnd.random() < 0.5:
        return text[:at]
    return text[:at] + rnd.choice(['"', "{", "}", ",", ":", "x", "\\"]) + text[at:]


def repeats_a_name(text):
    """Repeated names are told apart elsewhere: decoding takes the last, a lookup the first."""
    found = []

    def look(pairs):
        found.append(len(pairs) != len({k for k, _ in pairs}))
        return dict(pairs)

    try:
        json.JSONDecoder(object_pairs_hook=look).raw_decode(text)
    except ValueError:
        return False
    return any(found)


def lookups(df, spec):
    def at(*paths):
        return F.coalesce(*[F.get_json_object("payload", f"$.{p}") for p in paths])

    clocks = ["ts_ms", "source.ts_ms"]
    if spec.prefer_source_time:
        clocks.reverse()
    return df.select(
        "n",
        at("after.id", "before.id", "id").cast(spec.key["id"]).alias("id"),
        at("after.a", "a").cast(spec.columns["a"]).alias("a"),
        at("after.b", "b").cast(spec.columns["b"]).alias("b"),
        F.lower(F.coalesce(at("op"), F.lit("u"))).alias("op"),
        at(*clocks).cast("bigint").alias("version"),
        at("source.lsn").cast("bigint").alias("lsn"),
    )


@pytest.mark.parametrize("damage", [False, True])
@pytest.mark.parametrize("spec", SPECS, ids=lambda s: "-".join([*s.key.values(), *s.columns.values()]))
def test_same_rows_as_path_lookups(spark, settings, spec, damage):
    rnd = random.Random(5)
    records = [random_record(rnd) for _ in range(6000)]
    if damage:
        records = [r for r in (damaged(rnd, r) for r in records) if not repeats_a_name(r)]
    df = spark.createDataFrame(list(enumerate(records)), "n INT, payload STRING").cache()
    columns = ["n", "id", "a", "b", "op", "version", "lsn"]

    def usable(rows):
        return {r.n: tuple(str(r[c]) for c in columns) for r in rows if r.id is not None and r.op in OPS}

    got = usable(decode(df, spec).select(columns).collect())
    settings(spark__sql__ansi__enabled="false")
    assert got == usable(lookups(df, spec).collect())
    assert len(got) > 100


def test_the_last_of_repeated_names_counts(spark):
    raw = spark.createDataFrame([('{"id":1,"id":2,"a":"x","a":"y"}',)], "payload STRING")
    row = decode(raw, SPEC).first()
    assert (row.id, row.a) == ("2", "y")


def test_normalized_values_as_python_would_wrap_them(spark):
    """Every JSON value comes back equal: objects as they are, all others under "value"."""
    from driftlake.functions import normalize_value

    rnd = random.Random(3)

    def anything(depth=0):
        kind = rnd.randrange(8 if depth < 3 else 6)
        if kind == 6:
            return [anything(depth + 1) for _ in range(rnd.randrange(4))]
        if kind == 7:
            return {rnd.choice("abc") * i: anything(depth + 1) for i in range(rnd.randrange(4))}
        return rnd.choice(SCALARS + [10**25, "\\", "{", "[1", "tab\t"])

    values = [anything() for _ in range(3000)]
    texts = [rnd.choice(["", " ", "\n"]) + json.dumps(v, ensure_ascii=rnd.random() < 0.5) for v in values]
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, v STRING")
    rows = df.select(
        "n", normalize_value(F.col("v")).alias("wrapped"), normalize_value(F.col("v"), False).alias("bare")
    )
    for row in rows.collect():
        value = values[row.n]
        assert json.loads(row.bare) == value
        assert json.loads(row.wrapped) == (value if isinstance(value, dict) else {"value": value})
