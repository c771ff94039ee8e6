"""Operators on small fixtures, against plain Python where the result is not obvious."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.functions import images as I
from shelfmark.operators import calendar, checks, control, history, lookup, mart, ranking, staging
from shelfmark.schemas import COMPARED, DIMENSION_SCHEMA, KEYS, MART_SCHEMA, STAGING_SCHEMA

AS_OF = "2024-11-04 00:00:00"


# --- ranking and joins -----------------------------------------------------------


def test_number_rows_over_many_buckets(spark):
    ids = [i for i in range(1, 400) if i % 7]
    df = spark.createDataFrame([(i, i % 2) for i in ids], "id long, kind int").repartition(5)
    got = ranking.number_rows(df, "id", 100, ["kind"], rows_per_bucket=16).select("id", "_number").collect()
    want = {i: n for n, i in enumerate(sorted(ids, key=lambda i: (i % 2, i)), start=101)}
    assert {r.id: r["_number"] for r in got} == want


def test_number_rows_of_sparse_ids(spark):
    rng = random.Random(3)
    ids = sorted({rng.randrange(-(2**63), 2**63) for _ in range(200)} | {-(2**63), 2**63 - 1, 0, 1, 2})
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    got = ranking.number_rows(df, "id", rows_per_bucket=10).select("id", "_number").collect()
    assert {r.id: r["_number"] for r in got} == {i: n for n, i in enumerate(ids, start=1)}
    assert ranking.number_rows(df.limit(0), "id").count() == 0


def test_ranges_are_even_despite_an_outlier(spark):
    rows = 2_000_000
    df = spark.range(rows).union(spark.createDataFrame([(2**60,)], "id long"))
    sizes = [r["count"] for r in ranking.in_ranges(df, ["id"], rows + 1).groupBy("_range").count().collect()]
    assert len(sizes) == 9 and max(sizes) <= 2 * (rows + 1) / len(sizes)
    numbered = ranking.number_rows(df, "id")
    wrong = numbered.where((F.col("id") < rows) & (F.col("_number") != F.col("id") + 1) | (F.col("id") >= rows) & (F.col("_number") != rows + 1))
    assert numbered.count() == rows + 1 and wrong.isEmpty()


def test_prefix_sums(spark):
    rng = random.Random(8)
    rows = sorted({(rng.choice("abc"), rng.randrange(-50, 50)) for _ in range(150)}) + [("d", 0)]
    values = [rng.randrange(10) for _ in rows]
    df = spark.createDataFrame([(*r, v) for r, v in zip(rows, values)] + [(None, 1, 5)], "k string, i long, v long").repartition(4)
    for per_range in (20, 1000):
        got = {(r.k, r.i): r["_before"] for r in ranking.prefix_sums(df, ["k", "i"], "v", per_range).collect()}
        assert got == {(None, 1): 0} | {r: 5 + sum(values[:n]) for n, r in enumerate(rows)}
    assert ranking.prefix_sums(df.limit(0), ["k", "i"], "v").count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_no_text_is_aggregated(spark, small):
    dim, stg = _make(spark, DIM, DIMENSION_SCHEMA), _make(spark, STG, STAGING_SCHEMA)
    for df in (history.classify(stg, dim, small), mart.mart_update(_make(spark, [], MART_SCHEMA), dim)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
@pytest.mark.parametrize("small", [False, True])
def test_lookup_with_a_hot_key(spark, how, small):
    left = [(i, "hot" if i % 3 else f"k{i % 5}") for i in range(300)] + [(i, None) for i in range(300, 340)]
    right = [("hot", 1), ("k0", 2), ("k9", 3)]
    ldf = spark.createDataFrame(left, "id long, k string")
    rdf = spark.createDataFrame(right, "k string, v int")
    got = lookup.lookup(ldf, rdf, ["k"], how, "id", small=small, rows_per_task=10)
    values = dict(right)
    matched = {i: values[k] for i, k in left if k in values}
    if how == "left_semi":
        want = {i: None for i in matched}
    elif how == "left_anti":
        want = {i: None for i, _ in left if i not in matched}
    elif how == "inner":
        want = matched
    else:
        want = {i: matched.get(i) for i, _ in left}
    rows = got.collect()
    assert len(rows) == len(want)
    assert {r.id: (r.v if "v" in got.columns else None) for r in rows} == want


def test_hot_key_is_cut_into_slices(spark):
    left = spark.range(1000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup.lookup(left, right, ["k"], "inner", "id", rows_per_task=50)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == 1000 and max(per_task) < 600


def test_fits(spark):
    assert lookup.fits(spark.range(10), 10) and not lookup.fits(spark.range(11), 10)


# --- staging ---------------------------------------------------------------------


def test_dedup_keeps_lowest_id_and_all_null_keys(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", None), (4, "a", None), (5, None, "x"), (6, "b", "x"), (0, "b", "x")]
    df = spark.createDataFrame(rows, "id long, product_name string, manufacturer string")
    assert sorted(r.id for r in staging.dedup_keep_first(df).collect()) == [0, 1, 3, 4, 5]
    one = staging.dedup_keep_first(df, ["product_name"])
    assert one.columns == df.columns and sorted(r.id for r in one.collect()) == [0, 1, 5]


def test_dedup_comes_before_incomplete(spark):
    raw = [("1", "p", "m", ""), ("2", "p", "m", "10.000đ"), ("3", "q", "m", "20.000đ")]
    cols = ["dpi", "sensor", "connector", "pin", "os", "images", "size", "weight"]
    df = spark.createDataFrame(raw, "id string, name string, brand string, price string").withColumns(
        {"id": F.col("id").cast("long"), "created_at": F.lit(AS_OF).cast("timestamp_ntz"), **{c: F.lit("") for c in cols}}
    )
    assert [r.product_name for r in staging.stage_feed(df, "a").collect()] == ["q"]


# --- images ----------------------------------------------------------------------


def test_image_list(spark):
    text = "https://cdn/q:90/plain/https://shop/a.png, https://cdn/q:90/plain/https://shop/b.png"
    df = spark.createDataFrame([(text,), (None,), ("u/plain/v/plain/w,z",)], "images string")
    assert [r[0] for r in df.select(I.image_list(F.col("images"))).collect()] == [
        "https://shop/a.png, https://shop/b.png",
        None,
        "w, z",
    ]


def test_split_images_reads_long_lists(spark):
    df = spark.createDataFrame([(1, ", ".join(f"u{i}" for i in range(14)))], "id long, images string")
    assert [(r.n, r.url) for r in I.split_images(df).orderBy("n").collect()] == [(i + 1, f"u{i}") for i in range(14)]


# --- calendar --------------------------------------------------------------------


def test_date_fk_fills_only_null(spark):
    cal = calendar.date_dim(spark, "2024-01-01", "2024-12-31")
    rows = [(1, "2024-03-01 10:00:00", None), (2, "2024-03-01 10:00:00", 5), (3, "2030-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "id int, created_at string, date_insert_fk int").withColumn(
        "created_at", F.col("created_at").cast("timestamp_ntz")
    )
    got = {r.id: r.date_insert_fk for r in calendar.date_fk(df, cal).collect()}
    assert got == {1: 7000, 2: 5, 3: None}
    assert cal.count() == 366 and cal.filter("day_type = 'Weekend'").count() == 104


# --- history ---------------------------------------------------------------------


def _version(i, name="p", maker="m", price=1, sensor="s", deleted=False, expired="9999-12-31"):
    row = {f.name: None for f in DIMENSION_SCHEMA}
    row.update(id=i, product_name=name, manufacturer=maker, price=price, sensor=sensor)
    row.update(isDelete=deleted, expired_date=expired, created_at="2024-11-03 00:00:00")
    return row


def _make(spark, rows, schema):
    plain = [tuple(None if r.get(f.name) is None else str(r[f.name]) for f in schema) for r in rows]
    text = spark.createDataFrame(plain, ", ".join(f"`{f.name}` string" for f in schema))
    return text.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def _differs(a, b):
    return any(a[c] is not None and b[c] is not None and a[c] != b[c] for c in COMPARED)


def _brute_load(dim, stg):
    """The load as the statements it stands for, row by row."""
    same = lambda d, s: None not in (d[KEYS[0]], d[KEYS[1]]) and all(d[k] == s[k] for k in KEYS)
    live = [d for d in dim if not d["isDelete"] and d["expired_date"] == "9999-12-31"]
    fresh = [s for s in stg if not any(same(d, s) for d in dim)]
    changed = [s for s in stg if any(same(d, s) and _differs(d, s) for d in live)]
    ids = {d["id"] for d in live for s in changed if same(d, s)}
    top = max((d["id"] for d in dim), default=0)
    out = [(d["id"], d["product_name"], bool(d["isDelete"]) or d["id"] in ids) for d in dim]
    for n, s in enumerate(sorted(fresh, key=lambda s: s["id"]) + sorted(changed, key=lambda s: s["id"]), 1):
        out.append((top + n, s["product_name"], False))
    return out


DIM = [
    _version(1, "same"),
    _version(2, "changed", price=5),
    _version(3, "null sensor", sensor=None),
    _version(4, "withdrawn", deleted=True, expired="2024-01-01"),
    _version(5, "no maker", maker=None),
    _version(6, "twice", price=1),
    _version(7, "twice", price=9),
    _version(8, "changed", price=2, deleted=True, expired="2024-01-01"),
    _version(9, "untouched"),
]
STG = [
    _version(1, "same"),
    _version(2, "changed"),
    _version(3, "null sensor"),
    _version(4, "withdrawn", price=7),
    _version(5, "no maker", maker=None),
    _version(6, "twice"),
    _version(7, "brand new"),
]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_scd2_load_matches_brute_force(spark, monkeypatch, limit):
    """With a limit of zero nothing is small, so every join takes its shuffled form."""
    monkeypatch.setattr(history, "fits", lambda df, max_rows=limit: lookup.fits(df, max_rows))
    cal = calendar.date_dim(spark, "2024-11-01", "2024-11-30")
    got = history.scd2_load(_make(spark, DIM, DIMENSION_SCHEMA), _make(spark, STG, STAGING_SCHEMA), cal, AS_OF)
    rows = got.collect()
    assert sorted((r.id, r.product_name, r.isDelete) for r in rows) == sorted(_brute_load(DIM, STG))
    by_id = {r.id: r for r in rows}
    assert str(by_id[2].expired_date) == "2024-11-04" and str(by_id[2].date_delete) == "2024-11-04"
    assert str(by_id[6].expired_date) == str(by_id[7].expired_date) == "2024-11-04"
    assert all((str(r.expired_date) == "9999-12-31") == (not r.isDelete) for r in rows)
    assert by_id[10].date_insert_fk == 7248 and by_id[1].date_insert_fk == 7247
    assert got.schema == DIMENSION_SCHEMA


def test_scd2_twice_on_one_day_changes_nothing(spark):
    cal = calendar.date_dim(spark, "2024-11-01", "2024-11-30")
    stg = _make(spark, [s for s in STG if s["manufacturer"]], STAGING_SCHEMA)
    once = history.scd2_load(_make(spark, DIM, DIMENSION_SCHEMA), stg, cal, AS_OF).cache()
    twice = history.scd2_load(once, stg, cal, AS_OF)
    assert Counter(once.collect()) == Counter(twice.collect())


def test_step_operators_agree_with_the_load(spark):
    dim, stg = _make(spark, DIM, DIMENSION_SCHEMA), _make(spark, STG, STAGING_SCHEMA)
    assert sorted(r.product_name for r in history.new_products(stg, dim).collect()) == ["brand new", "no maker"]
    changed = history.changed_products(stg, dim)
    assert {r.product_name: r.n for r in changed.collect()} == {"changed": 1, "twice": 2}
    assert sorted(r.id for r in history.expire_ids(dim, changed).collect()) == [2, 6, 7]
    for small in (True, False):
        expired = history.expire(dim, history.expire_ids(dim, changed, small), "2024-11-04", small)
        assert expired.filter("expired_date = '2024-11-04'").count() == 3
    pairs = dim.alias("d").join(stg.alias("s"), dim["product_name"] == stg["product_name"])
    assert pairs.filter(history.any_differs(dim, stg)).select("d.product_name").distinct().count() == 3


def test_hot_key_with_many_current_versions(spark):
    """One key holds most rows; all of its versions expire, whatever the slicing."""
    dim = [_version(i, "hot", price=i % 50) for i in range(1, 500)] + [_version(i, f"p{i}") for i in range(500, 600)]
    stg = [_version(1, "hot", price=3), _version(2, "p550", price=8)]
    ddf, sdf = _make(spark, dim, DIMENSION_SCHEMA), _make(spark, stg, STAGING_SCHEMA)
    keys = history.changed_products(sdf, ddf, False).groupBy(*KEYS).agg(F.max("n").alias("n"))
    got = history.expire_keys(ddf, keys, "2024-11-04", small=False)
    assert got.filter("isDelete").count() == 500 and got.count() == 599


def test_key_collation(spark):
    dim = history.with_key_collation(_make(spark, [_version(1, "Chuột", "HÃNG")], DIMENSION_SCHEMA))
    stg = history.with_key_collation(_make(spark, [_version(1, "chuot ", "hang")], STAGING_SCHEMA))
    assert history.new_products(stg, dim, small=False).count() == 0


# --- mart ------------------------------------------------------------------------


def _names(df):
    return sorted((r.product_name or "-", r.id) for r in df.collect())


def test_mart_sync(spark):
    dw = [
        _version(1, "a", price=1, deleted=True, expired="2024-11-04"),
        _version(2, "a", price=2),
        _version(3, "b", deleted=True, expired="2024-11-04"),
        _version(4, "c"),
        _version(5, "a", maker="other"),
        _version(6, "d", sensor=None),
    ]
    old = [_version(1, "a", price=1), _version(3, "b"), _version(9, "d")]
    mdf, ddf = _make(spark, old, MART_SCHEMA), _make(spark, dw, DIMENSION_SCHEMA)
    # a moves to its new version, b goes, c comes; "a" of another maker is not
    # inserted because its name is there; d differs only by a NULL
    assert _names(mart.mart_update(mdf, ddf)) == [("a", 2), ("b", 3), ("d", 9)]
    assert _names(mart.mart_sync(mdf, ddf)) == [("a", 2), ("c", 4), ("d", 9)]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_not_in_with_nulls(spark, monkeypatch, limit):
    monkeypatch.setattr(mart, "fits", lambda df, max_rows=limit: lookup.fits(df, max_rows))
    dw = _make(spark, [_version(1, "a"), _version(2, "b"), _version(3, None)], DIMENSION_SCHEMA)

    def inserted(*names):
        return _names(mart.mart_insert(_make(spark, [_version(9, n) for n in names], MART_SCHEMA), dw))

    assert inserted("a") == [("b", 2)]
    assert inserted("a", None) == []
    assert inserted() == [("-", 3), ("a", 1), ("b", 2)]


# --- control ---------------------------------------------------------------------


def _logs(spark):
    rows = [
        (1, 2, "2024-11-03 08:00:00", "f1", 3, 1, "2024-11-04 09:00:00", "C_SE"),
        (2, 2, "2024-11-03 00:00:00", "f2", 3, 1, "2024-11-03 09:00:00", "C_SE"),
        (3, 3, "2024-11-03 23:59:59", "f3", 3, 1, "2024-11-03 09:00:00", "C_E"),
        (4, 2, "2024-11-04 00:00:00", "f4", 3, 1, "2024-11-04 09:00:00", "C_SE"),
    ]
    names = ["file_log_id", "config_id", "create_time", "file_path", "count", "file_size", "update_at", "status"]
    df = spark.createDataFrame(rows, names)
    return df.withColumns(
        {
            "create_time": F.col("create_time").cast("timestamp_ntz"),
            "update_at": F.col("update_at").cast("timestamp_ntz"),
            "file_size": F.col("file_size").cast("decimal(10,2)"),
        }
    )


def test_ready_file_by_create_or_update_day(spark):
    logs, configs = _logs(spark), spark.createDataFrame([(2, "two"), (3, "three")], "config_id long, name string")
    assert control.ready_file(logs, configs, 2, "2024-11-03").first().file_log_id == 1
    assert control.ready_file(logs, configs, 2, "2024-11-03", "update_at").first().file_log_id == 2
    assert control.ready_file(logs, configs, 3, "2024-11-03").isEmpty()
    assert control.on_day(logs, "create_time", "2024-11-03").count() == 3
    assert control.on_day(logs, "create_time").count() == 0
    with pytest.raises(control.MissingInput):
        control.require_rows(control.ready_file(logs, configs, 3, "2024-11-03"))
    assert {r.config_id: r.already_run for r in control.run_guard(logs, configs, "2024-11-04").collect()} == {2: True, 3: False}
    assert control.already_run(logs, 3, "2024-11-03") and not control.already_run(logs, 3, "2024-11-04")
    with pytest.raises(control.AlreadyRun):
        control.require_not_run(logs, 2, "2024-11-03")


def test_day_filter_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "logs")
    _logs(spark).write.parquet(path)
    plan = control.on_day(spark.read.parquet(path), "create_time", "2024-11-03")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(create_time" in plan and "LessThan(create_time" in plan


def test_transitions(spark):
    logs = _logs(spark)
    moved = control.transition(logs, 1, "L_P", AS_OF)
    moved = control.transition(moved, 1, "L_SE", AS_OF)
    assert control.by_id(moved, "file_log_id", 1).first().status == "L_SE"
    for bad in ((1, "C_E"), (3, "L_P"), (1, "XX")):
        with pytest.raises(control.BadTransition):
            control.transition(logs, bad[0], bad[1], AS_OF)
    with pytest.raises(control.MissingInput):
        control.transition(logs, 99, "L_P", AS_OF)
    updates = spark.createDataFrame([(3, "L_P")], "file_log_id long, status string")
    assert control.log_update(logs, updates, AS_OF).filter("status = 'L_P'").count() == 1
    with pytest.raises(PySparkException):
        control.log_update(logs, updates, AS_OF, check=True).collect()


def test_log_update_keeps_what_is_not_given(spark):
    updates = spark.createDataFrame([(3, "C_SE", 7)], "file_log_id long, status string, count long")
    row = control.by_id(control.log_update(_logs(spark), updates, AS_OF, check=True), "file_log_id", 3).first()
    assert (row.status, row["count"], row.file_size, str(row.update_at)) == ("C_SE", 7, Decimal("1.00"), AS_OF)


# --- checks ----------------------------------------------------------------------


def test_checks(spark):
    fact = spark.createDataFrame([(i, 5 if i < 90 else i) for i in range(100)] + [(100, None)], "id long, fk long")
    dim = spark.createDataFrame([(i,) for i in range(90, 99)], "pk long")
    lost = checks.orphans(fact, dim, "fk", "pk", "id")
    assert sorted(r.id for r in lost.collect()) == [*range(90), 99]
    assert [(r.fk, r.n) for r in checks.duplicate_keys(fact, ["fk"]).collect()] == [(5, 90)]
    df = spark.createDataFrame([(1, "C_E", "ab"), (2, "??", None), (3, None, "abcdef")], "id int, status string, t string")
    broken = checks.violations(df, "id", {"status": ("C_E",)}, ["t"], {"t": 4})
    assert sorted((r.id, r.rule) for r in broken.collect()) == [(2, "domain:status"), (2, "null:t"), (3, "length:t")]


# --- random worlds against brute force -------------------------------------------


def _random_version(rng, i, deleted_share=0.3):
    deleted = rng.random() < deleted_share
    row = _version(
        i,
        rng.choice(["a", "b", "c", "d", "e", "f", "g"]),
        rng.choice(["m", "n", None]),
        price=rng.choice([1, 2, None]),
        sensor=rng.choice(["s", "t", None]),
        deleted=deleted,
        expired="2024-01-01" if deleted or rng.random() < 0.1 else "9999-12-31",
    )
    return row


def _distinct_keys(rows):
    seen, out = set(), []
    for row in rows:
        key = tuple(row[k] for k in KEYS)
        if None in key or key not in seen:
            out.append(row)
        seen.add(key)
    return out


def _brute_mart(mart_rows, dw):
    same = lambda d, m: None not in [d[k] for k in KEYS] and all(d[k] == m[k] for k in KEYS)
    live = [d for d in dw if not d["isDelete"]]
    ids = []
    for m in mart_rows:
        versions = sorted((d for d in live if same(d, m)), key=lambda d: d["id"])
        changed = versions and _differs(versions[-1], m)
        ids.append((m["product_name"], versions[-1]["id"] if changed else m["id"]))
    names = {n for n, _ in ids}
    if None not in names:
        # the mart holds a key once: of several current versions the newest
        newest = [d for d in live if not any(same(d, o) and o["id"] > d["id"] for o in live)]
        ids += [(d["product_name"], d["id"]) for d in newest if d["product_name"] not in names]
    gone = {d["id"] for d in dw if d["isDelete"]}
    return sorted((n, i) for n, i in ids if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_random_loads_and_syncs(spark, monkeypatch, seed):
    rng = random.Random(seed)
    if seed % 2:
        for module in (history, mart):
            monkeypatch.setattr(module, "fits", lambda df, max_rows=0: lookup.fits(df, max_rows))
        monkeypatch.setattr(lookup, "ROWS_PER_TASK", 2)
    dim = [_random_version(rng, i) for i in range(1, 41)]
    stg = _distinct_keys([_random_version(rng, i) for i in range(1, 21)])
    cal = calendar.date_dim(spark, "2024-11-01", "2024-11-30")
    got = history.scd2_load(_make(spark, dim, DIMENSION_SCHEMA), _make(spark, stg, STAGING_SCHEMA), cal, AS_OF)
    rows = sorted((r.id, r.product_name, r.isDelete) for r in got.collect())
    assert rows == sorted(_brute_load(dim, stg))

    shown = [m for m in _distinct_keys([_random_version(rng, i) for i in range(30, 45)]) if m["manufacturer"]]
    synced = mart.mart_sync(_make(spark, shown, MART_SCHEMA), _make(spark, dim, DIMENSION_SCHEMA))
    assert sorted((r.product_name, r.id) for r in synced.collect()) == _brute_mart(shown, dim)
