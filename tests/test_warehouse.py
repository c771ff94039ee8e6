"""Increments of the stored dimension and mart against whole loads and syncs."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import calendar, history, mart
from shelfmark.plans import warehouse as W
from shelfmark.schemas import DIMENSION_SCHEMA, MART_SCHEMA, STAGING_SCHEMA
from shelfmark.sources.versions import Conflict, Folder, Table

CALENDAR = ("2024-01-01", "2024-12-31")


def _files(root):
    return {p: (os.stat(p).st_mtime_ns, os.stat(p).st_size) for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def _batch(spark, rng, size=14):
    rows, keys = [], set()
    for i in range(1, size + 1):
        name, maker = f"p{rng.randrange(12)}", rng.choice(["x", "y", None])
        if maker is not None and (name, maker) in keys:
            continue
        keys.add((name, maker))
        row = {f.name: None for f in STAGING_SCHEMA}
        row |= {"id": i, "product_name": name, "manufacturer": maker, "sensor": rng.choice(["s", "t", None]), "source": "f"}
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, STAGING_SCHEMA)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_equal_whole_loads(spark, tmp_path, seed):
    rng = random.Random(seed)
    cal = calendar.date_dim(spark, *CALENDAR)
    first = history.scd2_load(spark.createDataFrame([], DIMENSION_SCHEMA), _batch(spark, rng), cal, "2024-03-01 00:00:00")
    # withdrawn products, and two current versions of one key
    gone = F.pmod(F.col("id"), F.lit(5)) == 0
    whole = first.withColumns({"isDelete": gone, "expired_date": F.when(gone, F.lit("2024-03-02").cast("date")).otherwise(F.col("expired_date"))})
    twice = whole.where("manufacturer = 'x' AND NOT isDelete").limit(1)
    whole = whole.union(
        twice.withColumns({"id": F.lit(100).cast("long"), "sensor": F.lit("u")})
    )
    dim = W.Dimension(spark, str(tmp_path / "dim"))
    dim.create(whole, cal)
    whole = dim.read()
    shop = W.Mart(spark, str(tmp_path / "mart"), dim, buckets=4)
    shop.create(spark.createDataFrame([], MART_SCHEMA))
    synced = mart.mart_sync(spark.createDataFrame([], MART_SCHEMA), whole)
    assert _sorted(shop.read()) == _sorted(synced)
    for day in range(4, 7):
        batch, as_of = _batch(spark, rng), f"2024-03-0{day} 00:00:00"
        whole = spark.createDataFrame(history.scd2_load(whole, batch, cal, as_of).collect(), DIMENSION_SCHEMA)
        synced = spark.createDataFrame(mart.mart_sync(synced, whole).collect(), MART_SCHEMA)
        assert dim.load(batch, cal, as_of, f"day {day}")
        assert _sorted(dim.read()) == _sorted(whole)
        assert shop.sync() == [f"day {day}"]
        assert _sorted(shop.read()) == _sorted(synced)


def test_a_load_touches_no_closed_file_and_is_applied_once(spark, tmp_path):
    rng = random.Random(4)
    cal, root = calendar.date_dim(spark, *CALENDAR), str(tmp_path / "dim")
    dim = W.Dimension(spark, root)
    for day in (1, 2, 3):
        dim.load(_batch(spark, rng), cal, f"2024-04-0{day} 00:00:00", str(day))
    before, parts = _files(root), dim.state()["closed"]
    assert parts
    batch = _batch(spark, rng, 1000)
    assert dim.load(batch, cal, "2024-04-05 00:00:00", "4")
    assert {p: s for p, s in _files(root).items() if p in before} == before
    assert dim.state()["closed"][: len(parts)] == parts
    rows, files, version = _sorted(dim.read()), _files(root), dim.folder.head()[0]
    assert not dim.load(batch, cal, "2024-04-05 00:00:00", "4")
    assert (_sorted(dim.read()), _files(root), dim.folder.head()[0]) == (rows, files, version)
    assert [r.id for r in dim.read().orderBy("id").collect()] == list(range(1, len(rows) + 1))


def test_plans_of_the_sync_read_no_closed_part_and_only_touched_buckets(spark, tmp_path):
    rng = random.Random(6)
    cal = calendar.date_dim(spark, *CALENDAR)
    dim = W.Dimension(spark, str(tmp_path / "dim"))
    dim.load(_batch(spark, rng, 40), cal, "2024-04-01 00:00:00", "1")
    dim.load(_batch(spark, rng, 40), cal, "2024-04-02 00:00:00", "2")
    shop = W.Mart(spark, str(tmp_path / "mart"), dim)
    shop.create(spark.createDataFrame([], MART_SCHEMA))
    one = _batch(spark, random.Random(9), 40).where("product_name = 'p3'")
    dim.load(one, cal, "2024-04-03 00:00:00", "3")
    buckets, rows, expired = shop.changes("3", shop.folder.head()[1])
    own = dim.state()["loads"]["3"]
    read = {p.replace("file:", "") for df in (rows, expired) for p in df.inputFiles()}
    assert all(own["open"] in p or (own["closed"] and own["closed"] in p) for p in read if str(tmp_path) in p)
    assert len(buckets) == 1 < len(shop.folder.head()[1]["buckets"])
    untouched = {p: s for p, s in _files(tmp_path / "mart").items()}
    assert shop.sync() == ["3"] and shop.sync() == []
    assert {p: s for p, s in _files(tmp_path / "mart").items() if p in untouched} == untouched
    # what has been passed on needs no old open parts
    dim.folder.vacuum(1)
    shop.folder.vacuum(1)
    assert shop.read().count() and dim.read().count()


def test_a_missing_name_with_two_current_versions_goes_in_once(spark):
    rows = [{f.name: None for f in DIMENSION_SCHEMA} | {"id": i, "product_name": n, "manufacturer": m, "isDelete": False}
            for i, n, m in [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", None), (5, "b", None)]]
    dw = spark.createDataFrame([tuple(r.values()) for r in rows], DIMENSION_SCHEMA)
    got = mart.mart_insert(spark.createDataFrame([], MART_SCHEMA), dw)
    assert sorted(r.id for r in got.collect()) == [2, 3, 4, 5]


def test_readers_see_whole_states(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), spark.range(0).schema)
    assert table.read().count() == 0
    table.replace(spark.range(5))
    reader = table.read()
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="no"):
        table.replace(broken)
    assert table.read().count() == 5  # nothing of the failed writer
    table.replace(spark.range(7))
    assert (reader.count(), table.read().count()) == (5, 7)
    base, _ = table.folder.head()
    table.replace(spark.range(8), base)
    with pytest.raises(Conflict):
        table.replace(spark.range(6), base)
    assert table.append(spark.range(2)).count() == 10
    assert table.folder.vacuum(1) and table.read().count() == 10
    Folder(spark, str(tmp_path / "t")).remove()
    assert not (tmp_path / "t").exists()
