"""Each file is loaded once, also over restarts."""

from pyspark.sql import functions as F

from shelfmark.plans.queries import _spread
from shelfmark.schemas import FEEDS
from shelfmark.sources.csv_feed import export_csv
from shelfmark.streaming.arrivals import load_into_dimension, load_new_files


def test_each_new_file_is_loaded_once(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    folder.mkdir()
    config = {"staging_fields": "name, price", "ignore_rows": 1}
    batches = []

    def size(name):
        return (folder / name).stat().st_size

    def load(rows, files, batch):
        assert batch == len(batches)
        name = F.substring_index("_path", "/", -1)
        batches.append((
            sorted(tuple(r) for r in rows.select(name, "name", "price").collect()),
            sorted(tuple(r) for r in files.select(name, "bytes", "rows").collect()),
        ))

    def run(**options):
        load_new_files(spark, str(folder), config, checkpoint, load, **options).awaitTermination()

    for i in range(9):
        (folder / f"f{i}.csv").write_text(f'"name","price"\n"a{i}","1\\n000đ"\n"b",""\n')
    (folder / "none.csv").write_text('"name","price"\n')
    run()
    run()
    (rows, files), = batches
    assert rows == sorted(r for i in range(9) for r in [(f"f{i}.csv", f"a{i}", "1\n000đ"), (f"f{i}.csv", "b", "")])
    assert files == [(f"f{i}.csv", size(f"f{i}.csv"), 2) for i in range(9)] + [("none.csv", 15, 0)]
    for name in ("x", "y y%20", "z"):
        (folder / f"{name}.csv").write_text('"name","price"\n"c","2.000đ"\n')
    run(files_per_batch=2)
    assert [len(files) for _, files in batches[1:]] == [2, 1]
    assert [f[-1] for _, files in batches[1:] for f in files] == [1, 1, 1]


def test_a_batch_is_parsed_once_for_the_dimension(spark, tmp_path):
    fields = ["id", *FEEDS["a"].fields]
    row = {"id": "1", "name": "mouse", "brand": "b", "price": "100.000đ"}
    folder = tmp_path / "in"
    export_csv(spark.createDataFrame([tuple(row.get(c) for c in fields)], ", ".join(f"{c} string" for c in fields)), str(folder))
    loads = []

    class Stored:
        known = {}

        def state(self):
            return {"loads": self.known}

        def load(self, stg, calendar, as_of, name):
            loads.append((name, [f for f in stg.inputFiles() if str(folder) in f], [r["product_name"] for r in stg.collect()]))

    def run(checkpoint):
        config = {"staging_fields": ", ".join(fields)}
        day = "2024-11-04 00:00:00"
        load_into_dimension(spark, str(folder), config, str(tmp_path / checkpoint), "a", Stored(), None, day, "s").awaitTermination()

    run("one")
    assert loads == [("s 0", [], ["mouse"])]
    Stored.known = {"s 0": {}}
    run("two")
    assert len(loads) == 1


def test_rows_of_one_small_file_are_written_by_many_tasks(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    spread = _spread(rows, rows_per_file=100)
    assert spread.rdd.getNumPartitions() == 11
    assert sorted(r[0] for r in spread.collect()) == list(range(1000))
    assert _spread(rows.where("id < 0")).collect() == []
