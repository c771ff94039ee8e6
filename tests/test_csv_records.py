"""Records that do not have the columns of their config row."""

import csv
import random

import pytest

from shelfmark.sources import csv_feed


@pytest.mark.parametrize("numbered", [True, False])
@pytest.mark.parametrize("bad", ["1,2,3", "1", '"a\nb",2,3'])
def test_records_of_another_width_fail(spark, tmp_path, bad, numbered):
    (tmp_path / "x.csv").write_text(f"k,v\n0,0\n{bad}\n")
    for read in ("collect", "count"):
        with pytest.raises(Exception, match="fields do not match"):
            getattr(csv_feed.load_csv(spark, str(tmp_path), {"staging_fields": "k, v"}, numbered=numbered), read)()


def test_skipped_lines_have_any_width(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a title\nk,v,w\n1,2\n")
    config = {"staging_fields": "k, v", "ignore_rows": 2}
    assert [tuple(r) for r in csv_feed.load_csv(spark, str(tmp_path), config).collect()] == [(1, "1", "2")]
    (tmp_path / "x.csv").write_text("a title\nk,v,w\n1,2\n3\n")
    with pytest.raises(Exception, match="fields do not match"):
        csv_feed.load_csv(spark, str(tmp_path), config).collect()


TEXTS = ["plain", "a\nb", 'say "hi"', '"', '""\n""', "x,\ny", "", " sp ", "back\\slash", "\\n", "tab\there", "\r\nend", "é\n\n\nü", "\n"]


def _write(path, rows, **options):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator="\n", **options).writerows(rows)


@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
@pytest.mark.parametrize("size", [300, 10**7])
def test_line_breaks_in_quotes_over_many_blocks(spark, tmp_path, monkeypatch, size, quoting):
    """As the csv module reads it, however small the blocks are that tasks read."""
    rng = random.Random(size)
    want = []
    for name in ("a", "b"):
        rows = [[str(i), "".join(rng.choice(TEXTS) for _ in range(rng.randint(0, 6))), rng.choice(TEXTS)] for i in range(60)]
        rows[20][1] = "long \n" * 200  # blocks without the begin of a record
        _write(tmp_path / f"{name}.csv", [["k", "head\ning", "w"], *rows], quoting=quoting)
        want += list(csv.reader(open(tmp_path / f"{name}.csv", newline="", encoding="utf-8")))[1:]
    config = {"staging_fields": "k, v, w", "escaped_by": "", "ignore_rows": 1}
    if size == 300:
        monkeypatch.setattr(csv_feed, "fits", lambda df: False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        loaded = csv_feed.load_csv(spark, str(tmp_path), config)
        rows = loaded.orderBy("id").collect()
        named = csv_feed.load_csv(spark, str(tmp_path), config, numbered=False, file_column="_path").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.id for r in rows] == list(range(1, 121))
    assert [[r.k, r.v, r.w] for r in rows] == want
    assert sorted([r.k, r.v, r.w] for r in named) == sorted(want)
    assert {r._path.rsplit("/", 1)[1] for r in named} == {"a.csv", "b.csv"}


def test_escapes_and_line_breaks_together(spark, tmp_path):
    (tmp_path / "x.csv").write_text('k,v\n"1","a\\nb\nc"\n"2",\\N\n"3","d\\\\e"\n')
    rows = csv_feed.load_csv(spark, str(tmp_path), {"staging_fields": "k, v"}).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "1", "a\nb\nc"), (2, "2", None), (3, "3", "d\\e")]


def test_a_file_that_ends_inside_quotes_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text('k,v\n1,"open\n2,b\n')
    with pytest.raises(csv_feed.BadFile, match="ends inside quotes"):
        csv_feed.load_csv(spark, str(tmp_path), {"staging_fields": "k, v"})
