"""Landed files: restarts, repeated batches, and files that are refused."""

import glob
import os

import pytest
from packages import CLIENT_DATA, client_package, write

from rowloom.config import PackageConfig
from rowloom.plans.run import Normalization
from rowloom.plans.scratch import scratch_root
from rowloom.plans.table_queries import QUERIES
from rowloom.streaming import ingest

HALF = "<D><row><c1>whole</c1></row><row><c1>half</c1><c2>lost"


@pytest.fixture
def stream(spark, tmp_path):
    one = Normalization(spark, PackageConfig(client_package(tmp_path / "pkg")))
    paths = {n: str(tmp_path / n) for n in ("path", "dead_letters", "checkpoint")}

    def catch_up(check=True, per_batch=1, **settings):
        config = PackageConfig(one.config.package_root, check_contents=check, **settings)
        landed = ingest.landed_chunks(spark, str(tmp_path / "landing"), files_per_batch=per_batch)
        ingest.ingest(landed, "client", one.catalog, config, broadcast=True, **paths).awaitTermination()
        rows = spark.read.parquet(paths["path"]).collect()
        letters = spark.read.parquet(paths["dead_letters"]).collect()
        return rows, {(r["app_name"], r["source_file"].rpartition("/")[2], r["reason"]) for r in letters}

    catch_up.paths = paths
    return catch_up


def test_stream_continues_where_it_stopped(spark, tmp_path, stream):
    write(tmp_path, {"landing/1.xml": CLIENT_DATA})
    expected = Normalization(spark, PackageConfig(str(tmp_path / "pkg"))).run().drop("source_file").collect()
    rows, letters = stream()
    assert sorted(str(tuple(r)[:2] + tuple(r)[3:19]) for r in rows) == sorted(str(tuple(r)) for r in expected) and not letters
    write(tmp_path, {"landing/2.xml": "<D><row><c1>new</c1></row></D>"})
    rows, _ = stream()
    assert len(rows) == 13 and sum(r.record_id == "new" for r in rows) == 1


@pytest.mark.parametrize("check", [True, False])
def test_broken_off_files_are_set_aside(tmp_path, stream, check):
    write(tmp_path, {
        "landing/1.xml": CLIENT_DATA, "landing/2.xml": HALF, "landing/3.xml": "<row><c1>3</c1></row><!-- </row>",
        "landing/4.xml": b"<?xml version='1.0' encoding='shift_jis'?><row><c1>4</c1></row>",
        "landing/5.xml": "<?xml version='1.0' encoding='windows-1252'?><row><c1>€<!-- </row> --></c1></row>".encode("cp1252"),
        "landing/6.xml": "<row><c1>6</c1></row>",
    })
    rows, letters = stream(check, per_batch=4)
    assert {r.record_id for r in rows} == {"A1", "B2", "€", "6"}
    refused = {name: reason for _, name, reason in letters}
    assert set(refused) == {"2.xml", "3.xml", "4.xml"} and refused["2.xml"] == "the last record has no end"
    assert "no end" in refused["3.xml"] and "SHIFT_JIS" in refused["4.xml"]


def test_malformed_files_are_set_aside(tmp_path, stream):
    write(tmp_path, {"landing/1.xml": "<row><c1>a & b</c1></row>", "landing/2.xml": "<row><c1>2</c1></row>"})
    rows, letters = stream(per_batch=2)
    assert [r.record_id for r in rows] == ["2"] and [name for _, name, _ in letters] == ["1.xml"]


def test_a_repeated_batch_replaces_itself(tmp_path, stream):
    """The commit of the last batch is lost, as when the driver dies after writing: it runs again."""
    write(tmp_path, {"landing/1.xml": CLIENT_DATA, "landing/2.xml": HALF})
    before = stream(False, per_batch=2)
    commits = [p for p in glob.glob(f"{stream.paths['checkpoint']}/commits/*") if os.path.basename(p).isdigit()]
    for path in [max(commits), *glob.glob(f"{stream.paths['checkpoint']}/commits/.*.crc")]:
        os.remove(path)
    rows, letters = stream(False, per_batch=2)
    assert sorted(map(str, rows)) == sorted(map(str, before[0])) and letters == before[1]


def test_many_small_files_land_in_one_directory(spark):
    root = scratch_root(spark)
    before = set(glob.glob(f"{root}/rowloom-landing-*"))
    tasks = spark.conf.get(ingest.LISTING_TASKS)
    rows = QUERIES["truncated_records"](spark, "/root/testdata/sf0.001").collect()
    (landing,) = set(glob.glob(f"{root}/rowloom-landing-*")) - before
    assert not [p for p in glob.glob(f"{landing}/*") if os.path.isdir(p)]
    files = [p for p in glob.glob(f"{landing}/part-*") if os.path.getsize(p)]
    assert len(files) == len({r.file for r in rows})
    assert None not in {r.file for r in rows}
    assert spark.conf.get(ingest.LISTING_TASKS) == tasks


def test_streams_list_files_in_few_tasks(spark):
    with ingest.few_listing_tasks(spark):
        assert int(spark.conf.get(ingest.LISTING_TASKS)) <= 4 * spark.sparkContext.defaultParallelism
