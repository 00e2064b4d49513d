import uuid

import pytest

from skyledger.__main__ import main
from skyledger.config import LakeConfig
from skyledger.sources import tables
from skyledger.streaming import jobs


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    tag = uuid.uuid4().hex[:8]
    env = ["--root", str(tmp_path / "lake"), "--catalog", f"b{tag}", "--stream-catalog", f"s{tag}"]
    cfg = LakeConfig(catalog=f"b{tag}", stream_catalog=f"s{tag}", root=str(tmp_path / "lake"))
    csv, landing = str(tmp_path / "csv"), str(tmp_path / "landing")

    def run(*args):
        main([*env, *args])

    run("setup")
    run("make-flights", csv, "--rows", "300")
    run("make-events", csv, landing, "--damaged", "50")
    landed = spark.read.parquet(landing).count()
    run("make-events", csv, landing, "--events", "70", "--heavy", "500")
    assert spark.read.parquet(landing).count() == landed + 70
    run("batch", csv)
    run("bronze", "--path", landing, "--option", "maxFilesPerTrigger=1")
    run("silver", "--follow", "maxFilesPerTrigger=2")
    run("rejects")
    run("gold", "--follow", "maxFilesPerTrigger=2")
    run("current", "--follow", "maxFilesPerTrigger=2")
    run("summary")
    run("compact", "--keep-finished", "100000")
    events = spark.table(cfg.table_name("silver", stream=True))
    flights = spark.table(cfg.table_name("silver"))
    states = jobs.read_current(spark, cfg.table_name("gold", stream=True, table=jobs.CURRENT_TABLE))
    assert flights.count() == 300
    assert 0 < states.count() <= events.select("ID_Vuelo").distinct().count()
    assert spark.table(cfg.table_name("gold", stream=True)).count() >= states.count()
    summary = spark.table(cfg.table_name("gold", stream=True, table=jobs.SUMMARY_TABLE))
    assert summary.select("id_vuelo").distinct().count() == states.count()
    run("merge")
    run("summary")
    run("sweep", "--grace", "0")
    merged = jobs.read_merged(spark, cfg.table_name("gold", stream=True, table=jobs.MERGED_TABLE))
    assert merged.select("id_vuelo").distinct().count() == states.count()
    assert spark.table(summary_name := cfg.table_name("gold", stream=True, table=jobs.SUMMARY_TABLE)).count()
    assert tables.sweep(spark, summary_name, 0) == []
    run("teardown", "--table", cfg.table_name("gold"), "--path", cfg.checkpoint("gold"))
    assert not spark.catalog.tableExists(cfg.table_name("gold"))
    assert cfg.checkpoint("gold") in capsys.readouterr().out


def test_all_streaming_jobs_in_one_application(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    env = ["--root", str(tmp_path / "lake"), "--catalog", f"b{tag}", "--stream-catalog", f"s{tag}"]
    cfg = LakeConfig(catalog=f"b{tag}", stream_catalog=f"s{tag}", root=str(tmp_path / "lake"))
    csv, landing = str(tmp_path / "csv"), str(tmp_path / "landing")
    main([*env, "setup"])
    main([*env, "make-flights", csv, "--rows", "200"])
    main([*env, "make-events", csv, landing])
    main([*env, "batch", csv])
    main([*env, "stream", "--path", landing, "--side", "active", "--follow", "maxFilesPerTrigger=3"])
    counts = {
        name: spark.table(cfg.table_name(layer, stream=True, table=name)).count()
        for layer, name in [
            ("bronze", "vuelos"), ("silver", jobs.REJECTS_TABLE), ("gold", jobs.CURRENT_TABLE),
        ]
    }
    assert counts["vuelos"] == spark.table(cfg.table_name("silver", stream=True)).count() > 200
    assert counts[jobs.REJECTS_TABLE] == 0
    gold = spark.table(cfg.table_name("gold", stream=True))
    assert counts[jobs.CURRENT_TABLE] == gold.select("id_vuelo").distinct().count()


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["fly"])
