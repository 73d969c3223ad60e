"""Files -> Bronze -> Silver -> Gold on exported fixture files; row numbering."""

import os
import tempfile

import pytest

from forgeline.plans import pipeline
from forgeline.plans import layers as L
from forgeline.sources import files


def test_file_row_number_is_file_order(spark, tmp_path):
    p = tmp_path / "capteurs_temperature.csv"
    lines = ["machine_id;timestamp;temperature"] + [f"MACH-01;2025-01-01 {h % 24:02d}:00:00;{h}" for h in range(500)]
    p.write_text("\n".join(lines) + "\n")
    assert files.sniff_delimiter(spark, str(p)) == ";"
    df = files.with_file_row_number(files.read_delimited(spark, str(p)))
    got = sorted((r.row_number, int(r.temperature)) for r in df.collect())
    assert got == [(i + 1, i) for i in range(500)]


def test_run_from_files(spark):
    t, pr, i = L.FixtureChain(spark, "/root/testdata/sf0.001").raw()
    d = tempfile.mkdtemp(prefix="forgeline-src-")
    t.select(t.machine_id_raw.alias("machine_id"), t.timestamp_raw.alias("timestamp"), t.temperature_raw.alias("temperature")) \
        .coalesce(1).write.option("header", True).option("sep", ";").csv(os.path.join(d, "capteurs_temperature.csv"))
    pr.select(pr.machine_id_raw.alias("machine_id"), pr.timestamp_raw.alias("timestamp"), pr.pressure_raw.alias("pressure_bar")) \
        .coalesce(1).write.option("header", True).option("sep", "\t").csv(os.path.join(d, "capteurs_pression.tsv"))
    i.drop("row_number").coalesce(1).write.option("header", True).csv(os.path.join(d, "releves_incidents.csv"))
    out = tempfile.mkdtemp(prefix="forgeline-out-")
    arts = tempfile.mkdtemp(prefix="forgeline-art-")
    counts = pipeline.run_from_files(spark, d, out, batch_id="t", artifacts_dir=arts)
    assert counts["bronze_temperature"] == t.count()
    assert counts["bronze_incident"] == i.count()
    assert counts["gold_machine_hourly_feature"] > 0
    assert counts["temperature_method"] in ("mean", "median", "iterative")
    gold = spark.read.parquet(os.path.join(out, "gold_machine_hourly_feature"))
    assert "machine_id" in gold.columns and dict(gold.dtypes)["temp_mean_24h"] == "decimal(12,3)"
    decisions = spark.read.option("header", True).csv(os.path.join(arts, "imputation_decisions"))
    assert decisions.count() == 3
    assert spark.read.option("header", True).csv(os.path.join(arts, "gold_preview")).count() == 20
    ledger = spark.read.parquet(os.path.join(out, "ingestion_batch")).collect()
    assert all(r.started_at <= r.finished_at for r in ledger)


def test_sources_need_exact_stems_and_equal_headers(spark, tmp_path):
    for name in ("capteurs_temperature.csv", "capteurs_temperature.csv.bak", "capteurs_temperature.old.csv", ".capteurs_pression.tsv"):
        (tmp_path / name).write_text("machine_id,timestamp,temperature\n")
    found = files.find_source_files(str(tmp_path), spark)
    assert [p.rsplit("/", 1)[1] for p in found.values()] == ["capteurs_temperature.csv"]
    with pytest.raises(FileNotFoundError, match="incident, pressure"):
        files.require_sources(found)
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts" / "a.csv").write_text("machine_id,temperature\nM-1,2\n")
    (tmp_path / "parts" / "b.csv").write_text("temperature,machine_id\n2,M-1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, str(tmp_path / "parts"), ",").collect()


def test_checkpoint_folder_must_be_shared():
    from types import SimpleNamespace

    from forgeline.session import checkpoint_dir

    def session(master, configured=None, made=None):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[0] if made else None, setCheckpointDir=lambda d: made.append(d),
                             getConf=lambda: SimpleNamespace(get=lambda *a: configured))
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session(master, made=[]))
    assert checkpoint_dir(session("local[2]", made=[]))
    assert checkpoint_dir(session("yarn", "hdfs://x/y", [])) == "hdfs://x/y"


def test_reject_reasons_fit_their_column():
    import re
    from pathlib import Path

    from forgeline.operators import validate

    codes = re.findall(r'\("([a-z_]+)", ', Path(validate.__file__).read_text())
    assert len(codes) > 10 and len(";".join(codes)) <= validate.MAX_REASON_CHARS


def test_dimension_ids_are_kept(spark, tmp_path):
    from forgeline.operators import dims

    path = str(tmp_path / "dim")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "machine_code string")
    first = {r.machine_code: r.machine_id for r in dims.synced(spark, path, dims.machine_seed(spark), keys("MACH-20", "MACH-01"), "machine_code", "machine_id").collect()}
    second = {r.machine_code: r.machine_id for r in dims.synced(spark, path, dims.machine_seed(spark), keys("MACH-17", "MACH-20", None), "machine_code", "machine_id").collect()}
    assert first["MACH-20"] == 16 and second == {**first, "MACH-17": 17}


def test_file_row_number_many_files_and_blocks(spark, tmp_path):
    """Several files, each split into several blocks, several small files per task."""
    for k in range(3):
        lines = ["machine_id;timestamp;temperature"] + [f"MACH-0{k};2025-01-01 00:00:00;{i}" for i in range(3000)]
        (tmp_path / f"part-{k}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.with_file_row_number(files.read_delimited(spark, str(tmp_path), ";"))
        got = df.select("source_file", "row_number", "temperature").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 9000
    assert all(r.row_number == int(r.temperature) + 1 for r in got)


def test_delimiter_of_a_sample():
    from forgeline.sources.files import best_delimiter

    assert best_delimiter(['"a;b",c', '"1;2",3', '"4;5",6']) == ","
    assert best_delimiter(['a;b;c', '1,5;2,5;3', '1;2;"x,y,z"']) == ";"
    assert best_delimiter(['a|b', '"line', 'one; still the same, field"|2', '3|4']) == "|"
    assert best_delimiter(['id\tnote', '1\tyes, no; perhaps', '2\tone, two, three']) == "\t"
    assert best_delimiter([]) == best_delimiter(["single", "column"]) == best_delimiter([""]) == ","
    assert best_delimiter(["a;b,c", "1;2", "3;4"]) == ";"  # the header alone would not tell
    assert best_delimiter([f"{i};{i}" for i in range(99)] + ['"cut inside']) == ";"


def test_row_numbers_scan_the_text_once(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"p{k}.csv").write_text("_file;_place;value\n" + "".join(f"x;y;{i}\n" for i in range(50)))
    df = files.with_file_row_number(files.read_delimited(spark, str(tmp_path), ";"))
    assert df.columns == ["_file", "_place", "value", "source_file", "row_number"]
    assert all(r.row_number == int(r.value) + 1 for r in df.collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "csv" not in plan.lower().replace(str(tmp_path).lower(), "") and "Exchange hashpartitioning" not in plan  # stored rows, offsets broadcast


def test_a_failed_write_keeps_the_stored_dimension(spark, tmp_path):
    from pyspark.sql import functions as F

    from forgeline.operators import dims
    from forgeline.sources import fs, sinks

    path, keys = str(tmp_path / "dim"), lambda *names: spark.createDataFrame([(n,) for n in names], "machine_code string")
    first = {r.machine_code: r.machine_id for r in dims.synced(spark, path, dims.machine_seed(spark), keys("MACH-20"), "machine_code", "machine_id").collect()}
    broken = keys("MACH-30").withColumn("machine_code", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        dims.synced(spark, path, dims.machine_seed(spark), broken, "machine_code", "machine_id")
    with pytest.raises(Exception, match="stop"):
        sinks.write_table(broken, str(tmp_path), "dim")
    assert {r.machine_code: r.machine_id for r in spark.read.parquet(path).collect()} == first
    # a run that ended between the two moves
    (tmp_path / "dim").rename(tmp_path / "dim.previous")
    assert fs.recovered(spark, path) and not fs.recovered(spark, str(tmp_path / "none"))
    again = dims.synced(spark, path, dims.machine_seed(spark), keys("MACH-21"), "machine_code", "machine_id")
    assert {r.machine_code: r.machine_id for r in again.collect()} == {**first, "MACH-21": max(first.values()) + 1}
    assert {r.machine_code for r in spark.read.parquet(path + ".previous").collect()} == set(first)


def test_readings_are_parsed_once(spark, tmp_path, monkeypatch):
    """The passes of the baseline read parsed readings that are stored, not Bronze text parsed again in each."""
    class Seen(Exception):
        pass

    def looked_at(df, **_):
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(pipeline.units, "normalize_temperature_units", looked_at)
    t, pr, i = L.FixtureChain(spark, "/root/testdata/sf0.001").raw()
    with pytest.raises(Seen) as seen:
        pipeline.run_from_bronze_inputs(spark, t, pr, i, str(tmp_path / "out"), batch_id="t", estimator="least_squares")
    assert "regexp" not in str(seen.value) and "parse_ok" not in str(seen.value)
