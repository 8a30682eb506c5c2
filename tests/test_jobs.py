"""The jobs end to end on landing files."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from brinemark import fixed_values as fv
from brinemark.operators import parse, quality, seastate
from brinemark.plans import jobs
from brinemark.sources import schemas, tables
from brinemark.streaming import runs


def write_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def hour_lines(year, month, days, height=1.0):
    return [f"{month} {d} {h} 5.0 90 {height + (d * 7 + h) % 13 / 10} 180 {6 + h % 5} 0 0 0 {year}" for d in days for h in range(0, 24, 6)]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing = root / "landing"
    write_lines(landing, "Tuxpan.txt", hour_lines(1980, 1, range(1, 6)) + ["1 2 3", ""])
    write_lines(landing, "carmen.v2.txt", hour_lines(1981, 2, range(1, 4), 2.0) + ["1 2 3 500 90 1 1 1 0 0 0 1980"])
    jobs.ingest(spark, str(landing), str(root))
    jobs.refine(spark, str(root))
    return root


def test_every_line_is_in_one_table(spark, base):
    lines = tables.read_table(spark, schemas.BRONZE_LINES.path(str(base)))
    silver = jobs.silver(spark, str(base))
    rejected = tables.read_table(spark, schemas.QUARANTINE.path(str(base)))
    assert lines.count() == 35 and silver.count() == 32 and rejected.count() == 3
    assert silver.schema.fieldNames() == schemas.SILVER_METRICS.schema.fieldNames()
    assert {r["coast_name"] for r in silver.select("coast_name").distinct().collect()} == {"Tuxpan", "Playa del Carmen"}
    assert not rejected.where("resolved").count()


def test_batch_equals_stream(spark, base):
    lines = tables.read_table(spark, schemas.BRONZE_LINES.path(str(base)), schemas.BRONZE_LINES.schema)
    good, _ = quality.split_quality(parse.parse_lines(lines))
    cols = ["id", "coast_name", "datetime", "wave_height_m", "wave_power_kW_m"]
    assert sorted(map(tuple, good.select(cols).collect())) == sorted(map(tuple, jobs.silver(spark, str(base)).select(cols).collect()))


def test_rerun_without_new_files_adds_nothing(spark, base):
    before = jobs.silver(spark, str(base)).count()
    jobs.ingest(spark, str(base / "landing"), str(base))
    jobs.refine(spark, str(base))
    assert jobs.silver(spark, str(base)).count() == before


def test_bounded_batches_ingest_everything_once(spark, tmp_path):
    landing = tmp_path / "landing"
    for i in range(5):
        write_lines(landing, f"tuxpan.{i}.txt", hour_lines(1980, 1 + i, [1]))
    jobs.ingest(spark, str(landing), str(tmp_path), max_files=2)
    lines = tables.read_table(spark, schemas.BRONZE_LINES.path(str(tmp_path)))
    assert lines.count() == 20 and lines.select("source_file").distinct().count() == 5


def test_late_rows(spark, tmp_path):
    landing = tmp_path / "landing"
    write_lines(landing, "tuxpan.txt", hour_lines(1980, 1, range(1, 4)) + hour_lines(1981, 1, [1]))
    where = str(tmp_path)

    def step(late):
        jobs.ingest(spark, str(landing), where)
        jobs.refine(spark, where)
        jobs.daily(spark, where, late)
        return {str(r["date"]): r["max_wave_height_m"] for r in jobs.read_daily(spark, where).collect()}

    first = step("skip")
    assert len(first) == 4
    write_lines(landing, "tuxpan.late.txt", ["1 1 3 5 90 9.5 180 8 0 0 0 1980", "1 9 3 5 90 2.5 180 8 0 0 0 1980"])
    skipped = step("skip")
    assert len(skipped) == 5 and skipped["1980-01-01"] == first["1980-01-01"] and skipped["1980-01-09"] == 2.5
    assert jobs.read_daily(spark, where).count() == 5
    recomputed = step("recompute")
    assert len(recomputed) == 5 and recomputed["1980-01-01"] == 9.5 and recomputed["1981-01-01"] == first["1981-01-01"]
    assert jobs.read_daily(spark, where).count() == 5


def test_recompute_since_touches_only_those_years(spark, tmp_path):
    landing, where = tmp_path / "landing", str(tmp_path)
    write_lines(landing, "tuxpan.txt", hour_lines(1980, 1, [1]) + hour_lines(1981, 1, [1]))
    jobs.ingest(spark, str(landing), where)
    jobs.refine(spark, where)
    jobs.daily(spark, where)
    mark = jobs.silver(spark, where).agg(F.max("transformation_timestamp").cast("string")).first()[0]
    write_lines(landing, "tuxpan.b.txt", ["1 1 5 5 90 8.5 180 8 0 0 0 1981"])
    jobs.ingest(spark, str(landing), where)
    jobs.refine(spark, where)
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold" / "wave_daily_summary" / "year=1980").glob("*.parquet")}
    jobs.daily(spark, where, "recompute", since=mark)
    assert {p: p.stat().st_mtime_ns for p in old if p.exists()} == old
    got = {str(r["date"]): r["max_wave_height_m"] for r in jobs.read_daily(spark, where).collect()}
    assert len(got) == 2 and got["1981-01-01"] == 8.5


def test_progress_is_kept_and_only_touched_days_are_rebuilt(spark, tmp_path):
    landing, where = tmp_path / "landing", str(tmp_path)
    write_lines(landing, "tuxpan.txt", hour_lines(1980, 1, [1]) + hour_lines(1981, 1, [1, 2]))
    jobs.ingest(spark, str(landing), where)
    jobs.refine(spark, where)
    assert jobs.read_progress(spark, where, "recompute") is None
    jobs.daily(spark, where, "recompute")
    first = jobs.read_progress(spark, where, "recompute")
    files = lambda year: {p: p.stat().st_mtime_ns for p in (tmp_path / "gold" / "wave_daily_summary" / f"year={year}").glob("*.parquet")}
    old = files(1980), files(1981)
    jobs.daily(spark, where, "recompute")  # nothing new: nothing is written
    assert (files(1980), files(1981)) == old and jobs.read_progress(spark, where, "recompute") == first
    write_lines(landing, "tuxpan.b.txt", ["1 1 5 5 90 8.5 180 8 0 0 0 1981"])
    jobs.ingest(spark, str(landing), where)
    jobs.refine(spark, where)
    jobs.daily(spark, where, "recompute")
    assert files(1980) == old[0] and files(1981) != old[1]
    assert jobs.read_progress(spark, where, "recompute") > first
    got = {str(r["date"]): r["max_wave_height_m"] for r in jobs.read_daily(spark, where).collect()}
    assert len(got) == 3 and got["1981-01-01"] == 8.5


def test_equal_lines_of_a_file_stay_apart_when_it_is_delivered_again(spark, tmp_path):
    landing, where = tmp_path / "landing", str(tmp_path)
    for version in (1, 2):
        write_lines(landing, f"tuxpan.v{version}.txt", ["same line", "same line", "other"])
        jobs.ingest(spark, str(landing), where, once="1 day")
    write_lines(landing, "tuxpan.v3.txt", ["same line", "same line", "other", "new"])
    write_lines(landing, "acapulco.v1.txt", ["other"])
    jobs.ingest(spark, str(landing), where, once="1 day")
    lines = tables.read_table(spark, schemas.BRONZE_LINES.path(where))
    assert sorted(r["data"] for r in lines.collect()) == ["new", "other", "other", "same line", "same line"]
    assert lines.select("line_id").distinct().count() == 5


def test_places_run_on_over_splits_and_state_is_kept_on_disk(spark, tmp_path):
    landing, where = tmp_path / "landing", str(tmp_path)
    lines = [f"line {i % 7}" for i in range(3000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        write_lines(landing, "tuxpan.v1.txt", lines)
        write_lines(landing, "carmen.v1.txt", ["windows\r", "", "lines\r"])
        runs.number_lines(spark, str(landing), f"{where}/numbered", f"{where}/numbered-checkpoint")
        numbered = spark.read.parquet(f"{where}/numbered").withColumn("file", F.regexp_extract("source_file", r"([^/]+)$", 1))
        rows = sorted((r["place"], r["data"]) for r in numbered.where("file = 'tuxpan.v1.txt'").collect())
        assert rows == list(enumerate(lines))
        rows = sorted((r["place"], r["data"]) for r in numbered.where("file = 'carmen.v1.txt'").collect())
        assert rows == [(0, "windows"), (1, ""), (2, "lines")]
        jobs.ingest(spark, str(landing), where, once="1 day")
        # Another length of an early line moves all bytes after it, but no line.
        write_lines(landing, "tuxpan.v2.txt", ["a longer first line", *lines[1:], "added"])
        jobs.ingest(spark, str(landing), where, once="1 day")
        jobs.ingest(spark, str(landing), where, once="1 day")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    table = tables.read_table(spark, schemas.BRONZE_LINES.path(where))
    assert table.count() == 3005
    assert sorted(r["data"] for r in table.where("source_file like '%.v2.txt'").collect()) == ["a longer first line", "added"]
    offsets = pathlib.Path(runs.checkpoint_path(where, schemas.BRONZE_LINES)) / "offsets" / "0"
    assert "RocksDBStateStoreProvider" in offsets.read_text()
    assert not [f for f in (tmp_path / "numbered_lines").rglob("*.parquet")]


def test_third_years_prune_folders(spark, base):
    kept = quality.every_n_years(jobs.silver(spark, str(base)), 3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert {r["year"] for r in kept.select("year").distinct().collect()} == {1980}


@pytest.fixture(scope="module")
def big_base(spark, sf_dir, tmp_path_factory):
    """A silver table from the mapped rows, large enough to train on."""
    from brinemark.workload.mapping import observed

    where = str(tmp_path_factory.mktemp("big"))
    rows = observed(spark, sf_dir).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_extendedprice").alias("id"), "coast_name",
        F.col("datetime").cast("timestamp").alias("datetime"), "year",
        "wind_speed_ms", "wave_height_m", "wave_period_s", "wave_direction_deg", "wind_direction_deg", "wave_energy", "wave_power_kW_m")
    tables.append_table(rows, schemas.SILVER_METRICS.path(where), schemas.SILVER_METRICS.partition_by)
    return where


def test_train_classify_share_payload(spark, big_base, tmp_path):
    where, model_path = big_base, f"{tmp_path}/model"
    result = jobs.train(spark, where, model_path, trees=5, max_depth=6, max_iter=5, force=True)
    assert result.model is not None and result.gate.count() <= 6 and result.metrics.count() == 1
    runs.classify(spark, where, seastate.load_model(model_path))
    classes = tables.read_table(spark, schemas.SILVER_CLASSES.path(where), schemas.SILVER_CLASSES.schema)
    assert classes.count() == jobs.silver(spark, where).count()
    jobs.daily(spark, where)
    jobs.monthly_share(spark, where)
    failures = {r["coast_name"]: r["error"] for r in jobs.forecast(spark, where, resamples=30).collect()}
    levels = tables.read_table(spark, schemas.GOLD_FORECAST.path(where), schemas.GOLD_FORECAST.schema)
    fitted = {r["coast_name"] for r in levels.collect()}
    # A coast has levels or a reason; the peaks of one have no likelihood maximum at this scale.
    assert not fitted & set(failures) and len(fitted) + len(failures) == 7 and len(failures) <= 1
    assert set(failures.values()) <= {"no maximum of the likelihood above shape -1"}
    jobs.payload(spark, where, f"{tmp_path}/out")
    docs = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/out/coasts").collect()]
    assert len(docs) == 7 and all(d["has_data"] for d in docs)
    design = json.loads(spark.read.text(f"{tmp_path}/out/design").first()["value"])
    assert design["periods"] == ["50", "100"] and design["metrics"] == ["Height", "Power"]


def test_gates_stop_a_weak_model(spark, big_base, tmp_path):
    result = jobs.train(spark, big_base, f"{tmp_path}/none", trees=2, max_depth=2, max_iter=2)
    assert not result.accepted and result.model is None and not (tmp_path / "none").exists()


def test_missing_features_get_the_sentinel(spark, big_base):
    frame = seastate.training_frame(jobs.silver(spark, big_base)).withColumn("label", F.when(F.col("wave_height_m") > 5, 2).otherwise(1))
    model = seastate.fit_forest(frame, trees=2, max_depth=3)
    rows = spark.createDataFrame(
        [(5.0, 9.0, 8.0, 1e5, 300.0), (5.0, None, 8.0, 1e5, 300.0), (5.0, float("nan"), 8.0, 1e5, 300.0)],
        "wind_speed_ms float, wave_height_m float, wave_period_s float, wave_energy float, wave_power_kW_m float")
    got = [r["wave_classification"] for r in seastate.classify(rows, model).collect()]
    assert got[0] == "Mar suave" and got[1:] == [fv.UNKNOWN_SEA_STATE] * 2


def test_declared_tables(spark, tmp_path):
    names = schemas.create_tables(spark, f"{tmp_path}/lake")
    again = schemas.create_tables(spark, f"{tmp_path}/lake")
    assert names == again and len(names) == 8
    try:
        columns = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE {names[1]}").collect()}
        assert columns["wave_height_m"] == "Wave height, m"
        assert spark.table(names[1]).schema.fieldNames()[-2:] == ["coast_name", "year"]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_declared_tables_show_what_the_jobs_wrote(spark, tmp_path):
    base = f"{tmp_path}/o'lake"
    names = schemas.create_tables(spark, base)
    try:
        (tmp_path / "landing").mkdir()
        lines = [f"{m} 3 {h} 5.0 90 1.{h % 10} 180 8 0 0 0 {y}" for y in (1980, 1981) for m in (1, 2) for h in range(24)]
        (tmp_path / "landing" / "tuxpan.txt").write_text("\n".join(lines + lines[:1]))
        jobs.ingest(spark, f"{tmp_path}/landing", base)
        jobs.refine(spark, base)
        jobs.daily(spark, base)
        silver = spark.table("default.silver_swell_metrics")
        assert silver.count() == len(lines) + 1 and silver.where("year = 1981").count() == 48
        assert silver.select("id").distinct().count() == silver.count()
        daily = spark.table("default.gold_wave_daily_summary")
        assert daily.count() == 4 and daily.where("year = 1980").count() == 2
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from brinemark import session

    told = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        session.shared_root(told)


def test_work_folders_are_cleared(spark):
    from brinemark import session

    table = session.stored(spark.range(3), "clearing")
    assert table.count() == 3
    folder = session._HANDED_OUT[-1]
    session._HANDED_OUT[:] = [folder]
    session.clear_work(spark)
    assert not tables.table_exists(spark, folder)


def test_merge_schema_on_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_table(spark.createDataFrame([(1,)], "a int"), path)
    tables.append_table(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert {(r["a"], r["b"]) for r in tables.read_table(spark, path, merge_schema=True).collect()} == {(1, None), (2, "x")}


def test_explore(spark, tmp_path):
    rows = ["Anio,Mes,Dia,Hora,VelocidadViento,DireccionViento,AlturaDelOleaje,DireccionOleaje,PeriodoDeLaOla"]
    rows += [f"1980.0,{m}.0,{d}.0,{h}.0,{h % 9 + m / 10},{(h * 31) % 360},{0.5 + d % 5 / 4},{(d * 47) % 360},{5 + h % 6}"
             for m in range(1, 13) for d in range(1, 20) for h in range(24)]
    rows.append("1980.0,2.0,30.0,1.0,,10,,20,")
    (tmp_path / "obs.csv").write_text("\n".join(rows))
    observed = tables.read_observations(spark, str(tmp_path / "obs.csv"))
    assert dict(observed.dtypes)["Anio"] == "int" and observed.where("Fecha_Hora IS NULL").count() == 1
    found = jobs.explore(observed, month="Mes", wind="VelocidadViento", wind_dir="DireccionViento", height="AlturaDelOleaje",
                         wave_dir="DireccionOleaje", period="PeriodoDeLaOla", ids=["Fecha_Hora"])
    summary = {r["variable"]: r for r in found["summary"].collect()}
    assert summary["AlturaDelOleaje"]["null_count"] == 1 and summary["AlturaDelOleaje"]["count"] == 12 * 19 * 24
    assert sum(r["count"] for r in found["height_histogram"].collect()) == 12 * 19 * 24
    assert found["wind_by_month"].count() == 12 and found["correlation"].count() == 4
    assert 150 < found["scatter_sample"].count() < 420
    assert found["wind_rose"].count() == 32 * 12 and found["wave_rose"].count() == 32 * 11


def test_file_stem_is_that_of_the_pattern_without_one(spark):
    paths = ["file:///a.b/c/Tuxpan.v1.txt", "/x/tuxpan", "tuxpan.v2.txt", "/x/.hidden.txt", "/x/..", "/x/a..b", "/x/", "", "/x y/ñ%20.z", "a/b.c/d\n.e", None]
    df = spark.createDataFrame([(p,) for p in paths], "source_file string")
    got = df.select(runs.file_stem("source_file").alias("stem"), F.regexp_extract("source_file", r"([^/.]+)[^/]*$", 1).alias("wanted"))
    assert [r["stem"] for r in got.collect()] == [r["wanted"] for r in got.collect()]
    lines = spark.readStream.format("rate").load().selectExpr("'a' AS data", "'/x/a.txt' AS source_file", "value AS place")
    plan = runs.first_delivery(lines, "1 day")._jdf.queryExecution().analyzed().toString()
    assert "regexp" not in plan
