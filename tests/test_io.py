"""Sources and sinks: CSV header drift, raw simulator files, JSON model, bundle guards."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from hypercube.session import work_dir
from hypercube.sources import csv as csv_src
from hypercube.sources.model_json import edit_fields, explode_model
from hypercube.sources.raw_output import read_raw_output


def _write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_header_drift(spark, tmp_path):
    root = str(tmp_path)
    _write_text(f"{root}/g1/a.csv", "sim_id,batch_id,x_sec\n1,1,0.5\n2,1,0.25\n")
    _write_text(f"{root}/g2/b.csv", "x_sec,sim_id,batch_id\n0.75,3,2\n")
    _write_text(f"{root}/g3/c.csv", "batch_id,sim_id\n3,5\n")
    types = {"sim_id": "int", "batch_id": "int", "x_sec": "double"}
    df = csv_src.read_csv_union(spark, [f"{root}/g1", f"{root}/g2", f"{root}/g3"], types)
    got = sorted((r.sim_id, r.batch_id, r.x_sec) for r in df.collect())
    assert got == [(1, 1, 0.5), (2, 1, 0.25), (3, 2, 0.75), (5, 3, None)]
    assert dict(df.dtypes) == {"sim_id": "int", "batch_id": "int", "x_sec": "double"}
    missing = csv_src.read_optional_csv(spark, f"{root}/nope.csv", types)
    assert missing.count() == 0 and missing.columns == ["sim_id", "batch_id", "x_sec"]


def test_raw_output_reader(spark, tmp_path):
    root = str(tmp_path)
    head = "Date/Time,ZONE1 IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)"
    _write_text(f"{root}/Run_3/eplusout.csv", f"{head}\n 01/01  01:00:00,10.5\n 01/01  02:00:00,0\n")
    _write_text(f"{root}/Run_12/eplusout.csv", f"{head}\n 01/01  01:00:00,7\n")
    df = read_raw_output(spark, f"{root}/Run_*/eplusout.csv")
    got = sorted((r.sim_id, r.datetime, r.joules) for r in df.collect())
    assert got == [(3, " 01/01  01:00:00", 10.5), (3, " 01/01  02:00:00", 0.0), (12, " 01/01  01:00:00", 7.0)]


def test_raw_output_columns_in_any_order(spark, tmp_path):
    from hypercube.operators.results import hourly_projection
    from hypercube.sources.raw_output import scan_raw_output
    root = str(tmp_path)
    a, b = ("{} IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)".format(z) for z in "AB")
    _write_text(f"{root}/Run_1/out.csv", f"Date/Time,{a},{b},Other\n 01/01  01:00:00,1,2,9\n 01/01  02:00:00,,4,9\n")
    _write_text(f"{root}/Run_2/out.csv", f"Date/Time,{b},{a}\n 01/01  01:00:00,20,10\n")
    got = sorted((r.sim_id, r.header[0], r.joules) for r in read_raw_output(spark, root).where("header <> 'Other'").collect() if r.joules is not None)
    assert got == [(1, "A", 1.0), (1, "B", 2.0), (1, "B", 4.0), (2, "A", 10.0), (2, "B", 20.0)]
    frames = [hourly_projection(f) for f in scan_raw_output(spark, root)]
    rows = sorted((r.sim_id, r.datetime, r.zone_A, r.zone_B) for f in frames for r in f.collect())
    assert rows == [(1, " 01/01  01:00:00", 1.0, 2.0), (1, " 01/01  02:00:00", None, 4.0), (2, " 01/01  01:00:00", 10.0, 20.0)]


def test_mixed_headers_in_one_folder(spark, tmp_path):
    root = str(tmp_path)
    _write_text(f"{root}/a.csv", "sim_id,x_sec\n1,0.5\n")
    _write_text(f"{root}/b.csv", "x_sec,sim_id,note\n0.75,3,n\n")
    df = csv_src.read_csv_union(spark, root, {"sim_id": "int", "x_sec": "double"})
    assert sorted((r.sim_id, r.x_sec, r.note) for r in df.collect()) == [(1, 0.5, None), (3, 0.75, "n")]


def test_paths_by_the_file_system(spark, tmp_path):
    from hypercube.session import path_exists
    for root in (str(tmp_path), f"file://{tmp_path}"):
        assert path_exists(spark, root) and not path_exists(spark, f"{root}/nothing")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_no_local_scratch_on_a_cluster(master):
    from types import SimpleNamespace

    from hypercube.session import ensure_checkpoint_dir
    session = SimpleNamespace(sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
                              conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_json_model_and_field_edits(spark):
    docs = spark.createDataFrame([(1, '{"Zone":{"Z1":{"volume":50}},"OtherEquipment":{"E1":{"design_level":3}}}')],
                                 "k int, doc string")
    rows = sorted((r.object_class, r.object_name, r.field, r.value) for r in explode_model(docs, "doc", ["k"]).collect())
    assert rows == [("OtherEquipment", "E1", "design_level", "3"), ("Zone", "Z1", "volume", "50")]
    obj = spark.createDataFrame([(1, 2.0)], "a int, design_level double").select(F.struct("a", "design_level").alias("o"))
    edited = obj.select(edit_fields(F.col("o"), {"method": "Watts/Area"}, ["design_level"]).alias("o")).select("o.*")
    assert edited.columns == ["a", "method"] and edited.first().method == "Watts/Area"


def test_bundle_guards(spark, sf_small):
    from hypercube.plans.dashboard import export_bundle
    from hypercube.plans.study import Study
    st = Study(spark, sf_small)
    root = work_dir(spark, "bundle-test")
    args = dict(design=st.design, zone_mapping=st.zone_mapping, hourly_wide=st.hourly_wide,
                summary=st.summary, timing=st.timing, batch_size=20)
    paths = export_bundle(root, **args)
    man = spark.read.parquet(paths["manifest"]).first()
    assert man.n_runs == st.design.count() and man.schema_version == 1
    assert man.n_sparse_rows == spark.read.parquet(paths["hourly_sparse"]).count()
    assert spark.sql("select count(*) from run_dashboard").first()[0] == man.n_runs
    with pytest.raises(Exception):  # S15: refuses to overwrite
        export_bundle(root, **args)
    with pytest.raises(ValueError):  # Q4: no summary rows
        export_bundle(work_dir(spark, "bundle-empty"), **{**args, "summary": st.summary.limit(0)})


def test_a_failed_export_leaves_the_bundle_whole(spark, sf_small, monkeypatch):
    from hypercube.plans import dashboard
    from hypercube.plans.study import Study
    st = Study(spark, sf_small)
    root = work_dir(spark, "bundle-atomic")
    args = dict(design=st.design, zone_mapping=st.zone_mapping, hourly_wide=None, timing=None, batch_size=20)
    with pytest.raises(FileNotFoundError):
        dashboard.bundle_paths(spark, root)
    old = dashboard.export_bundle(root, **args, summary=st.summary)
    runs = spark.read.parquet(old["runs"]).count()

    def fails(*_, **__):
        raise OSError("disk full")
    fewer = {**args, "design": st.design.where("sim_id < 10")}
    with monkeypatch.context() as m:
        m.setattr(dashboard, "write_sparse", fails)
        with pytest.raises(OSError):
            dashboard.export_bundle(root, **fewer, summary=st.summary, mode="overwrite")
    assert dashboard.bundle_paths(spark, root) == old
    dashboard.register_views(spark, root)
    assert spark.table("run_dashboard").count() == runs == spark.read.parquet(old["manifest"]).first().n_runs
    new = dashboard.export_bundle(root, **fewer, summary=st.summary, mode="overwrite")
    assert dashboard.bundle_paths(spark, root) == new and spark.table("run_dashboard").count() == 9
    assert spark.read.parquet(old["runs"]).count() == runs
    # a writer that began before another one published is refused
    with pytest.raises(Exception, match="(?i)exist"):
        dashboard._publish(spark, root, "version-late", "000000000001")
    assert dashboard.bundle_paths(spark, root) == new


def test_consolidate_guards(spark, sf_small):
    from pyspark.sql import functions as F

    from hypercube.plans.consolidate import consolidate
    from hypercube.plans.study import BATCH_SIZE, Study
    from hypercube.sources.csv import type_map
    st = Study(spark, sf_small)
    files = st.batch_files()
    out = work_dir(spark, "consolidate-test")
    args = dict(summary_roots=files["summary"], hourly_roots=files["hourly"], timing_roots=files["timing"],
                types={**type_map(st.summary), **type_map(st.timing)}, batch_size=BATCH_SIZE,
                n_runs=st.design.agg(F.count(F.lit(1))).scalar())
    paths = consolidate(spark, out=out, **args)
    assert spark.read.parquet(paths["study_results"]).count() == st.summary.count()
    hourly = spark.read.parquet(paths["hourly"])
    assert hourly.count() == st.hourly_wide.count() and "batch_id" not in hourly.columns
    assert spark.read.parquet(paths["worker_timing_summary"]).first().n_sims == st.timing.count()
    with pytest.raises(FileExistsError):
        consolidate(spark, out=out, **args)
    with pytest.raises(ValueError):
        consolidate(spark, out=work_dir(spark, "consolidate-empty"),
                    **{**args, "summary_roots": [work_dir(spark, "nothing-here")]})


def test_worker_files_follow_the_rows_not_the_batches(spark, sf_small):
    from hypercube.plans.consolidate import land_batches
    from hypercube.plans.study import Study
    root = work_dir(spark, "landed")
    rows = spark.range(1, 2001).select(F.col("id").cast("int").alias("sim_id"), F.lit(0.5).alias("x_sec"))
    land_batches(rows, root, "csv", 10, 3)
    at = (csv_src.read_csv_union(spark, root, {"sim_id": "int"}).withColumn("file", F.input_file_name())
          .groupBy(F.ceil(F.col("sim_id") / 10)).agg(F.count_distinct("file").alias("files"), F.count("*").alias("n")).collect())
    assert len(at) == 200 and {(r.files, r.n) for r in at} == {(1, 10)}
    assert sum(len(g) for g in csv_src.header_groups(spark, root)) <= 3
    st = Study(spark, sf_small)
    kinds = st.batch_files()
    assert all(sum(len(g) for g in csv_src.header_groups(spark, p)) <= st.landed_files
               for kind in ("summary", "timing", "batch_timing") for p in kinds[kind])
    assert len(spark.read.parquet(*kinds["hourly"]).inputFiles()) <= st.landed_files


def test_files_are_listed_by_few_tasks_and_their_headers_checked(spark, tmp_path):
    own = spark.conf.get(csv_src.LISTING, None)
    with csv_src.listing_tasks(spark):
        assert int(spark.conf.get(csv_src.LISTING)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(csv_src.LISTING, None) == own
    _write_text(f"{tmp_path}/a.csv", "x,y\n1,2\n")
    _write_text(f"{tmp_path}/b.csv", "y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_src.read_text_columns(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]).collect()


def test_run_files_are_written_by_many_tasks(spark):
    from hypercube.sources.raw_output import write_run_files
    root = work_dir(spark, "run-files")
    wide = spark.range(1, 101).select(F.col("id").cast("int").alias("sim_id"), F.lit(" 01/01  01:00:00").alias("Date/Time"),
                                      F.lit(1.0).alias("A"))
    write_run_files(wide, root)
    files = [f for g in csv_src.header_groups(spark, root) for f in g]
    assert len(files) == 100 and len({os.path.basename(f).split("-")[1] for f in files}) > 1
    assert sorted(r.sim_id for r in read_raw_output(spark, root).collect()) == list(range(1, 101))


def test_run_files_are_read_a_portion_at_a_time(spark, tmp_path, monkeypatch):
    from hypercube.operators.results import hourly_projection
    from hypercube.sources.raw_output import scan_raw_output
    a, b = ("{} IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)".format(z) for z in "AB")
    for i in range(1, 101):
        head, cells = (f"Date/Time,{a},{b},Other", f"{i},{-i},9") if i % 3 else (f"Date/Time,{b},{a}", f"{-i},{i}")
        _write_text(f"{tmp_path}/w{i % 2}/Run_{i}/out.csv", f"{head}\n 01/01  01:00:00,{cells}\n")
    _write_text(f"{tmp_path}/w1/_temporary/Run_7/out.csv", "not,a,run\n1,2,3\n")
    _write_text(f"{tmp_path}/w1/Run_200/out.csv", "")
    monkeypatch.setattr(csv_src, "FILES_AT_ONCE", 7)
    own = {key: spark.conf.get(key, None) for key in csv_src.PORTION_SETTINGS}
    seen = []

    def files(spark, paths, found=csv_src._files_by_header):
        seen.append(sum(map(len, (heads := found(spark, paths)).values())))
        return heads
    monkeypatch.setattr(csv_src, "_files_by_header", files)
    frames = scan_raw_output(spark, [str(tmp_path), f"{tmp_path}/w1"], hourly_projection)
    assert len(seen) > 10 and max(seen) <= 7 and sum(seen) == 100
    rows = sorted(tuple(r) for f in frames for r in f.select("sim_id", "datetime", "zone_A", "zone_B").collect())
    assert rows == [(i, " 01/01  01:00:00", float(i), float(-i)) for i in range(1, 101)]
    # the frames are over a few files of rows, so their plans do not list the run files
    assert len(frames) == 2 and not any("Run_" in f for frame in frames for f in frame.inputFiles())
    assert {key: spark.conf.get(key, None) for key in csv_src.PORTION_SETTINGS} == own
    whole = [f for f in scan_raw_output(spark, f"{tmp_path}/w?/Run_*/out.csv") if "Other" in f.columns]
    assert len(whole) == 1 and whole[0].columns == ["datetime", a, b, "Other", "sim_id"] and whole[0].count() == 67
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_raw_output(spark, [str(tmp_path), f"{tmp_path}/nothing"])
    assert scan_raw_output(spark, []) == []


def test_a_portions_frames_are_let_go(spark, tmp_path, monkeypatch):
    import gc

    from py4j.java_gateway import JavaObject

    from hypercube.sources.raw_output import scan_raw_output
    for i in range(1, 61):
        _write_text(f"{tmp_path}/Run_{i}/out.csv", f"Date/Time,A\n 01/01  01:00:00,{i}\n")
    monkeypatch.setattr(csv_src, "FILES_AT_ONCE", 10)
    held = []

    def files(spark, paths, found=csv_src._files_by_header):
        held.append(sum(isinstance(x, JavaObject) for x in gc.get_objects()))
        return found(spark, paths)
    monkeypatch.setattr(csv_src, "_files_by_header", files)
    gc.collect()
    gc.disable()
    try:
        assert sum(f.count() for f in scan_raw_output(spark, str(tmp_path))) == 60
    finally:
        gc.enable()
    assert len(held) == 6 and held[-1] <= held[1], held


def test_no_folder_has_all_run_files(spark):
    from hypercube.sources.raw_output import write_run_files
    root = work_dir(spark, "run-folders")
    write_run_files(spark.range(1, 101).select(F.col("id").cast("int").alias("sim_id"), F.lit(" 01/01  01:00:00").alias("Date/Time"),
                                               F.lit(1.0).alias("A")), root)
    runs = [len(csv_src._listed(spark, worker)) for worker in csv_src._listed(spark, root)]
    assert sum(runs) == 100 and 1 < len(runs) <= 8 and max(runs) < 50
