import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortlens.plans.survey_job import OUTPUTS, run_survey_job
from cohortlens.schema import SURVEY_SCHEMA
from cohortlens.operators import ObservedRanges, clean_survey, minmax_scale
from cohortlens.sources import drop_old_runs, published, read_csv, read_csv_inferred, read_survey, write_parquet
from cohortlens.schema import safe_col
from tests.conftest import COHORT, SMALL_SF, survey_rows

HEADER = ",".join(SURVEY_SCHEMA.fieldNames())
# Quoted commas and quotes, empty fields, a short line, a field that is no number.
LINES = [
    '21,Female,33,"Lake, North","Tutor, B",1.5,,7.25,2,3,"2-4 hours",Mixed,PhD,No,8,1,Yes,0',
    "22,Male,,Hill,,0,0,,,,More than 8 hours,,,,,,,1",
    "23,Male,50,Hill",
    "24,Female,old,Hill,Nurse,1,2,3,4,5,1-3 hours,Mixed,MSc,No,6,7,No,1",
]


def _csv(tmp):
    path = os.path.join(tmp, "survey.csv")
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *LINES]) + "\n")
    return path


def test_csv_declared_and_inferred(spark):
    tmp = tempfile.mkdtemp(prefix="cohortlens-csv-")
    df = read_csv(spark, _csv(tmp))
    assert df.schema == SURVEY_SCHEMA
    r = {x["id"]: x for x in df.collect()}
    assert (r[21]["City"], r[21]["Profession"], r[21]["Work Pressure"]) == ("Lake, North", "Tutor, B", None)
    assert (r[22]["Age"], r[23]["CGPA"], r[24]["Age"]) == (None, None, None)
    assert [x["Sleep Duration"] for x in clean_survey(df).collect()] == [3.0]
    inferred = read_csv(spark, _csv(tmp), schema=None)
    assert inferred.columns == SURVEY_SCHEMA.fieldNames()
    assert (dict(inferred.dtypes)["id"], dict(inferred.dtypes)["Age"]) == ("int", "string")


def test_inferred_schema_is_kept(spark, tmp_path):
    """More data keeps the stored types, or raises by column name; nulls and narrower values fit."""
    stored = str(tmp_path / "schema" / "columns.json")

    def read(*lines):
        path = tmp_path / f"{abs(hash(lines))}.csv"
        path.write_text("\n".join(["id,when,x", *lines]) + "\n")
        return read_csv_inferred(spark, str(path), stored)

    first = read("1,2020-01-01,1.5", "2,2020-01-02,2")
    kinds = first.dtypes
    assert kinds == [("id", "int"), ("when", "date"), ("x", "double")]
    assert read("7,,3", "8,,4").dtypes == kinds and read(",,", "3,2021-05-05,").dtypes == kinds  # x looks like an int, then like text
    assert [r.x for r in read("7,,3").collect()] == [3.0]
    with pytest.raises(ValueError, match=r"id \(1 not int\), x \(2 not double\)"):
        read("5000000000,2020-01-01,a", "6,2020-01-01,b", "7,2020-01-01,1")
    other = tmp_path / "other.csv"
    other.write_text("id,x\n1,2\n")
    with pytest.raises(ValueError, match="not the stored ones"):
        read_csv_inferred(spark, str(other), stored)


def test_large_ids_survive_csv(spark, monkeypatch):
    """The declared-CSV query keeps ids that need a bigint."""
    from cohortlens.plans import catalog

    big = survey_rows(spark, COHORT).withColumn("id", safe_col("id") + (1 << 40))
    monkeypatch.setattr(catalog, "survey", lambda spark, sf_dir: big)
    assert sorted(r["id"] - (1 << 40) for r in catalog.q_csv_declared(spark, "").collect()) == [11, 12, 13, 14, 15, 16]


def test_partitioned_parquet_roundtrip(spark):
    tmp = tempfile.mkdtemp(prefix="cohortlens-pq-")
    df = survey_rows(spark, [*COHORT[:2], {**COHORT[0], "id": 3, "Gender": None}])
    write_parquet(df, tmp + "/out", partition_by="Gender")
    dirs = sorted(d for d in os.listdir(tmp + "/out") if d.startswith("Gender="))
    assert dirs == ["Gender=Female", "Gender=Male", "Gender=__HIVE_DEFAULT_PARTITION__"]
    back = spark.read.parquet(tmp + "/out")
    assert back.columns[-1] == "Gender"
    assert sorted((r["id"], r["Gender"]) for r in back.collect()) == [(3, None), (11, "Female"), (12, "Male")]


def test_survey_job_writes_every_output(spark):
    out = tempfile.mkdtemp(prefix="cohortlens-job-")
    paths = run_survey_job(read_survey(spark, SMALL_SF), out)
    assert set(paths) == set(OUTPUTS)
    counts = {k: spark.read.parquet(p).count() for k, p in paths.items()}
    cleaned = clean_survey(read_survey(spark, SMALL_SF)).count()
    assert counts["processed"] == counts["features"] == cleaned
    assert counts["academic_performance"] == counts["sleep_performance"] == 3
    assert counts["depression_correlations"] <= 5
    assert counts["correlation_matrix"] == 6
    assert counts["profile"] == 18


def test_survey_job_partitioned_outputs(spark):
    out = tempfile.mkdtemp(prefix="cohortlens-job-part-")
    paths = run_survey_job(read_survey(spark, SMALL_SF), out, partition_by="Gender")
    feats = spark.read.parquet(paths["features"])
    assert feats.columns[-1] == "Gender"
    assert sorted(d for d in os.listdir(paths["features"]) if d.startswith("Gender=")) == ["Gender=Female", "Gender=Male"]
    unpartitioned = run_survey_job(read_survey(spark, SMALL_SF), tempfile.mkdtemp(prefix="cohortlens-job-flat-"))
    a = spark.read.parquet(paths["high_risk"])
    b = spark.read.parquet(unpartitioned["high_risk"]).select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    s1 = spark.read.parquet(paths["city_degree_stats"])
    s2 = spark.read.parquet(unpartitioned["city_degree_stats"])
    assert s1.exceptAll(s2).count() == 0 and s2.exceptAll(s1).count() == 0


def test_stopped_job_shows_old_results_and_goes_on(spark, monkeypatch):
    """A run that dies between two outputs changes nothing; the next one reads its finished steps and publishes."""
    from cohortlens.plans import survey_job

    root = tempfile.mkdtemp(prefix="cohortlens-job-stop-")
    raw = survey_rows(spark, COHORT)
    old = run_survey_job(raw, root)
    assert published(spark, root) == old

    def fail(*_):
        raise RuntimeError("lost")

    more = raw.unionByName(raw.withColumn("id", safe_col("id") + 100))
    with monkeypatch.context() as m:
        m.setattr(survey_job, "correlation_pairs", fail)
        with pytest.raises(RuntimeError):
            run_survey_job(more, root, run_id="second")
    assert published(spark, root) == old and spark.read.parquet(published(spark, root)["processed"]).count() == 6

    with monkeypatch.context() as m:  # the finished steps are not done again
        for name in ("clean_survey", "quality_profile", "value_counts", "combined_summaries", "distinct_categories"):
            m.setattr(survey_job, name, fail)
        new = run_survey_job(more, root, run_id="second")
    assert published(spark, root) == new != old
    assert {k: spark.read.parquet(p).count() for k, p in new.items()}["high_risk"] == 6
    assert spark.read.parquet(new["features"]).count() == 12
    flat = run_survey_job(more, tempfile.mkdtemp(prefix="cohortlens-job-flat-"))
    for name, path in new.items():
        a, b = (
            df.select(*[F.round(safe_col(c), 9) if t == "double" else safe_col(c) for c, t in df.dtypes])
            for df in (spark.read.parquet(path), spark.read.parquet(flat[name]))
        )
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, name

    first = old["processed"].split("/")[-2]
    assert drop_old_runs(spark, root) == [first] and published(spark, root) == new
    assert sorted(os.listdir(f"{root}/runs")) == ["second"]
    with pytest.raises(FileNotFoundError):
        published(spark, tempfile.mkdtemp(prefix="cohortlens-none-"))


def test_job_runs_the_steps_that_are_wanted(spark):
    root = tempfile.mkdtemp(prefix="cohortlens-job-some-")
    paths = run_survey_job(survey_rows(spark, COHORT), root, outputs=["depression_correlations"])
    assert list(paths) == ["depression_correlations"] and published(spark, root) == paths
    steps = os.listdir(f"{root}/runs/{os.listdir(root + '/runs')[0]}/_steps")
    done = {s.removesuffix(".json") for s in steps if not s.startswith(".")}
    assert done == {"processed", "categories", "features", "correlation_matrix", "depression_correlations", "published"}
    with pytest.raises(ValueError):
        run_survey_job(survey_rows(spark, COHORT), root, outputs=["nothing"])


def test_ranges_observed_while_writing(spark, tmp_path):
    """Scaling by observed ranges gives what the extra pass gives, from one scan; also without rows, with nulls and NaN."""
    rows = spark.range(100).selectExpr(
        "id", "CAST(id % 7 AS DOUBLE) AS a", "CAST(NULL AS INT) AS b", "2 AS c", "CASE WHEN id = 3 THEN DOUBLE('NaN') ELSE id END AS d"
    )
    for k, df in enumerate((rows, rows.where("id < 0"))):
        ranges = ObservedRanges(["a", "b", "c", "d"])
        write_parquet(ranges.watch(df), str(tmp_path / f"t{k}"))
        table = spark.read.parquet(str(tmp_path / f"t{k}"))
        found = json.loads(json.dumps(ranges.get()))
        one = minmax_scale(table, ["a", "b", "c", "d"], ranges=found)
        two = minmax_scale(table, ["a", "b", "c", "d"])
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Subquery" not in plan and "Aggregate" not in plan


def test_partitioned_write_by_weight(spark, tmp_path):
    """A value with most of the rows gives files of like size, each of many rare ones and null a single file."""
    df = spark.range(36_000).selectExpr(
        "id", "CASE WHEN id < 30000 THEN 'hot' WHEN id % 200 = 7 THEN NULL ELSE concat('v', id % 200) END AS k", "id % 3 AS `k 2`"
    )
    write_parquet(df.repartition(9), str(tmp_path / "out"), partition_by="k", rows_per_file=2000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 36_000 and back.select("id").distinct().count() == 36_000
    files = {d.name: [f for f in d.iterdir() if f.name.endswith(".parquet")] for d in (tmp_path / "out").iterdir() if d.is_dir()}
    assert len(files) == 201 and all(len(f) == 1 for d, f in files.items() if d != "k=hot")
    sizes = [spark.read.parquet(str(f)).count() for f in files["k=hot"]]
    assert sum(sizes) == 30_000 and max(sizes) <= 2000 and 15 <= len(sizes) <= 24
    write_parquet(df.limit(0), str(tmp_path / "none"), partition_by=["k", "k 2"], rows_per_file=10)
    write_parquet(df, str(tmp_path / "two"), partition_by=["k", "k 2"], rows_per_file=1000)
    assert spark.read.parquet(str(tmp_path / "two")).where("k = 'hot'").count() == 30_000


def test_write_outputs_and_preview(spark):
    from cohortlens.sources import preview, write_outputs

    tmp = tempfile.mkdtemp(prefix="cohortlens-outs-")
    df = survey_rows(spark, COHORT[:3])
    paths = write_outputs({"a": df, "nested/b": df.select("id")}, tmp)
    assert set(paths) == {"a", "nested/b"}
    assert spark.read.parquet(paths["nested/b"]).count() == 3
    first = preview(df, 2, order_by=["id"]).collect()
    assert [r["id"] for r in first] == [11, 12]
    assert [r["id"] for r in preview(df, 2, order_by=[df["id"].desc()]).collect()] == [13, 12]


def test_job_keeps_digit_like_partition_values(spark):
    rows = [{**r, "Degree": f"0{i}"} for i, r in enumerate(COHORT)]
    out = tempfile.mkdtemp(prefix="cohortlens-job-digits-")
    paths = run_survey_job(survey_rows(spark, rows), out, partition_by="Degree")
    pairs = spark.read.parquet(paths["correlation_matrix"])
    assert "Degree" not in {x for r in pairs.collect() for x in r[:2]} and pairs.count() == 10
    stats = spark.read.parquet(paths["city_degree_stats"])
    assert sorted(r["Degree"] for r in stats.collect()) == ["00", "01", "02", "03", "04", "05"]


def test_partitioned_write_with_few_files(spark):
    tmp = tempfile.mkdtemp(prefix="cohortlens-few-")
    df = spark.range(4000).selectExpr("id", "id % 3 AS k").repartition(16)
    write_parquet(df, tmp + "/out", partition_by="k", tasks_per_value=2)
    assert spark.read.parquet(tmp + "/out").count() == 4000
    for d in (f"{tmp}/out/k={k}" for k in range(3)):
        assert 1 <= len([f for f in os.listdir(d) if f.endswith(".parquet")]) <= 2


@pytest.mark.parametrize("master, ships", [("local[4]", False), ("local", False), ("local-cluster[2,1,512]", True), ("spark://host:7077", True), ("yarn", True)])
def test_package_goes_to_executors_of_a_cluster(monkeypatch, master, ships):
    """Also when the driver runs in the repository's folder; once a session."""
    from types import SimpleNamespace

    from cohortlens import session

    sent = []
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", addPyFile=sent.append)
    monkeypatch.chdir(session._ROOT)
    for _ in range(2):
        session.ship_package(SimpleNamespace(sparkContext=context))
    assert len(sent) == int(ships)
    if ships:
        import zipfile

        assert "cohortlens/operators/correlate.py" in zipfile.ZipFile(sent[0]).namelist()


def test_scratch_tables_can_be_dropped(spark, monkeypatch):
    """Only those of this session, and only what it made; others in the folder stay."""
    from cohortlens import session
    from cohortlens.sources import materialize

    monkeypatch.setattr(session, "_scratch", {})
    root = session.checkpoint_root(spark).removeprefix("file:")
    write_parquet(spark.range(3), f"{root}/not-ours")
    table = materialize(spark.range(5), "some")
    assert table.count() == 5 and [d for d in os.listdir(root) if d.startswith("some-")]
    session.scratch_path(spark, "never-written")
    assert session.drop_scratch(spark) == 1 and session.drop_scratch(spark) == 0
    assert not [d for d in os.listdir(root) if d.startswith("some-")] and "not-ours" in os.listdir(root)
