
from support import values_df
from numprof.operators.profile import profile
from numprof.sources.files import read_results
from numprof.streaming.files import profile_files_stream


def test_files_stream_one_job_per_file(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "001.csv").write_text("1.0\n2.0\n3.0\n")
    (src / "b.csv").write_text("10.0\nabc\n30.0\n")
    (src / "b.txt").write_text("7.0\n")
    (src / "x y+z%.csv").write_text("8.0\n")
    out = str(tmp_path / "out")
    q = profile_files_stream(spark, str(src), out, kind="dataframe",
                             checkpoint_location=str(tmp_path / "ck"), available_now=True,
                             max_files_per_trigger=1)
    q.awaitTermination(120)
    got = {r["job_id"]: r for r in read_results(spark, out).collect()}
    assert set(got) == {"001.csv", "b.csv", "b.txt", "x y+z%.csv"}
    assert got["001.csv"]["record_count"] == 3 and got["001.csv"]["avg_value"] == 2.0
    assert got["b.csv"]["record_count"] == 2
    assert sum(c["count"] for c in got["b.csv"]["category_list"]) == 3


def test_rdd_kind_stream_drops_bad_lines(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "j.txt").write_text("1.0\nnan\n3.0\n")
    out = str(tmp_path / "out")
    q = profile_files_stream(spark, str(src), out, kind="rdd",
                             checkpoint_location=str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(120)
    r = read_results(spark, out).collect()[0]
    assert r["job_id"] == "j.txt" and r["record_count"] == 2 and r["processing_type"] == "RDD"
    assert r["category_map"]["medium"]["count"] == 2


def test_profile_runs_on_a_streaming_frame(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    values_df(spark, [1.0, 2.0, 4.0]).write.parquet(str(src / "p"))
    stream = spark.readStream.schema("value double").parquet(str(src / "p"))
    q = (profile(stream, "value").writeStream.outputMode("complete").format("memory")
         .queryName("numprof_running_profile").start())
    q.processAllAvailable()
    q.stop()
    r = spark.sql("SELECT * FROM numprof_running_profile").collect()[0]
    assert r["record_count"] == 3 and abs(r["avg_value"] - 7 / 3) < 1e-12
