import argparse
import json

from numprof.__main__ import run


def test_reference_flow_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text("1.0\nabc\n4.0\n")
    (tmp_path / "req.json").write_text(json.dumps({"job_id": "001", "data": [1, 2, 3]}) + "\n")
    res, out = str(tmp_path / "res"), str(tmp_path / "analysis")
    for kind in ("dataframe", "rdd"):
        run(spark, argparse.Namespace(command="profile", input=str(tmp_path / "in.csv"), output_root=res,
                                      job_id="001", kind=kind, cache=False))
    printed = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [p["processing_type"] for p in printed] == ["DataFrame", "RDD"]
    run(spark, argparse.Namespace(command="arrays", requests=str(tmp_path / "req.json"), output_root=res,
                                  engine_layout=False))
    charts = str(tmp_path / "charts")
    run(spark, argparse.Namespace(command="analyze", results_root=res, output_path=out, job_ids=None,
                                  charts=charts))
    series = spark.read.json(charts).collect()
    assert {r["chart"] for r in series} >= {"time_comparison"} and all(r["job_id"] == "001" for r in series)
    rec = spark.read.json(out).collect()
    assert len(rec) == 1 and rec[0]["job_id"] == "001"
    assert rec[0]["gpu_processing"]["status"] == "completed"
    assert rec[0]["gpu_processing"]["processed_count"] == 3
    assert rec[0]["spark_comparison"]["faster_method"] in ("RDD", "DataFrame")
