"""Helpers that test modules import; fixtures are in conftest.py."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def values_df(spark, values, name="value"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def lines_file(tmp_path, lines, name="in.txt"):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)
