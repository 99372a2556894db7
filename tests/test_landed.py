"""Files landed by tasks under the names they are given."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from dayfolio.workload.landed import land


def test_files_carry_their_names_and_lines(spark):
    rows = [(f"n{i}=100%.txt", f"text {i}") for i in range(50)] + [("n0=100%.txt", "more"), ("none.txt", None)]
    folder = Path(land(spark.createDataFrame(rows, "n string, t string"), "landed", F.col("n"), F.col("t")).removeprefix("file:"))
    assert {f.name for f in folder.iterdir()} == {n for n, _ in rows}
    assert sorted((folder / "n0=100%.txt").read_text().splitlines()) == ["more", "text 0"] and (folder / "none.txt").read_text() == "\n"
    assert (folder / "n7=100%.txt").read_text() == "text 7\n" and not list((folder.parent / "written").iterdir())
