import json
import os

import pytest

from knnrec.apps import main
from tests.fixtures import TINY


def _write(path, rows, sep):
    with open(path, "w") as fh:
        fh.write(f"user{sep}item{sep}rating{sep}ts\n")
        for u, i, r in rows:
            fh.write(f"{u + 1}{sep}{i + 1}{sep}{r}{sep}0\n")


def _read(spark, folder):
    return spark.read.json(folder).first()


@pytest.mark.parametrize("app", ["exact", "approximate"])
def test_knn_app_on_text_files(spark, tmp_path, app):
    train, test = str(tmp_path / "train.txt"), str(tmp_path / "test.txt")
    _write(train, TINY + TINY[:3], "::")  # repeated lines: averaged
    _write(test, [(3, 1, 5.0), (4, 3, 5.0), (4, 2, 3.0)], "::")
    out = str(tmp_path / "out")
    args = [app, "--train", train, "--test", test, "--json", out, "--k", "2", "--sep", "::",
            "--sims", "2:3,2:4,1:1", "--predict", "4:2"]
    if app == "approximate":
        args += ["--partitions", "3", "--replication", "3", "--persist", "checkpoint"]
    main(args)
    row = _read(spark, out)
    # ids are 1-based on the command line: 2:3 is the pair (1, 2) of TINY
    assert row.similarities["2:3"] == pytest.approx(0.5)
    assert row.similarities["1:1"] == 0.0
    assert row.predictions["4:2"] == pytest.approx(5.0)
    assert row.mae == pytest.approx(0.0) and row.n_test == 3

