"""A program that has the package on its own path alone, run from another folder."""

import subprocess
import sys
from pathlib import Path

PROGRAM = """
import sys
sys.path.insert(0, {repo!r})
from tierlake.session import build_session
from tierlake.sources.landing import ingest_files

spark = build_session(master="local[2]", spark__sql__shuffle__partitions="2")
with open("cells.csv", "w") as f:
    f.write('a,b\\n1,"x\\ny"\\n2,z\\n')
landed = ingest_files(spark, "lake", "cells", source="pos", paths=["cells.csv"])
print("landed", spark.read.parquet("lake/bronze/cells").count())
"""


def test_files_land_from_a_folder_without_the_package(tmp_path, monkeypatch):
    monkeypatch.delenv("PYTHONPATH", raising=False)
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "landed 2" in done.stdout, done.stderr[-2000:]
