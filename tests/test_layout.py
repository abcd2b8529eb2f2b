"""What the driver relies on, and that the core does not need the training-data operators."""

from __future__ import annotations

import re
from pathlib import Path
from types import SimpleNamespace

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_outside_llm_imports_it():
    for path in [*ROOT.glob("*.py"), *(ROOT / "sievework").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" in path.relative_to(ROOT).parts or path.name in ("__spark_entry__.py", "test_layout.py"):
            continue
        assert not re.search(r"^\s*(?:from|import)\s+sievework\.llm", path.read_text(), re.M), path


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark, data):
    df = entry.entry(spark)
    assert df.columns == ["dimension", "value", "n", "ratio"]
    assert df.count() > 0


def test_no_local_checkpoint():
    for path in (ROOT / "sievework").rglob("*.py"):
        assert "localCheckpoint" not in path.read_text(), path


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from sievework.plans.scratch import shared_dir

    session = lambda master, **conf: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)), sparkContext=SimpleNamespace(master=master, getConf=dict))
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("spark://host:7077", spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(session("local[2]")).startswith("file:///")
