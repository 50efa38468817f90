"""Source checks for traps that compile but misbehave."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parents[1] / "eventlake"


def sources():
    """The library without the optional training-data subpackage, which has its own style rules."""
    return [p for p in PKG.rglob("*.py") if "llm" not in p.relative_to(PKG).parts]


def test_no_python_identity_on_columns():
    # `col(x) is True` is Python identity, not a Column comparison
    pat = re.compile(r"\)\s+is\s+(True|False)\b")
    hits = [f"{p}:{i}" for p in sources() for i, line in enumerate(p.read_text().splitlines(), 1)
            if pat.search(line)]
    assert hits == []


def test_no_driver_collect_or_local_checkpoint_in_library():
    bad = re.compile(r"\.(collect|toPandas|localCheckpoint)\(")
    hits = [f"{p}:{i}" for p in sources() for i, line in enumerate(p.read_text().splitlines(), 1)
            if bad.search(line)]
    assert hits == []


def test_no_python_udfs_in_library():
    bad = re.compile(r"\b(udf|pandas_udf|mapInPandas|applyInPandas)\b|\.rdd\b")
    hits = [f"{p}:{i}" for p in sources() for i, line in enumerate(p.read_text().splitlines(), 1)
            if bad.search(line)]
    assert hits == []


def test_library_does_not_import_the_optional_subpackage():
    pat = re.compile(r"^\s*(from|import)\s+(eventlake\.llm|corpus_pipeline)")
    assert [str(p) for p in sources() for line in p.read_text().splitlines() if pat.search(line)] == []


def test_entry_loads_from_a_path():
    import importlib.util
    import subprocess
    import sys

    entry = PKG.parent / "__spark_entry__.py"
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', %r); m = u.module_from_spec(s); "
            "s.loader.exec_module(m); print(len(m.oracle_sql()))" % str(entry))
    out = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.strip()) >= 50
    assert importlib.util.find_spec("pyspark") is not None
