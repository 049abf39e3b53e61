"""The entry module imports, and gives its oracle, from any layout of pyspark."""

import os
import subprocess
import sys
import zipfile

import pyspark

from speechlens.functions import lexicon

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_with_pyspark_as_a_zip(tmp_path):
    """pyspark in a zip, far from any jar folder, and no JVM: import, list the
    queries and build every oracle statement."""
    home = os.path.dirname(pyspark.__file__)
    archive = tmp_path / "pyspark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for top, dirs, names in os.walk(home):
            dirs[:] = [d for d in dirs if d not in ("jars", "__pycache__", "bin", "sbin", "data", "examples", "licenses")]
            for n in names:
                if n.endswith((".py", ".json")):
                    full = os.path.join(top, n)
                    z.write(full, os.path.join("pyspark", os.path.relpath(full, home)))
    code = ("import pyspark, __spark_entry__ as e; assert 'pyspark.zip' in pyspark.__file__, pyspark.__file__;"
            "q, o = e.queries(), e.oracle_sql(); assert len(o) >= 42 and set(o) <= set(q); print('imported', len(q))")
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=REPO, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": f"{archive}:{REPO}"})
    assert run.returncode == 0, run.stderr[-2000:]
    assert "imported" in run.stdout


def test_packaged_stop_words_are_sparks(spark):
    for lang in lexicon.DEFAULT_LANGUAGES:
        assert lexicon.packaged_stop_words(lang) == lexicon.spark_stop_words(lang)


def test_rule_tables_are_filtered_before_their_size_is_checked(spark):
    import pytest

    rows = [("", "", 0)] + [(f"x{i}", "", 1) for i in range(1500)]
    df = spark.createDataFrame(rows, "suffix string, replacement string, min_len int")
    with pytest.raises(ValueError):
        lexicon.as_rule_list(df)
    ok = spark.createDataFrame(rows[:900], "suffix string, replacement string, min_len int")
    assert len(lexicon.as_rule_list(ok)) == 899
