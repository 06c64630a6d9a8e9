"""The shared folder: what is kept, what goes, what a failed task leaves."""

import os
import subprocess
import sys

import pytest

from rasterloom.session import scratch, shared_path, written
from rasterloom.sources import storage


def test_scratch_deletes_all_but_what_is_kept(spark):
    with scratch(spark) as keep:
        gone, kept = written(spark.range(3), "gone"), keep(written(spark.range(4), "kept"))
    assert kept.count() == 4
    assert not os.path.exists(gone._written_to.removeprefix("file://"))


def test_scratch_inside_scratch(spark):
    with scratch(spark):
        with scratch(spark) as keep:
            kept = keep(written(spark.range(4), "kept"))
        assert kept.count() == 4
    assert not os.path.exists(kept._written_to.removeprefix("file://"))


def test_a_failed_file_leaves_nothing(spark):
    uri = shared_path(spark, "failed") + "/part"
    with pytest.raises(ValueError):
        with storage.create(uri) as out:
            out.write(b"half")
            raise ValueError
    assert os.listdir(os.path.dirname(uri.removeprefix("file://"))) == []


@pytest.mark.parametrize("missing", ["rasterloom.llm", "corpus_pipeline", "public_tokenizers"])
def test_the_entry_does_without_the_corpus_operators(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
