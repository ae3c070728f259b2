"""The driver's entry points, with and without the corpus package."""

import subprocess
import sys

from tests.conftest import ROOT


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_rest_of_the_library_does_not_import_the_corpus_package():
    code = "import sys; sys.modules['lakewright.llm'] = None; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; assert len(e.queries()) > 100 and 'pipeline' not in e.queries() and 'op1_html_extraction' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
