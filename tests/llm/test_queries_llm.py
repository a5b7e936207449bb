"""Every corpus query on the smallest tables: against its SQL, else its shape."""

import pytest

pytest.importorskip("areastats.llm")

import __spark_entry__ as entry_module  # noqa: E402
from areastats.llm import queries  # noqa: E402
from compare import connect, difference  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_against_sql(spark, con, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), con, queries.CHECKS[name]) is None


@pytest.mark.parametrize("name", ["op2_pii_boosting", "op4_toxicity", "op7_language_bayes", "op10_quality_rules"])
def test_one_row_per_document(spark, con, name):
    found = sorted(r["doc_id"] for r in queries.QUERIES[name](spark, SF_DIR).collect())
    assert found == [r[0] for r in con.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(entry_module.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert "pipeline" in entry_module.queries()
