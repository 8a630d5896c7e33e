import pytest
from conftest import SMALL, assert_same

from talespan.llm.oracles import ORACLES
from talespan.llm.queries import QUERIES

COLUMNS = {
    "p1_found": "transcript_id bigint, segment_idx int, uri string", "p2_found": "transcript_id bigint, segment_idx int, survivor_id bigint, score_id bigint, evidence_id bigint",
    "p4_found": "transcript_id bigint, first_idx int, last_idx int, n_captions int, duration_ms bigint",
    "p6_found": "transcript_id bigint, tape_no int, turn_no int, speaker_no int, first_idx int, last_idx int, n_words int", "p7_ids": "doc_id bigint, ids array<int>",
    "p9_found": "doc_id bigint, start_pos int, end_pos int, pii_type string"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    if name in COLUMNS:
        assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[name]
    if name in ORACLES:
        assert_same(df, duck, ORACLES[name])
    else:
        assert df.count() > 0


def test_entry_adds_them():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(__file__).parent.parent.parent / "talespan"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "talespan.llm" in p.read_text()]
