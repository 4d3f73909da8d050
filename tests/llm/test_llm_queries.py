"""The registered corpus queries against their SQL twins, value by value."""

import pytest
from compare import duck, mismatch

from wattline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, small, name):
    assert mismatch(QUERIES[name](spark, small), duck(small), ORACLES[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == {
        "op6_sentence_pieces",
        "op7_token_files",
        "op8_quality",
        "op11_language",
        "op13_token_alignment",
    }
