"""Rows that meet the account dictionary carry numbers, not the raw texts."""

import pytest

from ledgerline.operators.encode import ENCODED_COLUMNS, encode_transactions


@pytest.mark.parametrize("on_error", ["failfast", "null", "quarantine"])
def test_texts_are_parsed_below_the_account_lookups(spark, raw, on_error):
    """a lookup that shuffles moves parsed rows."""
    t, n = raw
    e = encode_transactions(t, index_offset=0, n_rows=n, on_error=on_error, keep=["row_id", "Account"])[0]
    assert e.columns == [*ENCODED_COLUMNS, "batch_id", "row_id", "Account"]
    above = e._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert not [x for x in ("Timestamp#", "Amount Paid#", "Amount Received#", "Is Laundering#") if f"({x}" in above or "cast(" in above]
    assert e.where("From_ID is null or To_ID is null or row_id <> Index").isEmpty() and e.count() == n
