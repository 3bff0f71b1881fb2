"""A full copy of silver is cut into tasks that fit in memory."""

from noticehouse.session import empty
from noticehouse.sources.store import Store


def test_a_task_of_a_copy_sorts_few_rows(spark, spec, tmp_path):
    """Rows are some 2.5 KB, so a million of them are too many for one task."""
    store = Store(spark, str(tmp_path / "copied"), spec)
    store.copy(empty(spark, store._stored), 0, rows=1 << 20)
    assert (1 << 20) / store.ledger().buckets(0) <= 150_000
