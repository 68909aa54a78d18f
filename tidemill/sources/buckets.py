"""Tables kept in buckets of a key, so that joins and sums by it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def land_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Append rows to a table of ``buckets`` files' worth of ``key``, sorted by it.

    The table is in the session's catalog and its files are in ``path``. Rows are dealt to
    their bucket before the write, so that a bucket gains one file and not one for each
    task. Tables that shall meet without a shuffle take the same number of buckets; choose
    it by the size a bucket will have, as all later readers split the table by it.
    """
    dealt = rows.repartition(buckets, key)
    dealt.write.mode("append").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)

