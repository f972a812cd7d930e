"""Wide rows go to Python in small batches."""

import pyarrow as pa

from packloom.llm.common import cut, small_batches, written

_ROWS, _BYTES = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])


def test_batches_are_bounded_in_bytes_and_settings_come_back(spark):
    before = [spark.conf.get(k) for k in (_ROWS, _BYTES)]
    wide = spark.range(0, 3000, 1, 2).selectExpr("repeat('ab', 5000) AS text").mapInArrow(_sizes, "n long, bytes long")
    for df in (written(wide, "sizes"), cut(wide)):
        rows = df.collect()
        assert sum(r.n for r in rows) == 3000 and max(r.bytes for r in rows) < 3_000_000
    try:
        with small_batches(spark):
            raise ValueError
    except ValueError:
        pass
    assert [spark.conf.get(k) for k in (_ROWS, _BYTES)] == before
