"""Message texts are stored without trying a dictionary, in tasks that fit in memory."""

import pyarrow.parquet as pq

from noticehouse.sources import messages as msg
from noticehouse.sources.store import Store


def encodings(folder, column):
    (file,) = folder.glob("*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = [group.column(i) for i in range(group.num_columns)]
    return next(c.encodings for c in columns if c.path_in_schema == column)


def test_texts_have_no_dictionary(spark, spec, messages, tmp_path):
    sent = messages(*[{"id": 1}] * 200).coalesce(1)
    msg.write_messages(sent, str(tmp_path / "landing"), "parquet")
    assert not any("DICTIONARY" in e for e in encodings(tmp_path / "landing", "value"))
    store = Store(spark, str(tmp_path / "store"), spec)
    store.put(sent.selectExpr("value as raw_json", "value as rappel_guid"), "bronze", 0)
    bronze = tmp_path / "store" / "bronze" / "seq=0"
    assert not any("DICTIONARY" in e for e in encodings(bronze, "raw_json"))
    assert any("DICTIONARY" in e for e in encodings(bronze, "rappel_guid"))


def test_a_task_reads_few_messages(spark):
    """Packed to an eighth: 128 MB of files are 2 GB of typed rows."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size) <= 32 << 20
