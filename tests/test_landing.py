"""Landing folders of text messages."""

from noticehouse.sources import messages as msg


def test_landed_text_may_be_compressed(spark, messages, tmp_path):
    landing = tmp_path / "landing"
    texts = messages({"id": 1}, "broken", {"id": 2})
    msg.write_messages(texts, str(landing), "text", compression="gzip")
    assert list(landing.glob("*.txt.gz")) and not list(landing.glob("*.txt"))
    assert sorted(spark.read.text(str(landing)).collect()) == sorted(texts.collect())
