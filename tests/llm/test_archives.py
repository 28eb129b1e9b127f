"""WARC archives: round trips, revisits, odd payloads."""

from hashlib import sha1

from pyspark.sql import functions as F

from tallyweek.llm import queries, warc


def _written(spark, tmp_path, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("row", F.lit(1)).withColumn("digest", F.lit("x"))
    pages.repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    return queries.op1_warc_assembly(spark, str(tmp_path)).collect()


def test_payloads_and_revisits_come_back(spark, tmp_path):
    big, odd = "é" * 700, "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nüb"
    rows = [(1, "http://a.example/x", big), (2, "http://b.example/\r\ny", big), (3, None, odd), (4, "u", None), (5, "u", ""), (6, "::not a url::", odd), (7, "u", "x" * 300_000), (None, "u", big), (2, "u", big)]
    got = _written(spark, tmp_path, rows)
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        assert (page, len(data), sha1(data).hexdigest()) in {(r.page_id, r.payload_bytes, r.payload_digest) for r in got}
    big_rows = [r for r in got if r.payload_bytes == 1400]
    assert sorted(r.record_type for r in big_rows) == ["response"] + ["revisit"] * 3
    assert {r.page_id for r in big_rows if r.record_type == "response"} == {2}
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {2}
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 1000)


def test_empty_table(spark, tmp_path):
    assert _written(spark, tmp_path, []) == []


def test_one_nested_row_per_capture(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i}.example/", f"<p>{i}") for i in range(9)], "page_id bigint, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/archive")
    got = warc.assemble(warc.read_records(spark, f"{tmp_path}/archive")).collect()
    assert len(got) == 9
    for r in got:
        assert len(r.requests) == len(r.metadata) == 1
        i = int(r.metadata[0].page_id)
        assert r.response.uri == r.requests[0].uri == f"http://h{i}.example/"
        assert bytes(r.response.payload).decode() == f"<p>{i}"
        assert r.response.stated_digest == r.response.payload_digest
