import gzip
import hashlib

from llm_helpers import rows_of

from tickloom.llm import warc

PAGES = "page_id long, url string, html string"


def brute(pages):
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == data and p is not None]
        first = max(same) if same and len([p for p, _, h in pages if (h or "").encode() == data]) > 1 else None
        revisit = len(data) >= 1000 and first is not None and page_id != first
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


LONG = "é<p>" * 400
CASES = [(1, "http://a/", LONG), (5, "http://b/", LONG), (3, None, LONG), (None, "http://n/", LONG), (7, "http://c/\r\nX: y", "short"),
         (8, "http://d/", "short"), (9, "http://e/", None), (10, "http://f/", ""), (11, "http://g/", "x" * 300_000),
         (5, "http://b/", LONG), (12, "http://h/", "a\r\n\r\nWARC/1.1\r\n" * 90)]


def test_round_trip(spark):
    got = warc.round_trip(spark.createDataFrame(CASES, PAGES).repartition(3))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(got) == brute(CASES)


def test_only_nulls_share_a_payload(spark):
    rows = [(None, None, LONG), (None, None, LONG)]
    assert [r.record_type for r in warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()] == ["response"] * 2


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_selected_records_and_extra_columns(spark):
    df = spark.createDataFrame([(i, f"http://x/{i}", "z" * i, "f", 0) for i in range(200)], PAGES + ", file string, offset int")
    index = warc.write_warc(warc.with_record_type(df))
    chosen = index.where("page_id % 7 = 3")
    got = {r.page_id: bytes(r.payload) for r in warc.read_warc(chosen, max_gap=0).collect()}
    assert got == {i: b"z" * i for i in range(200) if i % 7 == 3}


def test_files_are_gzip_members_named_by_the_index(spark):
    index = warc.write_warc(warc.with_record_type(spark.createDataFrame(CASES, PAGES).coalesce(1))).collect()
    assert len({r.file for r in index}) == 1
    plain = gzip.decompress(open(index[0].file.removeprefix("file:"), "rb").read())
    assert plain.count(b"WARC-Record-ID: ") == len(CASES)


def test_coalescing():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("a", 46, 100), ("b", 0, 3)]
    assert list(warc.coalesce(ranges, 10, 1000)) == [(0, 2, 15), (2, 4, 146), (4, 5, 3)]
    assert list(warc.coalesce(ranges, 100, 50)) == [(0, 3, 45), (3, 4, 146), (4, 5, 3)]
    assert list(warc.coalesce([], 1, 1)) == []
