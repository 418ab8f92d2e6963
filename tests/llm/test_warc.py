import hashlib
import io

import zstandard

from tieout.llm.warc import archived, read_record, write_bundles
from tieout.session import scratch_path

PAGES = "page_id long, url string, html string"


def rows():
    big, other = "é" * 600, "x" * 1000
    return [
        (1, "http://a/ü b", big), (2, "http://b", big), (9, "http://c", big), (3, None, other), (4, "http://d", None),
        (5, "http://e", ""), (6, "http://f", "small"), (7, "http://g", "small"), (None, "http://h", big),
        (10, "u", "a\r\n\r\nWARC/1.1\r\n" + "y" * 2000), (11, "u", "z" * 3_000_000), (12, "u", "z" * 3_000_000),
        (12, "u", "z" * 3_000_000), (None, "u", "only" * 500), (None, "u", "only" * 500), (13, "u", "x" * 999),
        (14, "u", "x" * 999),
    ]


def wanted(pages):
    out = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        largest = max(same, default=None) if len(payload) >= 1000 else None
        again = largest is not None and (page_id is None or page_id < largest)
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(),
                    "revisit" if again else "response", largest if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    df = spark.createDataFrame(rows(), PAGES).repartition(3)
    for name in ("digest", "same", "largest", "bundle"):
        df = df.withColumn(name, df["url"])
    got = archived(df).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == wanted(rows())
    assert all(r.intact for r in got)
    assert {r.url for r in got if r.page_id == 1} == {"http://a/ü b"}


def test_any_record_by_its_place(spark):
    folder = "file://" + scratch_path(spark, "warc")
    index = write_bundles(spark.createDataFrame(rows(), PAGES).repartition(2), folder).collect()
    assert len(index) == len(rows())
    for r in index:
        headers, block = read_record(r.bundle, r.frame, r.offset_in_frame)
        assert headers["WARC-Record-ID"] == r.record_id
        assert int(headers["Content-Length"]) == len(block)
    assert max(r.frame for r in index) >= 1
    # a bundle is also an ordinary Zstandard file: the seek table is a frame readers skip
    for bundle in {r.bundle for r in index}:
        data = open(bundle.removeprefix("file://"), "rb").read()
        reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        assert reader.read().count(b"WARC-Record-ID") == sum(r.bundle == bundle for r in index)


def test_empty_table(spark):
    assert archived(spark.createDataFrame([], PAGES)).count() == 0
